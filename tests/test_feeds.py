import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas as S
from tallyline.plans import ingest
from tallyline.sinks.keyed_table import KeyedTable
from tallyline.sinks.run_log import Counts, RunLog
from tallyline.sources import documents
from tallyline.sources.landing import Window, loader_season, scan_window
from tallyline.sources.tables import jdbc_options, read_table
from tallyline.streaming import landing as stream
from tallyline.workspace import fresh_dir, pinned, shared_root


def lines(spark, *docs):
    return spark.createDataFrame([(d if isinstance(d, str) else json.dumps(d),) for d in docs], "value string")


def match(mid, score=(2, 1), status="FINISHED", **extra):
    full = None if score is None else {"home": score[0], "away": score[1]}
    return {
        "id": mid, "competition": {"id": 9}, "season": {"id": 77}, "utcDate": "2024-08-16T19:00:00Z",
        "status": status, "matchday": 1, "homeTeam": {"id": 1, "name": "A"}, "awayTeam": {"id": 2, "name": "B"},
        "score": {"winner": None, "fullTime": full, "halfTime": None}, **extra,
    }


def test_matches(spark):
    docs = lines(spark, {"matches": [match(1), match(2, None, "SCHEDULED", odd={"venue": "X"})]}, {"matches": []})
    rows = {r.id: r for r in documents.matches(docs).collect()}
    assert (rows[1].home_score_full_time, rows[1].away_score_full_time, rows[1].home_score_half_time) == (2, 1, None)
    assert rows[1].utc_date == dt.datetime(2024, 8, 16, 19) and rows[1].season_id == 77
    assert rows[2].home_score_full_time is None and rows[2].home_team_name == "A"
    assert json.loads(rows[2].raw_payload) == match(2, None, "SCHEDULED", odd={"venue": "X"})


def test_time_zone_of_the_session_does_not_matter(spark):
    docs = lines(spark, {"matches": [match(1)]})
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        assert documents.matches(docs).first().utc_date == dt.datetime(2024, 8, 16, 19)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_bad_records_are_kept_apart(spark):
    docs = lines(spark, {"matches": [match(1), {"id": "x"}, {"status": "FINISHED"}]}, '{"matches": [', "not json")
    assert [r.id for r in documents.matches(docs).collect()] == [1]
    bad = documents.rejected("matches", docs).collect()
    assert sorted((r.level, r.record) for r in bad) == [
        ("document", "not json"), ("document", '{"matches": ['),
        ("entry", '{"id":"x"}'), ("entry", '{"status":"FINISHED"}'),
    ]


def test_bad_score_does_not_lose_the_match(spark):
    broken = match(5)
    broken["score"]["fullTime"]["home"] = "two"
    row = documents.matches(lines(spark, {"matches": [broken]})).first()
    assert row.id == 5 and row.home_score_full_time is None and row.status == "FINISHED"


def test_matches_read_for_some_columns_are_the_same(spark):
    broken = match(5)
    broken["score"]["fullTime"]["home"] = "two"
    docs = lines(
        spark, {"matches": [match(1), broken, {"id": "x"}, {"status": "FINISHED"}, match(1), match(7, matchday="z"), "{", 3, None]},
        {"matches": []}, '{"matches": [', "not json", {"matches": "none"}, {"matches": [match(8, None, 4)]},
    )
    all_columns = documents.matches(docs, "value").drop("ingested_at")
    some = documents.matches(docs, "value", columns=("id", "status", "away_score_half_time"))
    assert sorted(map(repr, some.collect())) == sorted(map(repr, all_columns.select(*some.columns).collect()))
    again = documents.whole_matches(documents.matches(docs, "value", columns=("id",)), "value").drop("ingested_at")
    assert again.schema == all_columns.schema
    assert sorted(map(repr, again.collect())) == sorted(map(repr, all_columns.collect()))


def test_competitions_and_teams(spark):
    docs = lines(spark, {"competitions": [{"id": 1, "name": "N", "code": "C", "area": {"name": "Here"}}, {"id": 2}]})
    rows = {r.id: r for r in documents.competitions(docs).collect()}
    assert rows[1].area_name == "Here" and rows[2].area_name is None and rows[2].code is None
    team = {"id": 5, "name": "Spurs", "shortName": "Sp", "tla": "SPU", "area": {"name": "E"}}
    row = documents.teams(lines(spark, {"competition": {"id": 9}, "teams": [team]})).first()
    assert (row.id, row.short_name, row.competition_id, row.area_name) == (5, "Sp", 9, "E")


def test_standings_keep_the_order_of_both_levels(spark):
    def entry(team, position):
        return {"team": {"id": team, "name": f"T{team}"}, "position": position, "points": 1, "goalsFor": 2}

    doc = {
        "competition": {"id": 9}, "season": {"id": 77},
        "standings": [
            {"stage": "REGULAR", "type": "TOTAL", "table": [entry(1, 1), entry(2, 2)]},
            {"stage": "REGULAR", "type": "HOME", "table": [entry(2, 1)]},
        ],
    }
    rows = documents.standings(lines(spark, doc))
    got = sorted((r.table_no, r.row_no, r.type, r.team_id, r.position, r.season_id) for r in rows.collect())
    assert got == [(0, 0, "TOTAL", 1, 1, 77), (0, 1, "TOTAL", 2, 2, 77), (1, 0, "HOME", 2, 1, 77)]
    assert documents.standings(lines(spark, doc), "TOTAL").count() == 2


def test_standings_faults_at_every_level(spark):
    good = {"team": {"id": 4, "name": "T"}, "position": 2}
    docs = lines(
        spark, "no json", {"standings": "none"}, {"season": {"id": 5}}, {"standings": []},
        {"standings": [{"type": "A"}, {"type": "B", "table": []}, {"type": "C", "table": [good, {"position": 1}, "x", good]}]},
        {"standings": [{"type": "D", "table": 7}, {"type": "E", "table": [good]}]},
    )
    read = documents.classified_standings(docs)
    assert sorted((r.level, r.record) for r in documents.rejected_records(read).collect()) == [
        ("document", "no json"), ("document", '{"standings": "none"}'), ("entry", "x"), ("entry", '{"position":1}'),
        ("table", '{"type":"A"}'), ("table", '{"type":"D","table":7}'),
    ]
    assert sorted(r.type for r in documents.standings(docs).collect()) == ["C", "C", "E"]
    assert documents.standings(docs, "C").count() == 2


def test_run_keeps_rejected_records(spark, tmp_path):
    root = str(tmp_path / "raw")
    docs = {"teams": lines(spark, "broken", {"competition": {"id": 1}, "teams": [{"id": 1, "name": "A"}, {"name": "B"}]})}
    (entry,) = ingest.ingest(docs, root, 7).entries().collect()
    assert (entry.records_ingested, entry.records_rejected) == (1, 2)
    kept = sorted((r.level, r.record, r.version) for r in ingest.rejected(spark, root, "teams").collect())
    assert kept == [("document", "broken", 7), ("entry", '{"name":"B"}', 7)]
    assert ingest.rejected(spark, root, "matches").count() == 0


def test_players_tolerate_bad_birthdays(spark):
    squad = [
        {"id": 1, "name": "P", "dateOfBirth": "1999-02-03", "shirtNumber": 7},
        {"id": 2, "dateOfBirth": "1999-13-03"}, {"id": 3, "dateOfBirth": "soon"}, {"id": 4},
    ]
    rows = {r.id: r for r in documents.players(lines(spark, {"id": 5, "squad": squad})).collect()}
    assert rows[1].date_of_birth == dt.date(1999, 2, 3) and rows[1].team_id == 5 and rows[1].shirt_number == 7
    assert [rows[i].date_of_birth for i in (2, 3, 4)] == [None, None, None]


def test_windows(spark):
    today = dt.date(2025, 7, 20)
    assert loader_season(today) == 2024 and Window.full(today).seasons == (2023, 2024)
    assert Window.incremental(today).date_from == dt.date(2025, 7, 5)
    days = [dt.datetime(2023, 6, 30, 23), dt.datetime(2023, 7, 1), dt.datetime(2025, 7, 4, 23, 59), dt.datetime(2025, 7, 5)]
    frame = spark.createDataFrame([(i, d, "FINISHED") for i, d in enumerate(days)], "id int, utc_date timestamp_ntz, status string")

    def kept(window):
        return [r.id for r in scan_window(frame, window).collect()]

    assert kept(Window.incremental(today)) == [3]
    assert kept(Window.full(today)) == [1]
    assert kept(Window.of_seasons([2022, 2025])) == [0, 2, 3]
    assert kept(Window(date_to=dt.date(2025, 7, 4))) == [0, 1, 2]
    assert kept(Window(status="SCHEDULED")) == [] and kept(Window()) == [0, 1, 2, 3]


def test_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "FINISHED")], "id int, utc_date timestamp_ntz, status string").write.parquet(path)
    plan = scan_window(spark.read.parquet(path), Window(date_from=dt.date(2024, 1, 1), status="FINISHED"))._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters")[1]
    assert "GreaterThanOrEqual(utc_date" in pushed and "EqualTo(s" in pushed


def test_jdbc_reads_are_split():
    options = jdbc_options("jdbc:x", "raw.matches", "id", 1, 1001, 50, user="u")
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "50" and options["user"] == "u"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", "id", 5, 5, 1)


# -- keyed tables ----------------------------------------------------------------------


def report_rows(spark, *rows):
    return spark.createDataFrame(
        [(i, i, f"L{n}", "H", "A", dt.date(2024, 1, 1), 1, text, dt.datetime(2024, 1, n)) for i, n, text in rows],
        S.MATCH_REPORTS,
    )


def test_keyed_table_replaces_only_the_update_columns(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), S.REPORTS)
    assert table.upsert(report_rows(spark, (1, 1, "a"), (2, 1, "b")), 1, ["generated_at"]) == (2, 2)
    assert table.upsert(report_rows(spark, (2, 2, "c"), (2, 3, "d"), (3, 3, "e")), 2, ["generated_at"]) == (3, 2)
    rows = {r.match_id: (r.narrative, r.competition_code, r.generated_at.day) for r in table.current().collect()}
    assert rows == {1: ("a", "L1", 1), 2: ("d", "L1", 3), 3: ("e", "L3", 3)}


def test_replayed_batch_changes_nothing(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), S.REPORTS)
    table.upsert(report_rows(spark, (1, 1, "a")), 1, ["generated_at"])
    second = report_rows(spark, (1, 2, "b"), (4, 2, "z"))
    table.upsert(second, 2, ["generated_at"])
    before = sorted(map(tuple, table.current().collect()))
    table.upsert(second, 2, ["generated_at"])
    assert sorted(map(tuple, table.current().collect())) == before
    table.compact()
    assert sorted(map(tuple, table.current().collect())) == before
    table.upsert(report_rows(spark, (9, 5, "n")), 3, ["generated_at"])
    assert table.current().count() == 3
    table.compact()
    table.compact()
    assert table.current().count() == 3
    with pytest.raises(ValueError):
        table.upsert(second, -1, ["generated_at"])


def test_base_is_not_shuffled_for_a_small_batch(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), S.CHUNKS)
    many = spark.range(50_000).selectExpr(
        "id as report_id", "0 as chunk_index", "uuid() as chunk_text", "array(cast(id as float)) as embedding",
        "cast(null as timestamp_ntz) as created_at",
    )
    table.upsert(many, 0, ["chunk_text"])
    table.compact()
    table.upsert(many.limit(5), 1, ["chunk_text"])
    current = table.current()
    assert current.count() == 50_000
    current.collect()
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftAnti" in plan and "SortMergeJoin" not in plan


def test_update_columns_over_a_base(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "t"), S.REPORTS)
    table.upsert(report_rows(spark, (1, 1, "a"), (2, 1, "b")), 0, ["generated_at"])
    table.compact()
    table.upsert(report_rows(spark, (2, 2, "c"), (3, 2, "e")), 7, ["generated_at"])
    table.upsert(report_rows(spark, (3, 4, "f")), 12, ["generated_at"])
    rows = {r.match_id: (r.narrative, r.competition_code, r.generated_at.day) for r in table.current().collect()}
    assert rows == {1: ("a", "L1", 1), 2: ("c", "L1", 2), 3: ("f", "L2", 4)}


def test_stale_chunks_stay_unless_pruned(spark, tmp_path):
    def chunks(*rows):
        return spark.createDataFrame([(r, i, t, [1.0], None) for r, i, t in rows], S.REPORT_CHUNKS)

    table = KeyedTable(spark, str(tmp_path / "t"), S.CHUNKS)
    table.upsert(chunks((1, 0, "a"), (1, 1, "b"), (2, 0, "x")), 1, ["chunk_text"])
    table.upsert(chunks((1, 0, "c")), 2, ["chunk_text"])
    assert sorted((r.report_id, r.chunk_index, r.chunk_text) for r in table.current().collect()) == [
        (1, 0, "c"), (1, 1, "b"), (2, 0, "x"),
    ]
    pruned = table.pruned("report_id", "chunk_index")
    assert sorted((r.report_id, r.chunk_text) for r in pruned.collect()) == [(1, "c"), (2, "x")]


def season_rows(spark, *rows):
    """(id, season, status) as stored matches."""
    null = [None] * (len(S.RAW_MATCHES.names) - 3)
    named = [(i, season, status, *null) for i, season, status in rows]
    rest = [n for n in S.RAW_MATCHES.names if n not in ("id", "season_id", "status")]
    schema = [S.RAW_MATCHES["id"], S.RAW_MATCHES["season_id"], S.RAW_MATCHES["status"], *(S.RAW_MATCHES[n] for n in rest)]
    return spark.createDataFrame(named, T.StructType(schema))


def test_base_is_split_by_season_and_only_touched_seasons_are_written(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "m"), S.MATCHES)

    def seen(frame):
        return sorted((r.id, r.season_id, r.status) for r in frame.collect())

    table.upsert(season_rows(spark, (1, 10, "a"), (2, 10, "a"), (3, 11, "a"), (4, 12, "a"), (5, None, "a")), 1, ["id"])
    table.compact()
    # 2 changes, 3 moves to another season, 6 is new; season 12 and the rows without a season stay.
    table.upsert(season_rows(spark, (2, 10, "b"), (3, 13, "b"), (6, 13, "b")), 2, ["id"])
    want = [(1, 10, "a"), (2, 10, "b"), (3, 13, "b"), (4, 12, "a"), (6, 13, "b")]
    for _ in range(2):
        assert seen(table.current().filter("season_id IS NOT NULL")) == want
        assert table.current().count() == 6
        for season in (10, 11, 12, 13):
            assert seen(table.current(season)) == [r for r in want if r[1] == season]
        table.compact()
    folds = {p.parent.name: sorted(f.name for f in p.parent.iterdir() if f.is_dir()) for p in (tmp_path / "m" / "base").glob("*/fold=*")}
    assert folds["season_id=12"] == ["fold=1"] and folds["season_id=13"] == ["fold=2"]
    assert folds["season_id=10"] == ["fold=1", "fold=2"]
    files = table.current(12).inputFiles()
    assert files and all("season_id=12" in f for f in files)


def test_stream_on_a_new_checkpoint_leaves_the_base(spark, tmp_path):
    landing = str(tmp_path / "landing")
    table = stream.matches_table(spark, str(tmp_path / "table"))
    for number, docs in enumerate(([match(1), match(2, (0, 0))], [match(2, (4, 0)), match(3)])):
        land(spark, f"{landing}{number}", {"matches": docs})
        feed = stream.landing_stream(spark, f"{landing}{number}")
        stream.ingest_matches(feed, table, str(tmp_path / f"checkpoint{number}")).awaitTermination()
        table.compact()
    got = {r.id: r.home_score_full_time for r in table.current().collect()}
    assert got == {1: 2, 2: 4, 3: 2}
    assert table.stream_version("x", 0) == table.stream_version("x", 0) == 2


def test_run_log_keeps_failures(spark, tmp_path):
    log = RunLog(spark, str(tmp_path / "log"))
    log.run("ingest_teams", "teams", lambda: Counts(5, 4, 1))

    def broken():
        raise ValueError("no feed")

    with pytest.raises(ValueError):
        log.run("ingest_matches", "matches", broken)
    rows = {r.entity_type: (r.records_ingested, r.keys_ingested, r.records_rejected, r.status, r.error_message) for r in log.entries().collect()}
    assert rows == {"teams": (5, 4, 1, "success", None), "matches": (0, 0, 0, "failure", "no feed")}


def test_ingestion_run(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "raw")
    entry = {"team": {"id": 1, "name": "A"}, "position": 1}
    feeds = {
        "competitions": {"competitions": [{"id": 9, "name": "N", "code": "C"}]},
        "teams": {"competition": {"id": 9}, "teams": [{"id": 1, "name": "A"}, {"id": 1, "name": "A2"}]},
        "matches": {"matches": [match(1), match(2, utcDate="2023-01-01T12:00:00Z")]},
        "standings": {"competition": {"id": 9}, "season": {"id": 77}, "standings": [{"type": "TOTAL", "table": [entry]}]},
        "players": {"id": 1, "squad": [{"id": 4, "name": "P"}]},
    }
    for entity, doc in feeds.items():
        land(spark, str(landing / entity), doc)
    docs = ingest.landed(spark, str(landing))
    log = ingest.ingest(docs, root, 1, Window.incremental(dt.date(2024, 8, 20)))
    ingest.ingest(docs, root, 1, Window.incremental(dt.date(2024, 8, 20)))
    lines = {(r.entity_type, r.records_ingested, r.keys_ingested, r.status) for r in log.entries().collect()}
    assert lines == {
        ("competitions", 1, 1, "success"), ("teams", 2, 1, "success"), ("matches", 1, 1, "success"),
        ("standings", 1, 1, "success"), ("players", 1, 1, "success"),
    }
    stored = ingest.tables(spark, root)
    assert log.entries().count() == 10 and [r.id for r in stored["matches"].current().collect()] == [1]
    assert stored["teams"].current().first().name == "A2"


def test_empty_keyed_table(spark, tmp_path):
    assert KeyedTable(spark, str(tmp_path / "none"), S.TEAMS).current().count() == 0


def test_read_table(spark, tmp_path):
    report_rows(spark, (1, 1, "a")).write.parquet(str(tmp_path / "match_reports"))
    assert read_table(spark, str(tmp_path), S.REPORTS).first().narrative == "a"


def test_workspace_uses_the_shared_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert shared_root(spark) == root
    assert fresh_dir(spark, "x").startswith(root) and fresh_dir(spark, "x") != fresh_dir(spark, "x")
    frame = pinned(spark.range(5).withColumn("r", F.rand()))
    assert frame.collect() == frame.collect()
    assert "rand" not in frame._jdf.queryExecution().executedPlan().toString()


# -- streams ---------------------------------------------------------------------------


def land(spark, path, *docs):
    lines(spark, *docs).coalesce(1).write.mode("append").text(path)


def test_stream_equals_batch(spark, tmp_path):
    landing = str(tmp_path / "landing")
    table = stream.matches_table(spark, str(tmp_path / "table"))
    days = [
        [{"matches": [match(1, None, "SCHEDULED"), match(2, (0, 0))]}],
        [{"matches": [match(1, (3, 1)), match(3)]}, "broken"],
        [{"matches": [match(2, (0, 1))]}],
    ]
    for docs in days:
        land(spark, landing, *docs)
        docs = stream.landing_stream(spark, landing)
        query = stream.ingest_matches(docs, table, str(tmp_path / "checkpoint"), str(tmp_path / "bad"))
        query.awaitTermination()
    got = {r.id: (r.status, r.home_score_full_time, r.away_score_full_time) for r in table.current().collect()}
    assert got == {1: ("FINISHED", 3, 1), 2: ("FINISHED", 0, 1), 3: ("FINISHED", 2, 1)}
    assert table.history().count() == 5
    bad = spark.read.parquet(str(tmp_path / "bad")).collect()
    assert [(r.level, r.record, r.version) for r in bad] == [("document", "broken", 1)]
    every = documents.matches(documents.read_landing(spark, landing))
    assert every.select("id").distinct().count() == 3 and every.count() == 5


def test_identical_repeats_are_dropped_and_corrections_pass(spark, tmp_path):
    landing = str(tmp_path / "landing")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    for docs in ([{"matches": [match(1)]}], [{"matches": [match(1), match(2)]}], [{"matches": [match(1, (2, 2))]}]):
        land(spark, landing, *docs)
        rows = documents.matches(stream.landing_stream(spark, landing), "landed_at")
        unique = stream.drop_repeats(rows, "landed_at", "id", "raw_payload")
        stream.run_to_table(unique.select("id", "away_score_full_time"), out, checkpoint)
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(1, 1), (1, 2), (2, 1)]


def test_current_rows_carry_only_what_is_read(spark, tmp_path):
    table = KeyedTable(spark, str(tmp_path / "m"), S.MATCHES)
    table.upsert(season_rows(spark, (1, 10, "a"), (1, 10, "b"), (2, None, "a")), 1, ["status"])
    one = table.current()
    assert sorted((r.id, r.status) for r in one.collect()) == [(1, "b"), (2, "a")]
    assert "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    table.upsert(season_rows(spark, (1, 11, None)), 2, ["id"])
    both = table.current().select("id", "status")
    assert sorted(map(tuple, both.collect())) == [(1, None), (2, "a")]
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "raw_payload" not in plan
    assert sorted((r.id, r.status) for r in table.batch(1).collect()) == [(1, "b"), (2, "a")]


def test_after_gets_the_batch_as_written(spark, tmp_path):
    land(spark, str(tmp_path / "landing"), {"matches": [match(1), match(2), match(1)]}, "broken")
    table, seen = stream.matches_table(spark, str(tmp_path / "table")), []
    feed = stream.landing_stream(spark, str(tmp_path / "landing"))
    after = lambda rows, version: seen.append((version, sorted(r.id for r in rows.collect())))
    stream.ingest_matches(feed, table, str(tmp_path / "checkpoint"), after=after).awaitTermination()
    assert seen == [(0, [1, 2])]


def test_only_late_documents_are_read_for_corrections(spark, tmp_path):
    root, read_times = str(tmp_path), []

    def read(docs):
        read_times.append(docs)
        return documents.matches(docs, "landed_at")

    days = (("2001-02-01", [match(1), match(2)]), ("2001-01-11", [match(1), match(2, (5, 0)), match(2, (5, 0))]))
    for day, matches in days:
        lines(spark, {"matches": matches}).select(F.concat(F.lit(f"{day} "), "value")).write.mode("append").text(f"{root}/landing")
        feed = stream.landing_stream(spark, f"{root}/landing").select(
            F.expr("substring(value, 12)").alias("value"), F.expr("cast(left(value, 10) as timestamp)").alias("landed_at")
        )
        unique = stream.drop_repeats(documents.matches(feed, "landed_at"), "landed_at", "id", "raw_payload")
        stream.run_to_table(unique.select("id", "payload_hash", "landed_at"), f"{root}/out", f"{root}/checkpoint")
        stream.keep_late(
            feed, "landed_at", "id", "raw_payload", f"{root}/out", f"{root}/late", f"{root}/checkpoint-late", read=read
        ).awaitTermination()
    late = spark.read.parquet(f"{root}/late").collect()
    assert [(r.id, r.home_score_full_time) for r in late] == [(2, 5)]
    assert read_times[-1].filter("landed_at >= '2001-01-17'").count() == 0


def test_state_of_repeats_is_not_on_the_heap(spark, tmp_path):
    land(spark, f"{tmp_path}/landing", {"matches": [match(1), match(2)]})
    rows = documents.matches(stream.landing_stream(spark, f"{tmp_path}/landing"), "landed_at")
    unique = stream.drop_repeats(rows, "landed_at", "id", "raw_payload")
    stream.run_to_table(unique.select("id"), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
    files = [p.suffix for p in (tmp_path / "checkpoint" / "state" / "0").rglob("*") if p.is_file()]
    assert ".zip" in files and ".delta" not in files
    assert spark.conf.get(stream.STATE_STORE, None) is None


def test_late_repeats_are_not_read_whole(spark, tmp_path):
    root, kept = str(tmp_path), []

    def whole(rows):
        kept.append(rows)
        return documents.whole_matches(rows, "landed_at", "payload_hash")

    for day, matches in (("2001-02-01", [match(1), match(2)]), ("2001-01-11", [match(1), match(2, (5, 0)), match(2, (5, 0))])):
        lines(spark, {"matches": matches}).select(F.concat(F.lit(f"{day} "), "value")).write.mode("append").text(f"{root}/landing")
        feed = stream.landing_stream(spark, f"{root}/landing").select(
            F.expr("substring(value, 12)").alias("value"), F.expr("cast(left(value, 10) as timestamp)").alias("landed_at")
        )
        unique = stream.drop_repeats(documents.matches(feed, "landed_at", columns=("id",)), "landed_at", "id", "raw_payload")
        stream.run_to_table(unique.select("id", "payload_hash", "landed_at"), f"{root}/out", f"{root}/checkpoint")
        stream.keep_late(
            feed, "landed_at", "id", "raw_payload", f"{root}/out", f"{root}/late", f"{root}/checkpoint-late",
            read=lambda docs: documents.matches(docs, "landed_at", columns=("id",)), whole=whole,
        ).awaitTermination()
        late = spark.read.parquet(f"{root}/late").collect()
        assert [(r.id, r.home_score_full_time, r.home_team_name) for r in late] == ([(2, 5, "A")] if day < "2001-02" else [])
    assert set(kept[-1].columns) == {"landed_at", "id", "raw_payload", "payload_hash"}
