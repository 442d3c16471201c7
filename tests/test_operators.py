import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallyline.operators import filters as on
from tallyline.operators import vector_search
from tallyline.operators.form import block_of, with_form
from tallyline.operators.latest import latest_by_key, upsert
from tallyline.operators.ranking import rank_within, with_group_values
from tallyline.operators.sides import sides_unpivot
from tallyline.operators.topk import top_per_group
from tallyline.operators.vector_search import similar_chunks, top_chunks
from tallyline.plans import adhoc, tools
from tallyline.plans.reports import known_chunks, report_search
from tests.data import MATCH_DICTS, legs


def test_sides_give_two_rows_per_match(matches):
    rows = sides_unpivot(matches).collect()
    assert len(rows) == 2 * len(MATCH_DICTS)
    got = {(r.match_id, r.venue): (r.team_id, r.goals_scored, r.goals_conceded, r.team_result, r.points_earned) for r in rows}
    want = {(l["match_id"], l["venue"]): (l["team_id"], l["gf"], l["ga"], l["team_result"], l["points"]) for l in legs()}
    assert got == want


def test_sides_read_the_matches_once(matches, spark, tmp_path):
    matches.write.parquet(str(tmp_path / "m"))
    plan = sides_unpivot(spark.read.parquet(str(tmp_path / "m")))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def expected_form():
    by_team = defaultdict(list)
    for leg in legs():
        by_team[leg["team_id"], leg["competition_id"]].append(leg)
    out = {}
    for (team, comp), rows in by_team.items():
        rows.sort(key=lambda l: (l["match_date"], l["match_id"]))
        for i, leg in enumerate(rows):
            form = sum(l["points"] for l in rows[max(0, i - 4) : i + 1])
            out[leg["match_id"], team] = (form, len(rows) - i)
    return out


@pytest.mark.parametrize("grain", ["week", "month", "quarter", "year"])
def test_form_is_the_same_for_any_block(matches, grain):
    sides = sides_unpivot(matches, keep=("match_id", "match_date", "competition_id"))
    rows = with_form(sides, grain=grain).collect()
    got = {(r.match_id, r.team_id): (r.form_points_last5, r.match_recency_rank) for r in rows}
    assert len(rows) == len(got) and got == expected_form()


def long_history(spark, n):
    """A team with a third of all rows over twenty years, many matches of a day."""
    return spark.range(n).select(
        F.col("id").alias("match_id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).cast("long").alias("team_id"),
        F.lit(1).cast("long").alias("competition_id"),
        F.expr("date_add(date'2020-01-01', cast(id * 37 % 7300 div 4 * 4 as int))").alias("match_date"),
        (F.col("id") % 4).cast("int").alias("points_earned"),
    )


def test_one_long_history_is_spread_over_tasks(spark):
    n = 9000
    sides = long_history(spark, n)
    spark.sparkContext.setJobGroup("form-plan", "no job before the sink")
    try:
        formed = with_form(sides)
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("form-plan")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    w = Window.partitionBy("team_id", "competition_id").orderBy("match_date", "match_id")
    whole = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plain = sides.withColumns(
        {
            "form_points_last5": F.sum("points_earned").over(w.rowsBetween(-4, 0)),
            "match_recency_rank": F.count("*").over(whole) - F.row_number().over(w) + 1,
        }
    )
    assert plain.exceptAll(formed.select(plain.columns)).count() == 0 and formed.count() == n
    blocks = sides.groupBy("team_id", block_of(F.col("match_date"))).count()
    assert blocks.agg(F.max("count")).first()[0] < n / 100


def test_form_with_missing_competition(spark):
    sides = spark.createDataFrame(
        [(i, 1, None, None, 3) for i in range(8)],
        "match_id long, team_id long, competition_id long, match_date date, points_earned int",
    )
    rows = with_form(sides).collect()
    assert sorted((r.match_id, r.form_points_last5, r.match_recency_rank) for r in rows) == [
        (i, 3 * min(i + 1, 5), 8 - i) for i in range(8)
    ]


def test_rank_leaves_gaps_after_ties(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i, rng.randrange(4), rng.randrange(3)) for i in range(80)]
    ranked = rank_within(spark.createDataFrame(rows, "g string, id int, x int, y int"), ["g"], ["x", "y"]).collect()
    assert len(ranked) == 80
    for r in ranked:
        better = sum(1 for g, _, x, y in rows if g == r.g and (x, y) > (r.x, r.y))
        assert r.position == better + 1


def test_group_values_match_null_groups(spark):
    frame = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "g string, x int")
    rows = with_group_values(frame, ["g"], F.sum("x").alias("s")).collect()
    assert sorted((str(r.g), r.x, r.s) for r in rows) == [("None", 5, 5), ("a", 1, 3), ("a", 2, 3)]


def test_latest_by_key_equals_sequential_upserts(spark):
    rng = random.Random(5)
    rows = [(0 if i % 3 == 0 else rng.randrange(20), i, f"t{i}", f"a{i}") for i in range(400)]
    table = {}
    for k, seq, text, author in rows:
        table[k] = (text, table[k][1] if k in table else author)
    rng.shuffle(rows)
    frame = spark.createDataFrame(rows, "k int, seq int, text string, author string")
    got = latest_by_key(frame, ["k"], [F.col("seq")], ["text", "seq"]).collect()
    assert {r.k: (r.text, r.author) for r in got} == table


def test_latest_by_key_combines_before_the_shuffle(spark):
    frame = spark.range(100).select((F.col("id") % 2).alias("k"), "id")
    plan = latest_by_key(frame, ["k"], [F.col("id")])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan


def test_upsert_twice_is_upsert_once(spark):
    target = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "id int, name string, score int")
    batch = spark.createDataFrame(
        [(2, "c", None, 1), (2, "d", 7, 2), (3, "e", 1, 1)], "id int, name string, score int, seq int"
    )
    once = upsert(target, batch, ["id"], ["seq"])
    assert sorted(map(tuple, once.collect())) == [(1, "a", None), (2, "d", 7), (3, "e", 1)]
    twice = upsert(once, batch, ["id"], ["seq"])
    assert sorted(map(tuple, twice.collect())) == sorted(map(tuple, once.collect()))


def test_upsert_replaces_with_null(spark):
    target = spark.createDataFrame([(1, "a")], "id int, name string")
    batch = spark.createDataFrame([(1, None, 1)], "id int, name string, seq int")
    assert upsert(target, batch, ["id"], ["seq"]).collect()[0].name is None


def test_top_per_group_limits_before_the_shuffle(spark):
    frame = spark.range(1000).select((F.col("id") % 2).alias("g"), "id")
    best = top_per_group(frame, ["g"], 3, F.desc("id"))
    assert sorted(map(tuple, best.collect())) == [(0, 994), (0, 996), (0, 998), (1, 995), (1, 997), (1, 999)]
    plan = best._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2


def test_filters(matches):
    def ids(condition):
        return {r.match_id for r in matches.filter(condition).collect()}

    def want(keep):
        return {m["match_id"] for m in MATCH_DICTS if keep(m)}

    assert ids(on.involves("TEAM 3")) == want(lambda m: "Team 3" in (m["home_team_name"], m["away_team_name"]))
    assert ids(on.pairing("team 1", "team 2")) == want(lambda m: {m["home_team_id"], m["away_team_id"]} == {1, 2})
    assert ids(on.season_range(2023)) == want(lambda m: m["season_id"] % 10000 == 2023)
    assert 501 not in ids(on.season_range(2023)) and 502 in ids(on.season_range(2023))
    assert ids(on.season_range(None)) == ids(on.everything()) == want(lambda m: True)
    assert ids(on.equals("competition_code", "L2")) == want(lambda m: m["competition_id"] == 2)
    assert ids(on.one_of("competition_code", ["L1", "L9"])) == want(lambda m: m["competition_id"] == 1)
    assert {r.season_id for r in on.season_ids(matches, "L1", 2023).collect()} == {12023}
    newest = {max(m["season_id"] for m in MATCH_DICTS if m["competition_id"] == c) for c in (1, 2)}
    assert {r.season_id for r in on.latest_season(matches).collect()} == newest


def scans(frame):
    """Scans of files and reused exchanges of the plan as it ran, with the text of the plan."""
    frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    final = plan[: plan.index("== Initial Plan ==")]
    return final.count("FileScan parquet"), final.count("ReusedExchange"), final


def test_ranks_start_no_job_and_read_the_facts_once(spark, matches, tmp_path):
    matches.write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "ranks")
    try:
        made = [tools.league_tables(stored), adhoc.record_vs_top_n(stored, 2)]
        assert not list(tracker.getJobIdsForGroup("ranks"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for frame in made:
        read, reused, plan = scans(frame)
        assert read == 1 and reused >= 1, plan
        chosen = frame.filter("season_id = 12023")
        read, reused, plan = scans(chosen)
        assert read == 1 and "EqualTo(season_id,12023)" in plan, plan
        assert sorted(map(str, chosen.collect())) == sorted(str(r) for r in frame.collect() if r.season_id == 12023)


CHUNK = "report_id long, chunk_index int, embedding array<double>"
ASKED = "query_id long, embedding array<double>"


def cosine(a, b):
    dot = sum(x * y for x, y in zip(a, b, strict=True))
    return round(dot / (sum(x * x for x in a) ** 0.5 * sum(y * y for y in b) ** 0.5), 6)


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
@pytest.mark.parametrize("held", [200_000, 50])
def test_vector_search_against_brute_force(spark, monkeypatch, threshold, held):
    """More queries than a pack holds, many equal vectors, with and without broadcasting."""
    monkeypatch.setattr(vector_search, "PACK_BYTES", 8 * 8 * 16)
    monkeypatch.setattr(vector_search, "HELD_HITS", held)
    rng = random.Random(2)
    vectors = [(i, 0, [rng.choice((-1.0, 0.5, 1.0)) for _ in range(8)]) for i in range(300)]
    chunks = spark.createDataFrame(vectors, CHUNK).repartition(3)
    reports = spark.createDataFrame([(i,) for i in range(0, 300, 2)], "id long")
    queries = [(q, [rng.choice((-1.0, 0.5, 1.0)) for _ in range(8)]) for q in range(150)]
    asked = spark.createDataFrame(queries, ASKED)

    every, best = set(), set()
    for q, v in queries:
        scored = sorted((-cosine(e, v), i) for i, _, e in vectors if i % 2 == 0 and cosine(e, v) >= 0.3)
        every |= {(q, i, -s) for s, i in scored}
        best |= {(q, i, -s) for s, i in scored[:4]}
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        known = known_chunks(chunks, reports)
        rows = top_chunks(known, asked, 4, 0.3).collect()
        assert len(rows) == len(best)
        assert {(r.query_id, r.report_id, r.similarity) for r in rows} == best
        rows = similar_chunks(known, asked, 0.3).collect()
        assert {(r.query_id, r.report_id, r.similarity) for r in rows} == every
        plan = top_chunks(chunks, asked)._jdf.queryExecution().executedPlan().toString()
        assert ("CartesianProduct" in plan) == (threshold == "-1")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_report_search_joins_facts_and_texts_to_hits(spark):
    facts = "id long, match_id long, competition_code string, home_team string, away_team string, match_date date, matchday int, narrative string"
    told = "One sentence. " * 30 + "The end."
    reports = spark.createDataFrame([(1, 1, "L1", "A", "B", None, 2, told), (2, None, None, None, None, None, None, None)], facts)
    vectors = [(1, 0, [1.0, 0.0]), (1, 1, [1.0, 0.1]), (1, 9, [1.0, 0.2]), (2, 0, [1.0, 0.3]), (3, 0, [1.0, 0.0])]
    chunks = spark.createDataFrame(vectors, CHUNK)
    asked = spark.createDataFrame([(7, [2.0, 0.0]), (8, None), (None, [1.0, 0.0])], ASKED)
    found = sorted(report_search(chunks, reports, asked).collect(), key=lambda r: -r.similarity)
    assert [(r.query_id, r.report_id, r.chunk_index) for r in found] == [(7, 1, 0), (7, 1, 1), (7, 1, 9), (7, 2, 0)]
    assert found[0].chunk_text.startswith("One sentence. One") and found[1].chunk_text.endswith("The end.")
    assert [r.chunk_text for r in found[2:]] == [None, None] and found[0].home_team == "A"
    carried = chunks.withColumn("chunk_text", F.concat(F.lit("t"), F.col("chunk_index")))
    texts = {(r.report_id, r.chunk_index): r.chunk_text for r in report_search(carried, reports, asked).collect()}
    assert texts == {(1, 0): "t0", (1, 1): "t1", (1, 9): "t9", (2, 0): "t0"}


def test_vector_search_edges(spark):
    rows = [(1, 0, [3.0, 4.0]), (2, 0, [0.0, 0.0]), (3, 0, None), (4, 0, [-3.0, -4.0])]
    chunks = spark.createDataFrame(rows, "report_id long, chunk_index int, embedding array<float>")
    asked = spark.createDataFrame([(0, [6.0, 8.0]), (9, [0.0, 0.0])], ASKED)
    got = similar_chunks(chunks, asked, -1.0).collect()
    assert sorted((r.query_id, r.report_id, r.similarity) for r in got) == [(0, 1, 1.0), (0, 4, -1.0)]
    with pytest.raises(Exception, match="must have 3 elements"):
        similar_chunks(chunks, spark.createDataFrame([(0, [1.0, 2.0, 3.0])], ASKED)).collect()
    assert top_chunks(chunks, asked.limit(0)).collect() == [] == top_chunks(chunks.limit(0), asked).collect()
