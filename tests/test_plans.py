import datetime as dt
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tallyline.plans import adhoc, anomalies, build, evaluation, models, quality, reports, tools
from tallyline.sinks.layers import as_table, as_view, publish
from tests.data import MATCH_DICTS, legs

RAW = (
    "id long, competition_id long, season_id long, utc_date timestamp_ntz, status string, matchday int,"
    " home_team_id long, home_team_name string, away_team_id long, away_team_name string,"
    " home_score_full_time int, away_score_full_time int, home_score_half_time int, away_score_half_time int,"
    " winner string, ingested_at timestamp_ntz"
)


def raw(spark, *rows):
    """(id, status, full time, half time, competition)"""
    day = dt.datetime(2024, 12, 22, 16, 30)
    data = [
        (i, comp, 1, day, status, 18, 1, "Spurs", 2, "Reds", *full, *half, None, day)
        for i, status, full, half, comp in rows
    ]
    return spark.createDataFrame(data, RAW)


@pytest.fixture(scope="module")
def competitions(spark):
    return spark.createDataFrame(
        [(1, "First", "F1", "LEAGUE", "Here", "T", None), (2, "No code", None, "CUP", None, None, None)],
        "id long, name string, code string, type string, area_name string, plan string, ingested_at timestamp_ntz",
    )


def test_staging_to_mart(spark, competitions):
    source = raw(
        spark,
        (1, "FINISHED", (3, 6), (1, 3), 1),
        (2, "SCHEDULED", (None, None), (None, None), 1),
        (3, "FINISHED", (None, None), (1, 0), 1),
        (4, "FINISHED", (1, 1), (0, 1), 1),
        (5, "FINISHED", (2, 2), (None, None), 2),
    )
    stg = models.stg_matches(source)
    mart = models.mart_match_results(models.int_match_results(stg, models.stg_competitions(competitions)))
    rows = {r.match_id: r for r in mart.collect()}
    assert set(rows) == {1, 3, 4, 5}
    first = rows[1]
    assert (first.result, first.ht_leader, first.total_goals, first.goal_diff) == ("away", "away", 9, -3)
    assert first.is_high_scoring and not first.is_ht_lead_dropped and first.match_date == dt.date(2024, 12, 22)
    assert rows[3].result is None and rows[3].total_goals is None
    assert rows[3].is_high_scoring is False and rows[3].is_ht_lead_dropped is False
    assert rows[4].is_ht_lead_dropped and rows[4].result == "draw"
    assert rows[5].ht_leader is None and rows[5].is_high_scoring and rows[5].competition_name is None


def test_form_model_uses_win_draw_loss_on_both_sides(spark):
    stg = models.stg_matches(raw(spark, (1, "FINISHED", (2, 1), (0, 0), 1), (3, "FINISHED", (None, None), (0, 0), 1)))
    rows = {(r.match_id, r.team_id): (r.team_result, r.points_earned) for r in models.int_team_form(stg).collect()}
    assert rows == {(1, 1): ("win", 3), (1, 2): ("loss", 0), (3, 1): (None, 0), (3, 2): (None, 0)}


def table_by_hand(keep):
    lines = defaultdict(lambda: [0, 0, 0, 0, 0, 0, 0])
    for leg in filter(keep, legs()):
        line = lines[leg["team_name"]]
        line[0] += 1
        line[{"win": 1, "draw": 2, "loss": 3}.get(leg["team_result"], 0)] += leg["team_result"] is not None
        line[4] += leg["gf"] or 0
        line[5] += leg["ga"] or 0
        line[6] += leg["points"]
    return {team: tuple(line) for team, line in lines.items()}


def test_league_table(matches):
    rows = tools.league_table(matches, "L1", 2023).collect()
    want = table_by_hand(lambda l: l["competition_id"] == 1 and l["season_id"] == 12023)
    got = {r.team_name: (r.played_games, r.won, r.draw, r.lost, r.goals_for, r.goals_against, r.points) for r in rows}
    assert got == want
    for r in rows:
        better = sum(
            (o.points, o.goal_difference, o.goals_for) > (r.points, r.goal_difference, r.goals_for) for o in rows
        )
        assert r.position == better + 1
        assert r.points_per_game == ((200 * r.points + r.played_games) // (2 * r.played_games)) / 100
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    current = tools.league_table(matches, "L1", today=dt.date(2024, 3, 1)).collect()
    assert current == rows
    assert tools.league_table(matches, "none", 2023).count() == 0


def test_table_invariants(matches):
    scored = matches.filter("result is not null")
    for g in tools.league_tables(scored).groupBy("competition_code", "season_id").agg(
        F.sum("goals_for").alias("gf"), F.sum("goals_against").alias("ga"), F.sum("points").alias("pts"),
        F.sum("won").alias("won"), F.sum("draw").alias("draw"),
    ).collect():
        assert g.gf == g.ga and g.pts == 3 * g.won + g.draw


def test_bottler_index(matches):
    index = models.mart_bottler_index(matches)
    led = defaultdict(list)
    for m in MATCH_DICTS:
        if m["ht_leader"] in ("home", "away"):
            led[m["season_id"], m[f"{m['ht_leader']}_team_id"]].append(m["is_ht_lead_dropped"])
    want = {k: (len(v), sum(v)) for k, v in led.items() if len(v) >= 3}
    assert {(r.season_id, r.team_id): (r.matches_leading_ht, r.leads_dropped) for r in index.collect()} == want
    season = tools.bottler_index(index, matches, "L1", 3, 2023).collect()
    assert len(season) == sum(1 for s, _ in want if s == 12023)
    rates = [r.drop_rate_pct for r in season]
    assert rates == sorted(rates, reverse=True) and all(0 <= r <= 100 for r in rates)


def test_team_season_stats(matches):
    stats = tools.team_season_stats(matches, 3, "L1")
    splits = {r.split: r for r in stats.splits.collect()}
    mine = [l for l in legs() if l["team_id"] == 3 and l["competition_id"] == 1]
    for split, rows in {"aggregate": mine, "home": [l for l in mine if l["venue"] == "home"]}.items():
        assert splits[split].played == len(rows)
        assert splits[split].won == sum(l["team_result"] == "win" for l in rows)
        assert splits[split].goals_for == sum(l["gf"] for l in rows)
    assert splits["home"].played + splits["away"].played == splits["aggregate"].played
    assert stats.matches.count() == len(mine)
    by_name = tools.team_season_stats(matches, "team 3", "L1").splits.collect()
    assert by_name == stats.splits.collect()


def test_team_without_matches_has_zeros(matches):
    rows = tools.team_season_stats(matches, "nobody", "L1").splits.collect()
    assert [r.split for r in rows] == ["aggregate", "home", "away"]
    assert all(v == 0 for r in rows for v in list(r)[1:])


def test_scoreless_match_counts_as_lost_for_splits_but_not_in_the_table(matches):
    only = matches.filter("match_id = 500")
    splits = tools.team_season_stats(only, 1, "L1").splits.first()
    assert (splits.played, splits.lost, splits.goals_for) == (1, 1, 0)
    line = tools.league_table(only, "L1", 2023).first()
    assert (line.played_games, line.won, line.draw, line.lost, line.points) == (1, 0, 0, 0, 0)


def test_team_form_filters_before_the_window(matches):
    rows = tools.team_form(matches, "Team 2", 4, "L1").collect()
    mine = sorted(
        (l for l in legs() if l["team_id"] == 2 and l["competition_id"] == 1),
        key=lambda l: (l["match_date"], l["match_id"]),
    )
    want = [(l["match_id"], sum(x["points"] for x in mine[max(0, i - 4) : i + 1])) for i, l in enumerate(mine)]
    assert [(r.match_id, r.form_points_last5) for r in rows] == want[::-1][:4]
    blended = tools.team_form(matches, "Team", 1000)
    assert blended.count() == len(MATCH_DICTS)


def test_match_lists(matches):
    h2h = tools.head_to_head(matches, "team 1", "TEAM 2").collect()
    pair = [m for m in MATCH_DICTS if {m["home_team_id"], m["away_team_id"]} == {1, 2}]
    pair.sort(key=lambda m: (m["match_date"], m["match_id"]), reverse=True)
    assert [r.match_id for r in h2h] == [m["match_id"] for m in pair]
    assert h2h == tools.head_to_head(matches, "Team 2", "Team 1").collect()
    high = tools.high_scoring_matches(matches, min_goals=4, limit=5).collect()
    want = sorted(
        (m for m in MATCH_DICTS if (m["total_goals"] or 0) >= 4),
        key=lambda m: (m["total_goals"], m["match_date"], m["match_id"]), reverse=True,
    )[:5]
    assert [r.match_id for r in high] == [m["match_id"] for m in want] and high[0].total_goals == 9
    assert tools.recent_matches(matches, "L2", 3).count() == 3


def test_season_summary(matches):
    line = tools.season_summary(matches, "L1", 2023).first()
    mine = [m for m in MATCH_DICTS if m["season_id"] == 12023]
    goals = [m["total_goals"] for m in mine if m["total_goals"] is not None]
    assert line.total_matches == len(mine) and line.total_goals == sum(goals)
    assert line.avg_goals_per_game == ((200 * sum(goals) + len(goals)) // (2 * len(goals))) / 100
    assert line.home_wins + line.draws + line.away_wins == len(goals)
    assert tools.season_summary(matches, "L9").count() == 0


def test_compare_and_away_wins(matches):
    compared = {r.measure: (r.team_a, r.team_b) for r in tools.compare_teams(matches, 1, 2).collect()}
    for i, team in enumerate((1, 2)):
        line = tools.team_splits(tools.team_matches(matches, team)).first()
        assert {m: v[i] for m, v in compared.items()} == {m: line[m] for m in tools.COMPARED}
    wins = defaultdict(lambda: [0, 0])
    for l in legs():
        wins[l["team_name"]][l["venue"] == "away"] += l["team_result"] == "win"
    want = {t: (h, a) for t, (h, a) in wins.items() if a > h}
    assert {r.team_name: (r.home_wins, r.away_wins) for r in tools.away_over_home_wins(matches).collect()} == want


def test_record_against_the_best(matches):
    table = tools.league_tables(matches)
    best = {(r.season_id, r.team_name) for r in table.filter("position <= 2").collect()}
    want = defaultdict(int)
    for l in legs():
        if (l["season_id"], l["opponent"]) in best:
            want[l["season_id"], l["team_name"]] += 1
    got = {(r.season_id, r.team_name): r.played_games for r in adhoc.record_vs_top_n(matches, 2).collect()}
    assert got == want


def test_guarded_sql(spark, matches, tmp_path):
    publish(spark, {"mart_match_results": matches}, str(tmp_path))
    answer = tools.guarded_sql(spark, "select count(*) as n from marts.mart_match_results")
    assert answer.ok and answer.rows.first().n == len(MATCH_DICTS)
    assert tools.guarded_sql(spark, "drop table marts.mart_match_results").error.endswith("(got DROP)")
    unknown = tools.guarded_sql(spark, "select nothing_here from marts.mart_match_results")
    assert not unknown.ok and "nothing_here" in unknown.error
    assert not tools.guarded_sql(spark, "select * from marts.other").ok


def test_layers(spark, matches, tmp_path):
    stored = as_table(matches, str(tmp_path), "marts", "m", ["season_id"])
    assert stored.exceptAll(matches).count() == 0 and stored.count() == matches.count()
    assert "PartitionFilters: [isnotnull(season_id" in stored.filter("season_id = 12023")._jdf.queryExecution().executedPlan().toString()
    assert spark.table(as_view(matches, "staging", "matches")).count() == matches.count()


def test_build_and_check(spark, competitions, tmp_path):
    source = raw(spark, (1, "FINISHED", (3, 6), (1, 3), 1), (2, "FINISHED", (1, 1), (1, 0), 1), (3, "TIMED", (None, None), (None, None), 1))
    teams = spark.createDataFrame(
        [(1, "Spurs", "S", "SPU", 1, "E", None)],
        "id long, name string, short_name string, tla string, competition_id long, area_name string, ingested_at timestamp_ntz",
    )
    standings = models.standings_from_matches(models.stg_matches(source))
    built = build.build_models(build.RawTables(competitions, teams, source, standings), str(tmp_path))
    assert spark.table("staging_stg_matches").count() == 2
    assert {r.match_id for r in built["mart_match_results"].collect()} == {1, 2}
    assert built["int_team_form"].count() == 4
    again = build.build_models(build.RawTables(competitions, teams, source, standings), str(tmp_path / "next"))
    assert again["mart_league_table"].collect() == built["mart_league_table"].collect()
    checks = build.check_models(built).collect()
    assert len(checks) == 24 and all(c.ok for c in checks)


# -- outliers --------------------------------------------------------------------------


def test_league_features_and_flags(spark):
    rows = [("L1", 1, f"T{i}", p, g, 1.0) for i, (p, g) in enumerate([(1.0, 1.0)] * 9 + [(3.0, 1.0)])]
    rows.append(("L2", 1, "alone", 2.0, 2.0, 2.0))
    table = spark.createDataFrame(
        rows, "competition_code string, season_id long, team_name string, points_per_game double,"
        " goals_per_game double, conceded_per_game double"
    ).selectExpr("*", "competition_code as competition_name", "10 as played_games", "1 as points",
                 "0.0 as win_percentage", "0 as goal_difference")
    features = {r.team_name: r for r in anomalies.league_features(table).collect()}
    assert features["T0"].league_avg_ppg == 1.2
    assert abs(features["T0"].stddev_ppg - 0.6324555) < 1e-6
    assert features["alone"].stddev_ppg is None
    flags = {r.team_name: r for r in anomalies.league_flags(anomalies.league_features(table)).collect()}
    assert (flags["T9"].is_anomalous, flags["T9"].severity, flags["T9"].key_metric) == (True, "high", "points_per_game")
    assert flags["T9"].anomaly_type == "overperforming" and len(flags["T9"].explanation) > 20
    assert not flags["T0"].is_anomalous and flags["T0"].anomaly_type == "none"
    assert not flags["alone"].is_anomalous
    summary = {r.competition_code: (r.teams_analysed, r.teams_flagged) for r in anomalies.anomaly_summary(
        anomalies.league_flags(anomalies.league_features(table))).collect()}
    assert summary == {"L1": (10, 1), "L2": (1, 0)}


# -- reports ---------------------------------------------------------------------------


def test_backlogs(spark, matches):
    stored = spark.createDataFrame([(1, 500, "a"), (2, None, "b")], "id long, match_id long, narrative string")
    backlog = reports.narrative_backlog(matches, stored)
    assert backlog.count() == len(MATCH_DICTS) - 1
    days = [r.match_date for r in backlog.collect()]
    assert days == sorted(days)
    cost = reports.backlog_cost(backlog).first()
    assert cost.estimated_usd == pytest.approx((len(MATCH_DICTS) - 1) * 500 * 4.8 / 1e6)
    chunks = spark.createDataFrame([(2,)], "report_id long")
    assert [r.id for r in reports.embedding_backlog(stored, chunks).collect()] == [1]


def test_prompt(matches):
    row = reports.prompts(matches.filter("match_id = 501"), "Intro\n").first().prompt
    assert row == (
        "Intro\nMatch: Team 1 3-6 Team 2, HT: 1-3, Matchday 18, L1\nHalf-time leader: away\n"
        "HT lead dropped: False\nHigh scoring: True\nWrite the match report:"
    )
    assert "None-None" in reports.prompts(matches.filter("match_id = 500")).first().prompt


def test_context_block_keeps_the_order(spark):
    day = dt.date(2024, 1, 2)
    found = spark.createDataFrame(
        [(1, 7, 0, "low", "A", "B", day, "L1", 3, 0.5), (1, 8, 1, "high", "C", None, None, None, None, 0.9)],
        "query_id long, report_id long, chunk_index int, chunk_text string, home_team string, away_team string,"
        " match_date date, competition_code string, matchday int, similarity double",
    )
    assert reports.context_blocks(found).first().context == (
        "## Relevant match reports\n\n[C vs None, None, None, similarity: 0.90]\nhigh\n\n"
        "[A vs B, L1, 2024-01-02, similarity: 0.50]\nlow\n\n"
    )


# -- quality ---------------------------------------------------------------------------


def test_quality_rules(spark, matches):
    frame = spark.createDataFrame([(1, "a", 5), (1, None, -1), (None, "b", 101)], "id int, s string, x int")
    rules = [*quality.not_null("id", "s"), *quality.accepted_values("s", ["a"]), *quality.between("x", 0, 100),
             *quality.at_least("x", 0)]
    want = [
        ("not_null", "id", 1, False), ("not_null", "s", 1, False), ("accepted_values", "s", 1, False),
        ("range", "x", 2, False), ("range", "x", 1, False),
    ]

    def lines(found):
        return [(r.rule, r.column_name, r.n_bad, r.ok) for r in found.collect()]

    assert lines(quality.check_model("m", frame, rules)) == want
    assert lines(quality.check_model("m", frame, rules, ["id"])) == [("unique", "id", 1, False), *want]
    assert lines(quality.check_model("m", frame, unique=["id", "x"])) == [("unique", "id,x", 0, True)]
    assert lines(quality.check_model("m", frame.limit(0), rules, ["id"])) == [("unique", "id", 0, True)] + [
        (rule, column, 0, True) for rule, column, _, _ in want
    ]
    report = quality.run_all({"mart_match_results": matches})
    assert report.count() == 5 and report.filter("not ok").count() == 0


# -- evaluation ------------------------------------------------------------------------


def failures(frame):
    return [r.failures for r in frame.collect()]


def test_sql_answer_checks(spark):
    good = "select team_name from marts.mart_league_table"
    frame = spark.createDataFrame(
        [(good, True, "Four sides won away on matchday 9."), (None, None, None), ("drop x", False, "I don't know.")],
        "sql string, success boolean, answer string",
    )
    assert failures(evaluation.check_sql_answers(frame)) == [
        [],
        ["sql is empty", "success is False", "answer is empty"],
        ["success is False", "validate_sql failed: Only SELECT statements are allowed (got DROP)",
         "answer contains disallowed phrase: 'i don't know'"],
    ]


def test_verdict_checks(spark):
    every = ["is_anomalous", "severity", "anomaly_type", "explanation"]
    frame = spark.createDataFrame(
        [(every, "low", "x" * 21), (["severity"], "odd", "x" * 20)], "keys array<string>, severity string, explanation string"
    )
    assert failures(evaluation.check_verdicts(frame)) == [
        [],
        ["missing keys: anomaly_type, explanation, is_anomalous", "invalid severity value: 'odd'",
         "explanation too short (20 chars, need > 20)"],
    ]


def test_response_checks(spark):
    frame = spark.createDataFrame([("x" * 51,), (" ",), ("My training data " + "x" * 60,)], "response string")
    assert failures(evaluation.check_responses(frame)) == [
        [], ["response is empty", "response too short (1 chars, need > 50)"],
        ["response contains disallowed phrase: 'my training data'"],
    ]


GOLDEN = "question string, expected_contains array<string>, must_not_contain array<string>, must_include_number boolean, expected_behaviour string, response string"


def test_golden_cases(spark):
    cases = spark.createDataFrame(
        [
            ("q0", ["Reds"], None, True, None, "The REDS have 45 points"),
            ("q1", ["Reds", "45"], ["blues"], True, None, "The Blues"),
            ("q2", None, None, None, "graceful_refusal", "That is outside my scope"),
            ("q3", None, ["will win"], None, "graceful_refusal", "Reds will win"),
            ("q4", ["Reds"], None, True, None, None),
        ],
        GOLDEN,
    )
    checked = evaluation.check_golden(cases)
    assert [r.reasons for r in checked.collect()] == [
        [],
        ["missing expected text: 'Reds'", "missing expected text: '45'", "contains forbidden text: 'blues'",
         "no number found in response"],
        [],
        ["contains forbidden text: 'will win'", "expected graceful refusal but agent answered directly"],
        ["no response"],
    ]
    line = evaluation.summarize(checked).first()
    assert tuple(line) == (5, 2, 3, 0.4, False)
    advice = {r.kind: (r.failures, r.examples) for r in evaluation.recommend(checked).collect()}
    assert advice == {
        "missing expected text": (2, "q1"), "routing": (1, "q1"), "forbidden text": (2, "q1 | q3"),
        "no number": (1, "q1"), "graceful refusal": (1, "q3"),
    }
    own = evaluation.recommend(checked, {"no number": "Mind the figures."}, examples=1).collect()
    assert {r.advice for r in own} == {None, "Mind the figures."} and {r.examples for r in own} == {"q1", "q3"}
    (clean,) = evaluation.recommend(checked.filter(F.size("reasons") == 0)).collect()
    assert (clean.kind, clean.failures) == (evaluation.CLEAN, 0)


def test_pass_threshold_uses_the_unrounded_rate(spark):
    rows = [("q", None, None, i >= 1699, None, "x") for i in range(2000)]
    line = evaluation.summarize(evaluation.check_golden(spark.createDataFrame(rows, GOLDEN))).first()
    assert (line.passed, line.pass_rate, line.passed_threshold) == (1699, 0.85, False)


def test_judge_scores(spark):
    texts = ['{"grounding": 5, "responsiveness": 4, "accuracy": 3, "issues": [], "overall_pass": true}', "five", "", None]
    frame = spark.createDataFrame([(t,) for t in texts], "judge string")
    scores = [r.scores for r in evaluation.parse_scores(frame, "judge").collect()]
    assert scores[0].grounding == 5 and scores[0].overall_pass and scores[1:] == [None, None, None]
