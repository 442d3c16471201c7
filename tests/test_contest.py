import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tallyline.functions.season import in_season
from tallyline.sources.contest import ContestTables


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A star schema of 200 orders around two season cuts, with missing and unknown codes."""
    rng = random.Random(5)
    cuts = [dt.datetime(1996, 7, 1), dt.datetime(1997, 7, 1)]
    orders, lines = [], []
    for key in range(200):
        day = rng.choice(cuts) + dt.timedelta(seconds=rng.choice((-1, 0, 1)), days=rng.choice((-90, 0, 90)))
        orders.append((key, rng.randrange(20), rng.choice(("F", "O", "P", "X", None)), day))
        lines += [(key, n, rng.randrange(8), rng.choice("RAN")) for n in range(1, rng.randrange(1, 7))]
    content = {
        "region": ([(r, f"REGION_{r}") for r in range(2)], "r_regionkey int, r_name string"),
        "nation": ([(n, f"NATION_{n}", n % 2) for n in range(4)], "n_nationkey int, n_name string, n_regionkey int"),
        "customer": ([(c, c % 4) for c in range(20)], "c_custkey long, c_nationkey int"),
        "supplier": ([(s, s % 4) for s in range(8)], "s_suppkey long, s_nationkey int"),
        "orders": (orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderdate timestamp_ntz"),
        "lineitem": (lines, "l_orderkey long, l_linenumber int, l_suppkey long, l_returnflag string"),
    }
    root = tmp_path_factory.mktemp("contest")
    for name, (rows, schema) in content.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return ContestTables(spark, str(root))


def plan_of(frame):
    frame.collect()
    return frame._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.mark.parametrize("status", [None, "FINISHED", "SCHEDULED", "IN_PLAY", "POSTPONED"])
@pytest.mark.parametrize("season", [None, 1995, 1996, 1997, 2030])
def test_chosen_matches_are_the_same_as_filtered_ones(tables, status, season):
    wanted = tables.matches()
    if status is not None:
        wanted = wanted.filter(F.col("status") == status)
    if season is not None:
        wanted = wanted.filter(in_season(F.to_date("utc_date"), season))
    assert sorted(map(str, tables.matches(status, season).collect())) == sorted(map(str, wanted.collect()))


def test_status_and_season_reach_the_scan_and_the_lines(tables):
    assert tables.matches().count() > 50
    plan = plan_of(tables.matches("FINISHED"))
    assert "EqualTo(o_orderstatus,F)" in plan and "LeftSemi" not in plan
    plan = plan_of(tables.matches("FINISHED", 1996))
    assert "EqualTo(o_orderstatus,F), GreaterThanOrEqual(o" in plan  # the list is printed up to a length only
    counting = plan.rindex("partial_count")
    assert "LeftSemi" in plan[counting:], plan  # deeper in the plan: before the lines are counted
