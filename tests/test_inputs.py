from suite.inputs import Inputs
from suite.queries import _land


def test_feeds_out_of_matches_written_once(spark, tmp_path):
    inputs = Inputs(spark, "/root/testdata/sf0.001")
    want = sorted(r.value for r in inputs.match_docs().collect())
    tables = sorted(r.value for r in inputs.standing_docs().collect())
    once = Inputs(spark, "/root/testdata/sf0.001").written_once(standings=True)
    for feed in (once.match_docs(), once.match_docs(False), once.standing_docs()):
        assert not [f for f in feed.inputFiles() if "lineitem" in f]
    assert sorted(r.value for r in once.match_docs().collect()) == want
    assert sorted(r.value for r in once.standing_docs().collect()) == tables


def test_landed_files_are_compressed(spark, tmp_path):
    docs = spark.range(3).selectExpr("cast(id as string) as value")
    _land(docs, f"{tmp_path}/landing")
    names = [p.name for p in (tmp_path / "landing").glob("part-*")]
    assert names and all(n.endswith(".lz4") for n in names)
    assert sorted(r.value for r in spark.read.text(f"{tmp_path}/landing").collect()) == ["0", "1", "2"]
