import itertools

import pytest
from pyspark.sql import functions as F

from tallyline.llm import length_buckets as L
from tests.llm.corpora import SCHEMA, awkward, clashing, documents, rows_of


def padding(lengths, counts, chosen):
    return sum(c * (min(b for b in chosen if b >= n) - n) for n, c in zip(lengths, counts, strict=True))


@pytest.mark.parametrize("buckets", [1, 2, 3, 4, 9])
def test_bounds_are_optimal(buckets):
    lengths, counts = [1, 2, 5, 9, 10, 30, 31, 80], [9, 1, 4, 20, 3, 1, 7, 2]
    chosen = L.bounds(lengths, counts, buckets)
    options = (c for k in range(1, buckets + 1) for c in itertools.combinations(lengths, min(k, 8)) if c[-1] == 80)
    assert padding(lengths, counts, chosen) == min(padding(lengths, counts, c) for c in options)
    assert len(chosen) <= buckets and chosen[-1] == 80
    assert L.bounds([], [], buckets) == []


def test_every_token_is_packed_once(spark):
    docs = clashing(documents(spark, awkward()))
    got = L.packed(docs, longest=50, buckets=3, budget=200)
    rows = got.collect()
    words = {(r["doc_id"], r["n"]) for r in docs.select("doc_id", F.coalesce(L.words(), F.lit(0)).alias("n")).collect()}
    total = {}
    for r in rows:
        total.setdefault(r["doc_id"], 0)
        total[r["doc_id"]] += r["n_tokens"]
        assert r["n_tokens"] <= 50 and r["start"] == 50 * r["piece"]
        assert (r["batch"] is None) == (r["n_tokens"] == 0)
    assert {(i, n * (1 + (i == 12))) for i, n in words} == set(total.items())
    full = {}
    for r in rows:
        if r["n_tokens"]:
            full.setdefault((r["bucket_len"], r["batch"]), []).append(r["slot"])
            assert r["n_tokens"] <= r["bucket_len"]
    last = {}
    for (bucket, batch), slots in sorted(full.items()):
        room = max(200 // bucket, 1)
        assert sorted(slots) == list(range(len(slots))) and len(slots) <= room
        assert last.get(bucket, (room, -1)) == (room, batch - 1)  # only the last batch of a bucket is open
        last[bucket] = (len(slots), batch)


def test_ranges_do_not_change_numbers(spark):
    rows = [(i, "w " * (1 + i % 40)) for i in range(500)]
    one = rows_of(L.packed(documents(spark, rows), longest=16, buckets=4, budget=64))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows_of(L.packed(documents(spark, rows), longest=16, buckets=4, budget=64)) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_empty_table(spark):
    assert L.packed(spark.createDataFrame([], SCHEMA)).count() == 0
