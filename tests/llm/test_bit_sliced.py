import math

import numpy as np
from pyspark.sql import functions as F

from tallyline.llm import bit_sliced as I
from tests.llm.corpora import rows_of

SCHEMA = "vec_id long, embedding array<float>"


def brute(rows, wanted, k=5):
    numbers = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v):
            numbers.setdefault(i, []).append([math.floor(256 * float(np.float32(x))) for x in v])
    out = []
    for q in sorted(numbers):
        if wanted(q):
            found = [(-sum(a * b for a, b in zip(numbers[q][0], v, strict=True)), i)
                     for i, vs in numbers.items() if i != q for v in vs if len(v) == len(numbers[q][0])]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(found)[:k])]
    return sorted(out, key=repr)


def vectors(n=300, dim=9, seed=0):
    draw = np.random.default_rng(seed)
    rows = [(i, draw.normal(scale=0.4, size=dim).astype(np.float32).tolist()) for i in range(n)]
    return rows + [(n + i, rows[3][1]) for i in range(30)]  # ties


def check(spark, rows, every=7, block=64):
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("score", F.lit("x")).withColumn("block", F.lit("y"))
    got = I.top_k(frame, F.col("vec_id") % every == 0, 5, block)
    assert rows_of(got) == brute(rows, lambda q: q % every == 0)


def test_equals_brute_force(spark):
    check(spark, vectors())


def test_awkward_vectors(spark):
    rows = vectors(40)
    rows += [(200, None), (201, []), (202, [None] * 9), (203, [float("nan")] * 9), (204, [float("inf")] + [0.0] * 8)]
    rows += [(None, [0.1] * 9), (205, [0.5] * 4), (207, [0.25] * 4), (210, [0.0] * 9), (211, [-3.0] * 9), (211, [2.0] * 9)]
    check(spark, rows, every=5, block=16)


def test_fewer_than_k_and_none(spark):
    check(spark, [(0, [0.1, 0.2]), (1, [0.3, -0.2])], every=1)
    check(spark, [(0, [0.1])], every=1)
    assert I.top_k(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 50 == 0).count() == 0


def test_more_queries_than_a_part(spark, monkeypatch):
    monkeypatch.setattr(I, "QUERY_ROWS", 8)
    monkeypatch.setattr(I, "QUERY_BLOCKS", 2)
    check(spark, vectors(120), every=1)


def test_several_blocks_a_strip(spark, monkeypatch):
    monkeypatch.setattr(I, "STRIPS", 2)
    monkeypatch.setattr(I, "STRIP_BLOCKS", 4)
    check(spark, vectors(120), every=1, block=8)


def test_no_side_of_the_tiles_is_collected(spark):
    rows = vectors(200)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = I.top_k(frame, F.lit(True), 5, 2)  # queries are dealt to over 100 blocks, and few by any estimate
    assert rows_of(got) == brute(rows, lambda q: True)
    got.collect()
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_sums_are_inner_products():
    draw = np.random.default_rng(5)
    values, numbers = draw.integers(0, 300, (100, 6)), draw.integers(-200, 200, (3, 6))
    bits = [np.pad(((values.T >> b) & 1), ((0, 0), (0, 28))).astype(np.uint8) for b in range(9)]
    planes = np.stack([np.ascontiguousarray(np.packbits(x, axis=1, bitorder="little")).view(np.uint64) for x in bits], axis=1)
    total = I.sums(planes, numbers)
    got = sum((np.unpackbits(t.view(np.uint8), axis=1, bitorder="little")[:, :100].astype(int) << w) for w, t in enumerate(total))
    expected = np.maximum(numbers, 0) @ values.T + np.maximum(-numbers, 0) @ (511 - values.T)
    assert (got == expected).all()
