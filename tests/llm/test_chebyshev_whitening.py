import math

import numpy as np
import pytest

from tallyline.llm import chebyshev_whitening as C
from tests.llm.corpora import DIRECTORY

SCHEMA = "vec_id long, embedding array<float>"


def usable(rows, dim):
    return [
        (i, v) for i, v in rows
        if v is not None and len(v) == dim and all(c is not None and math.isfinite(c) and abs(c) < 2.0**35 for c in v)
    ]


def brute(rows, dim, components=8):
    """Per vector and component the columns of the contract, by a full eigendecomposition."""
    rows = usable(rows, dim)
    x = [[math.floor(1024 * float(np.float64(c))) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(column) for column in zip(*x, strict=True)]
    spread = [[n * a - s for a, s in zip(row, sums, strict=True)] for row in x]
    deviation = [sum(a * a for a in row) for row in spread]
    centred = np.array(spread, np.float64) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return rows, deviation, values, centred @ vectors


def compare(rows, frame, dim, components=8):
    found = frame.orderBy("vec_id", "component").collect()
    kept, deviation, values, projected = brute(rows, dim)
    k = min(components, dim)
    order = sorted(range(len(kept)), key=lambda j: kept[j][0])
    assert [(r["vec_id"], r["component"]) for r in found] == [(kept[j][0], c) for j in order for c in range(1, k + 1)]
    assert {r["n"] for r in found} == {len(kept)}
    assert [r["deviation"] for r in found[::k]] == [deviation[j] for j in order]
    got = np.array([r["whitened"] for r in found]).reshape(-1, k)
    want = (projected[:, :k] / np.sqrt(values[:k]))[order]
    sign = np.sign((got * want).sum(axis=0))
    assert np.abs(got * sign - want).max() < 1e-8
    assert np.allclose([r["explained"] for r in found[:k]], values[:k] / values.sum(), rtol=1e-9)
    assert len({r["identity_error"] for r in found}) == 1 and found[0]["identity_error"] < 1e-9


def test_sample_equals_eigendecomposition(spark):
    frame = spark.read.parquet(f"{DIRECTORY}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in frame.collect()]
    compare(rows, C.whitening(frame), 64)


def vectors(n, dim, seed=1):
    draw = np.random.default_rng(seed)
    scale = np.linspace(3, 0.3, dim)
    return [(i, [float(np.float32(c)) for c in draw.standard_normal(dim) * scale]) for i in range(n)]


@pytest.mark.parametrize("dim", [1, 5, 12, 50])
def test_any_dimension(spark, dim):
    rows = vectors(150, dim)
    compare(rows, C.whitening(spark.createDataFrame(rows, SCHEMA)), dim)


def test_unusable_rows_and_other_lengths(spark):
    rows = vectors(80, 6) + [
        (100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (103, [math.nan] * 6), (104, [math.inf] + [0.0] * 5),
        (105, [1.0, 2.0]), (106, [3.0e38] + [0.0] * 5), (107, [0.5] * 6), (108, [0.5] * 6),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    compare(rows, C.whitening(frame), 6)
    from pyspark.sql import functions as F

    wide = frame.select("*", *(F.lit("x").alias(c) for c in ("ids", "data", "rows", "i", "n", "component", "id")))
    compare(rows, C.whitening(wide), 6)


def test_null_and_repeated_ids_stay(spark):
    rows = vectors(40, 4) + [(None, [1.0, 2.0, 3.0, 4.0]), (3, [0.0, 1.0, 0.0, 1.0])]
    found = C.whitening(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(found) == 42 * 4 and sum(r["vec_id"] is None for r in found) == 4 and sum(r["vec_id"] == 3 for r in found) == 8


def test_one_vector_and_flat_components(spark):
    (row,) = [r for r in C.whitening(spark.createDataFrame([(1, [1.0, 2.0])], SCHEMA)).collect() if r["component"] == 1]
    assert row["deviation"] == 0 and row["whitened"] is None and row["explained"] is None and row["identity_error"] == 0
    rows = [(i, [float(i), float(2 * i), 0.0]) for i in range(9)]
    found = C.whitening(spark.createDataFrame(rows, SCHEMA)).filter("vec_id = 4").orderBy("component").collect()
    assert found[0]["whitened"] is not None and found[0]["explained"] == pytest.approx(1)
    assert [r["whitened"] for r in found[1:]] == [None, None]
    same = spark.createDataFrame([(i, [0.25] * 40) for i in range(30)], SCHEMA)
    assert {r["whitened"] for r in C.whitening(same).collect()} == {None}


def test_rank_below_block_converges(spark):
    """Forty dimensions, but only three of them vary."""
    rows = [(i, [*v, *([1.0] * 37)]) for i, v in vectors(200, 3)]
    found = C.whitening(spark.createDataFrame(rows, SCHEMA)).filter("vec_id = 0").orderBy("component").collect()
    assert [r["whitened"] is None for r in found] == [False] * 3 + [True] * 5


def test_doubles_and_large_sums(spark):
    """A sum beyond a long is null, smaller ones are exact."""
    rows = [(i, [1e6 * i, -1e6 * i]) for i in range(50)] + [(50, [3e10, 1e10])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = {r["vec_id"]: r["deviation"] for r in C.whitening(frame).filter("component = 1").collect()}
    _, deviation, _, _ = brute(rows, 2)
    assert found == {i: d if d < 2**63 else None for (i, _), d in zip(rows, deviation, strict=True)}
    assert None in found.values() or max(deviation) < 2**63


def test_empty_table(spark):
    assert C.whitening(spark.createDataFrame([], SCHEMA)).count() == 0
