"""Whitening of embeddings by subspace iteration with a Chebyshev filter.

The leading eigenvectors of the covariance V are found without forming V: one pass over the rows
gives V Q for a thin block Q, as the sum of X^T (X Q) over row blocks, X centred first. A
polynomial in V, built by the Chebyshev recurrence with one pass a degree, is small on the
unwanted part of the spectrum and grows fast beyond it. QR and Rayleigh-Ritz then give the next
estimates, until the residual of every wanted pair, ``|V q - e q|``, is below TOLERANCE times the
largest eigenvalue. Guard columns beside the wanted ones speed that up, and one of them is drawn
anew each round, so no eigenvector stays hidden behind an unlucky start.

Entries c become integers ``floor(1024 * c) + 100000``; their sums are exact, so the mean is too.

* Vectors that are null or empty, or hold null or non-finite entries, take no part, nor do those with
  an entry of 2**35 or more in size, whose integer would not fit exact sums.
* Vectors of several lengths have no common covariance: the commonest length takes part, of equally
  common ones the longest.
* Equal vectors each count; ids may repeat or be null. No vectors give no rows.
* A component without variance has whitened null and explained 0, null if nothing varies at all;
  identity_error is then that of the other components, 0 if there is none.
* ``deviation`` is null where the exact sum is beyond a long.
* Only the two named columns are read.

The vectors are stored once as row blocks of at most BLOCK_BYTES, which every pass reads. A task
returns one row a dimension; Spark adds them up, and the driver holds matrices of dimension by
``components + guard`` only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.workspace import stored

COMPONENTS = 8
GUARD = 24
DEGREE = 10
TOLERANCE = 1e-13
MAX_ROUNDS = 200
SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**35
BLOCK_BYTES = 1 << 21
NEGLIGIBLE = 1e-12




@dataclass(frozen=True)
class Shape:
    """What tasks must know of the stored vectors: how they are laid out, and the sums of their integers."""

    dtype: str
    dim: int
    n: int
    sums: list[int]

    def centred(self, data: bytes) -> np.ndarray:
        """``x - S / n`` of a block's rows: the whole part of the mean is taken off exactly."""
        whole = np.array([s // self.n for s in self.sums], np.float64)
        rest = np.array([(s % self.n) / self.n for s in self.sums], np.float64)
        return (integers(data, self.dtype, self.dim) - whole) - rest


@dataclass(frozen=True)
class Blocks:
    """Stored vectors: ids, id_nulls and data (binary, row by row)."""

    frame: DataFrame
    shape: Shape


def integers(data: bytes, dtype: str, dim: int) -> np.ndarray:
    """The whole numbers of a stored block, as doubles that hold them exactly."""
    values = np.frombuffer(data, dtype).reshape(-1, dim).astype(np.float64)
    return np.floor(values * SCALE) + SHIFT


def _pack(dtype: str) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("embedding")
            lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            values = flat.to_numpy(zero_copy_only=False).astype(np.float64)  # null becomes NaN
            with np.errstate(invalid="ignore"):
                good = np.abs(values) < LARGEST
            starts = np.concatenate([[0], np.cumsum(lengths)])
            bad = np.concatenate([[0], np.cumsum(~good)])
            usable = (lengths > 0) & (bad[starts[1:]] == bad[starts[:-1]])
            ids = batch.column("id")
            numbers = pc.fill_null(ids, 0).to_numpy(zero_copy_only=False).astype("<i8")
            missing = pc.is_null(ids).to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths[usable]).tolist():
                rows = np.flatnonzero(usable & (lengths == dim))
                step = max(BLOCK_BYTES // (8 * dim), 1)
                for at in range(0, len(rows), step):
                    some = rows[at : at + step]
                    data = values[starts[some][:, None] + np.arange(dim)].astype(dtype).tobytes()
                    sums = integers(data, dtype, dim).astype(np.int64).sum(axis=0)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([numbers[some].tobytes()], pa.binary()),
                            pa.array([missing[some].tobytes()], pa.binary()),
                            pa.array([data], pa.binary()), pa.array([len(some)], pa.int64()),
                            pa.array([dim], pa.int32()), pa.array([sums.tolist()], pa.list_(pa.int64())),
                        ],
                        names=["ids", "id_nulls", "data", "rows", "dim", "sums"],
                    )

    return pack


def blocks(vectors: DataFrame, id_column: str = "vec_id") -> Blocks | None:
    """Store the usable rows of ``vectors`` (id, ``embedding``) as row blocks; None if there are none."""
    kind = vectors.schema["embedding"].dataType.elementType.typeName()
    dtype = "<f4" if kind == "float" else "<f8"
    rows = vectors.select(F.col(id_column).cast("long").alias("id"), "embedding")
    packed = rows.mapInArrow(
        _pack(dtype), "ids binary, id_nulls binary, data binary, rows long, dim int, sums array<long>"
    )
    packed = stored(packed, "vector-blocks")
    by_length = packed.groupBy("dim").agg(F.sum("rows").alias("n"))
    most = by_length.orderBy(F.desc("n"), F.desc("dim")).first()
    if most is None:
        return None
    dim, n = most
    frame = packed.filter(F.col("dim") == dim)
    wide = frame.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return Blocks(frame.select("ids", "id_nulls", "data"), Shape(dtype, dim, n, [int(r["s"]) for r in sorted(wide.collect())]))


def _summed(b: Blocks, height: int, width: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of ``part(centred rows)``, a matrix of ``height`` by ``width``, over all blocks."""
    shape = b.shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((height, width))
        for batch in batches:
            for data in batch.column("data"):
                total += part(shape.centred(data.as_buffer()))
        columns = [pa.array(np.arange(height)), *(pa.array(total[:, j].copy()) for j in range(width))]
        yield pa.RecordBatch.from_arrays(columns, names=["i", *names])

    names = [f"c{j}" for j in range(width)]
    partial = b.frame.select("data").mapInArrow(add, ", ".join(["i long", *(f"{c} double" for c in names)]))
    total = np.zeros((height, width))
    for row in partial.groupBy("i").agg(*(F.sum(c).alias(c) for c in names)).collect():
        total[row["i"]] = row[1:]
    return total


def covariance_times(b: Blocks, q: np.ndarray) -> tuple[np.ndarray, float]:
    """V Q, and the trace of V, in one pass."""

    def part(x: np.ndarray) -> np.ndarray:
        return np.hstack([x.T @ (x @ q), (x * x).sum(axis=0)[:, None]])

    total = _summed(b, b.shape.dim, q.shape[1] + 1, part) / b.shape.n
    return total[:, :-1], float(total[:, -1].sum())


@dataclass(frozen=True)
class Whitening:
    """Eigenvalues falling, eigenvectors as columns, the trace of V and the certified residuals."""

    values: np.ndarray
    vectors: np.ndarray
    trace: float
    residuals: np.ndarray
    passes: int

    @property
    def varying(self) -> np.ndarray:
        return self.values > NEGLIGIBLE * self.trace


def fitted(b: Blocks, components: int = COMPONENTS, guard: int = GUARD, degree: int = DEGREE, seed: int = 11) -> Whitening:
    """The leading eigenpairs, certified; raises if MAX_ROUNDS do not suffice."""
    draw = np.random.default_rng(seed)
    dim = b.shape.dim
    wanted, width = min(components, dim), min(components + guard, dim)
    q = np.linalg.qr(draw.standard_normal((dim, width)))[0]
    passes = 0

    def times(block: np.ndarray) -> np.ndarray:
        nonlocal passes, trace
        passes += 1
        product, trace = covariance_times(b, block)
        return product

    trace = 0.0
    for _ in range(MAX_ROUNDS):
        z = times(q)
        small = q.T @ z
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, z = q @ turn, z @ turn
        residuals = np.linalg.norm(z - q * values, axis=0)[:wanted]
        if residuals.max() <= TOLERANCE * max(values[0], 0.0):
            return Whitening(np.maximum(values[:wanted], 0.0), q[:, :wanted], trace, residuals, passes)
        q = _filtered(q, z, values, degree, times)
        if width < dim:
            q[:, -1] = draw.standard_normal(dim)
        q = np.linalg.qr(q)[0]
    raise RuntimeError(f"residuals {residuals.tolist()} after {MAX_ROUNDS} rounds")


def _filtered(
    q: np.ndarray, z: np.ndarray, values: np.ndarray, degree: int, times: Callable[[np.ndarray], np.ndarray]
) -> np.ndarray:
    """The Chebyshev polynomial of ``degree`` in V times ``q``, damping [0, smallest Ritz value].

    ``z`` is V Q already. Scaled by its value at the largest eigenvalue, so nothing overflows.
    """
    half = max(values[-1], 1e-9 * values[0]) / 2
    scale = half / (values[0] - half)
    first = scale
    before, now = q, (z - half * q) * (first / half)
    for _ in range(degree - 1):
        after = 1.0 / (2.0 / first - scale)
        before, now = now, (times(now) - half * now) * (2.0 * after / half) - before * (scale * after)
        scale = after
    return now


def whitened(b: Blocks, model: Whitening) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error."""
    shape, k = b.shape, len(model.values)
    ok = model.varying
    project = np.where(ok, model.vectors / np.sqrt(np.where(ok, model.values, 1.0)), 0.0)

    def moments(x: np.ndarray) -> np.ndarray:
        w = x @ project
        return np.vstack([w.T @ w, w.sum(axis=0)])

    total = _summed(b, k + 1, k, moments) / shape.n
    error = np.abs(total[:-1] - np.outer(total[-1], total[-1]) - np.eye(k))[np.ix_(ok, ok)]
    identity_error = float(error.max()) if ok.any() else 0.0
    explained = np.where(ok, model.values, 0.0) / model.trace if model.trace > 0 else np.full(k, np.nan)
    modulus = np.array([(s + 2**63) % 2**64 - 2**63 for s in shape.sums], np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, nulls, data in zip(*(batch.column(c) for c in ("ids", "id_nulls", "data")), strict=True):
                x = shape.centred(data.as_buffer())
                size = (x * x).sum(axis=1) * float(shape.n) ** 2
                # Arithmetic modulo 2**64 is exact wherever the sum fits a long.
                spread = integers(data.as_buffer(), shape.dtype, shape.dim).astype(np.int64) * np.int64(shape.n) - modulus
                deviation = pa.array((spread * spread).sum(axis=1), mask=size > 2.0**63 * (1 - 1e-9))
                missing = np.frombuffer(nulls.as_buffer(), bool)
                w, n = x @ project, len(missing)
                every = pa.array(np.repeat(np.arange(n), k))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.frombuffer(ids.as_buffer(), "<i8"), mask=missing).take(every),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), n)),
                        pa.array(np.full(n * k, shape.n, np.int64)),
                        deviation.take(every),
                        pa.array(w.ravel(), mask=np.tile(~ok, n)),
                        pa.array(np.tile(explained, n), mask=np.isnan(np.tile(explained, n))),
                        pa.array(np.full(n * k, identity_error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return b.frame.mapInArrow(rows, WHITENED)


WHITENED = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whitening(vectors: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Fit on all usable rows of ``vectors`` (vec_id, embedding) and whiten them."""
    b = blocks(vectors)
    if b is None:
        return vectors.sparkSession.createDataFrame([], WHITENED)
    return whitened(b, fitted(b, components))
