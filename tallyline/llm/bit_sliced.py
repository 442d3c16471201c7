"""Exact top-k inner products with a bit-sliced index.

Vectors are quantised to integers and kept in blocks of rows. Of each block and component the
index holds one bitmap per bit (a slice). The scores of all rows of a block against a query are a
sum of slices: a component times a query's number adds its slices once for each bit set in that
number, shifted by the bit, and all slices of one weight are added with carry-save adders, 64
rows to a machine word, a block of queries at a time. From the sum, itself bit-sliced, the best
rows are taken from the most significant slice downward: rows with the bit displace those
without until k are left; rows that are equal to the last slice are decided by the smaller id.

Queries meet every block of rows once, in tiles: a strip of blocks and a part of the queries, dealt
to each other by key, so that neither side is ever collected. A tile hands on the k best of its strip.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SCALE = 256.0
BLOCK_ROWS, QUERY_ROWS, QUERY_BLOCKS = 4096, 64, 64
# Strips there are at least, if there are as many blocks, and blocks a strip has on average at most.
STRIPS, STRIP_BLOCKS = 64, 16
MOST_TASKS = 2048
U64 = np.uint64
ALL = U64(2**64 - 1)


def whole(vectors: DataFrame) -> DataFrame:
    """The rows (vec_id, embedding) that take part: no null and no non-finite component, not empty."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.select("vec_id", "embedding").filter(F.col("vec_id").isNotNull() & (F.size("embedding") > 0) & finite)


def _numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Quantised components, one row a vector; all vectors of a group are equally long."""
    values = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in column.chunks]).astype(np.float64)
    return np.floor(SCALE * values).astype(np.int64).reshape(len(column), -1)


def _sliced(table: pa.Table) -> pa.Table:
    """One block of the index: ids in order, least values, and slices [component, bit, word]."""
    table = table.sort_by("vec_id")
    values = _numbers(table.column("embedding"))
    least = values.min(axis=0)
    above = (values - least).T
    bits = max(int(above.max()).bit_length(), 1)
    words = -(-len(values) // 64)
    padded = np.zeros((len(least), words * 64), np.int64)
    padded[:, : len(values)] = above
    slices = [np.packbits(((padded >> b) & 1).astype(np.uint8), axis=1, bitorder="little") for b in range(bits)]
    return pa.table({
        "dim": table.column("dim")[:1], "block": table.column("block")[:1],
        "ids": pa.array([table.column("vec_id").to_numpy().astype(np.int64).tobytes()], pa.binary()),
        "least": pa.array([least.tobytes()], pa.binary()),
        "bits": pa.array([bits], pa.int32()),
        "slices": pa.array([np.stack(slices, axis=1).tobytes()], pa.binary()),
    })


INDEX = "dim int, block int, ids binary, least binary, bits int, slices binary"


def block_count(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> int:
    return max(1, ceil(whole(vectors).count() / block_rows))


def index(vectors: DataFrame, block_rows: int = BLOCK_ROWS, blocks: int | None = None) -> DataFrame:
    """The bit-sliced index of ``vectors`` (vec_id, embedding, ...): one row per block of about ``block_rows``."""
    rows = whole(vectors)
    blocks = blocks or block_count(vectors, block_rows)
    spread = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(blocks)).cast("int")
    rows = rows.select("vec_id", "embedding", F.size("embedding").alias("dim"), spread.alias("block"))
    return rows.groupBy("dim", "block").applyInArrow(_sliced, INDEX)


def _added(planes: dict[int, list[np.ndarray]], weight: int, plane: np.ndarray) -> None:
    """Add a plane of 1 << weight; three of one weight become one and a carry."""
    while True:
        held = planes.setdefault(weight, [])
        held.append(plane)
        if len(held) < 3:
            return
        a, b, c = held
        half = a ^ b
        planes[weight] = [half ^ c]
        np.bitwise_and(half, c, out=half)
        plane = half | (a & b)
        weight += 1


def sums(slices: np.ndarray, numbers: np.ndarray) -> list[np.ndarray]:
    """Slices of the scores of all rows: for each query (row of ``numbers``), sum of |number| * value.

    Where a number is negative the value's slices are complemented; the caller adds the constant.
    """
    size, sign = np.abs(numbers).astype(np.uint64), np.where(numbers < 0, ALL, U64(0))
    queries, words = len(numbers), slices.shape[2]
    masks = [np.where((size >> U64(j)) & U64(1) > 0, ALL, U64(0)) for j in range(int(size.max(initial=0)).bit_length())]
    planes: dict[int, list[np.ndarray]] = {}
    for d in range(slices.shape[0]):
        used = [(j, m[:, d, None]) for j, m in enumerate(masks) if m[:, d].any()]
        for b in range(slices.shape[1]):
            plane = slices[d, b] ^ sign[:, d, None]
            for j, mask in used:
                _added(planes, b + j, plane & mask)
    total, weight = [], 0
    while weight <= max(planes, default=-1):
        held = planes.get(weight, [])
        while len(held) > 1:
            a, b = held.pop(), held.pop()
            held.append(a ^ b)
            planes.setdefault(weight + 1, []).append(a & b)
        total.append(held[0] if held else np.zeros((queries, words), U64))
        weight += 1
    return total


def _first_bits(row: np.ndarray, most: int) -> list[int]:
    """Positions of the lowest set bits of a bitmap."""
    found = []
    for word in np.flatnonzero(row).tolist():
        value = int(row[word])
        while value and len(found) < most:
            low = value & -value
            found.append(64 * word + low.bit_length() - 1)
            value ^= low
        if len(found) == most:
            break
    return found


def best(total: list[np.ndarray], candidates: np.ndarray, k: int) -> list[list[int]]:
    """For each query the ``k`` candidate rows with the largest sums, ties to the lower row."""
    chosen, open_ = np.zeros_like(candidates), candidates
    for plane in reversed(total):
        upper = open_ & plane
        reached = np.bitwise_count(chosen | upper).sum(axis=1)
        full, short = (reached >= k)[:, None], (reached < k)[:, None]
        chosen = np.where(short, chosen | upper, chosen)
        open_ = np.where(full, upper, open_ & ~plane)
    found = []
    for sure, equal in zip(chosen, open_, strict=True):
        rows = _first_bits(sure, k)
        found.append(rows + _first_bits(equal, k - len(rows)))
    return found


def _tile(block: dict, query_ids: np.ndarray, numbers: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    ids, least = np.frombuffer(block["ids"], np.int64), np.frombuffer(block["least"], np.int64)
    words = -(-len(ids) // 64)
    slices = np.frombuffer(block["slices"], np.uint8).reshape(block["dim"], block["bits"], words * 8).view(U64)
    total = sums(slices, numbers)
    constant = (numbers * np.where(numbers < 0, least + (1 << block["bits"]) - 1, least)).sum(axis=1)
    there = np.zeros(words * 64, np.uint8)
    there[: len(ids)] = 1
    there = np.packbits(there, bitorder="little").view(U64)
    candidates = np.repeat(there[None, :], len(query_ids), axis=0)
    for q, (a, b) in enumerate(zip(np.searchsorted(ids, query_ids).tolist(), np.searchsorted(ids, query_ids, "right").tolist(), strict=True)):
        for row in range(a, b):
            candidates[q, row // 64] &= ~(U64(1) << U64(row % 64))
    for q, rows in enumerate(best(total, candidates, k)):
        for row in rows:
            score = sum(int(plane[q, row // 64] >> U64(row % 64) & U64(1)) << w for w, plane in enumerate(total))
            yield int(query_ids[q]), int(ids[row]), score + int(constant[q])


def _scored(k: int):
    names = ("query_id", "vec_id", "score")

    def score(strip: pa.Table, queries: pa.Table) -> pa.Table:
        """The ``k`` best of a strip for each query of a part, some queries at a time."""
        kept = [np.zeros((3, 0), np.int64)]
        for start in range(0, len(queries) if len(strip) else 0, QUERY_ROWS):
            some = queries.slice(start, QUERY_ROWS)
            query_ids, numbers = some.column("vec_id").to_numpy().astype(np.int64), _numbers(some.column("embedding"))
            found = []
            for i in range(len(strip)):
                block = {n: strip.column(n)[i].as_py() for n in ("dim", "ids", "least", "bits", "slices")}
                found += _tile(block, query_ids, numbers, k)
            if found:
                kept.append(_first_of_each(np.array(found, np.int64).T, k))
        return pa.table(dict(zip(names, np.concatenate(kept, axis=1), strict=True)))

    return score


def _first_of_each(found: np.ndarray, k: int) -> np.ndarray:
    """Of columns (query, row, score) the first ``k`` of each query, largest score first, ties to the lower id."""
    query, row, score = found
    found = found[:, np.lexsort((row, -score, query))]
    starts = np.flatnonzero(np.diff(found[0], prepend=found[0][0] - 1))
    nth = np.arange(found.shape[1]) - np.repeat(starts, np.diff(starts, append=found.shape[1]))
    return found[:, nth < k]


def top_k(vectors: DataFrame, chosen: Column, k: int = 5, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best of ``vectors`` (vec_id, embedding, ...) for each chosen row.

    The score is the integer inner product of components quantised to floor(256 * x). Rows with
    the query's own vec_id are no candidates; ties go to the smaller vec_id. Null or empty
    vectors, those with a null or non-finite component and rows without a vec_id take no part;
    vectors of different length are not compared. Repeated rows are candidates each, but one query.
    """
    queries = whole(vectors.filter(chosen)).dropDuplicates(["vec_id"])
    blocks, parts = block_count(vectors, block_rows), max(1, ceil(queries.count() / (QUERY_ROWS * QUERY_BLOCKS)))
    strips = min(blocks, max(STRIPS, ceil(blocks / STRIP_BLOCKS)))
    # A tile is a strip and a part. Each strip is sent to every part and each query to every strip; the
    # two are cogrouped, not joined: a join may collect one side by an estimate that does not see how
    # often it is dealt, and would hand on the bytes of a block once for every block of queries.
    rows = index(vectors, block_rows, blocks).withColumn("strip", F.col("block") % strips)
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    own = F.pmod(F.xxhash64("vec_id"), F.lit(parts)).cast("int")
    dealt = queries.select("vec_id", "embedding", F.size("embedding").alias("dim"), own.alias("part"))
    dealt = dealt.withColumn("strip", F.explode(F.sequence(F.lit(0), F.lit(strips - 1))))
    tile, tasks = ("dim", "strip", "part"), min(4 * strips * parts, MOST_TASKS)
    sides = [side.repartition(tasks, *tile).groupBy(*tile) for side in (rows, dealt)]
    scores = sides[0].cogroup(sides[1]).applyInArrow(_scored(k), "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = scores.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
