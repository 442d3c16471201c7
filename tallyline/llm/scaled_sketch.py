"""Document fingerprints as threshold-scaled sketches.

A sketch keeps every shingle hash below a fixed fraction of all hash values, so its size follows
the document and the sketch of a union is the union of the sketches. Likeness (common over joint)
and containment (common over own) are read off two sketches however unequal the documents. A
document with words but no hash that small keeps its smallest one, which is also the smallest of
any union without a small hash, so sketches still merge: drop all hashes above the threshold
unless none lies below it, then keep the least.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrowtext import shingle_sets, slices

WIDTH, FRACTION = 5, 1 / 8
LEAST_LONG = -(2**63)


def thinned(hashes: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of a sorted array of distinct shingle hashes."""
    kept = hashes[: np.searchsorted(hashes, np.uint64(int(fraction * 2**64)))]
    return kept if len(kept) else hashes[:1]


def merged(a: np.ndarray, b: np.ndarray, fraction: float = FRACTION) -> np.ndarray:
    """The sketch of two documents together."""
    return thinned(np.union1d(a, b), fraction)


def written(sketch: np.ndarray) -> str:
    return sketch.astype(">u8").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u8").astype(np.uint64)


def shares(a: np.ndarray, b: np.ndarray) -> tuple[float, float]:
    """Likeness of two sketches, and the share of ``a`` contained in ``b``; two empty ones are alike."""
    common = len(np.intersect1d(a, b, assume_unique=True))
    joint = len(a) + len(b) - common
    return (common / joint if joint else 1.0), (common / len(a) if len(a) else 1.0)


def sketches(texts: list[str], width: int = WIDTH, fraction: float = FRACTION) -> list[np.ndarray]:
    found = []
    for _, data, offsets in slices(pa.array(texts, pa.large_string())):
        found += [thinned(s, fraction) for s in shingle_sets(data, offsets, width)]
    return found


def fingerprints(docs: DataFrame, width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """(doc_id, fingerprint) of every row of ``docs`` (doc_id, text, ...); no words give an empty one."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in slices(batch.column("text")):
                marks = [written(thinned(s, fraction)) for s in shingle_sets(data, offsets, width)]
                columns = [batch.column("doc_id").slice(row, len(marks)), pa.array(marks, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "fingerprint"])

    return docs.select("doc_id", "text").mapInArrow(mark, "doc_id long, fingerprint string")


def _dealt(bounds: list[int], least: int):
    """Give each row its range of ids; the first row of a range also visits the range before it.

    The very first row visits the last range, so every row meets its successor there.
    """
    edges, last = np.array(bounds, dtype=np.int64), len(bounds)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = batch.column("key").to_numpy()
            home = np.searchsorted(edges, key, "right")
            guests = [(np.flatnonzero(np.isin(key, edges)), -1)]
            if least is not None:
                guests.append((np.flatnonzero(key == least), None))
            for rows, step in [(np.arange(len(key)), 0), *guests]:
                if not len(rows):
                    continue
                to = np.full(len(rows), last) if step is None else home[rows] + step
                late = np.full(len(rows), step != 0)
                columns = [pa.array(to, pa.int64()), pa.array(late), *(c.take(pa.array(rows)) if step != 0 else c for c in batch.columns)]
                yield pa.RecordBatch.from_arrays(columns, names=["range", "late", *batch.schema.names])

    return deal


RESULT = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, kept_in_edited double"
)


def _compared(width: int, fraction: float, rows: int = 128):
    def results(ids: list, texts: list[str], following: str) -> pa.RecordBatch:
        """Compare each text with its edited form and with the next one; ``following`` is after the last."""
        nexts = [*texts[1:], following]
        halves = [len(t) // 2 for t in texts]
        edited = [t[: len(t) - h] + n[:h] for t, h, n in zip(texts, halves, nexts, strict=True)]
        own = sketches([*texts, following], width, fraction)
        other = sketches(edited, width, fraction)
        near = [shares(a, b) for a, b in zip(own, other, strict=False)]
        beside = [shares(a, b)[0] for a, b in zip(own, own[1:], strict=False)]
        columns = [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()),
            pa.array([written(s) for s in own[:-1]], pa.string()),
            pa.array([written(s) for s in other], pa.string()),
            pa.array([n[0] for n in near], pa.float64()),
            pa.array(beside, pa.float64()),
            pa.array([n[1] for n in near], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in RESULT.split(", ")])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, place, done = [], [], None, False
        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("range", "late", "doc_id", "text"))
            for to, late, doc_id, text in zip(*columns, strict=True):
                if to != place:
                    ids, texts, place, done = [], [], to, False
                if done:
                    continue
                if texts and (late or len(texts) == rows or sum(map(len, texts[-2:])) > 1 << 20):
                    yield results(ids, texts, text)
                    ids, texts = [], []
                done = late
                ids.append(doc_id)
                texts.append(text)

    return compare


def edited_likeness(docs: DataFrame, width: int = WIDTH, fraction: float = FRACTION) -> DataFrame:
    """Fingerprint every text of ``docs`` (doc_id, text, ...), its edited text and its successor's.

    The edited text has its last floor(n/2) code points replaced by the first as many of the next
    document in ascending doc_id order, the first after the last. Null texts count as empty, null
    ids come first, rows of one id are ordered by text. Documents meet their successors in ranges
    of ids: one shuffle of the texts, and one row more for each range.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("doc_id", F.lit(LEAST_LONG)).alias("key"))
    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    row = docs.select(F.percentile_approx("key", steps, F.lit(20 * ranges)), F.min("key")).first()
    bounds = sorted({b for b in row[0] or [] if b > row[1]})
    dealt = docs.mapInArrow(_dealt(bounds, row[1]), "range long, late boolean, doc_id long, text string, key long")
    met = dealt.repartition("range").sortWithinPartitions("range", "late", "key", "text")
    return met.mapInArrow(_compared(width, fraction), RESULT)
