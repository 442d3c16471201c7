"""Exact top-k by cosine similarity for any set of query vectors against a large chunk table."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.vectors import SIMILARITY_PLACES
from tallyline.operators.topk import top_per_group
from tallyline.workspace import stored

PACK_BYTES = 1 << 20  # unit vectors in one pack
HELD_HITS = 200_000  # hits a task gathers before it keeps the best of them only
MIN_SIMILARITY = 0.4
LIMIT = 5

HITS = "query_id bigint, report_id bigint, chunk_index int, similarity double"
NAMES = ["query_id", "report_id", "chunk_index", "similarity"]


def _packed(frame: DataFrame, keys: Sequence[str], vectors: str) -> DataFrame:
    """Rows (keys, embedding) as packs: lists of keys beside one matrix ``vectors`` of unit vectors.

    A pack holds vectors of one length, PACK_BYTES at most. Vectors of length zero become NaN.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            embedding = batch.column("embedding")
            sizes = pc.list_value_length(embedding).to_numpy()
            start = 0
            while start < len(sizes):
                width = int(sizes[start])
                stop = min(start + max(1, PACK_BYTES // (8 * max(width, 1))), len(sizes))
                other = np.flatnonzero(sizes[start:stop] != width)
                n = int(other[0]) if len(other) else stop - start
                rows = embedding.slice(start, n).flatten().to_numpy(zero_copy_only=False)
                rows = rows.astype(np.float64).reshape(n, width)
                with np.errstate(invalid="ignore", divide="ignore"):
                    rows = rows / np.linalg.norm(rows, axis=1, keepdims=True)
                lists = [pa.ListArray.from_arrays([0, n], batch.column(k).slice(start, n)) for k in keys]
                yield pa.RecordBatch.from_arrays([*lists, pa.array([rows.tobytes()], pa.binary())], names=[*keys, vectors])
                start += n

    whole = frame.dropna(subset=[*keys, "embedding"]).select(*keys, "embedding")
    lists = ", ".join(f"{k} array<{whole.schema[k].dataType.simpleString()}>" for k in keys)
    return whole.mapInArrow(pack, f"{lists}, {vectors} binary")


def _best(hits: list[tuple[np.ndarray, ...]], limit: int) -> tuple[np.ndarray, ...]:
    """The first ``limit`` hits of every query."""
    query, report, chunk, similarity = (np.concatenate(c) for c in zip(*hits, strict=True))
    order = np.lexsort((chunk, report, -similarity, query))
    query = query[order]
    new = np.concatenate([[True], query[1:] != query[:-1]])
    nth = np.arange(len(query)) - np.maximum.accumulate(np.where(new, np.arange(len(query)), 0))
    order = order[nth < limit]
    return query[nth < limit], report[order], chunk[order], similarity[order]


def _scored(min_similarity: float, limit: int | None):
    """Hits of pairs of packs; with a limit only the best of each query leave the task."""

    def matrix(column: pa.Array, i: int, n: int) -> np.ndarray:
        return np.frombuffer(column[i].as_buffer(), np.float64).reshape(n, -1)

    def as_batch(hits: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in hits], names=NAMES)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, kept = [], 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                query, report, chunk = (batch.column(k)[i].values.to_numpy() for k in NAMES[:3])
                rows = matrix(batch.column("vectors"), i, len(report))
                wanted = matrix(batch.column("wanted"), i, len(query))
                if rows.shape[1] != wanted.shape[1]:
                    raise ValueError(f"stored vectors must have {wanted.shape[1]} elements like the queries")
                similarity = np.round(wanted @ rows.T, SIMILARITY_PLACES)
                fits = similarity >= min_similarity  # NaN, from a vector of length zero, does not
                if limit is not None and len(report) > limit:
                    similarity = np.where(fits, similarity, -np.inf)
                    least = np.partition(similarity, len(report) - limit, axis=1)[:, len(report) - limit]
                    fits &= similarity >= least[:, None]  # equal ones stay: their keys decide later
                q, r = np.nonzero(fits)
                hits = (query[q], report[r], chunk[r], similarity[q, r])
                if limit is None:
                    yield as_batch(hits)
                    continue
                held.append(hits)
                size += len(q)
                if size > HELD_HITS + 2 * kept:
                    held = [_best(held, limit)]
                    size = kept = len(held[0][0])
        if size:
            yield as_batch(_best(held, limit))

    return score


def _hits(chunks: DataFrame, queries: DataFrame, min_similarity: float, limit: int | None) -> DataFrame:
    keys = chunks.select(F.col("report_id").cast("bigint"), F.col("chunk_index").cast("int"), "embedding")
    asked = queries.select(F.col("query_id").cast("bigint"), "embedding")
    blocks = stored(_packed(asked, ["query_id"], "wanted"), "query-blocks")
    pairs = _packed(keys, ["report_id", "chunk_index"], "vectors").crossJoin(blocks)
    return pairs.mapInArrow(_scored(min_similarity, limit), HITS)


def similar_chunks(chunks: DataFrame, queries: DataFrame, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """Every (query_id, report_id, chunk_index) that is similar enough.

    ``queries`` (query_id, embedding) may have any number of rows. They are written as blocks, so
    that their size is known: a set below the broadcast threshold goes to every task of the
    vectors, a larger one meets them block after block, one read of the vectors for each file of
    queries. Either way the vectors are not shuffled, a pair of packs is one matrix product, and
    pairs below the threshold never leave their task. Rows without a key or a vector and vectors
    of length zero find nothing; vectors of different lengths are an error.
    """
    return _hits(chunks, queries, min_similarity, None)


def top_chunks(
    chunks: DataFrame, queries: DataFrame, limit: int = LIMIT, min_similarity: float = MIN_SIMILARITY
) -> DataFrame:
    """The best ``limit`` of ``similar_chunks`` for every query_id, ties to the smaller keys.

    A task keeps ``limit`` hits a query, so no more than that meets the window.
    """
    hits = _hits(chunks, queries, min_similarity, limit)
    best_first = (F.desc("similarity"), F.asc("report_id"), F.asc("chunk_index"))
    return top_per_group(hits, ["query_id"], limit, *best_first)
