"""Byte-level BPE with overlapping chunks.

Texts up to a chunk are encoded where they are read. A longer text is cut into chunks that
overlap by ``overlap`` characters and are dealt out to all tasks. Each is split by the
pre-token pattern from its own first character, wherever that falls. Two neighbours agree again
at the first boundary that both have in their overlap: the pattern looks only ahead, so from a
common boundary on their pre-tokens are the same. The pieces between those boundaries are
encoded on their own and put together in order; no byte pair is merged across a pre-token, so
the ids are those of the whole text. If the overlap holds no common boundary, as in one endless
word, the text is encoded in one go. Decoding concatenates the bytes of the ids.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

CHUNK, OVERLAP = 1 << 15, 1 << 9
#: No alternative of the pattern looks further than this beyond a boundary.
LOOK_AHEAD = 4


class Vocabulary:
    """The ranks of a ``.tiktoken`` file and the pattern of its pre-tokens; sent to tasks as bytes."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks, self.pattern = ranks, pattern

    @classmethod
    def read(cls, path: str, pattern: str) -> Vocabulary:
        return cls(Path(path).read_bytes(), pattern)

    def shared(self, spark: SparkSession) -> Broadcast:
        return spark.sparkContext.broadcast((self.ranks, self.pattern))


@lru_cache(maxsize=2)
def _coder(ranks: bytes, pattern: str) -> tiktoken.Encoding:
    by_bytes = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, ranks.splitlines()) if token}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=by_bytes, special_tokens={})


def _ids(coder: tiktoken.Encoding, text: str) -> np.ndarray:
    # Without special tokens nothing is allowed or refused: every text is ordinary.
    return coder.encode_to_numpy(text, disallowed_special=()).astype(np.int32)


def _listed(lists: list[np.ndarray]) -> pa.ListArray:
    places = np.concatenate([[0], np.cumsum([len(x) for x in lists])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(places), pa.array(np.concatenate([*lists, np.empty(0, np.int32)]), pa.int32()))


def _id_rows(column: pa.ListArray) -> Iterator[list[int]]:
    """The ids of each row; one conversion a row instead of one an id. A null row has none."""
    flat, places = column.values.to_numpy(), column.offsets.to_numpy()
    for a, b, there in zip(places[:-1], places[1:], column.is_valid().to_pylist(), strict=True):
        yield flat[a:b].tolist() if there else []


def _rows(batch: pa.RecordBatch, size: int = 256) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _encoding(shared: Broadcast, keys: tuple[str, ...], piece):
    """A map over batches that encodes ``piece(row number, batch)`` of each row."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*shared.value)
        for whole in batches:
            for batch in _rows(whole):
                ids = _listed([_ids(coder, text) for text in piece(batch)])
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), ids], names=[*keys, "ids"])

    return encode


def _texts(batch: pa.RecordBatch) -> Iterator[str]:
    return (text or "" for text in batch.column("text").to_pylist())


def _chunked(chunk: int, overlap: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _rows(whole, 1):
                (text,) = _texts(batch)
                starts = range(0, len(text), chunk)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([batch.column("key")[0].as_py()] * len(starts), pa.string()),
                        pa.array(range(len(starts)), pa.int32()),
                        pa.array([text[s : s + chunk + overlap] for s in starts], pa.string()),
                        pa.array([s + chunk + overlap >= len(text) for s in starts]),
                    ],
                    names=["key", "chunk", "text", "ends"],
                )

    return cut


def _bounds(pattern: str, chunk: int, overlap: int):
    """Boundaries of each chunk in its first and in its last overlap, counted from there."""
    split = regex.compile(pattern)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in _rows(whole):
                heads, tails = [], []
                for text, ends in zip(_texts(batch), batch.column("ends").to_pylist(), strict=True):
                    sure = len(text) if ends else len(text) - LOOK_AHEAD
                    found = np.array([0, *(m.end() for m in split.finditer(text))], dtype=np.int32)
                    found = found[found <= sure]
                    heads.append(found[found < overlap])
                    tails.append(found[found >= chunk] - chunk)
                columns = [batch.column("key"), batch.column("chunk"), _listed(heads), _listed(tails)]
                yield pa.RecordBatch.from_arrays(columns, names=["key", "chunk", "head", "tail"])

    return find


def _between(chunk: int):
    def pieces(batch: pa.RecordBatch) -> Iterator[str]:
        starts, stops = batch.column("start").to_pylist(), batch.column("stop").to_pylist()
        for text, start, stop in zip(_texts(batch), starts, stops, strict=True):
            yield text[start : len(text) if stop is None else chunk + stop]

    return pieces


def encoded(docs: DataFrame, vocabulary: Vocabulary, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """(doc_id, ids array<int>) of each row of ``docs`` (doc_id, text, ...), whatever its length.

    A null or empty text has no ids. Repeated rows, and rows without a doc_id, are all returned.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shared = vocabulary.shared(docs.sparkSession)
    size = F.length("text")
    short = docs.filter(size <= chunk).mapInArrow(_encoding(shared, ("doc_id",), _texts), "doc_id long, ids array<int>")

    long = docs.filter(size > chunk).withColumn("key", F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("-")), "text")))
    chunks = long.select("key", "text").mapInArrow(
        _chunked(chunk, overlap), "key string, chunk int, text string, ends boolean"
    ).repartition("key", "chunk")
    bounds = chunks.mapInArrow(
        _bounds(vocabulary.pattern, chunk, overlap), "key string, chunk int, head array<int>, tail array<int>"
    ).distinct()
    along = Window.partitionBy("key").orderBy("chunk")
    ahead = F.lead("head").over(along)
    met = bounds.select("key", "chunk", F.array_min(F.array_intersect("tail", ahead)).alias("stop"), ahead.isNull().alias("last"))
    cuts = met.select("key", "chunk", "stop", F.coalesce(F.lag("stop").over(along), F.lit(0)).alias("start"),
                      F.min(F.col("last") | F.col("stop").isNotNull()).over(Window.partitionBy("key")).alias("stitched"))
    pieces = chunks.join(cuts.filter("stitched"), ["key", "chunk"])
    pieces = pieces.mapInArrow(_encoding(shared, ("key", "chunk"), _between(chunk)), "key string, chunk int, ids array<int>")
    together = pieces.groupBy("key").agg(F.sort_array(F.collect_set(F.struct("chunk", "ids"))).alias("pieces"))
    together = together.select("key", F.flatten("pieces.ids").alias("ids"))
    unbroken = long.join(cuts.filter("not stitched").select("key").distinct(), "key", "left_semi")
    unbroken = unbroken.select("doc_id", "text").mapInArrow(_encoding(shared, ("doc_id",), _texts), "doc_id long, ids array<int>")
    stitched = long.select("doc_id", "key").join(together, "key").select("doc_id", "ids")
    return short.unionByName(stitched).unionByName(unbroken)


def decoded(ids: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, data binary) of rows (doc_id, ids): the bytes of the ids, one after the other."""
    shared = vocabulary.shared(ids.sparkSession)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*shared.value)
        for whole in batches:
            for batch in _rows(whole):
                data = [coder.decode_bytes(row) for row in _id_rows(batch.column("ids"))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(data, pa.binary())], names=["doc_id", "data"])

    return ids.select("doc_id", "ids").mapInArrow(decode, "doc_id long, data binary")


def digests(ids: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of rows (doc_id, ids)."""
    shared = vocabulary.shared(ids.sparkSession)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(*shared.value)
        spelled = [str(i) for i in range(coder.n_vocab)]
        for whole in batches:
            for batch in _rows(whole):
                sizes, of_ids, of_bytes = [], [], []
                for row in _id_rows(batch.column("ids")):
                    sizes.append(len(row))
                    of_ids.append(hashlib.sha256(",".join([spelled[i] for i in row]).encode()).hexdigest())
                    of_bytes.append(hashlib.sha256(coder.decode_bytes(row)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return ids.select("doc_id", "ids").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
