"""Token ids in files of bit or byte planes.

Documents are sorted by id over range partitions, encoded, and their ids, each document closed by
an end id, are cut into blocks of a fixed number of ids. A block is transposed: plane k holds byte
(or bit) k of all its ids, and each plane is compressed by zstandard, high planes to next to
nothing. A record of the file is one block with its index: its place, the size of each plane,
and the documents that have ids in it. The records lie in Parquet, without a second compression, so a
file appears only when its task has committed and any storage Spark reaches will do.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer

from tallyline.llm.arrowtext import slices

END_ID = 1
BLOCK_IDS = 1 << 16
REMEMBERED = 600_000
JOINED = 1000
#: Text of these characters is left alone by composition, lower-cases letter by letter, and is
#: parted by white space; then each piece has its ids whatever stands beside it.
PLAIN = "^[\t\n\r\x20-\x7e\xa1-Ġı-ɏ]*$"
TEXT_BYTES = 4 << 20
LETTERS = r"[\p{L}]+"

RECORD = (
    "part long, block long, first_id long, n_ids long, plane_bits int, plane_sizes array<int>, planes binary, "
    "doc_ids array<long>, doc_starts array<long>, doc_sizes array<long>"
)


@lru_cache(maxsize=1)
def _tokenizer(content: str) -> Tokenizer:
    return Tokenizer.from_str(content)


def _piece_rule(content: str) -> tuple[str, str] | None:
    """For a tokenizer that encodes matches of a pattern one by one: the pieces that are not runs of
    letters, as a pattern, and the mark of a piece's last id.

    Runs of letters must be pieces whole, so what comes before them in the pattern begins with a quote.
    """
    spec = json.loads(content)
    split = next(iter((spec.get("pre_tokenizer") or {}).get("pretokenizers", [])), {})
    mark = spec["model"].get("end_of_word_suffix")
    if not mark or (split.get("type"), split.get("behavior"), split.get("invert")) != ("Split", "Removed", True):
        return None
    ways = split["pattern"]["Regex"].split("|")
    if LETTERS not in ways or not all(w.startswith("'") for w in ways[: ways.index(LETTERS)]):
        return None
    return "|".join(w for w in ways if w != LETTERS), mark


class Encoder:
    """Ids of texts as little-endian 32-bit numbers; remembers the ids of pieces between texts.

    Arrow lowers a batch, puts blanks around its pieces and numbers the different ones; only those are
    looked up, and the ids of all are gathered by number. Pieces not met before are encoded many in
    one text, and the ids parted behind those that end a piece. Texts beyond PLAIN, and all texts of
    tokenizers that split otherwise, go to the tokenizer as they are.
    """

    def __init__(self, content: str):
        self.tokenizer = _tokenizer(content)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._forget()
        rule = _piece_rule(content)
        self.pieces = rule and rule[0]
        if rule:
            vocabulary = self.tokenizer.get_vocab()
            self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
            self.ends[[i for token, i in vocabulary.items() if token.endswith(rule[1])]] = True

    def _forget(self) -> None:
        """``known`` numbers the pieces met; piece k has the ids ``ids[starts[k] : starts[k + 1]]``."""
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, "<u4")
        self.starts = np.zeros(1, np.int64)

    def _listed(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _of_pieces(self, pieces: list[str]) -> Iterator[bytes]:
        for at in range(0, len(pieces), JOINED):
            some = pieces[at : at + JOINED]
            (data,) = self._listed([" ".join(some)])
            stops = (np.flatnonzero(self.ends[np.frombuffer(data, "<u4")]) + 1) * 4
            if len(stops) != len(some) or stops[-1] != len(data):
                yield from self._listed(some)
            else:
                yield from (data[a:b] for a, b in pairwise([0, *stops.tolist()]))

    def _numbered(self, pieces: list[str]) -> np.ndarray:
        """The number of each of different pieces, after those not met yet are encoded."""
        new = [p for p in pieces if p not in self.known]
        if len(self.known) + len(new) > REMEMBERED:
            self._forget()
            new = pieces
        if new:
            coded = list(self._of_pieces(new))
            sizes = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
            self.ids = np.concatenate([self.ids, np.frombuffer(b"".join(coded), "<u4")])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(sizes)])
        return np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))

    def _gathered(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of plain texts."""
        spaced = pc.replace_substring_regex(pc.utf8_lower(texts), self.pieces, r" \0 ")
        split = pc.ascii_split_whitespace(spaced)
        numbered = split.flatten().dictionary_encode()
        number = self._numbered(numbered.dictionary.to_pylist())[numbered.indices.to_numpy()]
        sizes = np.diff(self.starts)[number]
        stops = np.concatenate([[0], np.cumsum(sizes)])
        step = np.int32 if max(len(self.ids), stops[-1]) < 2**31 else np.int64
        places = np.repeat((self.starts[number] - stops[:-1]).astype(step), sizes)
        places += np.arange(stops[-1], dtype=step)
        flat = self.ids[places]
        bounds = stops[np.concatenate([[0], np.cumsum(split.value_lengths().to_numpy())])]
        return (flat[a:b] for a, b in pairwise(bounds.tolist()))

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        texts = pc.fill_null(texts, "")
        if self.pieces is None:
            return [np.frombuffer(ids, "<u4") for ids in self._listed(texts.to_pylist())]
        plain = pc.match_substring_regex(texts, PLAIN)
        for special in self.special:
            plain = pc.and_not(plain, pc.match_substring(texts, special))
        rows = self._gathered(texts.filter(plain))
        others = iter(self._listed(texts.filter(pc.invert(plain)).to_pylist()))
        return [next(rows) if p else np.frombuffer(next(others), "<u4") for p in plain.to_pylist()]


@lru_cache(maxsize=1)
def _encoder(content: str) -> Encoder:
    """One for all tasks of a worker: pieces met in one task are known to the next."""
    return Encoder(content)


def transposed(ids: np.ndarray, plane_bits: int) -> list[bytes]:
    """The planes of a block of 32-bit ids, lowest first."""
    cells = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if plane_bits == 1:
        return [np.packbits(p).tobytes() for p in np.unpackbits(cells, axis=1, bitorder="little").T]
    return [p.tobytes() for p in cells.T]


def restored(planes: list[bytes], plane_bits: int, n_ids: int) -> np.ndarray:
    rows = [np.frombuffer(p, np.uint8) for p in planes]
    if plane_bits == 1:
        cells = np.packbits(np.stack([np.unpackbits(r, count=n_ids) for r in rows]).T, axis=1, bitorder="little")
    else:
        cells = np.stack(rows).T
    return np.ascontiguousarray(cells).view("<u4").reshape(-1)


def _packed(content, end_id: int, block_ids: int, plane_bits: int, level: int):
    """Blocks of a sorted partition; only the ids of the open block are held."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One thread a task: Spark has given the other cores to other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, squeeze = _encoder(content.value), zstandard.ZstdCompressor(level)
        part, block, first = TaskContext.get().partitionId(), 0, 0
        open_, held, listed = [], 0, []  # arrays of ids, their number, documents (id, start, size)

        def record(ids: np.ndarray) -> pa.RecordBatch:
            planes = [squeeze.compress(p) for p in transposed(ids, plane_bits)]
            doc_ids, starts, sizes = (list(x) for x in zip(*listed, strict=True))
            row = [part, block, first, len(ids), plane_bits, [len(p) for p in planes], b"".join(planes), doc_ids, starts, sizes]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _TYPES, strict=True)], names=_NAMES)

        end = np.array([end_id], "<u4")
        for batch in batches:
            for at, _, offsets in slices(batch.column("text"), TEXT_BYTES):
                some = batch.slice(at, len(offsets) - 1)
                coded = encode(some.column("text"))
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), coded, strict=True):
                    ids = np.concatenate([ids, end])
                    listed.append((doc_id, first + held, len(ids)))
                    open_.append(ids)
                    held += len(ids)
                    if held < block_ids:
                        continue
                    joined, at_ = np.concatenate(open_), 0
                    while held - at_ >= block_ids:
                        yield record(joined[at_ : at_ + block_ids])
                        at_, block, first = at_ + block_ids, block + 1, first + block_ids
                        listed = [x for x in listed[-1:] if x[1] + x[2] > first]
                    open_, held = [joined[at_:].copy()], held - at_
        if held:
            yield record(np.concatenate(open_))

    return pack


_ARROW = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64())}
_NAMES, _TYPES = zip(*((n, _ARROW[t]) for n, t in (c.split() for c in RECORD.split(", "))), strict=True)


def write(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = END_ID,
    block_ids: int = BLOCK_IDS, plane_bits: int = 8, level: int = 3,
) -> None:
    """Write the ids of ``docs`` (doc_id, text, ...) in ascending doc_id order below ``path``.

    ``tokenizer`` is the path of a tokenizer file. A null or empty text is the end id alone. Rows
    of one doc_id follow each other in the order of their texts, null ids come first. No rows give
    files without records.
    """
    if plane_bits not in (1, 8):
        raise ValueError("plane_bits is 1 or 8")
    content = docs.sparkSession.sparkContext.broadcast(Path(tokenizer).read_text())
    ordered = docs.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    blocks = ordered.mapInArrow(_packed(content, end_id, block_ids, plane_bits, level), RECORD)
    blocks.write.option("compression", "uncompressed").parquet(path)


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What each document has in each block: its checksum if that is all of it, else the bytes."""
    expand = zstandard.ZstdDecompressor()
    for batch in batches:
        for r in batch.to_pylist():
            stops = np.cumsum(r["plane_sizes"]).tolist()
            planes = [expand.decompress(r["planes"][a:b]) for a, b in zip([0, *stops], stops, strict=False)]
            data = restored(planes, r["plane_bits"], r["n_ids"]).tobytes()
            out = []
            for doc_id, start, size in zip(r["doc_ids"], r["doc_starts"], r["doc_sizes"], strict=True):
                a, b = max(start - r["first_id"], 0), min(start + size - r["first_id"], r["n_ids"])
                piece = data[4 * a : 4 * b]
                whole = b - a == size
                out.append((doc_id, r["base"] + start, size, r["block"], zlib.crc32(piece) if whole else None, None if whole else piece))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "block", "crc", "piece"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = []
        for parts in batch.column("parts").to_pylist():
            crc = parts[0]["crc"]
            if crc is None:
                crc = 0
                for part in parts:
                    crc = zlib.crc32(part["piece"], crc)
            sums.append(crc)
        columns = [*(batch.column(c) for c in ("doc_id", "start", "n_tokens")), pa.array(sums, pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])


def summary(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone.

    Blocks are read in any order; a document over several blocks is put together from its pieces.
    """
    blocks = spark.read.schema(RECORD).parquet(path)
    along = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    bases = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    bases = bases.select("part", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("base"))
    pieces = blocks.join(F.broadcast(bases), "part").mapInArrow(
        _unpacked, "doc_id long, start long, n_tokens long, block long, crc long, piece binary"
    )
    parts = F.sort_array(F.collect_list(F.struct("block", "crc", "piece"))).alias("parts")
    together = pieces.groupBy("doc_id", "start", "n_tokens").agg(parts)
    return together.mapInArrow(_joined, "doc_id long, start long, n_tokens long, ids_crc32 long")
