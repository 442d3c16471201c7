"""Exact removal of repeated passages with a logarithmic family of suffix arrays.

The arrays are sampled. Every window of ``LENGTH`` bytes chooses the ``KEY``-byte string in it with
the smallest hash; only suffixes that begin at a chosen place are kept, about one byte in forty.
Equal windows choose the same place, so two equal windows are always found under one suffix key,
wherever they stand. An entry stands for the run of neighbouring windows that chose its place: its
key is the first KEY bytes of the suffix, its context the hash of all bytes of those windows.

A batch of documents becomes a suffix array of its own: its entries are dealt out by key, and each
part is sorted as bytes by the KEY bytes the suffixes begin with, then by (context, document,
position). Order goes no deeper, since a window may end with the key it chose and then shares no
later byte of the suffix; what it shares besides is compared by the context. The batch is
merge-scanned against the existing levels in one pass: an entry whose context occurs earlier is
covered whole; entries of one key with different contexts are contested; all others are new. What is
new forms a level. Two levels of equal size become one of twice the size, in the same pass, which
meets their entries in suffix order anyway; so n batches leave at most log2(n) + 1 levels and each
entry is rewritten as often.

Contested runs, the ends of repeated passages, are worked out twice more with the same scan and
smaller units: slots of ``SLOT`` windows, which share a core of LENGTH - SLOT + 1 bytes, and then
single windows, so the result is exact to the byte. These are compared whole and kept in no level;
the hash of a core or window is their key. Identity is by two 64-bit hashes.

No key gathers more rows than there are pieces of input: within a piece, at most an Arrow batch and
some ENTRIES, equal contexts are reduced to their first, and where a key has several contexts there, its entries are dealt out by
key and context and a single marker tells the others of that key. What is copied or common in a
third of all documents is therefore spread like everything else.

A text is named by its doc_id and, since ids may be null or repeated, by 128 bits of its sha256:
every entry, join and reduction goes by all three columns. Where an id stands in one row only, it is
name enough and the bits are zero, which spares entries a third of their bytes.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.arrowtext import BASE, BYTE_CODE, SLICE_BYTES, U64, column_bytes, mixed, powers, running_code
from tallyline.llm.id_filter import bitmap, listed, spot
from tallyline.workspace import shuffles_dropped, stored

LENGTH, KEY, SLOT = 100, 24, 8
BATCHES = 4
#: Entries reduced together, of one Arrow batch at most.
ENTRIES = 1 << 17
WIDTH = LENGTH - KEY + 1
LEAST_LONG = -(2**63)
OTHER_CODE = BYTE_CODE[::-1].copy()

#: A place packs, from the top: the first window's start, 7 bits of the number of windows, 7 of the
#: distance to the chosen place, 2 for a row of a level (one that stays, one that merges), 2 of kind.
PLAIN, MARKER, COVERED, CONTESTED = range(4)
OLD, MERGING = 4, 8


def _place(start, n, lead, kind):
    return (np.asarray(start, np.int64) << 18) | (np.asarray(n, np.int64) << 11) | (np.asarray(lead, np.int64) << 4) | kind


#: What tells texts apart: the id and the two halves of the tag.
TEXT = ("doc_id", "tag", "tail")
#: The bytes a suffix begins with, eight in a number; the numbers are ordered as the bytes are.
WORDS = ("key", "key_8", "key_16")
ENTRY = "key long, key_8 long, key_16 long, ctx long, doc_id long, tag long, tail long, place long"
COLUMNS = (*WORDS, "ctx", *TEXT, "place")
#: The parts of a place in SQL.
START = "shiftright(place, 18)"
WINDOWS, LEAD = "shiftright(place, 11) & 127", "shiftright(place, 4) & 127"


def _hash(g: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Hash of data[start:stop] from the running code ``g`` of data."""
    spelled = (g[stop] - g[start]) * powers(len(g))[1][start]
    return mixed(spelled + np.asarray(stop - start).astype(np.uint64) * U64(BASE))


def _least_of(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, by doubling."""
    reach = 1
    while 2 * reach <= width:
        values = np.minimum(values[:-reach], values[reach:])
        reach *= 2
    rest = width - reach
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(first start, windows, chosen place, key hash, context hash) of all runs in the rows of ``data``."""
    if len(data) < LENGTH:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),) * 2
    g = running_code(data)
    keys = (g[KEY:] - g[:-KEY]) * powers(len(data) + 1)[1][: len(data) - KEY + 1]
    low = U64((1 << 24) - 1)
    chosen = _least_of((keys & ~low) | np.arange(len(keys), dtype=np.uint64), WIDTH) & low
    chosen = chosen.astype(np.int64)
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        chosen[max(a, b - LENGTH + 1) : b] = -1  # windows that would leave their row
    first = np.concatenate([[0], np.flatnonzero(chosen[1:] != chosen[:-1]) + 1])
    last = np.concatenate([first[1:], [len(chosen)]]) - 1
    real = chosen[first] >= 0
    first, last = first[real], last[real]
    place = chosen[first]
    return first, last - first + 1, place, mixed(keys[place]), _hash(g, first, last + LENGTH)


def _spelled(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The KEY bytes of ``data`` at each place, as rows of WORDS."""
    words = np.empty((len(WORDS), len(place)), np.int64)
    for k, out in enumerate(words):
        word = np.zeros(len(place), np.uint64)
        for at in range(8 * k, 8 * k + 8):
            word = (word << U64(8)) | data[place + at]
        out[:] = (word ^ U64(1 << 63)).view(np.int64)
    return words


def _hashed(h: np.ndarray) -> np.ndarray:
    """The same for units that are compared whole: their hash."""
    words = np.zeros((len(WORDS), len(h)), np.int64)
    words[0] = h.view(np.int64)
    return words


def combined(
    h: np.ndarray, ctx: np.ndarray, doc: np.ndarray, tag: np.ndarray, tail: np.ndarray, place: np.ndarray, words: np.ndarray
) -> pa.RecordBatch:
    """Entries of one batch, reduced: first of each context, covered ones, and markers of contested keys.

    ``h`` is the hash of the key that ``words`` spells.
    """
    order = np.argsort(h, kind="stable")
    h, ctx, doc, tag, tail, place = (x[order] for x in (h, ctx, doc, tag, tail, place))
    words = [w[order] for w in words]
    same = np.zeros(len(h) + 1, dtype=bool)
    same[1:-1] = h[1:] == h[:-1]
    shared = np.flatnonzero(same[1:] | same[:-1])
    kind, marked = np.zeros(len(h), np.int64), np.empty(0, np.int64)
    if len(shared):
        shared = shared[np.lexsort([x[shared] for x in (place, tail, tag, doc, ctx, h)])]
        a, b, c, t, u, p = (x[shared] for x in (h, ctx, doc, tag, tail, place))
        new_key = np.concatenate([[True], a[1:] != a[:-1]])
        new_ctx = new_key | np.concatenate([[True], b[1:] != b[:-1]])
        group = np.cumsum(new_key) - 1
        several = np.bincount(group, weights=new_ctx) > 1
        head = np.maximum.accumulate(np.where(new_ctx, np.arange(len(a)), 0))
        again = (c == c[head]) & (t == t[head]) & (u == u[head]) & (p == p[head]) & ~new_ctx  # a repeated row, not a repeated text
        first = new_ctx | again
        kind[shared] = np.where(first, np.where(several[group], CONTESTED, PLAIN), COVERED)
        marked = shared[new_key][several]
        # Covered ones are met by nothing: any key will do, so they are spread.
        gone = shared[~first]
        spread = mixed(p.view(np.uint64) ^ mixed(c.view(np.uint64) ^ t.view(np.uint64)))[~first].view(np.int64)
    none = np.zeros(len(marked), np.int64)
    spelled = [np.concatenate([w, w[marked]]) for w in words]
    if len(shared):
        for word, other in zip(spelled, (spread, 0, 0), strict=True):
            word[gone] = other
    columns = (
        *spelled,
        np.concatenate([np.where(kind == COVERED, U64(0), ctx).view(np.int64), none]),
        *(np.concatenate([x, none]) for x in (doc, tag, tail)),
        np.concatenate([place | kind, none + MARKER]),
    )
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=COLUMNS)


def _rows(column: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    data, offsets = column_bytes(column)
    for i in range(len(offsets) - 1):
        yield i, data[offsets[i] : offsets[i + 1]]


def _tags(digest: bytes) -> tuple[int, int]:
    """Both halves of the tag of a text from its sha256."""
    return struct.unpack(">qq", digest[:16])


def _tag_columns(text: Column, repeated: Column) -> list[Column]:
    """The same in SQL, zero where the id is not ``repeated``."""
    digest = F.sha2(F.coalesce(text, F.lit("")).cast("binary"), 256)
    return [F.when(repeated, F.conv(F.substring(digest, at, 16), 16, -10).cast("long")).otherwise(0) for at in (1, 17)]


def _repeated_ids(docs: DataFrame) -> Broadcast:
    """The ids that stand in several rows; a few others may be among them."""
    return bitmap(docs.groupBy("doc_id").count().filter("count > 1").select("doc_id"))


def _suffixes(batches: Iterator[pa.RecordBatch], repeated: Broadcast | None = None) -> Iterator[pa.RecordBatch]:
    """Entries of all rows (doc_id, text, and spot with ``repeated``)."""

    for batch in batches:
        doc_ids = batch.column("doc_id").to_numpy()
        tagged = np.ones(len(doc_ids), bool) if repeated is None else listed(repeated, batch.column("spot").to_numpy())
        found, held = [], []  # held: rows (doc_id, tag, tail, offset in the text, bytes) of the open slice

        def flush() -> None:
            if held:
                sizes = np.array([len(x[4]) for x in held])
                offsets = np.concatenate([[0], np.cumsum(sizes)])
                data = np.concatenate([x[4] for x in held])
                first, n, place, h, ctx = runs(data, offsets)
                row = np.searchsorted(offsets, first, "right") - 1
                doc, tag, tail, base = (np.array([x[k] for x in held], np.int64) for k in range(4))
                start = first - offsets[row] + base[row]
                at = _place(start, n, place - first, PLAIN)
                found.append((h, ctx, doc[row], tag[row], tail[row], at, _spelled(data, place)))
                held.clear()

        def reduced() -> pa.RecordBatch:
            columns = [np.concatenate(c, axis=-1) for c in zip(*found, strict=True)]
            found.clear()
            return combined(*columns)

        size = 0
        for i, text in _rows(batch.column("text")):
            if len(text) < LENGTH:
                continue
            tags = _tags(hashlib.sha256(text).digest()) if tagged[i] else (0, 0)
            for at in range(0, len(text) - LENGTH + 1, SLICE_BYTES):
                part = text[at : at + SLICE_BYTES + LENGTH - 1]
                held.append((doc_ids[i], *tags, at, part))
                size += len(part)
                if size >= SLICE_BYTES:
                    flush()
                    size = 0
                    if sum(len(x[0]) for x in found) >= ENTRIES:
                        yield reduced()
        flush()
        if found:
            yield reduced()


NEXT, SPAN, OPEN = range(3)
SCANNED = "what int, " + ENTRY


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where one of ``columns`` differs from the row before; the first row always does."""
    changed = np.ones(len(columns[0]), bool)
    changed[1:] = np.logical_or.reduce([c[1:] != c[:-1] for c in columns])
    return changed


def _scanned(keep: bool):
    """Merge scan of rows sorted by (key, ctx, text, place): what is covered, contested, and the next level.

    That holds what is new and the levels that merge with it, in the order of the scan.
    """

    def settle(columns: list[np.ndarray], new_key: np.ndarray) -> Iterator[pa.RecordBatch]:
        *words, ctx, doc, tag, tail, place = columns
        kind, age = place & 3, place & (OLD | MERGING)
        marker = kind == MARKER
        group = np.cumsum(new_key) - 1
        entry = (kind == PLAIN) | (kind == CONTESTED)
        new_ctx = new_key | _changes([ctx, entry])
        head = np.maximum.accumulate(np.where(new_ctx, np.arange(len(ctx)), 0))
        again = (doc == doc[head]) & (tag == tag[head]) & (tail == tail[head]) & ((place >> 4) == (place[head] >> 4))
        first = entry & (new_ctx | again)
        contested = np.bincount(group, weights=entry & new_ctx) > 1
        contested |= np.bincount(group, weights=marker | (kind == CONTESTED)) > 0
        outputs = [(SPAN, (kind == COVERED) | (entry & ~first & (age == 0))), (OPEN, first & contested[group])]
        if keep:
            staying = (entry & new_ctx & (age == 0)) | (entry & (age == MERGING))
            markers = np.flatnonzero(marker & (age != OLD))
            staying[markers[np.unique(group[markers], return_index=True)[1]]] = True  # one of a key
            outputs.append((NEXT, staying))
        for what, rows in outputs:
            rows = np.flatnonzero(rows)
            if len(rows):
                texts = [pa.array(c[rows]) for c in (doc, tag, tail)]
                if what == NEXT:
                    out = [*(pa.array(c[rows]) for c in (*words, ctx)), *texts, pa.array(place[rows] & ~(OLD | MERGING))]
                else:
                    out = [*[pa.nulls(len(rows), pa.int64())] * (len(WORDS) + 1), *texts, pa.array(place[rows])]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(rows), what, np.int32)), *out], names=["what", *COLUMNS])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in COLUMNS]
            if rest is not None:
                columns = [np.concatenate(x) for x in zip(rest, columns, strict=True)]
            new_key = _changes(columns[: len(WORDS)])
            done = int(np.flatnonzero(new_key)[-1]) if len(new_key) else 0  # the last key may go on
            if done:
                yield from settle([c[:done] for c in columns], new_key[:done])
            rest = [c[done:] for c in columns]
        if rest is not None and len(rest[0]):
            yield from settle(rest, _changes(rest[: len(WORDS)]))

    return scan


def _scan(entries: DataFrame, keep: bool = False) -> DataFrame:
    apart = F.when(F.col("place").bitwiseAND(3) == CONTESTED, F.col("ctx"))
    ordered = entries.repartition(*WORDS, apart).sortWithinPartitions(*COLUMNS)
    # Later batches scan the levels again: what was shuffled for this one must not lie beside that.
    with shuffles_dropped(entries.sparkSession):
        return stored(ordered.mapInArrow(_scanned(keep), SCANNED), "suffix-scan", "zstd")


def _places(scanned: DataFrame, what: int) -> DataFrame:
    return scanned.filter(F.col("what") == what).select(*TEXT, "place")


@dataclass
class SuffixLevels:
    """The family of levels: level k holds the entries of 2**k batches, each file in suffix order.

    ``repeated`` lists the ids that stand in several rows of all batches; without it any may.
    """

    repeated: Broadcast | None = None
    levels: dict[int, DataFrame] = field(default_factory=dict)

    def scan(self, batch: DataFrame, keep: bool = True) -> tuple[DataFrame, DataFrame]:
        """(covered, contested) runs of ``batch`` (doc_id, text) against itself and all levels.

        Its documents must follow all earlier ones in doc_id order. With ``keep`` it then joins
        the levels: the scan also writes the level made of it and of those it merges with.
        """
        repeated = self.repeated
        rows = batch.select("doc_id", "text", spot("doc_id").alias("spot"))
        entries = rows.mapInArrow(lambda batches: _suffixes(batches, repeated), ENTRY)
        rank = 0
        while keep and rank in self.levels:
            rank += 1
        for k, level in self.levels.items():
            age = MERGING if k < rank else OLD
            entries = entries.unionByName(level.withColumn("place", F.col("place").bitwiseOR(age)))
        scanned = _scan(entries, keep)
        if keep:
            self.levels = {k: level for k, level in self.levels.items() if k > rank}
            self.levels[rank] = scanned.filter(F.col("what") == NEXT).drop("what")
        return _places(scanned, SPAN), _places(scanned, OPEN)


def _carried(shared: Broadcast, repeated: Broadcast | None, whole: bool):
    """(doc_id, tag, tail, n_bytes, sha256, packed text): the text only where the bitmap has the document."""

    def carry(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(3)
        for batch in batches:
            spots = batch.column("spot").to_numpy()
            passes = listed(shared, spots)
            tagged = np.ones(len(spots), bool) if repeated is None else listed(repeated, spots)
            ids = batch.column("doc_id").to_pylist()
            out = []
            for i, text in _rows(batch.column("text")):
                if not (passes[i] or whole):
                    continue
                digest = hashlib.sha256(text) if tagged[i] or not passes[i] else None
                tags = _tags(digest.digest()) if tagged[i] else (0, 0)
                if passes[i]:
                    out.append((ids[i], *tags, len(text), None, squeeze.compress(text)))
                else:
                    out.append((ids[i], *tags, len(text), digest.hexdigest(), None))
            if out:
                types = [pa.int64()] * 4 + [pa.string(), pa.binary()]
                columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*TEXT, "n_bytes", "sha256", "packed"])

    return carry


def _finer(slots: bool):
    """Entries of smaller units for the contested runs of each document."""

    def refine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        expand = zstandard.ZstdDecompressor()
        for whole in batches:
            for at in range(0, whole.num_rows, 64):
                found = [_units(row, expand, slots) for row in whole.slice(at, 64).to_pylist()]
                if found:
                    yield combined(*(np.concatenate(c, axis=-1) for c in zip(*found, strict=True)))

    return refine


def _units(row: dict, expand: zstandard.ZstdDecompressor, slots: bool) -> tuple[np.ndarray, ...]:
    text = np.frombuffer(expand.decompress(row["packed"]), np.uint8)
    open_ = np.array([(r["start"], r["n"], r["lead"]) for r in row["open"]], dtype=np.int64)
    start, n, lead = open_.T
    # Parts of the text that hold contested runs, a few slices long at most.
    order = np.argsort(start, kind="stable")
    start, n, lead = start[order], n[order], lead[order]
    found = []
    i = 0
    while i < len(start):
        j = int(np.searchsorted(start, start[i] + SLICE_BYTES))
        low, high = int(start[i]), int((start[i:j] + n[i:j]).max()) + LENGTH - 1
        found.append(_unit_rows(text[low:high], start[i:j] - low, n[i:j], lead[i:j], low, row, slots))
        i = j
    return tuple(np.concatenate(c, axis=-1) for c in zip(*found, strict=True))


def _unit_rows(text, start, n, lead, base: int, row: dict, slots: bool) -> tuple[np.ndarray, ...]:
    g = running_code(text)
    if slots:
        anchor = start + lead
        high = lead // SLOT  # slot of the first window; starts further right have smaller distances
        count = high - (lead - n + 1) // SLOT + 1
        which = np.repeat(np.arange(len(start)), count)
        slot = np.repeat(high, count) - (np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count))
        first = np.maximum(start[which], anchor[which] - SLOT * slot - SLOT + 1)
        last = np.minimum(start[which] + n[which] - 1, anchor[which] - SLOT * slot)
        core = anchor[which] - SLOT * slot
        h, ctx = _hash(g, core, core + LENGTH - SLOT + 1), _hash(g, first, last + LENGTH)
    else:
        which = np.repeat(np.arange(len(start)), n)
        first = last = start[which] + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        h, ctx = _hash(g, first, first + LENGTH), _hash(running_code(text, OTHER_CODE), first, first + LENGTH)
    place = _place(first + base, last - first + 1, np.zeros(len(first), np.int64), PLAIN)
    return h, ctx, *(np.full(len(first), row[c], np.int64) for c in TEXT), place, _hashed(h)


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce("doc_id", F.lit(LEAST_LONG)).cast("long").alias("doc_id"), "text")


def _refined(docs: DataFrame, open_: DataFrame, slots: bool, repeated: Broadcast | None) -> tuple[DataFrame, DataFrame]:
    shared = bitmap(open_)
    by_doc = open_.selectExpr(*TEXT, f"{START} as start", f"{WINDOWS} as n", f"{LEAD} as lead").distinct()
    by_doc = by_doc.groupBy(*TEXT).agg(F.collect_list(F.struct("start", "n", "lead")).alias("open"))
    texts = docs.withColumn("spot", spot("doc_id")).mapInArrow(_carried(shared, repeated, whole=False), CARRIED)
    entries = texts.dropDuplicates(TEXT).join(by_doc, list(TEXT)).select(*TEXT, "packed", "open")
    scanned = _scan(entries.mapInArrow(_finer(slots), ENTRY))
    return _places(scanned, SPAN), _places(scanned, OPEN)


CARRIED = "doc_id long, tag long, tail long, n_bytes long, sha256 string, packed binary"


def repeats(docs: DataFrame, batches: int = BATCHES, repeated: Broadcast | None = None) -> DataFrame:
    """(doc_id, tag, tail, spans) of the documents with repeated bytes: spans (start, stop), in any order, overlapping.

    ``docs`` (doc_id, text, ...) is taken in ``batches`` ranges of doc_id, as if they arrived one
    after the other. A byte is repeated if a string of LENGTH bytes around it also starts earlier:
    in a smaller doc_id or further left. ``tag`` and ``tail`` tell texts of one doc_id apart, the
    smaller count as earlier; fully repeated rows are one document. With ``repeated``, the bitmap of the
    ids of several rows, other ids have zeros there. Null ids come first, null texts are empty.
    """
    docs = _keyed(docs)
    steps = F.array(*[F.lit(i / batches) for i in range(1, batches)]) if batches > 1 else F.array(F.lit(1.0))
    bounds = sorted(set(docs.select(F.percentile_approx("doc_id", steps)).first()[0] or []))[: batches - 1]
    index, spans, open_ = SuffixLevels(repeated), [], []
    edges = [None, *bounds, None]
    for low, high in zip(edges, edges[1:], strict=False):
        batch = docs
        if low is not None:
            batch = batch.filter(F.col("doc_id") > low)
        if high is not None:
            batch = batch.filter(F.col("doc_id") <= high)
        covered, contested = index.scan(batch, keep=high is not None)
        spans.append(covered)
        open_.append(contested)
    for slots in (True, False):
        pending = open_[0]
        for more in open_[1:]:
            pending = pending.unionByName(more)
        covered, contested = _refined(docs, pending, slots, repeated)
        spans.append(covered)
        open_ = [contested]
    found = spans[0]
    for more in spans[1:]:
        found = found.unionByName(more)
    found = found.selectExpr(*TEXT, f"{START} as start", f"{START} + ({WINDOWS}) + {LENGTH - 1} as stop")
    found = found.groupBy(*TEXT).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    with shuffles_dropped(docs.sparkSession):
        return stored(found, "repeats")


def united(spans: list[dict]) -> np.ndarray:
    """Maximal runs (start, stop) of the union of ``spans``."""
    pairs = np.array(sorted((s["start"], s["stop"]) for s in spans), dtype=np.int64).reshape(-1, 2)
    if not len(pairs):
        return pairs
    reach = np.maximum.accumulate(pairs[:, 1])
    first = np.concatenate([[True], pairs[1:, 0] > reach[:-1]])
    last = np.concatenate([np.flatnonzero(first)[1:] - 1, [len(pairs) - 1]])
    return np.stack([pairs[first, 0], reach[last]], axis=1)


def kept_bytes(text: bytes, cut: np.ndarray) -> bytes:
    parts, at = [], 0
    for start, stop in cut.tolist():
        parts.append(text[at:start])
        at = stop
    return b"".join([*parts, text[at:]])


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    expand = zstandard.ZstdDecompressor()
    for whole in batches:
        for at in range(0, whole.num_rows, 256):
            out = []
            for r in whole.slice(at, 256).to_pylist():
                cut = united(r["spans"] or [])
                digest = r["sha256"]
                if r["packed"] is not None:
                    digest = hashlib.sha256(kept_bytes(expand.decompress(r["packed"]), cut)).hexdigest()
                out.append((r["doc_id"], r["n_bytes"], int((cut[:, 1] - cut[:, 0]).sum()), len(cut), digest))
            types = [pa.int64()] * 4 + [pa.string()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def removal(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every row of ``docs`` (doc_id, text, ...)."""
    repeated = _repeated_ids(_keyed(docs))
    found = repeats(docs, batches, repeated)
    shared = bitmap(found)
    rows = _keyed(docs).withColumn("spot", spot("doc_id")).mapInArrow(_carried(shared, repeated, whole=True), CARRIED)
    out = rows.join(found, list(TEXT), "left").mapInArrow(
        _summed, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
    return out.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(LEAST_LONG)))


def without_repeats(docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """``docs`` with the repeated bytes of ``text`` removed; a character cut in two goes with them.

    All other columns stay. Null texts stay null.
    """
    repeated = _repeated_ids(_keyed(docs))
    found = repeats(docs, batches, repeated).toDF("_doc", "_tag", "_tail", "_spans")

    def among(spots: pa.Array) -> pa.Array:
        return pa.array(listed(repeated, spots.to_numpy()))

    named = docs.withColumn("_doc_", F.coalesce("doc_id", F.lit(LEAST_LONG)))
    named = named.withColumn("_among", F.arrow_udf(among, "boolean")(spot("_doc_")))
    tag, tail = _tag_columns(F.col("text"), F.col("_among"))
    tagged = named.withColumns({"_tag_": tag, "_tail_": tail})
    same = (F.col("_doc_") == F.col("_doc")) & (F.col("_tag_") == F.col("_tag")) & (F.col("_tail_") == F.col("_tail"))
    joined = tagged.join(found, same, "left").drop("_doc", "_tag", "_tail", "_doc_", "_among", "_tag_", "_tail_")
    place = docs.columns.index("text")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                texts, spans = batch.column(place).to_pylist(), batch.column("_spans").to_pylist()
                new = [t if not s else kept_bytes(t.encode(), united(s)).decode(errors="ignore") for t, s in zip(texts, spans, strict=True)]
                batch = batch.select(docs_columns)
                yield batch.set_column(place, batch.schema.field(place), pa.array(new, batch.schema.field(place).type))

    docs_columns = docs.columns
    return joined.mapInArrow(cut, T.StructType(docs.schema.fields))
