"""Passages of test items in documents, by Wu-Manber search for many strings.

Test strings are windows of consecutive item words; documents and items are reduced to their
words in lower case with single blanks. For strings of like length, a table tells for every
block of bytes how far the next string can at least be, so most positions are never looked at.
Where a block ends a string's first ``least`` bytes, a bucket keyed by that block and the
string's first block lists the strings, and a comparison of all bytes confirms each.

Classical skipping is one position after another. Here the text is cut into lanes, and one
numpy step moves all lanes of a slice at once; a string belongs to the lane it begins in, and
reading on into the next lane finds it whole.

* Null or empty texts, and texts without words, have no words, no windows and no hits.
* An item of fewer than ``width`` words is one window. Equal windows of several items count for each.
* Items without an id hit words but are not listed; rows that share an id are one item.
* Documents keep all their columns and are never shuffled; equal rows are judged alike.
* Texts of any length are searched whole; a task holds a few bytes for each byte of the longest.

The tables of at most BLOCK_BYTES of item text go to the tasks at once. More items are searched
block after block, each adding to the spans found before.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrowtext import U64, mixed, slices
from tallyline.workspace import stored

WIDTH = 10
BLOCK_BYTES = 4 << 20
PIECE_BYTES = 1 << 18
SLICE_BYTES = 2 << 20
LANE = 512
PASSES_PER_STORE = 4
BLANK, MARK = 0x20, 0x0A
ODD = U64(0x9E3779B97F4A7C15)

CLEAN = np.arange(256, dtype=np.uint8)
CLEAN[65:91] += 32
CLEAN[[b for b in range(128) if not chr(b).isalnum()]] = BLANK
IS_WORD = CLEAN != BLANK


def normalised(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Every row as a mark, then each word with one blank around: ``\\n one two three ``."""
    rows = len(offsets) - 1
    wide = np.full(len(data) + 3 * rows, BLANK, np.uint8)
    clean = CLEAN[data]
    for row, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        wide[a + 3 * row] = MARK
        wide[a + 3 * row + 2 : b + 3 * row + 2] = clean[a:b]
    keep = wide != BLANK
    keep[1:] |= keep[:-1].copy()  # the blank after a word or a mark
    return wide[keep]


def _padded(data: np.ndarray) -> np.ndarray:
    return np.concatenate([data, np.zeros(8, np.uint8)])


def _blocks(padded: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` (2, 4 or 8) bytes from every place on as one number, without a copy."""
    return np.ndarray(len(padded) - size + 1, f"<u{size}", padded, strides=(1,))


def _keys(last: np.ndarray, first: np.ndarray) -> np.ndarray:
    return mixed(last.astype(np.uint64) * ODD + mixed(first.astype(np.uint64)))


@dataclass(frozen=True)
class _Class:
    """Strings of like length: ``skip`` by block, buckets as sorted keys beside string numbers."""

    least: int
    size: int
    shift: int
    skip: np.ndarray
    keys: np.ndarray
    strings: np.ndarray

    def slot(self, blocks: np.ndarray) -> np.ndarray:
        return ((blocks.astype(np.uint64) * ODD) >> U64(self.shift)).astype(np.int64)


@dataclass(frozen=True)
class Tables:
    text: np.ndarray  # padded
    starts: np.ndarray
    lengths: np.ndarray
    words: np.ndarray
    owner_from: np.ndarray  # string -> its range in ``owners``
    owners: np.ndarray  # item numbers
    items: list[str]
    classes: list[_Class]


def _class(text: np.ndarray, starts: np.ndarray, numbers: np.ndarray, least: int) -> _Class:
    size = 8 if least >= 16 else 4 if least >= 8 else 2
    blocks = _blocks(text, size)
    ends = np.arange(size, least + 1)
    bits = int(np.clip(np.ceil(np.log2(8.0 * len(starts) * len(ends))), 8, 22))
    made = _Class(
        least, size, 64 - bits, np.full(1 << bits, least - size + 1, np.int32), np.empty(0, np.uint64), numbers
    )
    for end in ends.tolist():  # ascending, so the smallest skip is written last
        made.skip[made.slot(blocks[starts + end - size])] = least - end
    keys = _keys(blocks[starts + least - size], blocks[starts])
    order = np.argsort(keys, kind="stable")
    return _Class(least, size, made.shift, made.skip, keys[order], numbers[order])


def tables(pieces: list[tuple[str | None, bytes]], width: int = WIDTH) -> Tables:
    """Search tables of normalised pieces of items, each ``" word word "``."""
    strings: dict[bytes, tuple[int, int, set[int]]] = {}
    numbers: dict[str, int] = {}
    at = 0
    for item, piece in pieces:
        blanks = np.flatnonzero(np.frombuffer(piece, np.uint8) == BLANK).tolist()
        count = min(width, len(blanks) - 1)
        for i in range(len(blanks) - count if count > 0 else 0):
            a, b = blanks[i], blanks[i + count] + 1
            owners = strings.setdefault(piece[a:b], (at + a, count, set()))[2]
            if item is not None:
                owners.add(numbers.setdefault(item, len(numbers)))
        at += len(piece)
    text = _padded(np.frombuffer(b"".join(p for _, p in pieces), np.uint8))
    lengths = np.array([len(s) for s in strings], np.int64)
    starts = np.array([s[0] for s in strings.values()], np.int64)
    owned = [sorted(s[2]) for s in strings.values()]
    grade = np.floor(np.log2(np.maximum(lengths, 1)))
    classes = []
    for g in np.unique(grade):
        members = np.flatnonzero(grade == g)
        classes.append(_class(text, starts[members], members, int(lengths[members].min())))
    return Tables(
        text, starts, lengths, np.array([s[1] for s in strings.values()], np.int64),
        np.concatenate([[0], np.cumsum([len(o) for o in owned], dtype=np.int64)]).astype(np.int64),
        np.array([n for o in owned for n in o], np.int64), list(numbers), classes,
    )


def _places(padded: np.ndarray, length: int, group: _Class) -> np.ndarray:
    """Where the last block of some string's first ``least`` bytes may end; ends are exclusive."""
    blocks, stops = _blocks(padded, group.size), length - group.least + 1
    at = np.arange(0, max(stops, 0), LANE)
    until = np.minimum(at + LANE, stops) + group.least
    at += group.least
    found = []
    while len(at):
        skip = group.skip[group.slot(blocks[at - group.size])]
        hit = skip == 0
        if hit.any():
            found.append(at[hit])
            skip[hit] = 1
        at = at + skip
        live = at < until
        if not live.all():
            at, until = at[live], until[live]
    return np.concatenate(found) if found else np.empty(0, np.int64)


def _expanded(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every number of the ranges [low, high), and the range it comes from."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    return low[which] + inner, which


def occurrences(norm: np.ndarray, t: Tables) -> tuple[np.ndarray, np.ndarray]:
    """(place, string) of every occurrence of every string in a normalised text."""
    padded = _padded(norm)
    wide, own = _blocks(padded, 8), _blocks(t.text, 8)
    places, strings = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    for group in t.classes:
        ends = _places(padded, len(norm), group)
        blocks = _blocks(padded, group.size)
        keys = _keys(blocks[ends - group.size], blocks[ends - group.least])
        listed, which = _expanded(
            np.searchsorted(group.keys, keys, "left"), np.searchsorted(group.keys, keys, "right")
        )
        place, string = ends[which] - group.least, group.strings[listed]
        fits = place + t.lengths[string] <= len(norm)
        place, string = place[fits], string[fits]
        at = 0
        done_places, done_strings = [], []
        while len(place):  # eight bytes at a time; what is left of a string below eight is masked
            left = t.lengths[string] - at
            spare = (8 - np.minimum(left, 8)).astype(np.uint64) * U64(8)
            differ = (wide[place + at] ^ own[t.starts[string] + at]) << spare
            same = differ == 0
            whole = same & (left <= 8)
            done_places.append(place[whole])
            done_strings.append(string[whole])
            more = same & (left > 8)
            place, string, at = place[more], string[more], at + 8
        places += done_places
        strings += done_strings
    return np.concatenate(places), np.concatenate(strings)


def _scanned(data: np.ndarray, offsets: np.ndarray, t: Tables, before: tuple[np.ndarray, ...] | None):
    """Per row: its words; spans (row, from, to) of hit words; distinct (row, item) pairs."""
    norm = normalised(data, offsets)
    marks, blanks = np.flatnonzero(norm == MARK), np.flatnonzero(norm == BLANK)
    first = np.searchsorted(blanks, marks)  # the blank before each row's first word
    n_words = np.diff(np.append(first, len(blanks))) - 1
    place, string = occurrences(norm, t)
    row = np.searchsorted(marks, place, "right") - 1
    word = np.searchsorted(blanks, place)
    cover = np.zeros(len(blanks) + 1, np.int64)
    np.add.at(cover, word, 1)
    np.add.at(cover, word + t.words[string], -1)
    if before is not None:
        rows, start, stop = before
        np.add.at(cover, first[rows] + start, 1)
        np.add.at(cover, first[rows] + stop, -1)
    hit = np.cumsum(cover) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[False], hit])))
    start, stop = edges[::2], edges[1::2]
    span_row = np.searchsorted(first, start, "right") - 1
    spans = (span_row, start - first[span_row], stop - first[span_row])
    seen = np.unique(row * len(t.starts) + string) if len(row) else np.empty(0, np.int64)
    row, string = np.divmod(seen, max(len(t.starts), 1))
    owners, which = _expanded(t.owner_from[string], t.owner_from[string + 1])
    pairs = np.unique(row[which] * max(len(t.items), 1) + t.owners[owners])
    return n_words, spans, np.divmod(pairs, max(len(t.items), 1))


def _offsets(rows: np.ndarray, n: int) -> pa.Array:
    return pa.array(np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=n))]).astype(np.int32))


def _pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Items as normalised pieces; neighbours of one long item share ``width - 1`` words."""
    for batch in batches:
        ids, pieces = [], []
        for row, data, offsets in slices(batch.column("text")):
            for i, text in enumerate(normalised(data, offsets).tobytes().split(bytes([MARK]))[1:]):
                item = batch.column("item_id")[row + i].as_py()
                blanks = np.flatnonzero(np.frombuffer(text, np.uint8) == BLANK)
                at = 0
                while at + 1 < len(blanks):
                    stop = int(np.searchsorted(blanks, blanks[at] + PIECE_BYTES))
                    stop = min(max(stop, at + width), len(blanks) - 1)
                    ids.append(item)
                    pieces.append(text[blanks[at] : blanks[stop] + 1])
                    at = stop - width + 1 if stop < len(blanks) - 1 else len(blanks)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(pieces, pa.binary())], ["item", "piece"])


def item_blocks(items: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> list[DataFrame]:
    """Pieces of ``items`` (item_id, text), dealt into blocks of at most ``block_bytes`` or one bucket.

    Hash buckets are counted and halved until none is larger than a block, then filled into blocks.
    """
    text = items.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    pieces = text.mapInArrow(lambda b: _pieces(b, width), "item string, piece binary").distinct()
    pieces = stored(pieces, "test-pieces")
    hashed = F.pmod(F.xxhash64("item", "piece"), F.lit(1 << 40))
    total = pieces.agg(F.sum(F.length("piece"))).first()[0] or 0
    buckets = 4 * max(-(-total // block_bytes), 1)
    while True:
        sizes = pieces.groupBy((hashed % buckets).alias("bucket")).agg(F.sum(F.length("piece")).alias("size"))
        sizes = sorted(tuple(r) for r in sizes.collect())
        if all(size <= max(block_bytes, PIECE_BYTES * 2) for _, size in sizes) or buckets >= 1 << 20:
            break
        buckets *= 2
    blocks: list[list[int]] = []
    room = 0
    for bucket, size in sizes:
        if size > room:
            blocks.append([])
            room = block_bytes
        blocks[-1].append(bucket)
        room -= size
    return [pieces.filter((hashed % buckets).isin(chosen)) for chosen in blocks or [[-1]]]


FOUND = "n_words long, spans array<struct<start: long, stop: long>>, items array<string>"


def found(docs: DataFrame, items: DataFrame, width: int = WIDTH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, spans (hit words [start, stop), counted from 0) and items (ids as text).

    Columns of those names that ``docs`` had are replaced.
    """
    kept = [c for c in docs.columns if c not in ("n_words", "spans", "items")]
    state = docs.select(*kept)
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in state.schema.fields), FOUND])
    for number, block in enumerate(item_blocks(items, width, block_bytes)):
        if number and number % PASSES_PER_STORE == 0:
            state = stored(state, "decontaminated")
        pieces = [(r["item"], bytes(r["piece"])) for r in block.collect()]
        shared = docs.sparkSession.sparkContext.broadcast(tables(pieces, width))
        state = state.mapInArrow(_pass(shared, len(kept), number > 0), schema)
    return state


def _pass(shared, n_kept: int, again: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t: Tables = shared.value
        names = pa.array(t.items, pa.string())
        for batch in batches:
            column = batch.column("text")
            for row, data, offsets in slices(column, SLICE_BYTES):
                n = len(offsets) - 1
                part = batch.slice(row, n)
                before = None
                if again:
                    old = part.column("spans")
                    rows = np.repeat(np.arange(n), old.value_lengths().to_numpy())
                    flat = old.flatten()
                    before = (rows, flat.field("start").to_numpy(), flat.field("stop").to_numpy())
                words, (span_row, start, stop), (item_row, item) = _scanned(data, offsets, t, before)
                ids = names.take(pa.array(item))
                if again:
                    old = part.column("items")
                    rows = np.concatenate([np.repeat(np.arange(n), old.value_lengths().to_numpy()), item_row])
                    order = np.argsort(rows, kind="stable")
                    ids = pa.concat_arrays([old.flatten().cast(pa.string()), ids]).take(pa.array(order))
                    item_row = rows[order]
                spans = pa.StructArray.from_arrays([pa.array(start), pa.array(stop)], ["start", "stop"])
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[:n_kept], pa.array(words),
                        pa.ListArray.from_arrays(_offsets(span_row, n), spans),
                        pa.ListArray.from_arrays(_offsets(item_row, n), ids),
                    ],
                    names=[*part.schema.names[:n_kept], "n_words", "spans", "items"],
                )

    return scan


def digests(scanned: DataFrame) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    listed = F.array_sort(F.array_distinct("items"))
    return scanned.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size(listed).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed, ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )
