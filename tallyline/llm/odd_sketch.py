"""Near duplicates by MinHash bands, odd sketches and full shingle sets.

1. One pass over the texts gives each document the size and a 128-bit digest of its shingle set,
   the keys of its MinHash bands, and an odd sketch: every MinHash sample flips one bit of a
   bitmap, so two bitmaps differ by XOR in about two bits for each sample in which the documents
   differ. Only these rows, some hundred bytes each, are kept; documents with equal sets become
   one from here on.
2. Of each bucket of a band one document is the hub, the one with the most company over all its
   buckets, and every member is paired with it, which is linear in the bucket. The XOR population
   count of a pair's sketches drops what cannot be similar; the bound is six standard deviations
   wide, so a similar pair is never dropped in practice.
3. The remaining pairs are confirmed on the full sets and joined to components.
4. Hubs whose members still are in several components may hide a link between two documents that
   are not linked to the hub: members of different components are compared on their full sets, in
   tiles of bounded size, and a tile returns only links that join components. What one component
   holds needs no further pair, so a group of thousands of copies never turns into all its pairs.

With 24 bands of 4 samples two documents of similarity 0.8 miss each other in all bands with
probability 3e-6, of similarity 0.9 with 1e-11; a chain of links survives unless all miss.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import groupby
from math import sqrt

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.arrowtext import SHINGLE_CODE, U64, mixed, shingle_sets, slices
from tallyline.llm.components import components
from tallyline.llm.id_filter import bitmap, listed, spot
from tallyline.workspace import stored

BANDS, ROWS = 24, 4
SKETCH_BITS = 512
SKETCH_WORDS = SKETCH_BITS // 64
SKETCH = [f"sketch{i}" for i in range(SKETCH_WORDS)]
_random = np.random.Generator(np.random.PCG64(4))
_FACTOR = _random.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * U64(2) + U64(1)
_PIECE = 1 << 14
TILE_ROWS, TILE_SHINGLES = 1024, 1 << 20


def minhashes(shingles: np.ndarray, starts: np.ndarray = np.zeros(1, np.int64)) -> np.ndarray:
    """One row of samples for each set, none empty, that begins at ``starts``: the least value per hash function."""
    least = np.full((BANDS * ROWS, len(starts)), 2**64 - 1, dtype=np.uint64)
    for at in range(0, len(shingles), _PIECE):
        part = shingles[at : at + _PIECE]
        low = int(np.searchsorted(starts, at, "right")) - 1
        high = int(np.searchsorted(starts, at + len(part)))
        inside = np.maximum(starts[low:high] - at, 0)
        for i, factor in enumerate(_FACTOR):
            product = part * factor
            product ^= product >> U64(32)
            np.minimum(least[i, low:high], np.minimum.reduceat(product, inside), out=least[i, low:high])
    return least.T


def odd_sketch(samples: np.ndarray) -> np.ndarray:
    """For each row of samples the parity of how many of them fall on each bit, as 64-bit words."""
    rows, width = samples.shape
    bit = mixed(samples + np.arange(width, dtype=np.uint64) * SHINGLE_CODE[0]) % U64(SKETCH_BITS)
    place = bit.astype(np.int64) + np.arange(rows)[:, None] * SKETCH_BITS
    parity = np.bincount(place.reshape(-1), minlength=rows * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8), bitorder="little").view(np.uint64).reshape(rows, SKETCH_WORDS)


def most_bits(similarity: float) -> int:
    """The largest XOR count that a pair of that similarity shows, but for six deviations."""
    samples, miss = BANDS * ROWS, 1 - similarity
    differing = samples * miss + 6 * sqrt(samples * miss * (1 - miss))
    flips = min(2 * differing, 2 * samples)
    expected = SKETCH_BITS / 2 * (1 - (1 - 2 / SKETCH_BITS) ** flips)
    return int(expected + 6 * sqrt(expected * (1 - expected / SKETCH_BITS)))


#: Bytes of text that are signed at once: the 64-bit arrays of a task stay at some twenty megabytes.
SIGNED_BYTES = 1 << 18

SIGNATURE = (
    "doc_id long, n_shingles long, digest_a long, digest_b long, bands array<long>, "
    + ", ".join(f"{w} long" for w in SKETCH)
)


def _signed(width: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for row, data, offsets in slices(batch.column("text"), SIGNED_BYTES):
                rows = len(offsets) - 1
                sets = list(shingle_sets(data, offsets, width))
                sizes = np.array([len(found) for found in sets], np.int64)
                digests = np.zeros((rows, 2), np.uint64)
                bands = np.zeros((rows, BANDS), np.uint64)
                sketches = np.zeros((rows, SKETCH_WORDS), np.uint64)
                full = np.flatnonzero(sizes)
                if len(full):
                    shingles = np.concatenate(sets)
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    digests[full, 0] = np.add.reduceat(shingles, starts)
                    digests[full, 1] = np.add.reduceat(mixed(shingles ^ SHINGLE_CODE[1]), starts)
                    samples = minhashes(shingles, starts)
                    keys = (samples.reshape(-1, BANDS, ROWS) * SHINGLE_CODE[:ROWS]).sum(axis=2, dtype=np.uint64)
                    bands[full] = mixed(keys + np.arange(BANDS, dtype=np.uint64) * SHINGLE_CODE[5])
                    sketches[full] = odd_sketch(samples)
                places = np.arange(rows + 1, dtype=np.int32) * BANDS
                columns = [
                    ids.slice(row, rows).cast(pa.int64()),
                    pa.array(sizes),
                    *(pa.array(digests[:, k].view(np.int64)) for k in range(2)),
                    pa.ListArray.from_arrays(pa.array(places), pa.array(bands.reshape(-1).view(np.int64))),
                    *(pa.array(sketches[:, k].copy().view(np.int64)) for k in range(SKETCH_WORDS)),
                ]
                names = ["doc_id", "n_shingles", "digest_a", "digest_b", "bands", *SKETCH]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return sign


def signatures(docs: DataFrame, width: int) -> DataFrame:
    return docs.select("doc_id", "text").mapInArrow(_signed(width), SIGNATURE)


def _sets(width: int, shared: Broadcast):
    """Shingle sets of the documents that the bitmap lets pass."""

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(listed(shared, batch.column("spot").to_numpy())))
            for row, data, offsets in slices(batch.column("text")):
                found = [s.view(np.int64) for s in shingle_sets(data, offsets, width)]
                places = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
                values = pa.array(np.concatenate(found) if found else np.empty(0, np.int64), pa.int64())
                columns = [batch.column("doc_id").slice(row, len(found)), pa.ListArray.from_arrays(pa.array(places), values)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "shingles"])

    return shingles


def _with_sets(rows: DataFrame, docs: DataFrame, width: int) -> DataFrame:
    """Add the full shingle sets to ``rows`` (doc_id, ...)."""
    spots = docs.select("doc_id", "text", spot("doc_id").alias("spot"))
    sets = spots.mapInArrow(_sets(width, bitmap(rows.select("doc_id"))), "doc_id long, shingles array<long>")
    return rows.join(sets.dropDuplicates(["doc_id"]), "doc_id")


def _groups(batches: Iterator[pa.RecordBatch], key: tuple[str, ...]) -> Iterator[list[dict]]:
    """Consecutive rows with equal keys; sets as arrays."""
    rows = (
        dict(zip(batch.schema.names, values, strict=True))
        for batch in batches
        for values in zip(*(_values(batch.column(n)) for n in batch.schema.names), strict=True)
    )
    for _, group in groupby(rows, key=lambda r: tuple(r[k] for k in key)):
        yield group


def _values(column: pa.Array):
    if not pa.types.is_list(column.type):
        return column.to_pylist()
    flat, at = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _pairs(found: list[tuple[int, int]]) -> pa.RecordBatch:
    u, v = zip(*found, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])


def _different_bits() -> Column:
    """Population count of the XOR of the sketches of ``a`` and ``b``."""
    counts = [F.bit_count(F.col(f"a.{w}").bitwiseXOR(F.col(f"b.{w}"))) for w in SKETCH]
    return reduce(Column.__add__, counts)


def _with_hub(percent: int):
    """Links of the members of a part to its hub, which comes first; one member is held at a time."""

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = []
        for group in _groups(batches, ("hub", "part")):
            own = None
            for row in group:
                if row["doc_id"] == row["hub"]:
                    own = row["shingles"]
                elif own is not None:
                    common = len(np.intersect1d(own, row["shingles"], assume_unique=True))
                    if 100 * common >= percent * (len(own) + len(row["shingles"]) - common):
                        found.append((row["hub"], row["doc_id"]))
            if len(found) > 10_000:
                yield _pairs(found)
                found = []
        if found:
            yield _pairs(found)

    return confirm


def _across(percent: int):
    """Links that join different components of a tile: those of its upper block with all others.

    An inverted index over the tile's shingles counts what a document has in common with every
    other one; of the links only those that join two components not yet joined are returned.
    """

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ("hub", "low", "high")):
            rows = list(group)
            sets = [r["shingles"] for r in rows]
            sizes = np.array([len(s) for s in sets])
            shingles = np.concatenate(sets)
            order = np.argsort(shingles, kind="stable")
            owner = np.repeat(np.arange(len(rows)), sizes)[order]
            first, code, seen = _index(shingles, order)
            at = np.concatenate([[0], np.cumsum(sizes)])
            component = [r["component"] for r in rows]
            root = {c: c for c in component}

            def top(c: int) -> int:
                while root[c] != c:
                    root[c] = root[root[c]]
                    c = root[c]
                return c

            found = []
            for x in (i for i, r in enumerate(rows) if r["block"] == r["high"]):
                own = code[at[x] : at[x + 1]]
                common = np.zeros(len(rows), np.int64)
                for a, b in zip(first[own].tolist(), (first[own] + seen[own]).tolist(), strict=True):
                    common[owner[a:b]] += 1
                near = np.flatnonzero(100 * common >= percent * (sizes + sizes[x] - common))
                for y in near.tolist():
                    a, b = top(component[x]), top(component[y])
                    if a != b:
                        root[max(a, b)] = min(a, b)
                        found.append((rows[x]["doc_id"], rows[y]["doc_id"]))
            if found:
                yield _pairs(found)

    return confirm


def _index(shingles: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, ...]:
    """Inverted index over the sorted shingles: first place, code of each shingle, and count."""
    ordered = shingles[order]
    new = np.concatenate([[True], ordered[1:] != ordered[:-1]])
    first = np.flatnonzero(new)
    code = np.empty(len(shingles), np.int64)
    code[order] = np.cumsum(new) - 1
    return first, code, np.diff(np.concatenate([first, [len(shingles)]]))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs`` (doc_id, text, ...).

    Words are runs of bytes other than space and 0x09-0x0D, A-Z lowered. Documents are linked if
    ``percent`` of their joint shingles of ``width`` words are common; a document of fewer words
    is one shingle. Null and wordless texts are linked with nothing; equal texts always are.
    ``component_id`` is the smallest doc_id a document reaches. doc_id identifies a document:
    repeated rows come out repeated and count once. A null doc_id takes part in no link and has
    null as component. Other columns are not looked at.
    """
    signed = stored(signatures(docs, width), "signatures")
    one = signed.filter("doc_id is not null and n_shingles > 0")
    digest = ["n_shingles", "digest_a", "digest_b"]
    classes = one.groupBy(*digest).agg(F.min("doc_id").alias("rep"))
    copies = one.select("doc_id", *digest).join(classes, digest)
    copies = stored(copies.filter("doc_id <> rep").select(F.col("doc_id").alias("u"), F.col("rep").alias("v")), "copies")
    reps = one.join(copies.select(F.col("u").alias("doc_id")), "doc_id", "left_anti").dropDuplicates(["doc_id"])

    banded = reps.select("doc_id", F.explode("bands").alias("bucket"))
    sizes = banded.groupBy("bucket").agg(F.count("*").alias("size")).filter("size > 1")
    members = stored(banded.join(sizes, "bucket"), "members")
    # The hub of a bucket is its member with the most company over all its buckets: in a group of
    # edited copies that is the text they were copied from, or the one closest to it.
    company = members.groupBy("doc_id").agg(F.sum("size").alias("company"))
    ranked = members.join(company, "doc_id").select("bucket", "doc_id", F.struct("company", -F.col("doc_id")).alias("place"))
    hubs = ranked.groupBy("bucket").agg((-F.max("place")["col2"]).alias("hub"))
    grouped = stored(members.join(hubs, "bucket").select("hub", "doc_id").distinct(), "groups")

    sketch = stored(reps.join(members.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "n_shingles", *SKETCH), "sketches")
    alike = (100 * F.least("a.n_shingles", "b.n_shingles")) >= percent * F.greatest("a.n_shingles", "b.n_shingles")
    pairs = grouped.filter("doc_id <> hub").join(sketch, "doc_id").alias("a").join(sketch.alias("b"), F.col("a.hub") == F.col("b.doc_id"))
    pairs = stored(pairs.filter(alike & (_different_bits() <= most_bits(percent / 100))).select("a.hub", "a.doc_id"), "pairs")
    parts = pairs.groupBy("hub").agg(F.ceil(F.count("*") / TILE_ROWS).cast("int").alias("parts"))
    dealt = pairs.join(parts, "hub").select("hub", "doc_id", F.pmod(F.xxhash64("doc_id"), F.col("parts")).cast("int").alias("part"))
    heads = parts.select("hub", F.col("hub").alias("doc_id"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    whole = _with_sets(dealt.unionByName(heads), docs, width)
    ordered = whole.repartition("hub", "part").sortWithinPartitions("hub", "part", F.col("doc_id") != F.col("hub"))
    links = stored(ordered.select("hub", "part", "doc_id", "shingles").mapInArrow(_with_hub(percent), "u long, v long"), "links")

    more = _between_components(grouped, sketch.select("doc_id", "n_shingles"), components(links), docs, width, percent)
    reached = components(links.unionByName(more).unionByName(copies))
    out = signed.select("doc_id", "n_shingles").join(reached.withColumnRenamed("id", "doc_id"), "doc_id", "left")
    component = F.coalesce("component", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), (F.col("doc_id") == component).alias("kept"))


def _between_components(
    grouped: DataFrame, sizes: DataFrame, found: DataFrame, docs: DataFrame, width: int, percent: int
) -> DataFrame:
    """Links (u, v) between different components that share a hub.

    The members of a hub are split into its own component and the rest, each into blocks bounded
    in rows and shingles. A tile is a block of the rest and any block before it, so no task holds
    more than two blocks, and pairs inside the hub's component are never looked at.
    """
    named = grouped.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left").join(sizes, "doc_id")
    named = named.select("hub", "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    own = named.filter("doc_id = hub").select("hub", F.col("component").alias("main"))
    named = named.join(own, "hub").withColumn("rest", F.col("component") != F.col("main"))
    counts = named.groupBy("hub").agg(
        *(F.ceil(F.greatest(F.count_if(side) / TILE_ROWS, F.sum(F.when(side, F.col("n_shingles")).otherwise(0)) / TILE_SHINGLES)).cast("int").alias(name)
          for name, side in (("mains", ~F.col("rest")), ("rests", F.col("rest"))))
    ).filter("rests > 0")
    spread = F.xxhash64("doc_id", F.lit(1))
    block = F.when(F.col("rest"), F.col("mains") + F.pmod(spread, F.col("rests"))).otherwise(F.pmod(spread, F.col("mains"))).cast("int")
    placed = named.join(counts, "hub").withColumn("block", block)
    last = F.col("mains") + F.col("rests") - 1
    # A block of the rest meets all blocks below it, and itself where it meets the first.
    upper = F.expr("transform(sequence(greatest(block + 1, mains), mains + rests), h -> named_struct('low', block, 'high', h))")
    upper = F.filter(upper, lambda t: t["high"] <= last)
    lower = F.expr("if(rest, transform(sequence(0, block - 1), l -> named_struct('low', l, 'high', block)), array())")
    tiles = placed.select("hub", "doc_id", "component", "block", F.explode(F.concat(upper, lower)).alias("tile"))
    tiles = tiles.select("hub", "doc_id", "component", "block", F.col("tile.low").alias("low"), F.col("tile.high").alias("high"))
    whole = _with_sets(stored(tiles, "tiles"), docs, width)
    ordered = whole.repartition("hub", "low", "high").sortWithinPartitions("hub", "low", "high", "doc_id")
    return stored(ordered.mapInArrow(_across(percent), "u long, v long"), "across")
