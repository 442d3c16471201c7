"""Language identification by prediction by partial matching (PPM).

Each language has a context tree over bytes: how often each byte followed each context of up to
``order`` bytes in its training texts. A byte is coded in the longest context known for the
language; a byte not seen there costs an escape (method C: as likely as there are distinct
followers) and is coded one context shorter, without the bytes already ruled out, down to all
256 bytes being alike. The statistics are frozen, so the code length of a text is the exact sum
over its bytes and the probabilities of the 256 bytes add up to one in every context. The
language with the shortest code wins.

All trees are laid out as one table, a row for each context any language knows and a column for
each byte that occurs in training, with one cost per language. A text is scored by two lookups a
byte, for all languages at once, in its own task.

Training uses a bounded sample: the ``sample`` labelled texts of each language with the smallest
hash of their text, and of their contexts the ``max_contexts`` most frequent. Counting them is a
Spark aggregation; only the counts, bounded by those two, come to the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tallyline.llm.arrowtext import slices

UNDETERMINED = "und"
SALTS = 64
SCORED_BYTES = 1 << 18
#: Rows that leave a task together. A whole batch of long texts would be held once more here and in the JVM.
SCORED_ROWS = 512


@dataclass(frozen=True)
class Model:
    """``cost[row_of[context code] * columns + column_of[byte]]`` has the bits for each language."""

    languages: tuple[str, ...]
    order: int
    column_of: np.ndarray
    row_of: np.ndarray
    cost: np.ndarray

    @property
    def columns(self) -> int:
        return int(self.column_of.max()) + 1

    def byte_costs(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of every byte under every language; contexts do not cross rows."""
        radix = self.columns
        symbol = self.column_of[data].astype(np.int64)
        code = np.zeros(len(data), dtype=np.int64)
        begin = np.repeat(offsets[:-1], np.diff(offsets))
        place = np.arange(len(data)) - begin
        for back in range(self.order, 0, -1):
            # Before the start of a row stands the symbol that no known context holds.
            previous = np.full(len(data), radix - 1, dtype=np.int64)
            previous[back:] = symbol[:-back]
            previous[place < back] = radix - 1
            code = code * radix + previous
        return self.cost[self.row_of[code] * radix + symbol]

    def code_lengths(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Bits of each row (one line) under each language (one column)."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        full = np.flatnonzero(np.diff(offsets) > 0)
        if len(full):
            bits = self.byte_costs(data, offsets).astype(np.float64)
            total[full] = np.add.reduceat(bits, offsets[:-1][full], axis=0)
        return total


@dataclass(frozen=True)
class Trees:
    """The frozen counts (lang, length, gram, n), small enough to send; every worker lays them out once."""

    grams: pd.DataFrame
    order: int

    @cached_property
    def model(self) -> Model:
        return built(self.grams, self.order)


def _least(sample: int):
    """The ``sample`` smallest different draws of each language in one task."""

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = None
        for batch in batches:
            rows = batch.to_pandas()
            rows = rows if kept is None else pd.concat([kept, rows])
            kept = rows.drop_duplicates().sort_values("draw").groupby("lang").head(sample)
        if kept is not None:
            yield pa.RecordBatch.from_pandas(kept, preserve_index=False)

    return least


def candidates(known: DataFrame, sample: int) -> DataFrame:
    """Different (lang, draw), at most SALTS * ``sample`` a language, with the ``sample`` smallest among them."""
    drawn = known.select("lang", "draw").mapInArrow(_least(sample), "lang string, draw long").distinct()
    first = Window.partitionBy("lang", F.pmod("draw", F.lit(SALTS))).orderBy("draw")
    return drawn.withColumn("place", F.row_number().over(first)).filter(F.col("place") <= sample).drop("place")


def sampled(training: DataFrame, sample: int) -> DataFrame:
    """(text, lang) of ``sample`` different texts a language, those with the smallest hashes.

    Only languages and hashes are ranked: first in each task, then in SALTS parts of a language,
    so that one task never ranks more than SALTS * ``sample`` of a language at last. One bound per language, a handful of rows, then
    selects the texts in the scan.
    """
    known = training.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    known = known.select("text", "lang", F.xxhash64("text").alias("draw"))
    first = Window.partitionBy("lang").orderBy("draw")
    drawn = candidates(known, sample).withColumn("place", F.row_number().over(first))
    bounds = drawn.filter(F.col("place") <= sample).groupBy("lang").agg(F.max("draw").alias("bound"))
    chosen = known.join(F.broadcast(bounds), "lang").filter("draw <= bound")
    return chosen.dropDuplicates(["lang", "draw"]).select("text", "lang")


def _grams(order: int):
    """Counts of (language, length, packed bytes of context and follower) in each batch."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang = batch.column("lang").to_pylist()
            for row, data, offsets in slices(batch.column("text")):
                found = []
                for i in range(len(offsets) - 1):
                    text = data[offsets[i] : offsets[i + 1]].astype(np.int64)
                    for length in range(1, order + 2):
                        if len(text) < length:
                            break
                        code = np.zeros(len(text) - length + 1, dtype=np.int64)
                        for k in range(length):
                            code = code * 256 + text[k : len(text) - length + 1 + k]
                        grams, n = np.unique(code, return_counts=True)
                        found.append(pd.DataFrame({"lang": lang[row + i], "length": length, "gram": grams, "n": n}))
                if found:
                    summed = pd.concat(found).groupby(["lang", "length", "gram"], as_index=False)["n"].sum()
                    yield pa.RecordBatch.from_pandas(summed, preserve_index=False)

    return count


def trained(training: DataFrame, order: int = 3, sample: int = 1500, max_contexts: int = 60_000) -> Trees:
    """Count the sample's grams with Spark."""
    counted = sampled(training, sample).mapInArrow(_grams(order), "lang string, length long, gram long, n long")
    counts = counted.groupBy("lang", "length", "gram").agg(F.sum("n").alias("n"))
    # A gram takes part if its context is one of the most frequent over all languages.
    context = counts.groupBy("length", (F.col("gram") / 256).cast("long").alias("context")).agg(F.sum("n").alias("seen"))
    kept = context.orderBy(F.desc("seen"), "length", "context").limit(max_contexts).drop("seen")
    grams = counts.withColumn("context", F.shiftright("gram", 8)).join(kept, ["length", "context"], "left_semi")
    return Trees(grams.select("lang", "length", "gram", "n").toPandas(), order)


def built(grams: pd.DataFrame, order: int) -> Model:
    """The cost table out of the counts (lang, length, gram, n), some contexts at a time."""
    languages = tuple(sorted(grams["lang"].unique()))
    gram = grams["gram"].to_numpy(np.int64)
    byte, context, length = gram & 255, gram >> 8, grams["length"].to_numpy(np.int64) - 1
    used = np.unique(byte)
    columns = len(used) + 1  # the last one stands for all bytes that never occur
    column_of = np.full(256, len(used), dtype=np.int16)
    column_of[used] = np.arange(len(used))
    alike = np.ones(columns)
    alike[-1] = 256 - len(used)
    who = np.searchsorted(languages, grams["lang"].to_numpy(str)) if len(grams) else byte

    contexts = np.unique(np.append(_named(length, context), 0))
    row = np.searchsorted(contexts, _named(length, context))
    by_row = np.argsort(row, kind="stable")
    cell = (column_of[byte].astype(np.int64) * len(languages) + who)[by_row]
    n, starts = grams["n"].to_numpy(float)[by_row], np.searchsorted(row[by_row], np.arange(len(contexts) + 1))

    def counts(rows: np.ndarray) -> np.ndarray:
        """Counts of some rows by byte and language; row -1 has none."""
        known = np.maximum(rows, 0)
        sizes = np.where(rows >= 0, starts[known + 1] - starts[known], 0)
        owner = np.repeat(np.arange(len(rows)), sizes)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes - starts[known], sizes)
        out = np.zeros((len(rows), columns * len(languages)))
        out[owner, cell[place]] = n[place]
        return out.reshape(len(rows), columns, len(languages))

    cost = np.zeros((len(contexts), columns, len(languages)), dtype=np.float32)
    size, code = contexts >> CODE_BITS, contexts & ((1 << CODE_BITS) - 1)
    for at in range(0, len(contexts), TOGETHER):
        some = slice(at, at + TOGETHER)
        longest = int(size[some].max())
        # A context that no language knows has no counts, which leaves the code as it is.
        chain = (np.where(size[some] >= k, _found(contexts, k, code[some]), -1) for k in range(longest, -1, -1))
        cost[some] = _bits((counts(rows) for rows in chain), cost[some].shape, alike)
    row_of = _rows_by_code(size, code, column_of, columns, order)
    return Model(languages, order, column_of, row_of, cost.reshape(len(contexts) * columns, len(languages)))


CODE_BITS = 48
TOGETHER = 256


def _named(size: np.ndarray, code: np.ndarray) -> np.ndarray:
    """One number for a context: short ones come first."""
    return (size << CODE_BITS) | code


def _found(contexts: np.ndarray, size: int, code: np.ndarray) -> np.ndarray:
    """The rows of the last ``size`` bytes of contexts; -1 where they are no context."""
    wanted = _named(np.full_like(code, size), code & ((1 << (8 * size)) - 1))
    at = np.minimum(np.searchsorted(contexts, wanted), len(contexts) - 1)
    return np.where(contexts[at] == wanted, at, -1)


def _bits(chain: Iterable[np.ndarray], shape: tuple[int, ...], alike: np.ndarray) -> np.ndarray:
    """Bits of each byte and language in some contexts, given their counts from the longest suffix down."""
    bits, open_ = np.zeros(shape), np.ones(shape, dtype=bool)
    escape = np.zeros((shape[0], 1, shape[2]))
    for seen in chain:
        counted = np.where(open_, seen, 0)
        hit = counted > 0
        total, kinds = counted.sum(axis=1, keepdims=True), hit.sum(axis=1, keepdims=True)
        # A context with all that is left is never left again.
        left = (open_ & ~hit).any(axis=1, keepdims=True)
        whole = np.where(total > 0, total + np.where(left, kinds, 0), 1)
        bits = np.where(hit, escape - np.log2(np.where(hit, counted, 1) / whole), bits)
        escape = escape + np.where((total > 0) & left, -np.log2(np.maximum(kinds, 1) / whole), 0)
        open_ &= ~hit
    remaining = (alike[:, None] * open_).sum(axis=1, keepdims=True)
    return np.where(open_, escape + np.log2(np.maximum(remaining, 1)), bits)


def _rows_by_code(size: np.ndarray, code: np.ndarray, column_of: np.ndarray, columns: int, order: int) -> np.ndarray:
    """The row of the longest known suffix for every code of ``order`` columns, newest last."""
    row_of = np.zeros(columns**order, dtype=np.int32)
    for k in range(order + 1):  # short ones first; longer ones overwrite their part
        rows = np.flatnonzero(size == k)
        short = np.zeros(len(rows), np.int64)
        for back in range(k - 1, -1, -1):
            short = short * columns + column_of[(code[rows] >> (8 * back)) & 255]
        part = row_of.reshape(-1, columns**k)
        part[:, short] = rows
    return row_of


def _scored(shared):
    """``detected`` in a task, by the trees in a broadcast."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value.model
        names = np.array([*model.languages, UNDETERMINED], dtype=object)
        for batch in (whole.slice(at, SCORED_ROWS) for whole in batches for at in range(0, whole.num_rows, SCORED_ROWS)):
            text = batch.column("text")
            letters = np.asarray(pa.compute.match_substring_regex(text, r"\p{L}").fill_null(False))
            n = len(text)
            best, share, rate = np.full(n, len(names) - 1), np.zeros(n), np.zeros(n)
            if model.languages:
                for row, data, offsets in slices(text, SCORED_BYTES):
                    bits = model.code_lengths(data, offsets)
                    short = bits.min(axis=1)
                    to = slice(row, row + len(bits))
                    best[to] = bits.argmin(axis=1)
                    share[to] = 1 / np.exp2(short[:, None] - bits).sum(axis=1)
                    rate[to] = short / np.maximum(np.diff(offsets), 1)
                best[~letters], share[~letters] = len(names) - 1, 0
            found = [pa.array(names[best], pa.string()), pa.array(share), pa.array(rate)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *found], names=[*batch.schema.names, "lang_pred", "score", "bits_per_byte"])

    return score


def detected(docs: DataFrame, trees: Trees) -> DataFrame:
    """Add ``lang_pred``, ``score`` and ``bits_per_byte`` to ``docs`` by their column ``text``.

    The score is the share of the winner when every language's code length is taken as a
    probability; ties go to the first language in name order. A null text or one without any
    letter is ``und`` with score 0, and so is everything if no language was learned. Columns of
    those three names are replaced; rows, repeated ones too, are kept as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)
    docs = docs.drop("lang_pred", "score", "bits_per_byte")
    found = [T.StructField("lang_pred", T.StringType()), *(T.StructField(c, T.DoubleType()) for c in ("score", "bits_per_byte"))]
    schema = T.StructType([*docs.schema.fields, *found])

    return docs.mapInArrow(_scored(shared), schema)


def rate_limits(found: DataFrame, share: float = 0.99, margin: float = 2.0) -> DataFrame:
    """(lang_pred, limit): bits a byte beyond which a text is in no learned language.

    For each language, ``margin`` times what all but the rest of ``share`` of its own texts that were not
    learned from need. ``found`` is the output of ``detected`` with lang and doc_id.
    """
    own = found.filter(held_out() & (F.col("lang") == F.col("lang_pred")))
    rate = F.percentile_approx("bits_per_byte", share, 10_000) * margin
    return own.groupBy("lang_pred").agg(rate.alias("limit"))


def held_out() -> F.Column:
    """The fifth of the documents that is never learned from, by a checksum of the id."""
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


def language_of(docs: DataFrame, **settings: int) -> DataFrame:
    """Learn from the labelled documents outside the held-out fifth and predict all.

    ``docs`` has doc_id, text and lang. A null doc_id is learned from never and counts as held out.
    """
    kept_out = F.coalesce(held_out(), F.lit(True))
    trees = trained(docs.filter(~kept_out).select("text", "lang"), **settings)
    return detected(docs.select("doc_id", "text"), trees).select(
        "doc_id", kept_out.alias("held_out"), "lang_pred", "score", "bits_per_byte"
    )
