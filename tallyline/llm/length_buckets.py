"""Packing by optimal length buckets.

Texts longer than the longest sequence are cut into pieces of that length. The histogram of piece
lengths, one row per length, is the only thing the driver sees; dynamic programming over it
chooses the bucket lengths that leave the least padding in all. Inside a bucket pieces are
numbered in document order and a batch takes as many as its token budget holds.

Numbering is distributed: documents fall into ranges of doc_id, a range knows how many pieces of
each bucket precede it, and only within a range rows are ranked. A bucket with most of the rows
is as spread as the rest.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LONGEST, BUCKETS, BUDGET = 2048, 8, 16_384
LEAST_LONG = -(2**63)


def words(text: str = "text") -> Column:
    """The length used by default: the number of words."""
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+"))


def bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """At most ``buckets`` bucket lengths, ascending, with the least padding.

    ``lengths`` ascend; the last one is always a bucket. Among equal splits the one with shorter
    lower buckets is taken, from the top bucket down.
    """
    size, n = np.array(lengths, dtype=object), np.array(counts, dtype=object)
    m = len(lengths)
    if not m:
        return []
    rows = np.concatenate([[0], np.cumsum(n)]).astype(float)
    tokens = np.concatenate([[0], np.cumsum(size * n)]).astype(float)
    size = size.astype(float)
    # least[j]: padding of the first j lengths, in the buckets so far
    least = size[np.arange(m)] * rows[1:] - tokens[1:]
    least = np.concatenate([[0], least])
    came = [np.zeros(m + 1, np.int64)]
    for _ in range(min(buckets, m) - 1):
        fresh, back = least.copy(), np.zeros(m + 1, np.int64)
        for j in range(1, m + 1):
            split = least[:j] + size[j - 1] * (rows[j] - rows[:j]) - (tokens[j] - tokens[:j])
            back[j] = int(split.argmin())
            fresh[j] = split[back[j]]
        least = fresh
        came.append(back)
    chosen, j = [], m
    for back in reversed(came):
        if j == 0:
            break
        chosen.append(lengths[j - 1])
        j = int(back[j])
    return chosen[::-1]


def packed(
    docs: DataFrame, length: Column | None = None, longest: int = LONGEST,
    buckets: int = BUCKETS, budget: int = BUDGET,
) -> DataFrame:
    """(doc_id, piece, start, n_tokens, bucket_len, batch, slot) for every piece of ``docs`` (doc_id, text, ...).

    ``length`` counts tokens of a row, words by default. A piece is tokens [start, start +
    n_tokens) of its document; batch ``batch`` of bucket ``bucket_len`` holds budget //
    bucket_len pieces, one at least, in ascending (doc_id, piece) order. A document without
    tokens, null or empty, has one row without bucket, batch and slot. Rows of one doc_id are
    ordered by length; null ids come first.
    """
    spark = docs.sparkSession
    count = F.coalesce(words() if length is None else length, F.lit(0)).cast("long")
    sized = docs.select(F.col("doc_id").cast("long"), count.alias("n"))
    last = F.greatest(F.ceil(F.col("n") / longest) - 1, F.lit(0)).cast("long")
    pieces = sized.select("doc_id", "n", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("piece"))
    start = F.col("piece") * longest
    pieces = pieces.select("doc_id", "piece", start.alias("start"), F.least(F.col("n") - start, F.lit(longest)).alias("n_tokens"))

    histogram = pieces.filter("n_tokens > 0").groupBy("n_tokens").agg(F.count("*").alias("c")).orderBy("n_tokens").collect()
    chosen = bounds([r["n_tokens"] for r in histogram], [r["c"] for r in histogram], buckets)
    bucket = F.lit(None).cast("long")
    for b in reversed(chosen):
        bucket = F.when(F.col("n_tokens") <= b, F.lit(b).cast("long")).otherwise(bucket)
    bucket = F.when(F.col("n_tokens") > 0, bucket)

    ranges = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.coalesce("doc_id", F.lit(LEAST_LONG))
    steps = F.array(*[F.lit(i / ranges) for i in range(1, ranges)])
    cuts = sorted(set(sized.select(F.percentile_approx(key, steps, F.lit(20 * ranges))).first()[0] or []))
    place = F.lit(0)
    if cuts:  # the number of cuts at or below the id, by halving
        place = _position(key, cuts, 0, len(cuts))
    placed = pieces.select("*", bucket.alias("bucket_len"), place.cast("int").alias("range"))
    before = Window.partitionBy("bucket_len").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counts = placed.groupBy("bucket_len", "range").agg(F.count("*").alias("c"))
    counts = counts.select("bucket_len", "range", F.coalesce(F.sum("c").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("bucket_len", "range").orderBy("doc_id", "piece", "n_tokens")
    ranked = placed.withColumn("place", F.row_number().over(inside) - 1)
    ranked = ranked.join(F.broadcast(counts.filter("bucket_len is not null")), ["bucket_len", "range"], "left")
    number = F.col("before") + F.col("place")
    room = F.greatest(F.floor(F.lit(budget) / F.col("bucket_len")), F.lit(1)).cast("long")
    return ranked.select(
        "doc_id", "piece", "start", "n_tokens", "bucket_len",
        F.floor(number / room).cast("long").alias("batch"), F.pmod(number, room).alias("slot"),
    )


def _position(key: Column, cuts: list[int], low: int, high: int) -> Column:
    if low == high:
        return F.lit(low)
    middle = (low + high) // 2
    return F.when(key >= cuts[middle], _position(key, cuts, middle + 1, high)).otherwise(_position(key, cuts, low, middle))
