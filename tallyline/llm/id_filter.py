"""A bitmap of fixed size over hashes of ids, to leave rows out of a shuffle.

An id without its bit is certainly not listed; one with it may be. The bitmap never grows, so it
can be sent to every task: when it fills up it lets more rows pass, and the join behind it still
gives the same result.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 25


def spot(column: str) -> Column:
    """The place of an id in the bitmap."""
    return F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(BITS))


def bitmap(ids: DataFrame) -> Broadcast:
    """The bitmap of the first column of ``ids``, shared with all tasks: at most BITS / 8 bytes."""
    name = ids.columns[0]
    spots = ids.select(spot(name).alias("spot"))
    words = spots.groupBy(F.floor(F.col("spot") / 64).cast("int").alias("word"))
    words = words.agg(F.bit_or(F.expr("shiftleft(1L, cast(spot % 64 as int))")).alias("bits")).toArrow()
    found = np.zeros(BITS // 64, np.int64)
    found[words["word"].to_numpy()] = words["bits"].to_numpy()
    return ids.sparkSession.sparkContext.broadcast(found.view(np.uint64))


def listed(shared: Broadcast, spots: np.ndarray) -> np.ndarray:
    """Which places have their bit."""
    return (shared.value[spots >> 6] >> (spots & 63).astype(np.uint64)) & np.uint64(1) > 0
