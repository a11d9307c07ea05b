"""A filter of keys in a table of bits whose size is fixed, however many keys there are.

Three bits per key: a key that was put in always passes, another one only if all its bits happen to
be set. Built by an aggregate, so what comes to the driver and is broadcast is bounded by the table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 27
_SHIFTS = (0, 18, 36)


def build(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """The table of column ``key`` (bigint, well mixed)."""
    places = [F.shiftrightunsigned("key", s).bitwiseAND(F.lit((1 << bits) - 1)) for s in _SHIFTS]
    at = keys.select(F.explode(F.array(*places)).alias("at"))
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("at").bitwiseAND(F.lit(63)).cast("int"))
    words = at.groupBy(F.shiftright("at", 6).alias("w")).agg(F.bit_or(bit).alias("b")).toArrow()
    table = np.zeros(1 << max(bits - 6, 0), np.uint64)
    table[words.column("w").to_numpy()] = words.column("b").to_numpy().view(np.uint64)
    return table


def passes(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    mask, found = np.uint64(len(table) * 64 - 1), np.ones(len(keys), bool)
    for s in _SHIFTS:
        at = (keys >> np.uint64(s)) & mask
        found &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return found
