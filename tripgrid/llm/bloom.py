"""A Bloom filter of fixed size, used to keep rows that cannot matter out of a shuffle.

The filter has ``BITS`` bits whatever the input, so building it collects at
most 131,072 words (1 MiB) and broadcasting it is safe. When very many keys
fill it up it lets more rows pass; results never depend on it, because an
exact operation always follows.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23


def build(df: DataFrame, *hashes: Column) -> np.ndarray:
    """Words of the filter that holds every row's ``hashes`` (uniform longs)."""
    spots = F.explode(F.array(*[F.pmod(h.cast("bigint"), F.lit(BITS)) for h in hashes]))
    words = (
        df.select(spots.alias("spot"))
        .groupBy(F.expr("shiftright(spot, 6)").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(spot & 63 as int))")).alias("bits"))
    )
    out = np.zeros(BITS // 64, dtype=np.uint64)
    for word, bits in words.toLocalIterator():  # at most BITS / 64 rows
        out[word] = np.uint64(bits & 0xFFFFFFFFFFFFFFFF)
    return out


def may_contain(words: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    """Mask of the rows whose hashes are all in the filter (arrays of int64)."""
    mask = np.ones(len(hashes[0]), dtype=bool)
    for h in hashes:
        spot = np.mod(h.astype(np.int64), BITS)
        mask &= (words[spot >> 6] >> (spot & 63).astype(np.uint64)) & np.uint64(1) == 1
    return mask
