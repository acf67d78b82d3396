"""Sets of hashes as bitmaps of bounded size."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Bits for each hash, and the largest bitmap: 64 MB.
BITS_EACH, MOST_BITS = 32, 1 << 29
BITMAP_ROW = 32768  # fixed by the SQL function that builds them


def mixed(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in order."""
    h = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


class Filter:
    """Whether a hash is one of a set; false positives happen, false negatives do not."""

    def __init__(self, frequent: DataFrame, column: str):
        n = frequent.count()
        bits = BITMAP_ROW
        while bits < min(n * BITS_EACH, MOST_BITS):
            bits *= 2
        place = F.pmod(F.col(column), F.lit(bits)) + 1  # the function counts from 1
        rows = frequent.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits")
        )
        found = bytearray(bits // 8)
        for row in rows.toLocalIterator():  # at most 64 MB in all
            at = (row["b"] - 1) * BITMAP_ROW // 8
            found[at : at + BITMAP_ROW // 8] = row["bits"]
        self.size, self.words = bits, frequent.sparkSession.sparkContext.broadcast(bytes(found))

    def has(self, hashes: np.ndarray) -> np.ndarray:
        # bits are a power of two, so the low ones are the positive remainder
        place = (hashes & np.uint64(self.size - 1)).astype(np.int64)
        found = np.frombuffer(self.words.value, np.uint8)
        return (found[place >> 3] >> (place & 7).astype(np.uint8)) & 1 > 0
