"""A Bloom filter of fixed size over strings or 64-bit hashes, filled by Spark and read in tasks.

Whatever the corpus, ``BITS`` bits come to the driver and go to the tasks (8 MiB). A task uses it only to drop what no
later join could keep: a false positive costs a row, never a result.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 26
PROBES = 3
_SHIFT = 26
#: The seed of Spark's xxhash64.
_SEED = 42


class Sieve:
    """The filter as tasks see it; ``bits`` is an array of bytes or a broadcast of one."""

    def __init__(self, bits: np.ndarray | Broadcast) -> None:
        self._bits = bits

    @property
    def bits(self) -> np.ndarray:
        return self._bits.value if isinstance(self._bits, Broadcast) else self._bits

    def opened(self) -> Sieve:
        """The filter with its bits at hand; called once in a task."""
        return Sieve(self.bits)

    def __contains__(self, word: str) -> bool:
        return self.has(xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"), _SEED))

    def has(self, h: int) -> bool:
        """Whether an unsigned 64-bit hash may be in."""
        bits, at, step = self.bits, h & (BITS - 1), (h >> _SHIFT & (BITS - 1)) | 1
        for i in range(PROBES):
            p = at + i * step & (BITS - 1)
            if not bits[p >> 3] >> (p & 7) & 1:
                return False
        return True

    def mask(self, hashes: np.ndarray) -> np.ndarray:
        """Which of an array of unsigned 64-bit hashes may be in."""
        bits, low = self.bits, np.uint64(BITS - 1)
        left = np.arange(len(hashes))
        for i in range(PROBES):
            h = hashes[left]
            p = (h & low) + np.uint64(i) * (h >> np.uint64(_SHIFT) & low | np.uint64(1)) & low
            left = left[bits[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8) & np.uint8(1) > 0]
        out = np.zeros(len(hashes), bool)
        out[left] = True
        return out


def hash_of(word: Column) -> Column:
    """The hash under which a string is in the filter."""
    return F.xxhash64(word)


def sieve(rows: DataFrame, hash_col: str) -> Sieve:
    """The filter over a column of 64-bit hashes, as a broadcast."""
    h = F.col(hash_col)
    at, step = h.bitwiseAND(BITS - 1), F.shiftrightunsigned(h, _SHIFT).bitwiseAND(BITS - 1).bitwiseOR(F.lit(1))
    probes = F.array(*((at + step * i).bitwiseAND(BITS - 1) for i in range(PROBES)))
    places = rows.where(h.isNotNull()).select(F.explode(probes).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).cast("int").alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("p").bitwiseAND(63).cast("int"))).alias("bits"))
    filled = words.toArrow()
    bits = np.zeros(BITS // 64, np.int64)
    bits[filled.column("at").to_numpy()] = filled.column("bits").to_numpy()
    return Sieve(rows.sparkSession.sparkContext.broadcast(bits.view(np.uint8)))
