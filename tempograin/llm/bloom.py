"""A split blocked Bloom filter over 64-bit hashes, built by Spark."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: One odd multiplier for each of a block's eight 64-bit words.
_SALTS = (0x47B6137B, 0x44974D91, 0x0824AD5B, 0x2DF1424B, 0x705495C7, 0x5C6BFB31, 0x1EFC4947, 0x22B7B0E9)
_LOW = (1 << 31) - 1


class BlockedBloom:
    """Eight words of 64 bits a block; a key sets one bit in each word of one
    block, so that a probe touches one cache line."""

    def __init__(self, words: np.ndarray):
        self.words = words

    @staticmethod
    def build(hashes: DataFrame, column: str, keys: int, bits_per_key: int = 16, most_blocks: int = 1 << 20) -> BlockedBloom:
        """From a column of longs. The blocks, at most ``most_blocks`` (64 MB),
        are filled where the keys are and only their words reach the driver."""
        blocks = min(most_blocks, max(1, -(-keys * bits_per_key // 512)))
        low = F.col(column).bitwiseAND(F.lit(_LOW))
        bits = [F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(low * F.lit(s), 25).bitwiseAND(F.lit(63)).cast("int"))).alias(f"w{i}") for i, s in enumerate(_SALTS)]
        filled = hashes.filter(F.col(column).isNotNull()).groupBy((F.shiftrightunsigned(column, 31) % blocks).alias("block")).agg(*bits).toArrow()
        words = np.zeros((blocks, 8), dtype=np.uint64)
        words[filled.column("block").to_numpy()] = np.stack([filled.column(f"w{i}").to_numpy().view(np.uint64) for i in range(8)], axis=1)
        return BlockedBloom(words)

    def might_contain(self, hashes: np.ndarray) -> np.ndarray:
        h = hashes.astype(np.int64).view(np.uint64)
        block = (h >> np.uint64(31)) % np.uint64(len(self.words))
        low = h & np.uint64(_LOW)
        found = np.ones(len(h), dtype=bool)
        for i, s in enumerate(_SALTS):
            bit = ((low * np.uint64(s)) >> np.uint64(25)) & np.uint64(63)
            found &= (self.words[block, i] >> bit) & np.uint64(1) == 1
        return found
