"""A set of hashes as a filter of bounded size: no member is denied, few others are let through."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: At most 2 ** 27 bits, 16 MB, whatever the set; below that SPARSE bits for each member. The fuller it is the more others pass, so
#: callers check members exactly afterwards.
MOST_BITS, SPARSE = 1 << 27, 32
_BLOCK = 1 << 15


def filter_of(keys: DataFrame, key: str = "key") -> np.ndarray:
    """The bits that the (well mixed, 64-bit) keys set; gathered as blocks of bits that Spark puts together."""
    size = min(max(1 << (SPARSE * keys.count()).bit_length(), _BLOCK), MOST_BITS)
    at = F.col(key).bitwiseAND(F.lit(size - 1))
    blocks = keys.groupBy(F.shiftright(at, 15).alias("block")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit(_BLOCK - 1))).alias("bits")).toArrow()
    out = np.zeros((size // _BLOCK, _BLOCK // 8), dtype=np.uint8)
    for block, bits in zip(blocks.column("block").to_pylist(), blocks.column("bits").to_pylist()):
        out[block] = np.frombuffer(bits, np.uint8)
    return out.ravel()


def may_hold(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the unsigned keys may be members."""
    at = (keys & np.uint64(8 * len(bits) - 1)).astype(np.int64)
    return (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
