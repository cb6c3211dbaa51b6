"""A Bloom filter over a column of hashes, for letting most rows of a large table skip a join.

The filter follows the number of hashes up to ``max_bits``; beyond that it lets more rows through.
Whoever uses it joins what it lets through, so its false alarms change no result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

BITS_PER_HASH = 12
_PROBES = 3


def build(hashes: DataFrame, max_bits: int = 1 << 28, min_bits: int = 1 << 16) -> np.ndarray:
    """The filter over column ``h`` as 64-bit words. At most ``max_bits`` / 64 numbers come to the driver."""
    wanted = max(min_bits, hashes.count() * BITS_PER_HASH)
    bits = min(max_bits, 1 << (wanted - 1).bit_length())
    probes = F.explode(F.array(*(F.shiftrightunsigned("h", 17 * n).bitwiseAND(F.lit(bits - 1)) for n in range(_PROBES))))
    words = hashes.select(probes.alias("p")).groupBy(F.shiftright("p", 6).alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(p & 63 AS int))")).alias("set")).toArrow()
    filter_ = np.zeros(bits // 64, np.uint64)
    filter_[words.column("word").to_numpy()] = words.column("set").to_numpy().astype(np.int64).view(np.uint64)
    return filter_


def holds(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    values, mask = h.astype(np.int64).view(np.uint64), np.uint64(filter_.size * 64 - 1)
    found = np.ones(len(values), bool)
    for n in range(_PROBES):
        p = (values >> np.uint64(17 * n)) & mask
        found &= ((filter_[p >> np.uint64(6)] >> (p & np.uint64(63))) & np.uint64(1)).astype(bool)
    return found


def member(filter_: np.ndarray, h: Column, context) -> Column:
    """True where the hash may be one of the filter's, always where it is."""
    sent = context.broadcast(filter_)

    @F.pandas_udf("boolean")
    def test(values: pd.Series) -> pd.Series:
        return pd.Series(holds(sent.value, values.to_numpy()))

    return test(h)
