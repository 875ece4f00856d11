"""A filter of bounded size for 64-bit keys, for thinning rows before a join.

It keeps every row whose key is in the set and few others, so whoever uses it
must tolerate or remove the others. The bits grow with the number of keys up to
MAX_BITS; beyond that the filter lets more rows pass, and results stay the same.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gaugeflow.llm.text import mix

#: 16 MB on the driver and in each worker.
MAX_BITS = 1 << 27
MIN_BITS = 1 << 16


def _positions(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    spread = mix(np.asarray(keys).view(np.uint64))
    half = np.uint64(bits - 1)
    return spread & half, (spread >> np.uint64(32)) & half


class KeyFilter:
    def __init__(self, bits: np.ndarray) -> None:
        self.bits = bits

    def __len__(self) -> int:
        return len(self.bits) * 64

    def passes(self, keys: np.ndarray) -> np.ndarray:
        """Whether each 64-bit key may be in the set."""
        out = np.ones(len(keys), dtype=bool)
        for at in _positions(keys, len(self)):
            word = self.bits[(at >> np.uint64(6)).astype(np.int64)]
            out &= ((word >> (at & np.uint64(63))) & np.uint64(1)).astype(bool)
        return out


def build_filter(keys: DataFrame, column: str) -> KeyFilter:
    """Build the filter as an aggregation; at most MAX_BITS / 64 rows reach the driver."""
    count = keys.count()
    bits = MIN_BITS
    while bits < 16 * count and bits < MAX_BITS:
        bits *= 2

    def places(batches):
        import pyarrow as pa

        for batch in batches:
            key = batch.column(0).drop_null().to_numpy(zero_copy_only=False)
            at = np.unique(np.concatenate(_positions(np.ascontiguousarray(key, np.int64), bits)))
            yield pa.record_batch(
                {"word": (at >> np.uint64(6)).astype(np.int64),
                 "bit": (at & np.uint64(63)).astype(np.int32)})

    rows = (keys.select(F.col(column).cast("long"))
            .mapInArrow(places, "word long, bit int")
            .groupBy("word").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("mask"))
            .toArrow())
    table = np.zeros(bits // 64, np.uint64)
    table[rows["word"].to_numpy()] = rows["mask"].to_numpy().view(np.uint64)
    return KeyFilter(table)
