"""A Bloom filter of fixed size for hashes, made by Spark and sent to all executors; it may fill up, and never misses."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hashing import mix

#: Bits of a block, as bitmap_construct_agg has them.
BLOCK_BITS = 32768


def probes(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The two bits of each hash."""
    return (mix(h) % np.uint64(bits)).astype(np.int64), (mix(h + np.uint64(1 << 63)) % np.uint64(bits)).astype(np.int64)


def in_filter(filt: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes may be in the filter."""
    found = np.ones(len(h), bool)
    for at in probes(h, len(filt) * 8):
        found &= (filt[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return found


def fixed_filter(hashes: DataFrame, bits: int) -> Broadcast:
    """The filter of a column of longs: `bits` bits (in whole blocks) whatever the number of rows is, which is what reaches the driver."""
    blocks = -(-bits // BLOCK_BITS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at = probes(b.column(0).to_numpy().view(np.uint64), blocks * BLOCK_BITS)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(at))], ["bit"])

    bit = hashes.mapInArrow(run, "bit long").groupBy(F.expr(f"bit div {BLOCK_BITS}").alias("block"))
    whole = np.zeros((blocks, BLOCK_BITS // 8), np.uint8)
    for r in bit.agg(F.bitmap_construct_agg(F.col("bit") % BLOCK_BITS).alias("bits")).collect():
        whole[r["block"]] = np.frombuffer(r["bits"], np.uint8)
    return hashes.sparkSession.sparkContext.broadcast(whole.ravel())
