"""A broadcast bitmap that spares rows from a join. It only lets more through than asked; the join decides exactly."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import _text as X

U = np.uint64
#: 16 bits or more for each key, up to so many in all: 256 MB.
MOST_BITS = 1 << 31
_CHUNK = 32768  # bits in one of the engine's bitmaps


_SEEDS = (U(0x9E3779B97F4A7C15), U(0xC2B2AE3D27D4EB4F))


def _places(key: np.ndarray, size: int) -> list[np.ndarray]:
    """A key's bits in a bitmap of ``size``."""
    return [(X.mix(key ^ seed) & U(size - 1)).astype(np.int64) for seed in _SEEDS]


def passes(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    out = np.ones(len(key), bool)
    for bit in _places(key, 8 * len(bitmap)):
        out &= (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8)) & 1 == 1
    return out


def bit_filter(keys: DataFrame):
    """The bitmap of ``keys`` (one column of longs), of a power of two bits by their number, as a broadcast."""
    wanted = min(MOST_BITS, max(1 << 20, 16 * keys.count()))
    size = 1 << (wanted - 1).bit_length()

    def bits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = _places(batch.column(0).to_numpy(zero_copy_only=False).view(U), size)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(bit))], ["bit"])

    placed = keys.mapInArrow(bits, "bit long").select((F.col("bit") / _CHUNK).cast("long").alias("bucket"), (F.col("bit") % _CHUNK).alias("bit"))
    made = placed.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    out = np.zeros(size // 8, np.uint8)
    for row in made.toLocalIterator():  # a row for each 4 KB of the bitmap
        out[row["bucket"] * _CHUNK // 8 : (row["bucket"] + 1) * _CHUNK // 8] = np.frombuffer(bytes(row["map"]), np.uint8)
    return keys.sparkSession.sparkContext.broadcast(out)
