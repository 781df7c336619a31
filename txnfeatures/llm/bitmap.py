"""Which of ``2**bits`` places some hashes fall on: a filter of fixed size, however many hashes there are.

A place that is set may stand for another hash, so the filter only saves rows
that a join or an exact count would drop; with more hashes it saves less.
"""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: 2 MB.
BITS = 24
#: Bits of one bitmap row of Spark.
WIDTH = 1 << 15


def place(hashed: np.ndarray, bits: int = BITS) -> np.ndarray:
    """The place of each 64-bit hash (its lowest bits)."""
    return (hashed & np.uint64((1 << bits) - 1)).astype(np.int64)


def presence(hashes: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Packed bits of all places that the bigint ``column`` falls on; at most ``2**bits / 8`` bytes reach the driver."""
    at = F.col(column).bitwiseAND(F.lit((1 << bits) - 1)) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(at).alias("part")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bitmap")
    )
    packed = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in rows.collect():
        first = (row["part"] - 1) * WIDTH // 8
        packed[first : first + WIDTH // 8] = np.frombuffer(bytes(row["bitmap"]), np.uint8)[: WIDTH // 8]
    return packed


def is_present(packed: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (packed[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1
