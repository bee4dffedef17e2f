"""Bitmaps of 64-bit keys that tasks test before they send rows: a fixed size, whatever the
number of keys. A bit that another key set lets a row through; it never holds one back."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 26
CELL = 1 << 15  # bits of one row of bitmap_construct_agg


def bitmap_of(keys: DataFrame, bits: int = BITS) -> np.ndarray:
    """Bitmap of 2^bits bits (at least CELL) with the low bits of column `key` set. The driver
    gets at most 2^bits / 8 bytes."""
    place = keys.select(F.col("key").bitwiseAND(F.lit((1 << bits) - 1)).alias("p"))
    cells = place.select(F.expr(f"p div {CELL}").alias("cell"), F.expr(f"p % {CELL}").alias("p"))
    cells = cells.repartition("cell").groupBy("cell").agg(F.bitmap_construct_agg("p").alias("bits"))
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in cells.toLocalIterator():
        out[r["cell"] * CELL // 8:(r["cell"] + 1) * CELL // 8] = np.frombuffer(r["bits"], np.uint8)
    return out


def test(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (uint64) may be in the set."""
    p = keys & np.uint64(8 * len(bitmap) - 1)
    return ((bitmap[(p >> np.uint64(3)).astype(np.int64)] >> (p & np.uint64(7)).astype(np.uint8)) & 1).astype(bool)
