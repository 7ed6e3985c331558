"""Bitmaps of a fixed size, built from slices in parallel and broadcast.

The size is a parameter, not a function of the input: as the input grows a filter lets more through
and the exact step behind it has more to do, but results stay the same.
"""
from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import ship
from .shingles import mix

SLICE_BITS = 19


def cells_of(values: np.ndarray, log2_cells: int, row: int = 0) -> np.ndarray:
    """Cell of each 64-bit value in row ``row`` of a sketch with 2**log2_cells cells a row."""
    return mix(values ^ np.uint64(0xA5A5 + 7919 * row)) >> np.uint64(64 - log2_cells)


def pack_cells(cells: np.ndarray) -> bytes:
    """Sorted cells of one slice as differences."""
    return np.diff(cells.astype(np.uint32), prepend=np.uint32(0)).astype("<u4").tobytes()


def unpack_cells(blob: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(blob, "<u4"), dtype=np.uint32)


def members(values: DataFrame, log2_cells: int) -> np.ndarray:
    """Bitmap (2**log2_cells bits) of the values of a long column ``value``."""
    ship(values.sparkSession)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = np.unique(cells_of(b["value"].to_numpy(zero_copy_only=False)
                                       .astype(np.int64).view(np.uint64), log2_cells))
            part, at = np.unique(cells >> np.uint64(SLICE_BITS), return_index=True)
            ends = np.append(at, len(cells))[1:]
            low = cells & np.uint64((1 << SLICE_BITS) - 1)
            yield pa.record_batch([pa.array(part.astype(np.int32)), pa.array(
                [pack_cells(low[a:e]) for a, e in zip(at, ends, strict=True)], pa.binary())],
                names=["part", "blob"])

    found = values.select("value").mapInArrow(split, "part int, blob binary")
    return collect_bitmap(found, log2_cells)


def _either(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """OR the cell lists of each slice; a task holds the bitmaps of its slices only."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for part, blob in zip(b["part"].to_pylist(), b["blob"], strict=True):
            bits = held.setdefault(part, np.zeros(1 << SLICE_BITS, dtype=bool))
            bits[unpack_cells(blob.as_buffer())] = True
    yield pa.record_batch([pa.array(list(held), pa.int32()), pa.array(
        [np.packbits(x, bitorder="little").tobytes() for x in held.values()], pa.binary())],
        names=["part", "blob"])


def collect_bitmap(cells: DataFrame, log2_cells: int) -> np.ndarray:
    """Merge cell lists by slice and gather the bitmap: 2**log2_cells bits, whatever the input.

    There are no more tasks than slices, and one job brings the slices of all of them.
    """
    n = min(int(cells.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            max(1, 1 << log2_cells >> SLICE_BITS))
    to = F.pmod(F.col("part"), F.lit(n))
    merged = cells.repartitionById(n, to).mapInArrow(_either, "part int, blob binary")
    return _joined(merged.collect(), log2_cells)


def gather(merged: DataFrame, log2_cells: int) -> np.ndarray:
    return _joined(merged.toLocalIterator(), log2_cells)


def _joined(rows: Iterable[Row], log2_cells: int) -> np.ndarray:
    out = np.zeros(max(1, (1 << log2_cells) >> 3), dtype=np.uint8)
    size = 1 << (SLICE_BITS - 3)
    for r in rows:
        out[r["part"] * size:(r["part"] + 1) * size] = np.frombuffer(r["blob"], np.uint8)
    return out


def test(bitmap: np.ndarray, cells: np.ndarray) -> np.ndarray:
    at = cells.astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8) & np.uint8(1)).astype(bool)
