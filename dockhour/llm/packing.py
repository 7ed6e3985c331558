"""Best-fit packing of token pieces into sequences with exact-complement hashing.

Pieces of one length are interchangeable, so the packing is decided on the number of pieces of each
length: at most ``capacity`` counts whatever the input.  The plan that comes out says which ranks
within a length go to which sequences; ranking and placing the pieces are distributed.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, trimmed, written
from .prefix import running
from .tokens import TOKEN_SLICE_BYTES, encoder, slices

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


class Plan(NamedTuple):
    """Rows in order of (length, rank): ranks from ``rank`` on go, ``per`` to a sequence."""
    length: np.ndarray
    rank: np.ndarray
    per: np.ndarray
    offset: np.ndarray
    sequence: np.ndarray


def _pair(free: np.ndarray, gap: int) -> list[int] | None:
    """Two available lengths that fill ``gap``, the larger as large as possible."""
    low = np.arange(1, gap // 2 + 1)
    ok = np.flatnonzero((free[low] > 0) & (free[gap - low] > np.where(low * 2 == gap, 1, 0)))
    return [gap - int(low[ok[0]]), int(low[ok[0]])] if len(ok) else None


class SumIndex:
    """Which sums of two available lengths exist; entries may outlive their lengths."""

    def __init__(self, free: np.ndarray) -> None:
        present = np.flatnonzero(free > 0)
        bits = sum(1 << int(x) for x in present)
        mask, both = (1 << len(free)) - 1, 0
        for x in present:
            both |= (bits << int(x)) & mask
        raw = np.frombuffer(both.to_bytes(len(free) // 8 + 1, "little"), dtype=np.uint8)
        self.pairs = np.unpackbits(raw, bitorder="little")[:len(free)]

    def fill(self, free: np.ndarray, gap: int) -> list[int] | None:
        """One, two or three available lengths that fill ``gap`` exactly."""
        if free[gap] > 0:
            return [gap]
        if self.pairs[gap] and (found := _pair(free, gap)):
            return found
        first = np.arange(gap - 2, 0, -1)
        for x in first[(free[first] > 0) & (self.pairs[gap - first] > 0)]:
            free[x] -= 1
            rest = _pair(free, gap - int(x))
            free[x] += 1
            if rest:
                return [int(x), *rest]
        return None


def plan_packing(counts: np.ndarray, capacity: int) -> Plan:
    """Pack ``counts[l]`` pieces of each length l into as few sequences of ``capacity`` as it can.

    The longest piece left opens a sequence.  Its gap is filled exactly by one, two or three
    available lengths if any do; else the longest piece that fits goes in and the smaller gap is
    tried again.  The pattern is then repeated while its lengths last.
    """
    free = counts.astype(np.int64).copy()
    used_rank = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence, steps, index = [], 0, 0, None
    for longest in range(capacity, 0, -1):
        while free[longest] > 0:
            if index is None or steps % 32 == 0:
                index = SumIndex(free)
            steps += 1
            left, gap, parts = free.copy(), capacity - longest, [longest]
            left[longest] -= 1
            while gap > 0:
                exact = index.fill(left, gap)
                if exact:
                    parts += exact
                    break
                fits = np.flatnonzero(left[1:gap + 1] > 0)
                if not len(fits):
                    break
                best = int(fits[-1]) + 1
                # As many of them as fit while a smaller gap can't be filled exactly is found by
                # the next rounds; a single length left fills the gap at once.
                take = min(int(left[best]), gap // best) if len(fits) == 1 else 1
                parts += [best] * take
                left[best] -= take
                gap -= best * take
            kinds, per = np.unique(parts, return_counts=True)
            times = int((free[kinds] // per).min())
            offset = 0
            for kind, n in zip(kinds[::-1], per[::-1], strict=True):
                rows.append((kind, used_rank[kind], n, offset, sequence))
                used_rank[kind] += n * times
                offset += kind * n
            free[kinds] -= per * times
            sequence += times
    table = np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)
    return Plan(*table.T)


def _place(plan: Plan, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequence and offset of pieces by length and rank within it."""
    key = plan.length * (1 << 48) + plan.rank
    row = np.searchsorted(key, length * (1 << 48) + rank, side="right") - 1
    nth = rank - plan.rank[row]
    return (plan.sequence[row] + nth // plan.per[row],
            plan.offset[row] + nth % plan.per[row] * length)


def token_pieces(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Token pieces of each document: ids with ``end_id`` behind them, cut at ``capacity``."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for part in slices(batch, "text", TOKEN_SLICE_BYTES):
                ids, offsets = enc.encode(part["text"], end_id)
                n = np.diff(offsets)
                pieces = -(-n // capacity)
                row = np.repeat(np.arange(len(n)), pieces)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
                start = piece * capacity
                length = np.minimum(n[row] - start, capacity)
                at = offsets[row] + start
                crc = [zlib.crc32(ids[a:a + m]) for a, m in zip(at, length, strict=True)]
                yield pa.record_batch([
                    part["doc_id"].take(pa.array(row)), pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64())],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])

    ship(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(trimmed(cut), PIECES)


def pack(docs: DataFrame, vocabulary: str, end_id: int = 1, capacity: int = 4096,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sequence and offset of each piece of each document.

    Null and empty texts are one piece of the end id alone.  Every input row is packed, so repeated
    rows give repeated pieces; pieces of one length are ranked by id and piece (null ids first).
    Texts of any length are cut into pieces of ``capacity``.  An empty table gives no rows; other
    columns are not read.
    """
    pieces = written(token_pieces(docs, vocabulary, end_id, capacity, id_col, text_col), "pieces")
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for r in pieces.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[r["length"]] = r["count"]
    plan = plan_packing(counts, capacity)
    # A row for each pattern and length in it: bounded by the capacity, not by the input.
    shared = docs.sparkSession.sparkContext.broadcast(plan)
    ranked = running(pieces, ["length"], ["doc_id", "piece", "ids_crc32"], [], "piece-ranks")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = (b[c].to_numpy(zero_copy_only=False) for c in ("length", "row_before"))
            sequence, offset = _place(shared.value, length, rank)
            yield pa.record_batch(
                [b["doc_id"], b["piece"], b["start"], b["length"], b["ids_crc32"],
                 pa.array(sequence, pa.int64()), pa.array(offset, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
