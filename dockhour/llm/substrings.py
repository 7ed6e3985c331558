"""Removal of repeated word windows: count-min sketches first, exact groups second.

1. Each partition sketches its windows: counts by cell in a few rows of fixed width.  The sketches
   are added up slice by slice; a window whose cells all reach two may be repeated, any other occurs
   once.  Estimates are never too low, so no repeated window is lost.
2. Windows estimated repeated are grouped exactly by a 96-bit fingerprint.  A task sends a window
   once however often it has it; holders of windows that it has twice are known at once.
3. Found starts and whole texts meet by document, and the covered words go.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bitmaps import SLICE_BITS, cells_of, gather, test
from .common import ship, written
from .shingles import mix, word_prints
from .tokens import slices

FLUSH_WINDOWS = 4_000_000
_BASES = (0x9E3779B97F4A7C15 | 3, 0xC2B2AE3D27D4EB4F | 3)
_powers: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}
ENTRY = np.dtype([("h1", "<u8"), ("h2", "<u4"), ("key", "<i8"), ("at", "<u4"), ("twice", "u1")])
START = np.dtype([("key", "<i8"), ("at", "<u4")])


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, for at least n places."""
    size = 1 << max(16, (n + 1).bit_length())
    if (base, size) not in _powers:
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.ones(size, dtype=np.uint64)
            p[1:] = np.uint64(b)
            out.append(np.cumprod(p, dtype=np.uint64))
        _powers[base, size] = (out[0], out[1])
    return _powers[base, size]


def _rolling(prints: np.ndarray, k: int, base: int) -> np.ndarray:
    """Polynomial fingerprints of all runs of k words, from prefix sums modulo 2**64."""
    n = len(prints)
    up, down = _power(base, n)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(prints * up[:n], dtype=np.uint64, out=total[1:])
    return mix((total[k:] - total[:-k]) * down[:n - k + 1])


def windows(part: pa.RecordBatch, k: int) -> np.ndarray:
    """One entry for each window of ``k`` words inside a document of a slice."""
    words = word_prints(part["text"])
    n = np.maximum(np.diff(words.offsets) - k + 1, 0)
    if not n.sum():
        return np.empty(0, dtype=ENTRY)
    at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    start = np.repeat(words.offsets[:-1], n) + at
    out = np.empty(len(start), dtype=ENTRY)
    out["h1"] = _rolling(words.prints, k, _BASES[0])[start]
    out["h2"] = _rolling(words.prints, k, _BASES[1])[start] >> np.uint64(32)
    out["key"] = np.repeat(part["key"].to_numpy(zero_copy_only=False), n)
    out["at"], out["twice"] = at, 0
    return out


def _pack(cells: np.ndarray) -> bytes:
    """Sorted cells as differences, byte planes apart, compressed."""
    gaps = np.diff(cells.astype("<u4"), prepend=np.uint32(0))
    return zstandard.ZstdCompressor(level=1).compress(
        np.ascontiguousarray(gaps.view(np.uint8).reshape(-1, 4).T).tobytes())


def _unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u4").ravel(), dtype=np.uint32)


def _sketch(h1: np.ndarray, rows: int, log2_cells: int) -> Iterator[pa.RecordBatch]:
    """The counts of one partition, by slice of the sketch: cells met once and more often."""
    for row in range(rows):
        cells = np.sort(cells_of(h1, log2_cells, row))
        first = np.flatnonzero(np.concatenate(([True], cells[1:] != cells[:-1])))
        more = np.diff(np.append(first, len(cells))) > 1
        cells = cells[first]
        slot = (cells >> np.uint64(SLICE_BITS)).astype(np.int64)
        names, at = np.unique(slot, return_index=True)
        low = cells & np.uint64((1 << SLICE_BITS) - 1)
        once, many = [], []
        for a, e in zip(at, np.append(at, len(cells))[1:], strict=True):
            once.append(_pack(low[a:e][~more[a:e]]))
            many.append(_pack(low[a:e][more[a:e]]))
        per_row = 1 << (log2_cells - SLICE_BITS)
        yield pa.record_batch([pa.array((names + row * per_row).astype(np.int32)),
                               pa.array(once, pa.binary()), pa.array(many, pa.binary())],
                              names=["part", "once", "many"])


def _add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up the sketches of all partitions: bit set where a cell's count is two or more."""
    held: dict[int, np.ndarray] = {}
    for b in batches:
        for part, once, many in zip(b["part"].to_pylist(), b["once"], b["many"], strict=True):
            count = held.setdefault(part, np.zeros(1 << SLICE_BITS, dtype=np.uint8))
            cells = _unpack(once.as_buffer())
            count[cells] = np.minimum(count[cells] + 1, 2)
            count[_unpack(many.as_buffer())] = 2
    yield pa.record_batch([pa.array(list(held), pa.int32()), pa.array(
        [np.packbits(x > 1, bitorder="little").tobytes() for x in held.values()], pa.binary())],
        names=["part", "blob"])


def _by_bucket(bucket: np.ndarray, entries: np.ndarray, kind: int) -> pa.RecordBatch:
    order = np.argsort(bucket, kind="stable")
    bucket, entries = bucket[order], entries[order]
    names, at = np.unique(bucket, return_index=True)
    ends = np.append(at, len(bucket))[1:]
    blobs = [entries[a:e].tobytes() for a, e in zip(at, ends, strict=True)]
    return pa.record_batch([pa.array(names, pa.int32()),
                            pa.array(np.full(len(names), kind, np.int32)),
                            pa.array(blobs, pa.binary())], names=["bucket", "kind", "blob"])


def _runs(e: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Entries in order of window, where each window starts, and how many entries it has."""
    e = e[np.lexsort((e["h2"], e["h1"]))]
    new = np.ones(len(e), dtype=bool)
    new[1:] = (e["h1"][1:] != e["h1"][:-1]) | (e["h2"][1:] != e["h2"][:-1])
    first = np.flatnonzero(new)
    return e, first, np.diff(np.append(first, len(e)))


def _starts(e: np.ndarray) -> np.ndarray:
    out = np.empty(len(e), dtype=START)
    out["key"], out["at"] = e["key"], e["at"]
    return out


def remove_repeated_windows(docs: DataFrame, k: int = 35, id_col: str = "doc_id",
                            text_col: str = "text", sketch_rows: int = 2, log2_cells: int = 28,
                            with_text: bool = False) -> DataFrame:
    """Per document: words, words removed and the digest of the words that stay.

    A word goes if some window of ``k`` words over it starts anywhere else too, in the same
    document or another.  ``sketch_rows`` * 2**``log2_cells`` bits are broadcast, whatever the
    input; a small sketch only sends more windows to the exact step.

    Null and blank texts and texts of fewer than ``k`` words lose nothing.  Repeated rows count as
    different places, so a text of at least ``k`` words that occurs twice goes whole.  Every input
    row gives one row; an empty table gives none; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"),
                    F.xxhash64(id_col, text_col).alias("key"))

    def flushes(batches: Iterator[pa.RecordBatch], sieve=None) -> Iterator[np.ndarray]:
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                e = windows(part, k)
                held.append(e if sieve is None else e[sieve(e["h1"])])
                n += len(e)
                if n >= FLUSH_WINDOWS:
                    yield np.concatenate(held)
                    held, n = [], 0
        if n:
            yield np.concatenate(held)

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                held.append(windows(part, k)["h1"].copy())
                n += len(held[-1])
                if n >= FLUSH_WINDOWS:
                    yield from _sketch(np.concatenate(held), sketch_rows, log2_cells)
                    held, n = [], 0
        if n:
            yield from _sketch(np.concatenate(held), sketch_rows, log2_cells)

    counted = (d.mapInArrow(sketch, "part int, once binary, many binary")
               .repartitionById(buckets, F.col("part"))
               .mapInArrow(_add, "part int, blob binary"))
    bits = gather(counted, log2_cells + (sketch_rows - 1).bit_length())
    repeated = spark.sparkContext.broadcast(bits)  # sketch_rows * 2**log2_cells bits

    def estimated(h1: np.ndarray) -> np.ndarray:
        ok = np.ones(len(h1), dtype=bool)
        for row in range(sketch_rows):
            at = np.flatnonzero(ok)
            cells = cells_of(h1[at], log2_cells, row) + np.uint64(row << log2_cells)
            ok[at] = test(repeated.value, cells)
        return ok

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for found in flushes(batches, estimated):
            e, first, size = _runs(found)
            own = np.repeat(size > 1, size)
            if own.any():
                s = _starts(e[own])
                yield _by_bucket(s["key"] % buckets, s, 0)
            send = e[first]
            send["twice"] = size > 1
            yield _by_bucket(((send["h1"] >> np.uint64(32)) * np.uint64(buckets)
                              >> np.uint64(32)).astype(np.int64), send, 1)

    def group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            passed = b.filter(pa.compute.equal(b["kind"], 0))
            if passed.num_rows:
                yield passed
            held += [np.frombuffer(x.as_buffer(), ENTRY) for x in
                     b.filter(pa.compute.equal(b["kind"], 1))["blob"]]
        if held:
            e, first, size = _runs(np.concatenate(held))
            hit = e[np.repeat(size > 1, size) & (e["twice"] == 0)]
            s = _starts(hit)
            yield _by_bucket(s["key"] % buckets, s, 0)

    starts = written(d.mapInArrow(candidates, "bucket int, kind int, blob binary")
                     .repartitionById(buckets, "bucket")
                     .mapInArrow(group, "bucket int, kind int, blob binary"), "window-starts")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, at = [], None, None
        for batch in batches:
            is_doc = batch["kind"].to_numpy(zero_copy_only=False) == 1
            held += [np.frombuffer(x.as_buffer(), START) for x in
                     batch.filter(pa.array(~is_doc))["blob"]]
            rows = batch.filter(pa.array(is_doc))
            if not rows.num_rows:
                continue
            if key is None:
                s = np.concatenate(held) if held else np.empty(0, START)
                s = s[np.argsort(s["key"], kind="stable")]
                key, at = np.ascontiguousarray(s["key"]), s["at"].astype(np.int64)
            out = [_kept(text, at[a:e], k) for text, a, e in zip(
                rows["text"], *(np.searchsorted(key, rows["key"].to_numpy(zero_copy_only=False),
                                                side=side) for side in ("left", "right")),
                strict=True)]
            yield pa.record_batch([
                rows["doc_id"], pa.array([o[0] for o in out], pa.int64()),
                pa.array([o[1] for o in out], pa.int64()),
                pa.array([hashlib.sha256(o[2]).hexdigest() for o in out]),
                *([pa.array([o[2].decode() for o in out])] if with_text else [])],
                names=["doc_id", "n_words", "n_removed", "kept_sha256",
                       *(["kept_text"] if with_text else [])])

    both = d.select(F.pmod("key", F.lit(buckets)).cast("int").alias("bucket"),
                    F.lit(1).alias("kind"), "doc_id", "text", "key",
                    F.lit(None).cast("binary").alias("blob")).unionByName(
        starts.select("bucket", "kind", F.lit(None).cast("long").alias("doc_id"),
                      F.lit(None).cast("string").alias("text"),
                      F.lit(None).cast("long").alias("key"), "blob"))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (
        ", kept_text string" if with_text else "")
    return (both.repartitionById(buckets, "bucket").sortWithinPartitions("kind")
            .mapInArrow(cut, schema))


def _kept(text: pa.StringScalar, starts: np.ndarray, k: int) -> tuple[int, int, bytes]:
    """Number of words, number of words removed, and the words that stay."""
    found = text.as_buffer().to_pybytes().split() if text.is_valid else []
    if not len(starts):
        return len(found), 0, b" ".join(found)
    edge = np.zeros(len(found) + 1, dtype=np.int64)
    starts = np.unique(starts)
    edge[starts] += 1
    edge[starts + k] -= 1
    gone = np.cumsum(edge[:-1]) > 0
    stay = [found[i] for i in np.flatnonzero(~gone)]
    return len(found), int(gone.sum()), b" ".join(stay)
