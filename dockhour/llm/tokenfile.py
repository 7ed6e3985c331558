"""Token-id files: independent zstandard frames, a document directory and a trailing seek table.

Layout of a file, in the public seekable form of the zstandard format:
  frames     zstandard frames of FRAME_IDS ids each (little-endian unsigned 32 bits); a frame is
             readable without the others, and frames are cut without regard to documents
  directory  a skippable frame that holds one zstandard frame: the number of documents, then their
             ids, a null flag each and the number of ids each
  seek table a skippable frame with compressed size, size and checksum (low half of XXH64) of each
             frame, and at the very end the number of frames, a flag byte and a magic number
A reader takes the last bytes first and decompresses only frames that hold the ids asked for.
"""
from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch_path, ship, trimmed, written
from .tokens import TOKEN_SLICE_BYTES, encoder, slices

# Fixed values of the public seekable format.
SKIPPABLE_DIRECTORY = 0x184D2A50
SKIPPABLE_SEEK_TABLE = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

FRAME_IDS = 1 << 16
LEVEL = 1


class TokenFileWriter:
    def __init__(self, sink) -> None:
        self.sink, self.zstd = sink, zstandard.ZstdCompressor(level=LEVEL)
        self.frames: list[tuple[int, int, int]] = []
        self.waiting: list[np.ndarray] = []
        self.n_waiting = 0
        self.docs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def add(self, doc_id: np.ndarray, is_null: np.ndarray, ids: np.ndarray, n: np.ndarray) -> None:
        self.docs.append((doc_id, is_null, n))
        self.waiting.append(np.ascontiguousarray(ids, dtype="<u4"))
        self.n_waiting += len(ids)
        if self.n_waiting >= FRAME_IDS:
            ready = np.concatenate(self.waiting)
            whole = len(ready) // FRAME_IDS * FRAME_IDS
            for a in range(0, whole, FRAME_IDS):
                self._frame(ready[a:a + FRAME_IDS])
            self.waiting, self.n_waiting = [ready[whole:].copy()], len(ready) - whole

    def _frame(self, ids: np.ndarray) -> None:
        raw = ids.tobytes()
        packed = self.zstd.compress(raw)
        self.sink.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))

    def close(self) -> None:
        rest = np.concatenate(self.waiting) if self.waiting else np.empty(0, "<u4")
        if len(rest):
            self._frame(rest)
        parts = [np.concatenate(x) for x in zip(*self.docs, strict=True)] if self.docs else [[]] * 3
        body = struct.pack("<Q", len(parts[0])) + b"".join(
            np.asarray(x, dtype=t).tobytes() for x, t in zip(parts, ("<i8", "u1", "<u8"),
                                                             strict=True))
        packed = self.zstd.compress(body)
        self.sink.write(struct.pack("<II", SKIPPABLE_DIRECTORY, len(packed)) + packed)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        foot = struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        # The directory's own length goes in front of the entries' frame for readers from the end.
        self.sink.write(struct.pack("<II", SKIPPABLE_SEEK_TABLE, len(table) + len(foot))
                        + table + foot)


class TokenFileReader:
    """Reads documents by number; ``source`` is a seekable file."""

    def __init__(self, source, size: int) -> None:
        self.source = source
        n, flag, magic = struct.unpack("<IBI", self._read(size - 9, 9))
        if magic != SEEKABLE_MAGIC or not flag & CHECKSUM_FLAG:
            raise ValueError("not a token file with a checksummed seek table")
        table = self._read(size - 9 - 12 * n, 12 * n)
        entries = np.frombuffer(table, dtype="<u4").reshape(-1, 3).astype(np.int64)
        self.packed, self.sizes, self.sums = entries.T if n else (np.empty(0, np.int64),) * 3
        self.at = np.concatenate(([0], np.cumsum(self.packed)))
        self.first = np.concatenate(([0], np.cumsum(self.sizes))) // 4
        magic, length = struct.unpack("<II", self._read(int(self.at[-1]), 8))
        if magic != SKIPPABLE_DIRECTORY:
            raise ValueError("the directory is missing")
        body = zstandard.ZstdDecompressor().decompress(self._read(int(self.at[-1]) + 8, length))
        docs = struct.unpack_from("<Q", body)[0]
        self.doc_id = np.frombuffer(body, "<i8", docs, 8)
        self.is_null = np.frombuffer(body, "u1", docs, 8 + 8 * docs).astype(bool)
        self.n = np.frombuffer(body, "<u8", docs, 8 + 9 * docs).astype(np.int64)
        self.start = np.cumsum(self.n) - self.n
        self._last: tuple[int, np.ndarray] | None = None

    def _read(self, at: int, n: int) -> bytes:
        self.source.seek(at)
        return self.source.read(n)

    def frame(self, i: int) -> np.ndarray:
        if self._last is None or self._last[0] != i:
            raw = zstandard.ZstdDecompressor().decompress(
                self._read(int(self.at[i]), int(self.packed[i])))
            if xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != self.sums[i]:
                raise ValueError(f"frame {i} does not match its checksum")
            self._last = (i, np.frombuffer(raw, dtype="<u4"))
        return self._last[1]

    def pieces(self, doc: int) -> Iterator[np.ndarray]:
        """The ids of a document, frame by frame."""
        at, end = int(self.start[doc]), int(self.start[doc] + self.n[doc])
        i = int(np.searchsorted(self.first, at, side="right")) - 1
        while at < end:
            base = int(self.first[i])
            part = self.frame(i)[at - base:end - base]
            yield part
            at, i = at + len(part), i + 1

    def ids(self, doc: int) -> np.ndarray:
        return np.concatenate([np.empty(0, "<u4"), *self.pieces(doc)])


def _open(uri: str) -> tuple[pafs.FileSystem, str]:
    return (pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:")
            else (pafs.LocalFileSystem(), uri))


def write_token_files(docs: DataFrame, folder: str, vocabulary: str, end_id: int = 2,
                      n_files: int | None = None, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """Write the ids of all documents in ascending id order; the manifest, one row per file.

    Ids are dealt to files at quantiles, so each file holds a run of ids and file names sort like
    them.  Null ids come first, null texts are empty; repeated ids stay next to each other, ordered
    by text.  A file is written under a name of the attempt and renamed when complete, so repeated
    attempts of a task leave one whole file.  Manifest: file, path, n_docs, n_tokens.  An empty
    table gives no files and an empty manifest.
    """
    spark = docs.sparkSession
    ship(spark)
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    n_files = n_files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = d.agg(F.percentile_approx("doc_id", [i / n_files for i in range(1, n_files)],
                                     100 * n_files)).first()[0] or []
    edges = F.array(*[F.lit(c) for c in sorted(set(cuts))]).cast("array<bigint>")
    file = F.coalesce(F.size(F.filter(edges, lambda e: e < F.col("doc_id"))), F.lit(0))
    dealt = (d.withColumn("file", file).repartitionById(n_files, "file")
             .sortWithinPartitions("file", "doc_id", "text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        fs, base = _open(folder)
        fs.create_dir(base, recursive=True)
        rows, writer, sink, now = [], None, None, None
        docs_in = tokens_in = 0

        def finish():
            writer.close()
            sink.close()
            name = f"{base}/ids-{now:06d}.zst"
            fs.move(part_name, name)
            rows.append((now, f"ids-{now:06d}.zst", docs_in, tokens_in))

        for batch in batches:
            files = batch["file"].to_numpy(zero_copy_only=False)
            for f in np.unique(files):
                at = np.flatnonzero(files == f)
                if now != f:
                    if writer:
                        finish()
                    now, docs_in, tokens_in = int(f), 0, 0
                    part_name = f"{base}/.part-{now:06d}-{uuid.uuid4().hex}"
                    sink = fs.open_output_stream(part_name)
                    writer = TokenFileWriter(sink)
                for part in slices(batch.slice(int(at[0]), len(at)), "text",
                                   TOKEN_SLICE_BYTES):
                    ids, offsets = enc.encode(part["text"], end_id)
                    writer.add(part["doc_id"].fill_null(0).to_numpy(zero_copy_only=False),
                               part["doc_id"].is_null().to_numpy(zero_copy_only=False),
                               ids, np.diff(offsets))
                    docs_in += part.num_rows
                    tokens_in += len(ids)
        if writer:
            finish()
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in rows], t) for i, t in enumerate(
                (pa.int32(), pa.string(), pa.int64(), pa.int64()))],
            names=["file", "path", "n_docs", "n_tokens"])

    return written(dealt.mapInArrow(trimmed(write), "file int, path string, n_docs long, n_tokens long"),
                   "token-manifest")


def read_token_files(manifest: DataFrame, folder: str) -> DataFrame:
    """Read every document back: doc_id, start, n_tokens, ids_crc32 (frames are checked).

    ``start`` is the number of ids of all documents before it in the files' order.
    """
    ship(manifest.sparkSession)
    ahead = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    files = manifest.select("path", F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0))
                            .alias("file_start"), F.row_number().over(Window.orderBy("file"))
                            .alias("nth"))
    n = max(1, manifest.count())

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _open(folder)
        for batch in batches:
            for path, before in zip(batch["path"].to_pylist(), batch["file_start"].to_pylist(),
                                    strict=True):
                name = f"{base}/{path}"
                with fs.open_input_file(name) as source:
                    reader = TokenFileReader(source, fs.get_file_info(name).size)
                    for a in range(0, len(reader.n), 10_000):
                        some = range(a, min(a + 10_000, len(reader.n)))
                        crc = []
                        for i in some:
                            c = 0
                            for p in reader.pieces(i):
                                c = zlib.crc32(p, c)
                            crc.append(c)
                        at = slice(some.start, some.stop)
                        yield pa.record_batch([
                            pa.array(reader.doc_id[at], pa.int64(), mask=reader.is_null[at]),
                            pa.array(before + reader.start[at], pa.int64()),
                            pa.array(reader.n[at], pa.int64()), pa.array(crc, pa.int64())],
                            names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return (files.repartitionById(n, (F.col("nth") - 1).cast("int"))
            .mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files(docs: DataFrame, vocabulary: str, end_id: int = 2, folder: str | None = None,
                **columns: str) -> DataFrame:
    """Write the files below ``folder`` (default: the shared scratch) and read them back."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")
    return read_token_files(write_token_files(docs, folder, vocabulary, end_id, **columns), folder)
