"""Exact Jaccard join of shingle sets on PartEnum signatures, with connected components.

1. Every set sends its signatures, packed by partition, to the partition of the signature; equal
   sets of one task send them once.
2. A signature's holders are paired: all pairs in small groups.  A large group is a crowd around one
   of its holders; each holder is paired with the STARS centres that it meets most often.  Pairs that
   a lower bound on their difference rules out are dropped, the rest is compared set by set.
3. Large groups with the same centre are taken together.  Where their holders do not all carry one
   label of a connected part yet, holders with different labels are compared too, again with the
   lower bound first: in blocks, and each pair only under the smallest centre that both have.  This
   runs twice: the nearest pair of each holder gives new labels, then all pairs that are still apart
   are taken, so a crowd with many links does not have all of them compared set by set.

Only documents of pairs that pass the lower bound have their sets written and shuffled.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bitmaps import cells_of, members, test
from .common import ship, trimmed, written
from .components import components, shared_labels
from .partenum import Bands, signatures
from .shingles import Sets, mix, shingle_sets, word_prints
from .tokens import release, slices

ALL_PAIRS_UP_TO = 4
STARS, LABEL_ROUNDS = 4, 4
BLOCK = 1024
COLUMNS, ROWS, CELLS = 512, 64, 1 << 19
LEAST_CELLS, PER_CELL = 128, 4
FLUSH = 500_000
FOUND = "kind int, a long, b long, doc_id long, n long, f1 long, f2 long, profile binary"
PACKED = "bucket int, signature binary, node binary, rows binary"


def _sums(sets: Sets) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit fingerprints of each set."""
    out = []
    for values in (sets.shingles, sets.shingles * np.uint64(3) + np.uint64(99)):
        total = np.zeros(len(values) + 1, dtype=np.uint64)
        np.cumsum(mix(values), dtype=np.uint64, out=total[1:])
        out.append(mix(total[sets.offsets[1:]] - total[sets.offsets[:-1]]).view(np.int64))
    return out[0], out[1]


def _profiles(sets: Sets) -> list[bytes]:
    """Element counts by hash cell, at most 255 a cell.

    Each element in which two sets differ changes one cell by one, so the distance of two profiles
    is never above the number of such elements.  The number of cells is a power of two near
    size / PER_CELL; a profile is folded to fewer cells by adding neighbours.
    """
    size = np.diff(sets.offsets)
    least = LEAST_CELLS.bit_length() - 1
    bits = np.maximum(np.ceil(np.log2(np.maximum(size, 1) / PER_CELL)), least).astype(np.int64)
    cells = 1 << bits
    base = np.cumsum(cells) - cells
    spread = mix(sets.shingles ^ np.uint64(0x77))
    cell = (spread >> np.repeat(64 - bits, size).astype(np.uint64)).astype(np.int64)
    counts = np.bincount(np.repeat(base, size) + cell, minlength=int(cells.sum()))
    flat = np.minimum(counts, 255).astype(np.uint8).tobytes()
    return [flat[a:a + m] for a, m in zip(base.tolist(), cells.tolist(), strict=True)]


def _fold(profile: np.ndarray, cells: int) -> np.ndarray:
    return profile.reshape(cells, -1).sum(axis=1, dtype=np.int32)


def _distances(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Lower bounds of the differences of pairs of sets, from their profiles."""
    out = np.empty(len(left), dtype=np.int64)
    small = np.array([len(x) == len(y) == LEAST_CELLS for x, y in zip(left, right, strict=True)],
                     dtype=bool)
    at = np.flatnonzero(small)
    if len(at):
        x, y = (np.stack([side[i] for i in at]).astype(np.int16) for side in (left, right))
        out[at] = np.abs(x - y).sum(axis=1)
    for i in np.flatnonzero(~small):
        cells = min(len(left[i]), len(right[i]))
        out[i] = np.abs(_fold(left[i], cells) - _fold(right[i], cells)).sum()
    return out


def _may_differ(na: np.ndarray, nb: np.ndarray, percent: int) -> np.ndarray:
    return (na + nb) * (100 - percent) // (100 + percent)


class _Packer:
    """Gathers signatures with their holders and hands them out by partition."""

    def __init__(self, buckets: int) -> None:
        self.buckets, self.parts, self.n = buckets, [], 0

    def add(self, sig: np.ndarray, node: np.ndarray) -> None:
        self.parts.append((sig, node))
        self.n += len(sig)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if not self.n:
            return
        sig, node = (np.concatenate([p[i] for p in self.parts]) for i in (0, 1))
        self.parts, self.n = [], 0
        bucket = ((sig >> np.uint64(32)) * np.uint64(self.buckets) >> np.uint64(32)).astype(int)
        order = np.argsort(bucket, kind="stable")
        sig, node, bucket = sig[order], node[order], bucket[order]
        names, at = np.unique(bucket, return_index=True)
        pick = [slice(a, e) for a, e in zip(at, np.append(at, len(bucket))[1:], strict=True)]
        yield pa.record_batch([
            pa.array(names, pa.int32()), pa.array([sig[s].tobytes() for s in pick], pa.binary()),
            pa.array([node[s].tobytes() for s in pick], pa.binary()),
            pa.array([b"" for _ in pick], pa.binary())],
            names=["bucket", "signature", "node", "rows"])


def _groups(sig: np.ndarray, node: np.ndarray):
    """Distinct (signature, node) in order, and the extent of the groups with several holders."""
    order = np.lexsort((node, sig))
    sig, node = sig[order], node[order]
    fresh = np.ones(len(sig), dtype=bool)
    fresh[1:] = (sig[1:] != sig[:-1]) | (node[1:] != node[:-1])
    sig, node, order = sig[fresh], node[fresh], order[fresh]
    first = np.flatnonzero(np.concatenate(([True], sig[1:] != sig[:-1])))
    size = np.diff(np.append(first, len(sig)))
    some = size > 1
    return sig, node, order, first[some], size[some]


def _unique_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lo, hi = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((hi, lo))
    lo, hi = lo[order], hi[order]
    fresh = np.ones(len(lo), dtype=bool)
    fresh[1:] = (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])
    return lo[fresh], hi[fresh]


def _counted_pairs(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), dtype=bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    first = np.flatnonzero(fresh)
    return a[first], b[first], np.diff(np.append(first, len(a)))


def _found(kind: int, a: np.ndarray, b: np.ndarray, n: np.ndarray | None = None) -> pa.RecordBatch:
    none = pa.nulls(len(a), pa.int64())
    return pa.record_batch([pa.array(np.full(len(a), kind, np.int32)), pa.array(a, pa.int64()),
                            pa.array(b, pa.int64()), none,
                            none if n is None else pa.array(n, pa.int64()), none, none,
                            pa.nulls(len(a), pa.binary())],
                           names=["kind", "a", "b", "doc_id", "n", "f1", "f2", "profile"])


def _first_round(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs of small groups (kind 1), and holders of large groups with their centre and how often
    they meet it (kind 2), of a partition; document rows pass."""
    held = []
    for b in batches:
        for bucket, sig, node, rows in zip(b["bucket"].to_pylist(), b["signature"], b["node"],
                                           b["rows"], strict=True):
            if bucket >= 0:
                held.append((np.frombuffer(sig.as_buffer(), "<u8"),
                             np.frombuffer(node.as_buffer(), "<i8")))
            else:
                with pa.ipc.open_stream(rows.as_buffer()) as reader:
                    yield from reader
    if not held:
        return
    sig, node, _, first, size = _groups(*(np.concatenate(x) for x in zip(*held, strict=True)))
    left, right, large = [], [], []
    for s in np.unique(size[size <= ALL_PAIRS_UP_TO]):
        at = first[size == s][:, None] + np.arange(s)
        i, j = np.triu_indices(s, 1)
        left.append(node[at[:, i]].ravel())
        right.append(node[at[:, j]].ravel())
    for f, s in zip(first[size > ALL_PAIRS_UP_TO], size[size > ALL_PAIRS_UP_TO], strict=True):
        holders = node[f:f + s]
        center = holders[np.argmin(mix(holders.view(np.uint64)))]
        large.append(np.stack([holders, np.full(s, center)]))
    if left:
        yield _found(1, *_unique_pairs(np.concatenate(left), np.concatenate(right)))
    if large:
        yield _found(2, *_counted_pairs(*np.concatenate(large, axis=1)))


def _owned(centers: pa.ListArray, center: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Which pairs of the rows ``left`` and ``right`` have no centre below ``center`` in common."""
    own = np.ones((len(left), len(right)), dtype=bool)
    flat = centers.flatten().to_numpy(zero_copy_only=False)
    row = np.repeat(np.arange(len(centers)), centers.value_lengths().to_numpy(zero_copy_only=False))
    below = flat < center
    names, column, count = np.unique(flat[below], return_inverse=True, return_counts=True)
    shared = np.flatnonzero(count > 1)
    place = np.full(len(names), -1)
    place[shared] = np.arange(len(shared))
    row, column = row[below], place[column]
    for start in range(0, len(shared), COLUMNS):
        some = (column >= start) & (column < start + COLUMNS)
        held = np.zeros((len(centers), COLUMNS), dtype=np.float32)
        held[row[some], column[some] - start] = 1
        own &= (held[left] @ held[right].T) == 0
    return own


def _bounds(folded: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Distances of the profiles ``i`` and ``j``, some pairs at a time whatever their length."""
    far = np.empty(len(i), dtype=np.int32)
    step = max(1, CELLS // folded.shape[1])
    for at in range(0, len(i), step):
        apart = folded[i[at:at + step]]
        apart -= folded[j[at:at + step]]
        np.abs(apart, out=apart).sum(axis=1, dtype=np.int32, out=far[at:at + step])
    return far


def _nearest(i: np.ndarray, far: np.ndarray) -> np.ndarray:
    """The place of the least ``far`` of each ``i``."""
    order = np.lexsort((far, i))
    return order[np.flatnonzero(np.concatenate(([True], i[order][1:] != i[order][:-1])))]


def _crossing(group: pa.Table, percent: int, probe: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of one block pair with different labels that the lower bound lets through; with
    ``probe`` the nearest of them for each row."""
    block, node, root, n = (group[c].to_numpy() for c in ("block", "node", "root", "n"))
    center, low, high = (group[c][0].as_py() for c in ("center", "low", "high"))
    left, right = np.flatnonzero(block == low), np.flatnonzero(block == high)
    ok = root[left, None] != root[None, right]
    if low == high:
        ok &= left[:, None] < right[None, :]
    for at in range(0, len(left), ROWS):
        x, y = n[left[at:at + ROWS], None], n[None, right]
        ok[at:at + ROWS] &= np.abs(x - y) <= _may_differ(x, y, percent)
    if ok.any():
        ok &= _owned(group["centers"].combine_chunks(), center, left, right)
    i, j = np.nonzero(ok)
    i, j = left[i], right[j]
    if not len(i):
        return i, j
    profile = [np.frombuffer(p.as_buffer(), np.uint8) for p in group["profile"]]
    cells = min(len(p) for p in profile)
    far = _bounds(np.stack([_fold(p, cells) for p in profile]), i, j)
    near = far <= _may_differ(n[i], n[j], percent)
    i, j, far = i[near], j[near], far[near]
    if probe and len(i):
        part = far / (n[i] + n[j])
        some = np.union1d(_nearest(i, part), _nearest(j, part))
        i, j = i[some], j[some]
    return node[i], node[j]


def _second_round(percent: int, probe: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``_crossing`` of each block pair; rows come sorted by it, one is held at a time."""
        def groups() -> Iterator[pa.Table]:
            rest = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                table = pa.Table.from_batches([batch])
                table = table if rest is None else pa.concat_tables([rest, table])
                center, low, high = (table[c].to_numpy() for c in ("center", "low", "high"))
                new = (center[1:] != center[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
                first = np.concatenate(([0], np.flatnonzero(new) + 1))
                for f, e in zip(first[:-1], first[1:], strict=True):
                    yield table.slice(f, e - f)
                rest = table.slice(first[-1])
            if rest is not None:
                yield rest

        for group in groups():
            a, b = _crossing(group, percent, probe)
            if len(a):
                a, b = _unique_pairs(a, b)
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    return run


def _similar(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x, y in zip(b["set_a"], b["set_b"], strict=True):
                x, y = (np.frombuffer(s.as_buffer(), "<u8") for s in (x, y))
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch([b["a"], b["b"]], names=["a", "b"]).filter(
                pa.array(keep, pa.bool_()))

    return run


def _bounded(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            left, right = ([np.frombuffer(p.as_buffer(), np.uint8) for p in b[c]]
                           for c in ("profile_a", "profile_b"))
            na, nb = (b[c].to_numpy(zero_copy_only=False) for c in ("n_a", "n_b"))
            ok = _distances(left, right) <= _may_differ(na, nb, percent)
            yield pa.record_batch([b["a"], b["b"]], names=["a", "b"]).filter(pa.array(ok))

    return run


def _nodes_of(part: pa.RecordBatch, f1: np.ndarray) -> np.ndarray:
    null = part["doc_id"].is_null().to_numpy(zero_copy_only=False)
    return np.where(null, f1, part["doc_id"].fill_null(0).to_numpy(zero_copy_only=False))


def _sets_of(d: DataFrame, pairs: DataFrame, k: int, log2_filter: int, label: str) -> DataFrame:
    """Sets of the documents that occur in ``pairs``, and of a few that the filter lets through."""
    wanted = pairs.select(F.col("a").alias("value")).unionByName(
        pairs.select(F.col("b").alias("value")))
    near = d.sparkSession.sparkContext.broadcast(members(wanted, log2_filter))  # fixed size

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            null = batch["doc_id"].is_null().to_numpy(zero_copy_only=False)
            ids = batch["doc_id"].fill_null(0).to_numpy(zero_copy_only=False)
            some = null | test(near.value, cells_of(ids.view(np.uint64), log2_filter))
            for part in slices(batch.filter(pa.array(some)), "text"):
                sets = shingle_sets(word_prints(part["text"], lower=True), k)
                blobs = [sets.shingles[a:b].tobytes() for a, b in zip(
                    sets.offsets[:-1], sets.offsets[1:], strict=True)]
                yield pa.record_batch([pa.array(_nodes_of(part, _sums(sets)[0])),
                                       pa.array(blobs, pa.binary())], names=["node", "shingles"])

    return written(d.mapInArrow(trimmed(gather), "node long, shingles binary"), f"{label}-sets")


def _links(d: DataFrame, close: DataFrame, k: int, percent: int, log2_filter: int,
           label: str) -> DataFrame:
    """The pairs (a, b) that reach the threshold, compared set by set."""
    sets = _sets_of(d, close, k, log2_filter, label)
    full = {s: sets.select(F.col("node").alias(s), F.col("shingles").alias(f"set_{s}"))
            for s in "ab"}
    return written(close.join(full["a"], "a").join(full["b"], "b")
                   .mapInArrow(trimmed(_similar(percent)), "a long, b long"), f"{label}-links")


def jaccard_components(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id",
                       text_col: str = "text", log2_filter: int = 26,
                       with_root: bool = False) -> DataFrame:
    """Per document: ``doc_id``, ``n_shingles`` and ``component_id``, the smallest linked id.

    ``with_root`` adds ``node``, what a row is linked under (see ``set_nodes``), and ``root``, the
    smallest node of its component; neither is ever null.

    A-Z is lowered; a document's set is its distinct shingles of ``k`` words, or its whole word
    sequence if it has fewer.  Two documents link when their Jaccard similarity is at least
    ``percent`` / 100; components are the connected parts of all links.

    Null and blank texts have empty sets, link with nothing and are their own component.  Each row
    gives one row.  Rows with one id are one document for the links.  Documents without an id take
    part in links under a fingerprint; a component of such documents alone has a null id.  An empty
    table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    ship(spark)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    bands = Bands(percent)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        packer, seen, turn = _Packer(buckets), set(), 0
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(word_prints(part["text"], lower=True), k)
                f1, f2 = _sums(sets)
                n, node = np.diff(sets.offsets), _nodes_of(part, f1)
                rows = pa.record_batch([
                    pa.array(np.zeros(len(n), np.int32)), pa.array(node), pa.array(node),
                    part["doc_id"], pa.array(n), pa.array(f1), pa.array(f2),
                    pa.array(_profiles(sets), pa.binary())],
                    names=["kind", "a", "b", "doc_id", "n", "f1", "f2", "profile"])
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, rows.schema) as out:
                    out.write_batch(rows)
                turn += 1
                yield pa.record_batch([
                    pa.array([-turn], pa.int32()), pa.array([b""]), pa.array([b""]),
                    pa.array([sink.getvalue().to_pybytes()], pa.binary())],
                    names=["bucket", "signature", "node", "rows"])
                fresh = []
                for i, key in enumerate(zip(f1.tolist(), f2.tolist(), strict=True)):
                    fresh.append(n[i] > 0 and key not in seen)
                    seen.add(key)
                signed = signatures(_only(sets, np.array(fresh, dtype=bool)), bands)
                packer.add(signed.signature, node[np.flatnonzero(fresh)][signed.owner])
                if packer.n >= FLUSH:
                    yield from packer.flush()
        yield from packer.flush()

    to = F.when(F.col("bucket") >= 0, F.col("bucket")).otherwise(F.pmod(F.xxhash64("rows"), F.lit(buckets)).cast("int"))
    found = written(d.mapInArrow(trimmed(sign), PACKED).repartitionById(buckets, to)
                    .mapInArrow(trimmed(_first_round), FOUND), "partenum")
    rows = found.filter("kind = 0").select("doc_id", F.col("a").alias("node"), "n", "f1", "f2")
    classes = written(rows.filter("n > 0").groupBy("f1", "f2", "n").agg(
        F.min("node").alias("rep")), "set-classes")
    reps = written(rows.filter("n > 0").select("node", "f1", "f2", "n")
                   .join(classes, ["f1", "f2", "n"]).select("node", "rep").distinct(), "set-reps")

    def by_rep(pairs: DataFrame) -> DataFrame:
        a = reps.select(F.col("node").alias("a"), F.col("rep").alias("ra"))
        b = reps.select(F.col("node").alias("b"), F.col("rep").alias("rb"))
        return pairs.join(a, "a").join(b, "b").select(
            F.col("ra").alias("a"), F.col("rb").alias("b"), *pairs.columns[2:])

    # By "a" alone: the counts and the first join of by_rep take one shuffle, for both kinds at once.
    met = written(by_rep(found.filter("kind > 0").repartition("a").groupBy("a", "b", "kind").agg(
        F.sum("n").alias("met"))), "met")
    held = written(met.filter("kind = 2").groupBy(F.col("a").alias("node"), F.col("b").alias("center"))
                   .agg(F.sum("met").alias("met")), "holders")
    rank = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("met"), "center"))
    stars = held.filter("node <> center").withColumn("rank", rank).filter(F.col("rank") <= STARS)
    small = met.filter("kind = 1 AND a <> b").select("a", "b")
    pairs = written(small.unionByName(stars.select(F.col("node").alias("a"), F.col("center").alias("b")))
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
                    "pairs")
    light = written(found.filter("kind = 0 AND n > 0").select(F.col("a").alias("node"), "n", "profile")
                    .join(reps.select(F.col("rep").alias("node")).distinct(), "node"), "profiles")
    side = {s: light.select(F.col("node").alias(s), F.col("n").alias(f"n_{s}"),
                            F.col("profile").alias(f"profile_{s}")) for s in "ab"}
    close = written(pairs.join(side["a"], "a").join(side["b"], "b")
                    .mapInArrow(trimmed(_bounded(percent)), "a long, b long"), "close-pairs")
    equal = reps.select(F.col("node").alias("a"), F.col("rep").alias("b"))
    links = _links(d, close, k, percent, log2_filter, "star")
    def crossing(labels: DataFrame, known: DataFrame, label: str) -> DataFrame:
        """Pairs of holders of one crowd with different labels, but for those in ``known``."""
        crowd = written(held.select("center", "node").join(labels, "node", "left")
                        .select("center", "node", F.coalesce("root", "node").alias("root")),
                        f"{label}-crowds")
        mixed = written(crowd.groupBy("center").agg(
            F.min("root").alias("lo"), F.max("root").alias("hi"), F.count(F.lit(1)).alias("size"))
            .filter("lo < hi").select("center", F.ceil(F.col("size") / BLOCK).cast("int").alias("blocks")),
            f"{label}-mixed")
        live = written(crowd.join(mixed, "center").withColumn(
            "block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")), f"{label}-live")
        met = live.groupBy("node").agg(F.collect_list("center").alias("centers"))
        cells = live.join(met, "node").join(light, "node").withColumn(
            "other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
            "center", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "node", "root", "n", "profile", "centers")
        again = cells.repartition(buckets, "center", "low", "high").sortWithinPartitions(
            "center", "low", "high").mapInArrow(
            trimmed(_second_round(percent, label == "probe")), "a long, b long")
        return written(again.join(known, ["a", "b"], "left_anti"), f"{label}-pairs")

    near = crossing(shared_labels(links, LABEL_ROUNDS), pairs, "probe")
    links = links.unionByName(_links(d, near, k, percent, log2_filter, "probe"))
    parts = components(links)
    more = _links(d, crossing(parts, pairs.unionByName(near), "cross"), k, percent, log2_filter, "cross")
    roots = components(parts.toDF("a", "b").unionByName(more).unionByName(equal))

    extra = ["node", "root"] if with_root else []
    placed = written(rows.join(roots, "node", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("root", "node").alias("root"),
        (F.col("n") > 0).alias("full"), *extra[:1]), "placed")
    names = written(placed.filter("full").groupBy("root").agg(F.min("doc_id").alias("least")),
                    "component-ids")
    return placed.join(names, "root", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("full"), F.col("least")).otherwise(F.col("doc_id")).alias("component_id"),
        *extra)


def set_nodes(docs: DataFrame, k: int, key_col: str, id_col: str = "doc_id",
              text_col: str = "text") -> DataFrame:
    """``key``, ``node`` and ``n`` of each row: its id, or without one its set's fingerprint."""
    ship(docs.sparkSession)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                sets = shingle_sets(word_prints(part["text"], lower=True), k)
                yield pa.record_batch([part["key"], pa.array(_nodes_of(part, _sums(sets)[0])),
                                       pa.array(np.diff(sets.offsets))],
                                      names=["key", "node", "n"])

    return docs.select(F.col(key_col).cast("long").alias("key"),
                       F.col(id_col).cast("long").alias("doc_id"),
                       F.col(text_col).alias("text")).mapInArrow(
        gather, "key long, node long, n long")


def _only(sets: Sets, keep: np.ndarray) -> Sets:
    """The sets that ``keep`` marks, renumbered."""
    size = np.diff(sets.offsets)
    return Sets(sets.shingles[np.repeat(keep, size)],
                np.concatenate(([0], np.cumsum(size[keep]))))
