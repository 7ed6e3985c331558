"""Block pairs of a crowd: the pairs that pass, and the memory that comparing them takes."""
from __future__ import annotations

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dockhour.llm import jaccard, tokens
from dockhour.llm.common import ship
from dockhour.llm.jaccard import jaccard_components

from .helpers import make, prose


def block_pair(rows, cells, low, high, center=300):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 9, cells)
    profiles = [(base + (rng.random(cells) < rng.choice([0.05, 0.9]))).astype(np.uint8)
                for _ in range(rows)]
    profiles = [np.repeat(p, 2) if i % 7 == 0 else p for i, p in enumerate(profiles)]
    n = np.array([int(p.sum()) for p in profiles])
    block = rng.choice([low, high], rows)
    centers = [sorted(rng.choice(400, 4, replace=False).tolist()) for _ in range(rows)]
    node = rng.permutation(rows) + 10
    return pa.table({
        "center": np.full(rows, center), "low": np.full(rows, low, np.int32),
        "high": np.full(rows, high, np.int32), "block": block.astype(np.int32), "node": node,
        "root": node // 3, "n": n, "centers": pa.array(centers, pa.list_(pa.int64())),
        "profile": pa.array([p.tobytes() for p in profiles], pa.binary())})


@pytest.mark.parametrize("low,high", [(0, 1), (1, 1)])
def test_pairs_of_a_block_pair(low, high):
    rows = block_pair(150, 64, low, high).to_pylist()
    want = {}
    for x, a in enumerate(rows):
        for y, b in enumerate(rows):
            if a["root"] == b["root"] or (a["block"], b["block"]) != (low, high) or (
                    low == high and x >= y):
                continue
            if any(c < 300 for c in set(a["centers"]) & set(b["centers"])):
                continue
            p, q = (np.frombuffer(r["profile"], np.uint8).astype(int).reshape(64, -1).sum(axis=1)
                    for r in (a, b))
            far = int(np.abs(p - q).sum())
            if far <= (a["n"] + b["n"]) * 20 // 180:
                want[a["node"], b["node"]] = far / (a["n"] + b["n"])
    i, j = jaccard._crossing(block_pair(150, 64, low, high), 80, False)
    assert want and sorted(zip(i.tolist(), j.tolist())) == sorted(want)
    i, j = jaccard._crossing(block_pair(150, 64, low, high), 80, True)
    near = list(zip(i.tolist(), j.tolist()))
    assert set(near) <= set(want)
    for node in {v for pair in want for v in pair}:
        for side in (0, 1):
            best = min((far for pair, far in want.items() if pair[side] == node), default=None)
            assert best is None or any(
                want[pair] == best for pair in near if pair[side] == node)


def test_no_block_pair_takes_much_memory():
    """Full blocks, profiles of 256 and of 1024 cells: 185 and 594 MB when pairs were 65536 at once."""
    for cells in (256, 1024):
        group = block_pair(2 * jaccard.BLOCK, cells, 0, 1)
        tracemalloc.start()
        jaccard._crossing(group, 80, True)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 64 << 20


def test_workers_of_the_joins_hold_no_encoder(spark):
    """A worker that encoded before lets its word cache go when it makes signatures."""
    path = tokens.vocabulary()
    docs = make(spark, [(i, prose(random.Random(i), 30), "s") for i in range(40)], clash=False)

    def encode(batches):
        for b in batches:
            tokens.encoder(path).encode(b["text"])
            yield pa.record_batch([pa.array([len(tokens._encoders)])], names=["held"])

    def held(batches):
        for _ in batches:
            yield pa.record_batch([pa.array([len(tokens._encoders)])], names=["held"])

    one = docs.select("text").repartition(1)
    ship(spark)
    assert one.mapInArrow(encode, "held long").agg(F.max("held")).first()[0] == 1
    jaccard_components(docs.repartition(1)).collect()
    assert docs.select("text").repartition(1).mapInArrow(held, "held long").agg(
        F.max("held")).first()[0] == 0
