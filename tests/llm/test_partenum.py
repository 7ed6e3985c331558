"""Signatures of PartEnum: which sets share one, and which sets emit empty ones."""
from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from dockhour.llm.partenum import Bands, signatures
from dockhour.llm.shingles import Sets, mix


def as_sets(rows):
    return Sets(np.concatenate(rows),
                np.concatenate(([0], np.cumsum([len(r) for r in rows]))))


def elements(start, n):
    return np.sort(mix(np.arange(start, start + n, dtype=np.uint64)))


def by_set(signed, n):
    return [set(signed.signature[signed.owner == i].tolist()) for i in range(n)]


@pytest.mark.parametrize("percent", [80, 85])
def test_unrelated_sets_share_no_signature(percent):
    """Sets of 100 to 800 elements, none in two of them; at 80 empty signatures had up to 11 holders."""
    size = np.random.default_rng(3).integers(100, 800, 400)
    rows = [elements(1000 * i, s) for i, s in enumerate(size)]
    held = Counter(s for own in by_set(signatures(as_sets(rows), Bands(percent)), len(rows))
                   for s in own)
    assert max(held.values()) == 1


@pytest.mark.parametrize("percent", [80, 85])
def test_pairs_at_the_threshold_share_a_signature(percent):
    """Differences as large as they may be: on one side only, on both, at every edge of a band."""
    bands, rng = Bands(percent), np.random.default_rng(4)
    edges = [int(e) for e in bands.edges if 1 < e < 1500]
    sizes = sorted({max(1, e + d) for e in edges for d in (-1, 0, 1)}
                   | set(rng.integers(1, 900, 150).tolist()))
    rows, turn = [], 0
    for large in sizes:
        least = -(-large * percent // 100)
        for small in sorted({least, (least + large) // 2, large}):
            both = -(-percent * (small + large) // (100 + percent))
            turn += 1
            base = rng.permutation(mix(np.arange(turn * 10000, turn * 10000 + 5000, dtype=np.uint64)))
            rows.append(np.sort(base[:small]))
            rows.append(np.sort(np.concatenate([base[:both], base[small:small + large - both]])))
    own = by_set(signatures(as_sets(rows), bands), len(rows))
    for i in range(0, len(rows), 2):
        a, b = rows[i], rows[i + 1]
        met = len(np.intersect1d(a, b))
        assert 100 * met >= percent * (len(a) + len(b) - met)
        assert own[i] & own[i + 1], (len(a), len(b), met)
