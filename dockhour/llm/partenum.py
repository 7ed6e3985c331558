"""PartEnum signatures of sets for a Jaccard threshold.

Sizes fall into bands; two similar sets share the band of the larger one.  Within a band the
threshold bounds the number of elements in which two sets differ by k.  The element domain is cut
into n1 buckets of n2 parts by a hash; as more than k // (k2 + 1) buckets exist, some bucket
differs in at most k2 elements, hence agrees on some n2 - k2 of its parts.  A signature is the
content of those parts, so similar sets share at least one.

Parts that hold nothing say nothing, and sets without much in a bucket would all share them.  There
are SLACK buckets more than needed.  A set of its own size differs from similar sets of the band in
``reach`` elements at most, often far fewer than k, so a similar pair agrees in all buckets but
reach // (k2 + 1).  Only a set with as many buckets in which such content can be empty emits its
empty signatures too: otherwise one of the buckets that agree has content, and both sets emit that.
"""
from __future__ import annotations

from itertools import combinations
from typing import NamedTuple

import numpy as np

from .shingles import Sets, mix


class Scheme(NamedTuple):
    k2: int
    n2: int
    slack: int


SMALL, LARGE, SMALL_K = Scheme(3, 7, 0), Scheme(1, 3, 4), 15


class Bands:
    """Size bands, with the ratio of two similar sizes squared between their edges."""

    def __init__(self, percent: int, largest: int = 1 << 40) -> None:
        self.percent = percent
        ratio = (100 / percent) ** 2
        edges = [1]
        while edges[-1] <= largest:
            edges.append(max(edges[-1] + 1, int(np.ceil(edges[-1] * ratio))))
        self.edges = np.array(edges, dtype=np.int64)

    def of(self, sizes: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edges, sizes, side="right") - 1

    def differ(self, band: np.ndarray) -> np.ndarray:
        """Elements in which two similar sets can differ if the larger is in ``band``."""
        most = self.edges[band + 1] - 1
        return 2 * most * (100 - self.percent) // (100 + self.percent)

    def reach(self, sizes: np.ndarray, band: np.ndarray) -> np.ndarray:
        """Elements in which a set of ``sizes`` and a similar one can differ, the larger in ``band``."""
        other = np.minimum(sizes * 100 // self.percent, self.edges[band + 1] - 1)
        return (sizes + other) * (100 - self.percent) // (100 + self.percent)


class Signed(NamedTuple):
    signature: np.ndarray
    owner: np.ndarray


def _sums(cells: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sums modulo 2**64 of ``values`` by cell."""
    low = np.bincount(cells, (values & np.uint64(0xFFFFFFFF)).astype(np.float64), n)
    high = np.bincount(cells, (values >> np.uint64(32)).astype(np.float64), n)
    return low.astype(np.uint64) + (high.astype(np.uint64) << np.uint64(32))


def _sign(sets: Sets, owners: np.ndarray, band: np.ndarray, k: np.ndarray, reach: np.ndarray,
          s: Scheme) -> Signed:
    """Signatures of the sets ``owners`` in their bands."""
    k2 = np.minimum(s.k2, k) if s is SMALL else np.full(len(k), s.k2)
    n1 = k // (k2 + 1) + 1 + s.slack
    agree = n1 - reach // (k2 + 1)
    size = np.diff(sets.offsets)[owners]
    element = np.repeat(sets.offsets[owners] - (np.cumsum(size) - size), size) + np.arange(
        size.sum())
    shingle = sets.shingles[element]
    cells = n1 * s.n2
    base = np.cumsum(cells) - cells
    spread = mix(shingle ^ np.repeat(mix(band.astype(np.uint64)), size)) >> np.uint64(32)
    cell = (np.repeat(base, size)
            + (spread * np.repeat(cells, size).astype(np.uint64) >> np.uint64(32)).astype(np.int64))
    total = int(cells.sum())
    content = _sums(cell, mix(shingle), total).reshape(-1, s.n2)
    count = np.bincount(cell, minlength=total).reshape(-1, s.n2)
    bucket_owner = np.repeat(np.arange(len(owners)), n1)
    bucket = np.arange(len(bucket_owner)) - np.repeat(np.cumsum(n1) - n1, n1)
    tag = mix(band.astype(np.uint64)[bucket_owner] << np.uint64(32) | bucket.astype(np.uint64))
    out_sig, out_owner = [], []
    for own_k2 in np.unique(k2):
        rows = np.flatnonzero(k2[bucket_owner] == own_k2)
        chosen = np.array([[j not in gone for j in range(s.n2)]
                           for gone in combinations(range(s.n2), int(own_k2))])
        held = count[rows] @ chosen.T.astype(np.int64)
        sums = np.stack([content[rows][:, c].sum(axis=1, dtype=np.uint64) for c in chosen], axis=1)
        names = mix(np.arange(len(chosen), dtype=np.uint64) + np.uint64(17))
        sig = mix(mix(sums ^ tag[rows][:, None]) + names[None, :])
        thin = np.bincount(bucket_owner[rows], (held == 0).any(axis=1), len(owners))
        emit = (held > 0) | (thin >= agree)[bucket_owner[rows]][:, None]
        out_sig.append(sig[emit])
        out_owner.append(np.broadcast_to(bucket_owner[rows][:, None], sig.shape)[emit])
    return Signed(np.concatenate(out_sig), owners[np.concatenate(out_owner)])


def signatures(sets: Sets, bands: Bands) -> Signed:
    """All signatures of all non-empty sets; ``owner`` is the set's number."""
    size = np.diff(sets.offsets)
    parts = []
    own = np.flatnonzero(size > 0)
    low, high = bands.of(size[own]), bands.of(size[own] * 100 // bands.percent)
    for step in range(int((high - low).max()) + 1 if len(own) else 0):
        at = np.flatnonzero(low + step <= high)
        band = low[at] + step
        k, reach = bands.differ(band), bands.reach(size[own[at]], band)
        for scheme, some in ((SMALL, k <= SMALL_K), (LARGE, k > SMALL_K)):
            if some.any():
                parts.append(_sign(sets, own[at][some], band[some], k[some], reach[some], scheme))
    if not parts:
        return Signed(np.empty(0, np.uint64), np.empty(0, np.int64))
    return Signed(*(np.concatenate(x) for x in zip(*parts, strict=True)))
