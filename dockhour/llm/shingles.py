"""Word fingerprints, word windows and shingle sets of text slices, vectorised with numpy."""
from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the public splitmix64 finaliser)."""
    x = x + _A
    x = (x ^ (x >> np.uint64(30))) * _B
    x = (x ^ (x >> np.uint64(27))) * _C
    return x ^ (x >> np.uint64(31))


class Words(NamedTuple):
    """Fingerprints of the words of several texts; text i has prints[offsets[i]:offsets[i + 1]]."""
    prints: np.ndarray
    offsets: np.ndarray


def word_prints(texts: pa.Array, lower: bool = False) -> Words:
    """Words are runs of bytes other than space and 0x09-0x0D; null texts have none."""
    texts = pc.ascii_trim_whitespace(pc.fill_null(texts, ""))
    if lower:
        texts = pc.ascii_lower(texts)
    lists = pc.ascii_split_whitespace(texts)
    coded = lists.flatten().dictionary_encode()
    found = [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()]
    prints = np.array(found, dtype=np.uint64)[coded.indices.to_numpy(zero_copy_only=False)]
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    blank = pc.equal(texts, "").to_numpy(zero_copy_only=False)
    if blank.any():  # a blank text splits into one empty word
        keep = np.ones(len(prints), dtype=bool)
        keep[offsets[:-1][blank]] = False
        prints = prints[keep]
        offsets = offsets - np.concatenate(([0], np.cumsum(blank)))
    return Words(prints, offsets)


def fold(prints: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Fingerprints of all runs of ``k`` words; run i starts at word i."""
    n = len(prints) - k + 1
    if n <= 0:
        return np.empty(0, dtype=np.uint64)
    h = np.full(n, seed, dtype=np.uint64)
    for j in range(k):
        h = mix(h ^ prints[j:j + n]) + prints[j:j + n]
    return h


class Sets(NamedTuple):
    """Sorted distinct shingles of several texts."""
    shingles: np.ndarray
    offsets: np.ndarray


def shingle_sets(words: Words, k: int) -> Sets:
    """Distinct shingles of ``k`` words; a text with fewer words has its whole sequence as one."""
    runs = fold(words.prints, k, 1)
    out = []
    for a, b in zip(words.offsets[:-1], words.offsets[1:], strict=True):
        if b - a >= k:
            out.append(np.unique(runs[a:b - k + 1]))
        else:
            out.append(fold(words.prints[a:b], int(b - a), int(b - a) + 2) if b > a else runs[:0])
    sizes = np.array([len(x) for x in out], dtype=np.int64)
    return Sets(np.concatenate(out) if out else runs[:0],
                np.concatenate(([0], np.cumsum(sizes))))
