"""Token ids of whole texts, word by word, with a bounded cache in each Python worker.

The public word tokenizer drops white space and never joins characters across it, so a text's ids
are those of its words one after the other.  A word that is letters with symbols behind them splits
there too, unless the normalizer ends the letters in a mark, which would join the symbols.  Distinct words of a batch are encoded once, many to a call, and spread over the batch
with numpy.
"""
from __future__ import annotations

import os
import string
import unicodedata
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .common import trim

# ASCII symbols that the tokenizer separates from letters before them; the apostrophe is not among
# them because it starts contractions.
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
CACHE_ENTRIES = 300_000
SLICE_BYTES = 4 << 20
TOKEN_SLICE_BYTES = 2 << 20
CHUNK = 1000
_encoders: dict[str, WordEncoder] = {}


class Encoded(NamedTuple):
    """Ids of several texts, one after the other; text i has ids[offsets[i]:offsets[i + 1]]."""
    ids: np.ndarray
    offsets: np.ndarray


def _ends_in_letter(core: str) -> bool:
    """Whether letters still end in one after the tokenizer's normalizer (NFC, lower case)."""
    return core.isascii() or unicodedata.normalize("NFC", core).lower()[-1].isalpha()


def _split(word: str) -> tuple[str, str]:
    """A word as letters and the symbols behind them, or as a whole."""
    core = word.rstrip(TAIL)
    if core.isalpha() and _ends_in_letter(core):
        return core.lower() if core.isascii() else core, word[len(core):]
    return word, ""


def _spread(flat: np.ndarray, sizes: np.ndarray, index: np.ndarray
            ) -> tuple[np.ndarray, np.ndarray]:
    """The runs of ``flat`` (of the given sizes) that ``index`` names, and where each ends."""
    n = sizes[index]
    ends = np.concatenate(([0], np.cumsum(n)))
    at = np.repeat((np.cumsum(sizes) - sizes)[index] - ends[:-1], n)
    at += np.arange(ends[-1])
    return flat[at], ends


class WordEncoder:
    def __init__(self, path: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.pieces: dict[str, bytes] = {"": b""}

    def _learn(self, pieces: list[str]) -> None:
        alone = [p for p in pieces if not p.isalpha()]
        letters = [p for p in pieces if p.isalpha()]
        chunks = [letters[a:a + CHUNK] for a in range(0, len(letters), CHUNK)]
        found = self.tokenizer.encode_batch([" ".join(c) for c in chunks],
                                            add_special_tokens=False)
        for chunk, e in zip(chunks, found, strict=True):
            word = np.array(e.word_ids, dtype=np.int64)
            ends = [*((np.flatnonzero(np.diff(word)) + 1) * 4).tolist(), 4 * len(word)]
            if len(ends) != len(chunk):  # some letters fall apart when they are lowered
                alone += chunk
                continue
            raw, at = np.array(e.ids, dtype="<u4").tobytes(), 0
            for p, end in zip(chunk, ends, strict=True):
                self.pieces[p] = raw[at:end]
                at = end
        for p, e in zip(alone, self.tokenizer.encode_batch_fast(alone, add_special_tokens=False),
                        strict=True):
            self.pieces[p] = np.array(e.ids, dtype="<u4").tobytes()

    def words(self, found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of distinct words, one after the other, and how many each word has.

        ASCII letters with symbols behind them are split by Arrow, other words one by one.
        """
        core = pc.ascii_rtrim(found, TAIL)
        plain = pc.ascii_is_alpha(core)
        heads = pc.ascii_lower(core.filter(plain)).dictionary_encode()
        tails = pc.ascii_ltrim(found.filter(plain), string.ascii_letters).dictionary_encode()
        parts = heads.dictionary.to_pylist() + tails.dictionary.to_pylist()
        split = [_split(w) for w in found.filter(pc.invert(plain)).to_pylist()]
        wanted = set(parts).union(*split)
        need = wanted - self.pieces.keys()
        if len(self.pieces) + len(need) > CACHE_ENTRIES:  # keep what these words use
            self.pieces = {p: self.pieces[p] for p in {"", *wanted} - need}
        if need:
            self._learn(sorted(need))
        get = self.pieces
        blobs = [get[p] for p in parts] + [get[a] + get[b] for a, b in split] + [b""]
        flat = np.frombuffer(b"".join(blobs), dtype="<u4")
        sizes = np.fromiter((len(b) >> 2 for b in blobs), dtype=np.int64, count=len(blobs))
        pair = np.full((len(found), 2), len(blobs) - 1)
        plain = plain.to_numpy(zero_copy_only=False)
        pair[plain, 0] = heads.indices.to_numpy()
        pair[plain, 1] = len(heads.dictionary) + tails.indices.to_numpy()
        pair[~plain, 0] = len(parts) + np.arange(len(split))
        flat, ends = _spread(flat, sizes, pair.ravel())
        return flat, np.diff(ends[::2])

    def encode(self, texts: pa.Array, end_id: int | None = None) -> Encoded:
        """Encode one slice of texts (null: empty) and append ``end_id`` to each."""
        lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = lists.flatten().dictionary_encode()
        flat, sizes = self.words(coded.dictionary)
        index = coded.indices.to_numpy(zero_copy_only=False)
        offsets = lists.offsets.to_numpy().astype(np.int64)
        offsets -= offsets[0]
        if end_id is not None:  # one more word, after each text's last
            index = np.insert(index, offsets[1:], len(sizes))
            flat, sizes = np.append(flat, np.array([end_id], "<u4")), np.append(sizes, 1)
            offsets += np.arange(len(offsets))
        ids, ends = _spread(flat, sizes, index)
        return Encoded(ids, ends[offsets])


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Place of a public vocabulary file; another file's path can be passed to the operators."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file; its cache outlives the task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def release() -> None:
    """Let go of the worker's encoders.

    Workers go on to other operators' tasks; those that hold much themselves call this first.
    """
    if _encoders:
        _encoders.clear()
        trim()


def slices(batch: pa.RecordBatch, text: str, most_bytes: int = SLICE_BYTES):
    """Cut a batch into runs of rows of about ``most_bytes`` of text."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch[text]), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        base = size[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(size, base + most_bytes, side="right")))
        yield batch.slice(at, to - at)
        at = to
