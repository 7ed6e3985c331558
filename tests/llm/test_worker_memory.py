"""What Python workers hold while they encode, and between tasks."""
from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from dockhour.llm import common, tokens

ODD = ["", "Word,", "it's", "...", "naïve!", "a1.", "Ab́,", "É;", "K.", "İ?", "ǅ-x", "don't.", "x\x00,",
       "é", "ﬁne)", "ΑΣ.", "中文,", "(open", "end)", "A-B-C", "U.S.A.", "😀!", " x", "a b", "#tag"]


def ids_of(encoder, texts, end_id=None):
    ids, offsets = encoder.encode(pa.array(texts, pa.string()), end_id)
    return [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def spelled(i: int) -> str:
    out = ""
    while i:
        i, r = divmod(i, 26)
        out += chr(97 + r)
    return "Q" + out


def test_the_word_cache_stays_small_and_ids_do_not_change():
    encoder = tokens.WordEncoder(tokens.vocabulary())
    first = [" ".join(map(spelled, range(1000))), None, " ".join(ODD)]
    before = ids_of(encoder, first, 1)
    for a in range(0, 450_000, 50_000):
        encoder.encode(pa.array([" ".join(map(spelled, range(a, a + 50_000)))]), 1)
        assert len(encoder.pieces) <= 300_000
    assert ids_of(encoder, first, 1) == before


def test_a_slice_with_more_words_than_the_cache(monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)
    texts = [" ".join(map(spelled, range(a, a + 40))) for a in range(0, 400, 20)] + ODD
    encoder, plain = tokens.WordEncoder(tokens.vocabulary()), Tokenizer.from_file(tokens.vocabulary())
    wanted = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert ids_of(encoder, texts) == wanted
    assert [x for t in texts for x in ids_of(encoder, [t])] == wanted


def test_odd_words_and_ends():
    rng = random.Random(3)
    texts = [None, "", " ", "\n"] + [rng.choice([" ", "\n", " \t "]).join(rng.choices(ODD, k=9)) for _ in range(60)]
    encoder, plain = tokens.WordEncoder(tokens.vocabulary()), Tokenizer.from_file(tokens.vocabulary())
    wanted = [[*plain.encode(t or "", add_special_tokens=False).ids, 7] for t in texts]
    assert ids_of(encoder, texts, 7) == wanted
    assert ids_of(encoder, texts[1:], 7) == wanted[1:]
    sliced = encoder.encode(pa.array(texts, pa.string()).slice(5, 20), 7)
    assert sliced.ids.tolist() == sum(wanted[5:25], [])
    assert np.diff(sliced.offsets).tolist() == list(map(len, wanted[5:25]))
    assert ids_of(encoder, [], 7) == []


def test_tasks_give_freed_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "trim", lambda: calls.append(1))
    task = common.trimmed(lambda batches: (b for b in batches))
    assert list(task(iter([1, 2]))) == [1, 2] and len(calls) == 1
    ended = task(iter([1, 2]))
    next(ended)
    ended.close()
    assert len(calls) == 2


def test_release_gives_the_cache_back(monkeypatch):
    calls = []
    monkeypatch.setattr(tokens, "trim", lambda: calls.append(1))
    tokens.release()
    calls.clear()
    tokens.encoder(tokens.vocabulary())
    tokens.release()
    assert not tokens._encoders and len(calls) == 1
    tokens.release()
    assert len(calls) == 1
