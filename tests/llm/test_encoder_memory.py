"""Memory that encoding one slice of texts takes beside the word cache."""
from __future__ import annotations

import random
import tracemalloc

import pyarrow as pa

from dockhour.llm import tokens

from .helpers import prose


def test_a_slice_takes_little_memory():
    rng = random.Random(1)
    words = [prose(rng, 40) for _ in range(200)]
    texts, size = [], 0
    while size < tokens.TOKEN_SLICE_BYTES:
        texts.append(" ".join(rng.choices(words, k=8)))
        size += len(texts[-1].encode())
    texts = pa.array(texts)
    encoder = tokens.WordEncoder(tokens.vocabulary())
    encoder.encode(texts, 1)
    tracemalloc.start()
    encoder.encode(texts, 1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64 << 20
