"""The Merkle manifest against a plain Python tree."""
from __future__ import annotations

import hashlib
import zlib

import pytest

from dockhour.llm import merkle
from dockhour.llm.merkle import verified_manifest

from .helpers import LOWER, corpus, make

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(values):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def tree(nodes):
    """Root of the nodes, and for each node its siblings (left, right) level by level."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            a = p - p % 8
            paths[i].append(("".join(nodes[a:p]), "".join(nodes[p + 1:a + 8])))
        nodes = [h("".join(nodes[a:a + 8])) for a in range(0, len(nodes), 8)]
        at = [p // 8 for p in at]
    return nodes[0], paths


def expected(rows):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    groups = {}
    if not rows:
        return []
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    below = {}
    for g in names:
        groups[g].sort(key=lambda x: x[:3])
        below[g] = tree([x[2] for x in groups[g]])
    root, above = tree([below[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for (_, _, own, r), path in zip(groups[g], below[g][1], strict=True):
            node, whole = own, path + above[k]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None:
                node = leaf((*r[:4], r[4].translate(LOWER)))
            for left, right in whole:
                node = h(left, node, right)
            out.append((r[0], own, below[g][0], root, h(*[a + b for a, b in whole]), node,
                        node == root))
    return out


def key(row):
    return tuple(str(v) for v in row)


def check(df, rows):
    got = verified_manifest(df, FIELDS)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    assert sorted(map(key, got.collect())) == sorted(map(key, expected(rows)))


def spread(rows, langs):
    return [(i, t, langs[n % len(langs)], s, len(t) if t else None)
            for n, (i, t, s) in enumerate(rows)]


@pytest.mark.parametrize("depth", [1, 3])
def test_manifest_equals_plain_tree(spark, monkeypatch, depth):
    """With blocks of 8 leaves the rounds of blocks recurse on this small table as well."""
    monkeypatch.setattr(merkle, "DEPTH", depth)
    monkeypatch.setattr(merkle, "BLOCK", 8 ** depth)
    langs = [None, "en", "en", "", "é", "en", "z", "Z", "en", *[f"l{i}" for i in range(9)]]
    rows = spread([(i, t and t.upper(), s) for i, t, s in corpus()], langs)
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clash = df.selectExpr("*", "1 AS grp", "2 AS pos", "3 AS total", "4 AS path", "5 AS root",
                          "6 AS digest", "7 AS forged", "8 AS block", "9 AS carry0")
    check(clash, [(i, s, g, n, t) for i, t, g, s, n in rows])


def test_one_group_one_row_and_no_rows(spark):
    for some in (corpus(), corpus()[:1], corpus()[:9], []):
        df = make(spark, some, clash=False)
        check(df, [(i, s, "en", len(t) if t is not None else None, t) for i, t, s in some])


def test_a_changed_row_is_found(spark):
    df = make(spark, [(i, "Tampered TEXT" if i % 2 else "all lower", "s") for i in range(600)])
    rows = verified_manifest(df, FIELDS).collect()
    hit = {r["doc_id"] for r in rows if not r["verified"]}
    assert hit == {i for i in range(600) if i % 2 and zlib.crc32(str(i).encode()) % 3 == 0}
