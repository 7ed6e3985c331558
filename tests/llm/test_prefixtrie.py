"""The conversation trie against a dictionary of all prefixes."""
from __future__ import annotations

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from dockhour.llm.prefixtrie import (ROOT, _prefixes, conversation_trie, prefix_trie,
                                     z_fast_trie)

SCHEMA = "conv_id long, turn long, role string, text string"


def rebuilt(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            own.setdefault(c, []).append((turn is not None, turn or 0, key, role, text))
    turns = {c: [x[3:] for x in sorted(v)] for c, v in own.items()}
    out = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = turns.get(base, [])[:h] + turns[c][h:]
    return out


def expected(sequences, chars):
    members, ends, children = {}, {}, {}
    for c, seq in sequences.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        below = children.get(p, [])
        leaves[p] = sum(leaves[b] for b in below) or 1
        saved[p] = sum(saved[b] for b in below) + (
            (len(members[p]) - 1) * chars(p[-1]) if p else 0)
    return sorted((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]),
                   len(children.get(p, [])), leaves[p], saved[p],
                   hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
                  for p in members)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
           "saved_tokens", "ends_sha256"]


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def conversations(seed=5):
    """Blocks with and without their first conversation, ties, nulls, copies, a long one, repeated
    rows, conversations that are left without turns."""
    rng = random.Random(seed)
    rows = []
    for c in [*range(0, 30), *range(95, 130), *range(210, 220), 300, *range(-7, 3), 1 << 40]:
        for t in range(rng.randrange(1, 8)):
            rows.append((c, t, rng.choice(["user", "assistant", None]),
                         rng.choice(["hi", "", None, f"text é😀 {rng.randrange(6)}"])))
    rows += [(400 + i, t, "user", f"same {t}") for i in range(25) for t in range(9)]
    rows += [(500 + i, t, "user", f"long {t}") for i in (0, 1, 7) for t in range(70 - i)]
    rows += [(600, None, "user", "no turn"), (600, 0, "user", "zero"), (600, None, None, None),
             (601, 2, "a", "tie"), (601, 2, "b", "tie"), (None, 0, "user", "nobody's")]
    return rows + rows[:9]


def test_equals_all_prefixes(spark):
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr(
        "*", "1 AS depth", "2 AS place", "'k' AS key", "3 AS rep", "4 AS node", "5 AS chars",
        "6 AS print")
    got = conversation_trie(df)
    assert got.columns == COLUMNS
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    sequences = rebuilt(rows)
    assert any(not s for s in sequences.values())  # some have no turns left
    assert rows_of(got) == expected(sequences, lambda turn: len(turn[1]))


def test_few_conversations(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    for rows in ([(7, 0, "user", "short")], [(0, 0, "user", "x"), (100, 0, "user", "x")]):
        assert rows_of(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == expected(
            rebuilt(rows), lambda turn: len(turn[1]))


def strings(seed=8):
    """Strings over two turns: branches at many depths, ends inside edges, one very long."""
    rng = random.Random(seed)
    out = {i: [rng.choice("ab") for _ in range(rng.randrange(0, 12))] for i in range(60)}
    out |= {100 + i: ["a"] * i + ["c"] * (i % 3) for i in range(0, 40, 3)}
    return out


def test_trie_of_dense_strings(spark):
    sequences = strings()
    turns = spark.createDataFrame([(c, d + 1, k, ord(k)) for c, s in sequences.items()
                                   for d, k in enumerate(s)],
                                  "conv_id long, depth long, key string, chars long")
    convs = spark.createDataFrame([(c,) for c in sequences], "conv_id long")
    assert rows_of(prefix_trie(turns, convs)) == expected(sequences, ord)


def two_fattest(a, b):
    return max(range(a + 1, b + 1), key=lambda x: x & -x)


def test_nodes_are_compacted_under_their_handles(spark):
    sequences = {c: s for c, s in strings().items() if s}
    distinct = {tuple(s): c for c, s in sorted(sequences.items(), reverse=True)}
    turns = spark.createDataFrame([(c, d + 1, k, 1) for s, c in distinct.items()
                                   for d, k in enumerate(s)],
                                  "conv_id long, depth long, key string, chars long")
    paths = _prefixes(turns).withColumnRenamed("conv_id", "rep")
    ends = spark.createDataFrame([(c, len(s)) for s, c in distinct.items()], "rep long, n long")
    name = {r["print"]: tuple(sequences[r["rep"]][:r["depth"]]) for r in paths.collect()} | {ROOT: ()}
    nodes = z_fast_trie(paths, ends).collect()
    prefixes = {p[:d] for p in distinct for d in range(len(p) + 1)}
    kids = {p: sum(q[:-1] == p for q in prefixes if q) for p in prefixes}
    assert {name[r["node"]] for r in nodes} == {
        p for p in prefixes if p and (p in distinct or kids[p] > 1)}
    assert len(nodes) == len({r["node"] for r in nodes})
    for r in nodes:
        p = name[r["node"]]
        assert name[r["up"]] == p[:r["top"]] and len(p) == r["depth"] > r["top"]
        assert r["handle"] == two_fattest(r["top"], r["depth"])
        assert name[r["handle_print"]] == p[:r["handle"]] and name[r["first"]] == p[:r["top"] + 1]
