"""Operators in SQL functions against plain Python on small tables."""
from __future__ import annotations

import collections
import hashlib
import math
import zlib

import pytest
from pyspark.sql import functions as F

from dockhour.llm import queries
from dockhour.llm.mixing import mix, source_targets
from dockhour.llm.naming import exact_groups
from dockhour.llm.rules import line_rules
from dockhour.llm.sharding import byte_shards

from .helpers import WORD, WS, corpus, make


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, corpus()).repartition(5)


def empty(spark):
    return make(spark, []).limit(0)


@pytest.mark.parametrize("n", [1, 4, 16])
def test_shards_are_contiguous_and_balanced(docs, n):
    rows = byte_shards(docs, n).collect()
    source = corpus()
    assert len(rows) == len(source)
    rows.sort(key=lambda r: (r["shard"], r["slot"]))
    ids = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in rows]
    assert ids == sorted(ids)
    want = collections.Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))
                               for i, t, _ in source)
    assert want == collections.Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows)
    total, largest = sum(r["size"] for r in rows), max(r["size"] for r in rows)
    sizes = collections.Counter()
    for shard in range(n):
        own = [r for r in rows if r["shard"] == shard]
        assert [r["slot"] for r in own] == list(range(len(own)))
        sizes[shard] = sum(r["size"] for r in own)
    assert all(abs(s - total / n) <= largest for s in sizes.values())


def test_empty_tables(spark):
    assert byte_shards(empty(spark)).count() == 0
    assert exact_groups(empty(spark)).count() == 0
    assert line_rules(empty(spark)).count() == 0
    assert mix(empty(spark)).count() == 0


@pytest.mark.parametrize("block", [8, 64, 4096])
def test_exact_groups(docs, block):
    rows = exact_groups(docs, block_bytes=block).collect()
    groups, listed = collections.defaultdict(list), set()
    for i, t, _ in corpus():
        text = WS.sub(" ", t or "")
        groups[text].append(i)
        listed.add((i, text))
    want = set()
    for i, text in listed:
        ids = [x for x in groups[text] if x is not None]
        keep = min(ids) if ids else None
        want.add((i, keep, len(groups[text]), i == keep,
                  hashlib.sha256(text.encode()).hexdigest()))
    got = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows]
    assert len(got) == len(set(got)) and set(got) == want


def test_line_rules(docs):
    source = corpus()
    host_docs = collections.Counter(s for _, _, s in source)
    line_docs = collections.Counter()

    def lines(t):
        return [x for x in (t or "").split("\n") if WORD.search(x)]

    def norm(x):
        return WS.sub(" ", x.strip(" \t\n\x0b\x0c\r")).lower()
    for _, t, s in source:
        line_docs.update({(s, norm(x)) for x in lines(t)})
    hot = {k for k, n in line_docs.items() if n >= 2 and n >= 0.02 * host_docs[k[0]]}
    want = collections.Counter()
    for i, t, s in source:
        w = WORD.findall(t or "")
        seen = collections.defaultdict(list)
        for j in range(len(w) - 2):
            seen[tuple(w[j:j + 3])].append(j)
        rep = len({j + o for at in seen.values() if len(at) > 1 for j in at for o in range(3)})
        own = lines(t)
        left = len(w) - sum(len(WORD.findall(x)) for x in own if (s, norm(x)) in hot)
        failed = len(w) < 50 or 100 * rep > 50 * len(w)
        want[(i, len(w), sum(map(len, w)), sum((t or "").count(c) for c in "#*$%&|<>"),
              len(own) - len(set(own)), rep, failed, not failed and left >= 0.3 * len(w),
              left)] += 1
    got = line_rules(docs, min_docs=2, with_text=True)
    rows = got.collect()
    assert collections.Counter(
        (r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"],
         r["n_repeat_words"], r["base_failed"], r["kept"], r["n_words_left"])
        for r in rows) == want
    for r in rows:
        assert len(WORD.findall(r["clean_text"])) == r["n_words_left"]


def targets(sizes, weights=(1, 2, 3), most=3):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode())
    names += [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    open_, out, rest = set(names), {}, sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not over:
            return {**out, **{s: level * weight[s] for s in open_}}
        for s in over:
            out[s] = most * sizes[s]
            rest -= out[s]
        open_ -= over
    return out


def test_mix(docs):
    rows = mix(docs).collect()
    source = corpus()
    sizes = collections.Counter()
    for _, t, s in source:
        sizes[s] += len(WORD.findall(t or ""))
    want = targets(sizes)
    assert len(rows) == len(source)
    taken = collections.Counter()
    for r in rows:
        assert r["source_size"] == sizes[r["source"]]
        assert math.isclose(r["target"], want[r["source"]], rel_tol=1e-9, abs_tol=1e-9)
        assert r["taken"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
    for s, n in taken.items():
        most = max((len(WORD.findall(t or "")) for _, t, x in source if x == s), default=0)
        assert abs(n - want[s]) <= most / 2 + 1
    key = [(r["doc_id"], r["source"], r["size"], r["taken"]) for r in rows]
    again = [(r["doc_id"], r["source"], r["size"], r["taken"])
             for r in mix(docs.repartition(2)).collect()]
    assert collections.Counter(key) == collections.Counter(again)


def test_targets_stop_at_three_times_the_size(spark):
    sizes = {"a": 1000, "b": 1, "c": 7, "d": 0, None: 30}
    got = {r["source"]: r["target"] for r in source_targets(
        spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()}
    want = targets(sizes)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[s], want[s], abs_tol=1e-9) for s in want)


def test_plans_have_no_python(docs):
    for df in (byte_shards(docs), exact_groups(docs), line_rules(docs), mix(docs)):
        plan = df._jdf.queryExecution().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
        assert "CartesianProduct" not in plan


def test_sql_names_are_queries():
    assert set(queries.SQL) <= set(queries.QUERIES)
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 11))


def test_hot_source_is_split(spark):
    rows = [(i, "w " * (i % 7), "hot" if i % 3 else "rest") for i in range(3000)]
    out = mix(make(spark, rows, clash=False))
    n = out.groupBy("source").agg(F.sum("taken").alias("t"), F.max("target").alias("g")).collect()
    assert all(abs(r["t"] - r["g"]) <= 4 for r in n)
