"""The pipeline's stages against what they should keep, each on its own input."""
from __future__ import annotations

import collections

import corpus_pipeline as P

from .helpers import WS, corpus, make
from .test_text_operators import labelled, linked


def rows_of(df):
    return collections.Counter((r["doc_id"], r["text"], r["source"]) for r in df.collect())


def test_exact_stage(spark):
    docs = make(spark, corpus())
    out = P.exact_dedup(spark, docs, "")
    assert out.columns == docs.columns
    keep = {}
    for i, t, s in corpus():
        text = WS.sub(" ", t or "")
        if text not in keep or keep[text][0] is None or (i is not None and i < keep[text][0]):
            keep[text] = (i, t, s)
    assert rows_of(out) == collections.Counter(keep.values())


def test_near_stage_keeps_one_of_each_group(spark):
    rows = [r for r in corpus() if r[0] is not None]
    rows = list({r[0]: r for r in rows}.values())
    out = P.near_dedup(spark, make(spark, rows), "")
    want = {c for (_, _, c) in linked(rows, 5, 80)}
    assert sorted(r["doc_id"] for r in out.collect()) == sorted(want)


INSIDE = ["scores", "rejected", "_key", "_variant", "_copies", "_copy", "_id", "doc", "key", "node",
          "variant", "times", "kept", "copies", "n_chars", "lang"]


def test_stages_return_their_columns_unchanged(spark, tmpdir_path):
    """Names that stages or operators use inside, null ids, repeated rows: whole rows come back."""
    rows, labels = labelled(spark, 120, 6)
    spark.createDataFrame([(i, 1 - q, t) for i, q, t in labels],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{tmpdir_path}/labels.parquet")
    full = [(i, t, s, *[f"{c} {n}" for c in INSIDE])
            for n, (i, t, s) in enumerate([*rows[:60], *corpus(), rows[0]])]
    full.append(full[0])
    schema = "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in INSIDE)
    docs = spark.createDataFrame(full, schema)
    have = collections.Counter(full)
    for name, stage in P.STAGES[:4]:
        out = stage(spark, docs, tmpdir_path)
        assert out.schema == docs.schema, name
        got = collections.Counter(map(tuple, out.collect()))
        most = 3 if name == "source_mix" else 1
        assert got and all(n <= most * have[r] for r, n in got.items()), name
        assert stage(spark, docs.limit(0), tmpdir_path).collect() == [], name


def test_mix_stage_repeats_rows(spark):
    docs = make(spark, corpus())
    out = P.source_mix(spark, docs, "")
    assert out.columns == docs.columns
    have = rows_of(docs)
    assert all(n <= 3 * have[k] for k, n in rows_of(out).items())


def test_toxicity_stage(spark, tmpdir_path):
    rows, labels = labelled(spark, 300, 6)
    spark.createDataFrame([(i, 1 - q, t) for i, q, t in labels],
                          "doc_id long, quality int, toxic int").write.parquet(
        f"{tmpdir_path}/labels.parquet")
    docs = make(spark, [*rows, (9001, None, None), (9002, "", "s")])
    kept = {r["doc_id"] for r in P.toxicity(spark, docs, tmpdir_path).collect()}
    clean = {i for i, _, t in labels if not t} | {9001, 9002}
    assert clean <= kept and len(kept - clean) <= 2


def test_whole_run_and_empty_table(spark, tmpdir_path):
    rows, labels = labelled(spark, 120, 7)
    schema = "doc_id long, quality int, toxic int"
    for name, some in (("a", rows), ("b", [])):
        make(spark, some, clash=False).write.parquet(f"{tmpdir_path}/{name}/documents.parquet")
        spark.createDataFrame([(i, 1 - q, t) for i, q, t in labels], schema).write.parquet(
            f"{tmpdir_path}/{name}/labels.parquet")
    out = P.run(spark, f"{tmpdir_path}/a")
    assert {"doc_id", "sequence_id", "offset"} <= set(out.columns) and out.count() > 0
    assert P.run(spark, f"{tmpdir_path}/b").count() == 0


def test_stages_are_named_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact_dedup", "near_dedup", "source_mix",
                                        "packing"]
