"""Cases of the review of round 2."""
from __future__ import annotations

import collections
import random

import corpus_pipeline as P
import pyarrow as pa
from tokenizers import Tokenizer

from dockhour.llm.chain import labelled_sample, score_documents
from dockhour.llm.queries import op2_line_rules
from dockhour.llm.template import extract_main_text
from dockhour.llm.tokens import WordEncoder, vocabulary

from .helpers import corpus, make, prose
from .test_pipeline import rows_of
from .test_text_operators import linked


def main_texts(spark, rows):
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    return {r["page_id"]: r["text"] for r in extract_main_text(pages.repartition(3)).collect()}


def test_template_texts_inside_an_article_go(spark):
    """A line of the host goes directly in an article, and in elements that repeat there."""
    rows, want = [], {}
    for i in range(10):
        own = "".join(f"<p>Part {i} {j}</p>" for j in range(1 + i % 4))
        rows.append((i, f"http://a.example/{i}", f"<html><body><article><h1>Head {i}</h1>{own}"
                     "<div>Get our letter</div><p>Read more here</p></article></body></html>"))
        want[i] = " ".join([f"Head {i}", *[f"Part {i} {j}" for j in range(1 + i % 4)]])
    for i in range(20, 24):  # the article is the same teaser everywhere
        rows.append((i, f"http://b.example/{i}", "<html><body><article>Our teaser</article>"
                     f"<div>Story {i}</div></body></html>"))
        want[i] = f"Story {i}"
    for i in (30, 31):  # copies of one page make no template
        rows.append((i, f"http://c.example/{i}", "<body><article><h1>Alone</h1><p>Text</p>"
                     "</article></body>"))
        want[i] = "Alone Text"
    assert main_texts(spark, rows) == want


def test_class_words_do_not_hide_whole_articles(spark):
    pages = {
        "<body class='single right-sidebar nav-below-header'><article>One</article>": "One",
        "<html class='no-banner has-menu'><article>One</article>": "One",
        "<main class='site-main right-sidebar'><p>One</p></main>": "One",
        "<div class='content-sidebar-wrap'><article>One</article><p>x</p></div>": "One",
        "<main><h1>Up</h1><div class='sidebar-layout'><article>One</article></div></main>": "Up One",
        "<article data-id='ad-12'>One</article>": "One",
        "<article>One <a href='/p?id=ad'>two</a> <a href=/p?id=ad>three</a></article>":
            "One two three",
        "<article>One <a title='the hidden cost'>two</a></article>": "One two",
        "<article>One <a title='style=display:none aria-hidden=true'>two</a></article>": "One two",
        # What is beside stays so.
        "<article>One</article><div class='related'><article>More</article></div>": "One",
        "<article>One<div class='related'><article>More</article></div></article>": "One",
        "<div id=comments><article class='comment'>First!</article></div><p>One</p>": "One",
        "<article>One<p HIDDEN>no</p><p style='color:red; Display : none'>no</p>"
        "<p aria-hidden=\"true\">no</p><p ID=ad>no</p><p role=navigation>no</p></article>": "One",
    }
    rows = [(i, f"http://h{i}.example/", p) for i, p in enumerate(pages)]
    assert main_texts(spark, rows) == dict(enumerate(pages.values()))


def test_near_stage_with_rows_without_an_id(spark):
    rng = random.Random(11)
    a, b = prose(rng, 90, 5000), prose(rng, 80, 5000)
    extra = [(None, f"{a} tail", "s0"), (None, a, "s1"), (None, a, "s1"), (None, a.upper(), "s2"),
             (None, b, "s0"), (None, "", "s0"), (None, None, "s1"), (None, " ", None), (None, "", "s0")]
    rows = corpus() + extra
    out = rows_of(P.near_dedup(spark, make(spark, rows).repartition(4), ""))
    assert all(n <= rows.count(r) for r, n in out.items())
    want = {i for (i, _, c) in linked(rows, 5, 80) if i is not None and c == i}
    assert {i for i, _, _ in out} - {None} == want
    lone = collections.Counter({r: n for r, n in out.items() if r[0] is None})
    blank = {r: rows.count(r) for r in extra if not (r[1] or "").strip()}
    assert {r: lone[r] for r in blank} == blank
    # One of the group of `a`; `b` and the text of the corpus that nobody has; not the copy of 5.
    worded = sorted((r[1].lower() for r in (lone - collections.Counter(blank)).elements()), key=len)
    assert len(worded) == 3 and worded[0] == "no id here at all"
    assert worded[1] == b and worded[2] in (a, f"{a} tail")


def test_symbols_after_letters_that_end_in_a_mark():
    """The normalizer turns the last letter into a letter and a mark, which joins the symbols."""
    texts = ["TAKSİ.", "TAKSİ", "takSİ!?) x", "\u0958.", "क\u0958, \u0958", "ΟΔΟΣ. é. cafe\u0301."]
    want = [e.ids for e in Tokenizer.from_file(vocabulary()).encode_batch(
        texts, add_special_tokens=False)]
    got = WordEncoder(vocabulary()).encode(pa.array(texts))
    assert [got.ids[a:b].tolist() for a, b in zip(got.offsets, got.offsets[1:])] == want


def test_a_document_in_many_rows_is_one_document_for_its_lines(spark, tmpdir_path):
    rng = random.Random(4)
    foot = " ".join(f"f{i}" for i in range(30))
    rows = [(i, f"{prose(rng, 60, 9000)}\n{foot if i < 21 else foot[:-1]}", "s") for i in range(40)]
    rows += [rows[30]] * 19  # 20 rows of one document
    rows += [(50 + i, f"{prose(rng, 60, 9000)}\n{foot}", None) for i in range(19)]
    rows += [rows[-1]] * 5 + [(None, prose(rng, 60, 9000), None)] * 25
    make(spark, rows, clash=False).write.parquet(f"{tmpdir_path}/documents.parquet")
    out = op2_line_rules(spark, tmpdir_path).collect()
    assert len(out) == len(rows)
    # 21 documents have the footer, 19 the other line; on the null host 19 have it.
    assert {(r["doc_id"], r["n_words_left"], r["kept"]) for r in out} == {
        (i, 60 if s == "s" and i is not None and i < 21 else len(t.split()), True) for i, t, s in rows}


def test_sampled_labels_keep_the_share_of_toxic_rows_and_blank_texts_stay(spark):
    rows = [(i, f"same words {'x' if i % 2 else 'y'}", "s") for i in range(400)]
    rows += [(900, None, "s"), (901, " ", "s"), (902, "...", "s")]
    schema = "doc_id long, low_quality int, toxic int"
    share = spark.createDataFrame([(i, 0, int(i % 20 == 0)) for i in range(400)], schema)
    out = score_documents(make(spark, rows), share, per_class=20).collect()
    mean = sum(r["scores"]["toxic"] for r in out if r["doc_id"] < 400) / 400
    assert abs(mean - 0.05) < 0.03
    every = spark.createDataFrame([(i, 0, 1) for i in range(400)], schema)
    out = score_documents(make(spark, rows), every).collect()
    assert {r["doc_id"] for r in out if not r["rejected"]} == {900, 901, 902}


def test_an_id_listed_often_is_one_row_of_the_sample(spark):
    """Listing one labelled document 500 times more changes no score and collects no more rows."""
    rng = random.Random(5)
    rows = [(i, prose(rng, 60) + (" vile nasty" if i % 4 == 0 else ""), "s") for i in range(200)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), int(i % 4 == 0)) for i in range(100)] + [
        (150, 7, 0), (151, None, 1)], "doc_id long, low_quality int, toxic int")
    ids, _, _, weights = labelled_sample(make(spark, [*rows, *[rows[1]] * 500]), labels,
                                         ["low_quality", "toxic"], 2000, "doc_id", "text")
    assert sorted(ids) == list(range(100)) and len(weights) == 100

    def scores(some):
        found = score_documents(make(spark, some, clash=False), labels).select("doc_id", "scores")
        return {r["doc_id"]: tuple(r["scores"]) for r in found.collect()}

    assert scores(rows) == scores([*rows, *[rows[1]] * 500])
    assert scores([]) == {}
