"""Operators with Arrow batches against brute force, round trips and held-out rows."""
from __future__ import annotations

import collections
import hashlib
import io
import itertools
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from dockhour.llm.chain import fit_chain, features_of, score_documents
from dockhour.llm.components import components
from dockhour.llm.jaccard import jaccard_components
from dockhour.llm.packing import pack, plan_packing
from dockhour.llm.partenum import Bands, signatures
from dockhour.llm.shingles import Sets
from dockhour.llm.substrings import remove_repeated_windows
from dockhour.llm.template import extract_main_text
from dockhour.llm.tokenfile import TokenFileReader, TokenFileWriter, token_files
from dockhour.llm.tokens import WordEncoder, vocabulary

from .helpers import LOWER, WORD, corpus, make


@pytest.fixture(scope="module")
def docs(spark):
    return make(spark, corpus()).repartition(5)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary())


def linked(rows, k, percent):
    """Component ids by comparing all pairs; rows of one id are one document."""
    sets = []
    for i, t, _ in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append({tuple(w[j:j + k]) for j in range(len(w) - k + 1)} if len(w) >= k
                    else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        same = rows[a][0] is not None and rows[a][0] == rows[b][0]
        if sets[a] and sets[b] and (
                same or 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both)):
            parent[find(a)] = find(b)
    least = {}
    for x, (i, _, _) in enumerate(rows):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return collections.Counter((r[0], len(s), least.get(find(x)) if s else r[0])
                               for x, (r, s) in enumerate(zip(rows, sets, strict=True)))


@pytest.mark.parametrize("k,percent", [(4, 85), (5, 80)])
def test_jaccard_components(docs, k, percent):
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"])
                              for r in jaccard_components(docs, k, percent).collect())
    assert got == linked(corpus(), k, percent)


def test_jaccard_crowd_of_near_copies(spark):
    """A large group whose members are linked through one another, and some through nobody."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(150)]
    rows = []
    for i in range(120):
        w = list(base)
        for j in rng.sample(range(150), i // 10):
            w[j] = f"x{i}_{j}"
        rows.append((i, " ".join(w), "s"))
    rng.shuffle(rows)
    df = make(spark, rows, clash=False).repartition(7)
    got = collections.Counter((r["doc_id"], r["n_shingles"], r["component_id"])
                              for r in jaccard_components(df, 4, 85).collect())
    assert got == linked(rows, 4, 85)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(5)
    bands = Bands(85)
    for n in [1, 2, 3, 6, 7, 8, 12, 20, 39, 60, 100, 150, 400, 1500]:
        for _ in range(30):
            a = rng.integers(0, 1 << 62, n, dtype=np.int64).astype(np.uint64)
            most = int(n * 0.15 / 1.85 * 2)
            drop = int(rng.integers(0, most // 2 + 1))
            add = int(rng.integers(0, most - drop + 1))
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 62, add).astype(np.uint64)])
            both = n - drop
            if 100 * both < 85 * (n + len(b) - both):
                continue
            sets = Sets(np.concatenate([a, b]), np.array([0, n, n + len(b)]))
            s = signatures(sets, bands)
            assert set(s.signature[s.owner == 0]) & set(s.signature[s.owner == 1]), (n, drop, add)


def test_components(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 500), (7, 7)] + [
        (rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(x, x) == find(x) for x in list(parent))


@pytest.mark.parametrize("log2_cells", [19, 22])
def test_repeated_windows(docs, log2_cells):
    k, rows = 35, corpus()
    count = collections.Counter()
    for _, t, _ in rows:
        w = WORD.findall(t or "")
        count.update(tuple(w[j:j + k]) for j in range(len(w) - k + 1))
    want = collections.Counter()
    for i, t, _ in rows:
        w = WORD.findall(t or "")
        gone = {q for j in range(len(w) - k + 1) if count[tuple(w[j:j + k])] > 1
                for q in range(j, j + k)}
        kept = " ".join(x for q, x in enumerate(w) if q not in gone)
        want[(i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)] += 1
    got = remove_repeated_windows(docs, k, log2_cells=log2_cells, with_text=True).collect()
    assert collections.Counter(map(tuple, got)) == want


def test_window_that_repeats_inside_one_text(spark):
    half = " ".join(f"v{i}" for i in range(40))
    rows = [(1, f"{half} mid {half}", "s"), (2, "x " * 36, "s"), (3, "y " * 35, "s")]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in remove_repeated_windows(
        make(spark, rows), 35, log2_cells=19).collect()}
    assert got == {1: (81, 80), 2: (36, 36), 3: (35, 0)}


def labelled(spark, n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        toxic = i % 5 == 0
        low = i % 3 == 0
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 200))]
        if toxic:
            w += rng.choices(["nasty,", "vile", "foulness", "fouler!", "Foulest"], k=3)
        if low:
            w += ["%%%"] * 3 + ["junk"] * 2
        rng.shuffle(w)
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(low), int(toxic)))
    return rows, labels


def test_chain_on_held_out_rows(spark):
    rows, labels = labelled(spark, 600, 4)
    rows += [(9001, None, "s"), (9002, "", "s"), (None, "vile nasty fouler", "s"), rows[0]]
    train = [x if x[0] < 300 else (x[0], None, x[2]) for x in labels]
    lab = spark.createDataFrame(train + [(5, 0, 1), (None, 1, 1)],
                                "doc_id long, low_quality int, toxic int")
    out = score_documents(make(spark, rows), lab).collect()
    assert len(out) == len(rows)
    truth = {i: t for i, _, t in labels}
    held = [r for r in out if r["doc_id"] is not None and 300 <= r["doc_id"] < 600]
    wrong = [r["doc_id"] for r in held if r["rejected"] != bool(truth[r["doc_id"]])]
    assert len(wrong) <= 0.02 * len(held)
    assert all(not r["rejected"] for r in out if not r["text"])


def test_chain_feeds_out_of_fold_probabilities():
    """The second category is the first one again: its model leans on the chained input."""
    rng = random.Random(1)
    y = np.array([[i % 2, i % 2] for i in range(200)])
    texts = pa.array([("mark " if v[0] else "") + " ".join(
        f"w{rng.randrange(50)}" for _ in range(20)) for v in y])
    chain = fit_chain(features_of(texts), y, np.arange(200) % 5, n_features=0 + 20)
    assert len(chain[0].chained) == 0 and chain[1].chained[0] > 1


def test_chain_without_labels(spark):
    lab = spark.createDataFrame([], "doc_id long, low_quality int, toxic int")
    out = score_documents(make(spark, [(1, "a b", "s"), (2, None, "s")]), lab).collect()
    assert [r["rejected"] for r in out] == [False, False]


def test_word_encoder_equals_the_tokenizer(tokenizer):
    texts = [t for _, t, _ in corpus()] + [
        "Don't we'll I'M it's '' 's", "A.B,c!! 12ab3 x'y''z", "İstanbul ΣΑΣ ΟΔΟΣ. ﬁne",
        "é café. <|endoftext|> a<|startoftext|>b", "\x1c \x85x ‍", "ǅ ǆ Ⅷ ½"]
    got = WordEncoder(vocabulary()).encode(pa.array(texts, pa.string()), end_id=2)
    want = tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
    for i, e in enumerate(want):
        assert got.ids[got.offsets[i]:got.offsets[i + 1]].tolist() == [*e.ids, 2], texts[i]


def test_pack(docs, tokenizer):
    cap = 128
    rows = pack(docs, vocabulary(), end_id=1, capacity=cap).collect()
    want = collections.Counter()
    for i, t, _ in corpus():
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        for p, a in enumerate(range(0, len(ids), cap)):
            want[(i, p, a, len(ids[a:a + cap]), zlib.crc32(ids[a:a + cap]))] += 1
    assert collections.Counter(tuple(r)[:5] for r in rows) == want
    full = collections.defaultdict(list)
    for r in rows:
        full[r["sequence_id"]].append((r["offset"], r["length"]))
    for parts in full.values():
        at = 0
        for o, n in sorted(parts):
            assert o == at
            at += n
        assert at <= cap
    least = -(-sum(r["length"] for r in rows) // cap)
    assert len(full) <= least + 1


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_each_piece_once(seed):
    rng = np.random.default_rng(seed)
    cap = 200
    counts = np.zeros(cap + 1, dtype=np.int64)
    lengths = rng.integers(1, cap + 1 if seed % 2 else 40, 3000)
    np.add.at(counts, lengths, 1)
    plan = plan_packing(counts, cap)
    used, load = collections.Counter(), collections.Counter()
    order = np.argsort(plan.length, kind="stable")
    nxt = {}
    for i in order:
        assert plan.rank[i] == nxt.get(plan.length[i], 0) or plan.rank[i] > 0
    total = int((counts * np.arange(cap + 1)).sum())
    from dockhour.llm.packing import _place
    length = np.repeat(np.arange(cap + 1), counts)
    rank = np.concatenate([np.arange(c) for c in counts])
    sequence, offset = _place(plan, length, rank)
    seen = set()
    for s, o, n in zip(sequence.tolist(), offset.tolist(), length.tolist(), strict=True):
        assert (s, o) not in seen and o + n <= cap
        seen.add((s, o))
        load[s] += n
        used[n] += 1
    assert max(load.values()) <= cap
    assert len(load) <= -(-total // cap) * 1.02 + 1


def test_token_files(docs, tokenizer):
    rows = token_files(docs, vocabulary(), end_id=2).collect()
    rows.sort(key=lambda r: r["start"])
    assert [r["start"] for r in rows] == list(np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1])
    ids = [(-1 if r["doc_id"] is None else r["doc_id"]) for r in rows]
    assert ids == sorted(ids)
    want = collections.Counter()
    for i, t, _ in corpus():
        x = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        want[(i, len(x), zlib.crc32(x))] += 1
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows) == want


def test_token_file_reads_single_documents_and_finds_damage():
    rng = np.random.default_rng(0)
    docs = [rng.integers(0, 49408, n).astype("<u4") for n in (1, 200_000, 0, 5, 70_000)]
    sink = io.BytesIO()
    w = TokenFileWriter(sink)
    for i, d in enumerate(docs):
        w.add(np.array([i * 10]), np.array([i == 3]), d, np.array([len(d)]))
    w.close()
    raw = sink.getvalue()
    r = TokenFileReader(io.BytesIO(raw), len(raw))
    for i in (4, 0, 2, 1, 3):
        assert np.array_equal(r.ids(i), docs[i])
    assert r.doc_id.tolist() == [0, 10, 20, 30, 40] and r.is_null.tolist()[3]
    frames = []
    frame = r.frame
    r.frame = lambda i: frames.append(i) or frame(i)
    r.ids(3)
    assert len(set(frames)) == 1
    bad = bytearray(raw)
    bad[40] ^= 0xFF
    with pytest.raises(Exception):
        TokenFileReader(io.BytesIO(bytes(bad)), len(bad)).ids(1)


def test_empty_tables(spark):
    none = make(spark, []).limit(0)
    assert jaccard_components(none).count() == 0
    assert remove_repeated_windows(none, log2_cells=19).count() == 0
    assert pack(none, vocabulary()).count() == 0
    assert token_files(none, vocabulary()).count() == 0
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert extract_main_text(pages).count() == 0


PAGE = ("<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t=\"</p>\";"
        "</script></head><body><header>Site</header><nav><ul><li><a href='/a'>Menu {i}</a></ul>"
        "</nav><div class='cookie-notice'>We use cookies</div><div>Always the same line</div>"
        "<article><h1>Head {i}</h1><p>One &amp; <b>t</b>wo\n  &lt;{i}&gt;<p>Next<br>line"
        "<form><input>Name</form><div class=\"ad\">Buy</div><!-- <p>no</p> --></article>"
        "<aside>Side</aside><section id=comments><p>First!</p></section>"
        "<footer>&copy; {i}</footer></body></html>")


def test_main_text(spark):
    rows = [(i, f"https://host.example/{i}", PAGE.format(i=i), 1) for i in range(6)]
    want = {i: f"Head {i} One & two <{i}> Next line" for i in range(6)}
    plain = ("<html><body><div>Shared words of the site</div><div class=x><p>Only {i}</p>"
             "<p>tail {i}</p></div></body></html>")
    for i in range(6, 10):
        rows.append((i, f"http://plain.example:80/{i}", plain.format(i=i), 1))
        want[i] = f"Only {i} tail {i}"
    named = ("<body><div id='page'><div class='site-header'>Top</div><div id='content'><div class="
             "'post-header'><h2>Head {i}</h2></div><p>Body {i}</p><p hidden>no</p><p style='display: "
             "none'>no</p><div class='social-share'>Share</div></div><div>Other {i}</div></div></body>")
    for i in range(20, 23):
        rows.append((i, f"http://named.example/{i}", named.format(i=i), 1))
        want[i] = f"Head {i} Body {i}"
    rows += [(10, None, "<p>Lone &#233; text", 1), (11, "bad url", None, 1), (12, "u", "", 1),
             (13, "http://one.example/", "no markup at all", 1),
             (14, "http://cut.example/", "<article><p>Cut <b>off &am", 1),
             (15, "http://x.example/", "a < b <i>c</i>d<script>x", 1),
             (16, "http://long.example/", "<article>" + "<p>word " * 30000 + "</article>", 1)]
    want |= {10: "Lone é text", 11: "", 12: "", 13: "no markup at all", 14: "Cut off &am",
             15: "a < b cd", 16: " ".join(["word"] * 30000)}
    rows.append(rows[0])
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = extract_main_text(pages.repartition(3)).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["text"] == want[r["page_id"]], r["page_id"]
        assert r["n_chars"] == len(r["text"])
