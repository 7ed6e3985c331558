"""Main text of pages by template deduction over the pages of a host.

Tokens are elements by their path and texts by path and content.  Tokens that occur equally often
on every page of a host have the same occurrence vector and form an equivalence class; a class is
valid when it has several tokens on most of the host's pages and each of its elements lies inside
an element of a valid class.  Valid classes, nested by their paths, are the host's template: its
own texts go, in an article too, and what is left are slots.  A text in an element that repeats
within a slot belongs to the template when enough pages have it.  Slots are told apart by the
elements around them: those of navigation, notices, adverts and the like are not main text, and
where slots of an article (or main) element, or of one named as content, are left, only those are.
"""
from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, written

# Fixed values of HTML: elements without content, elements whose content is not markup, and
# elements that stand in a line of text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math".split())
INLINE = frozenset("a abbr b bdi bdo big cite code data del dfn em font i ins kbd label mark q s "
                   "samp small span strike strong sub sup time tt u var wbr".split())
# What is not main text: by element, and by a word of a class, id or role.
SIDE_ELEMENTS = frozenset("head nav footer aside form script style noscript template iframe button "
                          "select textarea dialog menu object svg math".split())
SIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner "
    "cookie cookies consent gdpr notice notices alert popup modal overlay menu nav navbar "
    "navigation breadcrumb breadcrumbs sidebar side aside footer foot header masthead topbar "
    "comment comments reply replies respond disqus share sharing social related recommended "
    "newsletter subscribe subscription signup login search widget pagination pager toolbar "
    "disclaimer privacy legal copyright contentinfo complementary".split())
# Inside an article these name parts of the article.
ARTICLE_WORDS = frozenset("header masthead topbar".split())
MAIN = frozenset(("article", "main"))
# Their class words tell about the page.
WHOLE = frozenset(("html", "body", "main"))
# Classes and ids of the main part where a page has no article or main element.
CONTENT_WORDS = frozenset("content article post entry story main articlebody maincontent".split())
HIDDEN_STYLE = re.compile(r"(?:^|;)\s*display\s*:\s*none\b", re.I)
CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure "
                     "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table "
                     "ul".split())
SAME_LEVEL = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"),
              "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}

MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([a-zA-Z][^\s/>]*)((?:\"[^\"]*\"|'[^']*'|[^>\"'])*)(?:>|\Z)", re.S)
# One whole attribute, so that nothing inside another one's value is read as a name.
ATTRIBUTE = re.compile(r"([^\s\"'>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"


class Block(NamedTuple):
    """Text of a block and where it stands.

    ``main`` is 2 inside an article or main element, 1 inside an element with such a class or id,
    else 0; ``beside`` tells what is not main text."""
    path: str
    text: str
    main: int
    beside: bool


class Element(NamedTuple):
    name: str
    path: str
    main: int
    beside: bool
    worded: bool
    firm: bool
    at: int


class Page(NamedTuple):
    blocks: list[Block]
    paths: list[tuple[str, str]]


def _attributes(raw: str) -> dict[str, str]:
    """Values by name in lower case; the first of several counts."""
    out: dict[str, str] = {}
    for a in ATTRIBUTE.finditer(raw):
        out.setdefault(a[1].lower(), a[2] or a[3] or a[4] or "")
    return out


def _hidden(attributes: dict[str, str]) -> bool:
    return ("hidden" in attributes or attributes.get("aria-hidden", "").strip().lower() == "true"
            or bool(HIDDEN_STYLE.search(attributes.get("style", ""))))


def parse(source: str) -> Page:
    """Blocks of text in order, and the path and parent's path of each element.

    Class words of html, body and main say nothing about what stands in them.  Nor do those of an
    element around an article or main element, unless the page has another one that is not so
    surrounded: then a list of teasers is still beside.
    """
    page, wrappers = _walk(source, frozenset())
    return _walk(source, wrappers)[0] if wrappers else page


def _walk(source: str, wrappers: frozenset[int]) -> tuple[Page, frozenset[int]]:
    """The page, and the elements (by their place in the source) that would put its article or main
    elements beside by class words alone; ``wrappers`` are let off."""
    root = Element("", "", 0, False, False, False, -1)
    stack, blocks, paths, piece = [root], [], [], []
    around: set[int] = set()
    free: set[int] = set()
    at = 0

    def end_block():
        text = " ".join(html.unescape("".join(piece)).split())
        if text:
            block = next(e for e in reversed(stack) if e.name not in INLINE)
            blocks.append(Block(block.path, text, stack[-1].main, stack[-1].beside))
        piece.clear()

    def close_to(depth: int):
        end_block()
        del stack[depth:]

    while at < len(source):
        m = MARKUP.search(source, at)
        if m is None:
            piece.append(source[at:])
            break
        piece.append(source[at:m.start()])
        at = m.end()
        if m[2] is None:  # a comment or declaration
            continue
        name = m[2].lower()
        if m[1]:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i].name == name), 0)
            if name in INLINE:
                if depth and all(e.name in INLINE for e in stack[depth:]):
                    if stack[depth].beside != stack[depth - 1].beside:
                        end_block()
                    del stack[depth:]
            elif depth:
                close_to(depth)
            continue
        if name in VOID:
            if name == "br" or name not in INLINE:
                piece.append(" ") if name == "br" else end_block()
            continue
        attributes = _attributes(m[3]) if m[3] else {}
        words = {w for a in ("class", "id", "role") if a in attributes
                 for w in re.split(r"[^a-z0-9]+", attributes[a].lower())}
        label = ".".join([name, *sorted(w for w in words if w and not w.isdigit())])
        if name not in INLINE:
            shut = ("p",) if name in CLOSES_P else SAME_LEVEL.get(name, ())
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in shut:
                    close_to(i)
                    break
                if stack[i].name not in INLINE and stack[i].name != "p":
                    break
            end_block()
        up = stack[-1]
        side = SIDE_WORDS - ARTICLE_WORDS if up.main else SIDE_WORDS
        worded = bool(words & side) and name not in WHOLE and m.start() not in wrappers
        firm = (up.firm or name in SIDE_ELEMENTS or name == "header" and not up.main
                or bool(attributes) and _hidden(attributes))
        beside = up.beside or worded or firm
        if beside and not up.beside:
            end_block()
        main = 2 if name in MAIN else int(name not in INLINE and bool(words & CONTENT_WORDS))
        own = Element(name, f"{up.path}/{label}", up.main if beside else max(up.main, main), beside,
                      worded, firm, m.start())
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>", re.I).search(source, at)
            at = end.end() if end else len(source)
            continue
        if m[3].rstrip().endswith("/") and name in ("svg", "math"):
            continue
        if name in MAIN and not worded and not firm:
            around.update(e.at for e in stack if e.worded)
            free.difference_update(e.at for e in stack if e.name == "main")
            if not up.beside:
                free.add(own.at)
        stack.append(own)
        if name not in INLINE:
            paths.append((own.path, up.path))
    end_block()
    return Page(blocks, paths), frozenset() if free else frozenset(around)


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)


def main_text(page: Page, fixed: frozenset[int]) -> str:
    """The page's slots that are main text, joined by one space."""
    slots = [b for b in page.blocks if not b.beside and _hash(b.path, b.text) not in fixed]
    best = max((b.main for b in slots), default=0)
    return " ".join(b.text for b in slots if b.main == best)


def _host(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")))


# Pages that must have a text whose own element repeats within a slot.
REPEATED_MIN_PAGES = 8
OCCURRENCES = ("host string, token long, parent long, is_text boolean, n_pages long, v1 long, "
               "v2 long, low long, high long")


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens of a batch by host: pages that have them, their share of the vector, and the least
    and greatest key of these pages."""
    for batch in batches:
        held: dict[tuple[str, int, int, bool], list[int]] = {}
        for host, key, source in zip(batch["host"].to_pylist(), batch["key"].to_pylist(),
                                     batch["html"].to_pylist(), strict=True):
            page = parse(source or "")
            seen = Counter((_hash(p), _hash(up), False) for p, up in page.paths)
            seen.update((_hash(b.path, b.text), _hash(b.path), True) for b in page.blocks)
            seen[(0, 0, False)] = 1  # the page itself
            for token, n in seen.items():
                v = xxhash.xxh3_64_intdigest(key.to_bytes(8, "little", signed=True), seed=n)
                row = held.setdefault((host, *token), [0, 0, 0, key, key])
                row[0] += 1
                row[1] += v & 0xFFFFFFFF
                row[2] += v >> 32
                row[3] = min(row[3], key)
                row[4] = max(row[4], key)
        names, sums = list(held), np.array(list(held.values()), dtype=np.int64).reshape(-1, 5)
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
        yield pa.record_batch([
            *[pa.array([k[i] for k in names], kind) for i, kind in enumerate(kinds)],
            *[pa.array(sums[:, i]) for i in range(5)]],
            names=["host", "token", "parent", "is_text", "n_pages", "v1", "v2", "low", "high"])


def _template(tokens: pd.DataFrame) -> pd.DataFrame:
    """Tokens of the valid classes of one host, nested from the outermost inwards."""
    classes = tokens.groupby(["v1", "v2"]).token.transform("size")
    solid = tokens[classes > 1]
    root = _hash("")
    inside, template = {root}, set()
    while True:
        new = set(solid[solid.parent.isin(inside)].token) - template
        if not new:
            break
        template |= new
        inside |= new
    template |= set(solid[solid.is_text & (solid.n_pages >= REPEATED_MIN_PAGES)].token)
    return pd.DataFrame({"host": [tokens.host.iloc[0]],
                         "template": [sorted(int(t) for t in template)]})


def host_templates(pages: DataFrame, min_share: float = 0.5, min_pages: int = 2) -> DataFrame:
    """Per host the tokens of its template (hashes).

    Tokens on less than ``min_share`` of a host's pages, or on fewer than ``min_pages``, are left
    out before a host's tokens meet, so at most 1 / min_share times a page's tokens do.  So are
    tokens that only copies of one page have (pages with one ``key``).
    """
    counts = (pages.mapInArrow(_occurrences, OCCURRENCES)
              .groupBy("host", "token", "parent", "is_text")
              .agg(*[F.sum(c).alias(c) for c in ("n_pages", "v1", "v2")],
                   F.min("low").alias("low"), F.max("high").alias("high")))
    counts = written(counts, "page-tokens")
    hosts = written(counts.filter("token = 0").select(
        "host", F.col("n_pages").alias("host_pages")), "page-hosts")
    common = (counts.filter((F.col("token") != 0) & (F.col("n_pages") >= min_pages)
                            & (F.col("low") < F.col("high")))
              .join(hosts, "host").filter(F.col("n_pages") >= min_share * F.col("host_pages")))
    return written(common.select("host", "token", "parent", "is_text", "n_pages", "v1", "v2")
                   .groupBy("host")
                   .applyInPandas(_template, "host string, template array<long>"), "templates")


def extract_main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
                      html_col: str = "html") -> DataFrame:
    """``page_id``, ``url``, main ``text`` and its length in code points for every page.

    Null and empty pages have an empty text.  Null urls and urls without a host share one group.  A
    host with a single page has no template beyond the page's own structure, so only the elements
    around its texts decide.  Every input row gives one row; other columns are not read.
    """
    ship(pages.sparkSession)
    p = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                     F.col(html_col).alias("html"), _host(F.col(url_col)).alias("host"))
    templates = host_templates(p.select("host", F.xxhash64("html").alias("key"), "html"))
    kind = {f.name: f.dataType.simpleString() for f in p.schema.fields}

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[tuple, frozenset[int]] = {}
        for b in batches:
            texts = []
            for host, source, tokens in zip(b["host"].to_pylist(), b["html"].to_pylist(),
                                            b["template"], strict=True):
                if host not in known:
                    known[host] = frozenset(tokens.as_py() or ())
                texts.append(main_text(parse(source or ""), known[host]))
            yield pa.record_batch([b["page_id"], b["url"], pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())],
                                  names=["page_id", "url", "text", "n_chars"])

    return p.join(templates, "host", "left").mapInArrow(
        extract, f"page_id {kind['page_id']}, url {kind['url']}, text string, n_chars long")
