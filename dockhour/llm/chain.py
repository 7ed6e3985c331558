"""Classifier chains of linear models on word features, for toxicity and what goes with it.

The categories are predicted one after the other; a later model also gets the probabilities of the
earlier ones.  In training those come from models that did not see the row (out-of-fold), so that a
later model learns from the kind of probabilities it meets when scoring.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import reduce
from itertools import product
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, ship, trimmed
from .tokens import release, slices

EDGES = ".,;:!?%$#*&|<>()[]{}\"'`~^+=/\\_-"
PREFIXES = (4, 5)


class Linear(NamedTuple):
    """A logistic model: bias, weights of word features, weights of earlier probabilities."""
    bias: float
    features: np.ndarray
    weights: np.ndarray
    chained: np.ndarray


def word_features(word: str) -> tuple[int, ...]:
    """The word without edge symbols in lower case, and its first letters, as 32-bit hashes."""
    w = word.strip(EDGES).lower()
    if not w:
        return ()
    return (zlib.crc32(b"w" + w.encode()),
            *(zlib.crc32(b"%d" % n + w[:n].encode()) for n in PREFIXES if len(w) > n))


class Found(NamedTuple):
    """Distinct (row, feature) pairs of a slice of texts."""
    row: np.ndarray
    feature: np.ndarray


def features_of(texts: pa.Array, only: np.ndarray | None = None) -> Found:
    """Features that occur in each text (null: none); ``only`` keeps those of a sorted array."""
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    coded = lists.flatten().dictionary_encode()
    per_word = [word_features(w) for w in coded.dictionary.to_pylist()]
    n = np.fromiter((len(f) for f in per_word), np.int64, len(per_word))
    flat = np.fromiter((f for fs in per_word for f in fs), np.int64, int(n.sum()))
    word = np.repeat(np.arange(len(n)), n)
    if only is not None:
        keep = np.isin(flat, only)
        flat, word = flat[keep], word[keep]
        n = np.bincount(word, minlength=len(n))
    start = np.cumsum(n) - n
    index = coded.indices.to_numpy(zero_copy_only=False)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    has = n[index] > 0
    index, row = index[has], row[has]
    times = n[index]
    at = np.repeat(start[index] - (np.cumsum(times) - times), times) + np.arange(times.sum())
    pairs = np.unique(np.repeat(row, times) << 32 | flat[at])
    return Found(pairs >> 32, pairs & 0xFFFFFFFF)


def _choose(found: Found, y: np.ndarray, n_features: int, min_rows: int) -> np.ndarray:
    """Features (small integers) whose presence says most about ``y`` by chi-square, sorted."""
    if not len(found.feature):
        return np.empty(0, np.int64)
    seen = np.bincount(found.feature).astype(float)
    both = np.bincount(found.feature, weights=y[found.row])
    n, pos = len(y), y.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (both * n - seen * pos) ** 2 / (seen * (n - seen) * pos * (n - pos)) * n
    chi[~np.isfinite(chi) | (seen < min_rows)] = 0
    best = np.argsort(-chi, kind="stable")[:n_features]
    return np.sort(best[chi[best] > 0])


def _design(found: Found, features: np.ndarray, rows: int, earlier: np.ndarray) -> np.ndarray:
    x = np.zeros((rows, 1 + len(features) + earlier.shape[1]))
    x[:, 0] = 1
    at = np.searchsorted(features, found.feature)
    ok = at < len(features)
    ok[ok] = features[at[ok]] == found.feature[ok]
    x[found.row[ok], 1 + at[ok]] = 1
    x[:, 1 + len(features):] = earlier
    return x


def _fit(found: Found, y: np.ndarray, earlier: np.ndarray, n_features: int, min_rows: int,
         ridge: float, steps: int = 30, weight: np.ndarray | None = None) -> Linear:
    """Logistic regression with a ridge penalty by Newton steps on the chosen features.

    ``weight`` tells how many rows each one stands for, one on average."""
    weight = np.ones(len(y)) if weight is None else weight
    prior = (y.sum() + 0.5) / (len(y) + 1)
    constant = Linear(float(np.log(prior / (1 - prior))) if 0 < y.sum() < len(y)
                      else (50.0 if len(y) and y.all() else -50.0),
                      np.empty(0, np.int64), np.empty(0), np.zeros(earlier.shape[1]))
    if not 0 < y.sum() < len(y):
        return constant
    features = _choose(found, y, n_features, min_rows)
    x = _design(found, features, len(y), earlier)
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        gradient = x.T @ (weight * (p - y)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    k = 1 + len(features)
    return Linear(float(w[0]), features, w[1:k], w[k:])


def _probability(model: Linear, found: Found, rows: int, earlier: np.ndarray) -> np.ndarray:
    z = np.full(rows, model.bias)
    if len(model.features):
        at = np.minimum(np.searchsorted(model.features, found.feature), len(model.features) - 1)
        ok = model.features[at] == found.feature
        z += np.bincount(found.row[ok], weights=model.weights[at[ok]], minlength=rows)
    z += earlier @ model.chained
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def fit_chain(found: Found, labels: np.ndarray, folds: np.ndarray, n_features: int = 200,
              min_rows: int = 2, ridge: float = 0.2,
              weight: np.ndarray | None = None) -> list[Linear]:
    """One model for each column of ``labels``, in order, each on out-of-fold earlier ones."""
    rows = len(labels)
    weight = np.ones(rows) if weight is None else weight
    names, code, seen = np.unique(found.feature, return_inverse=True, return_counts=True)
    often = seen >= min_rows
    names, keep = names[often], often[code]
    found = Found(found.row[keep], (np.cumsum(often) - 1)[code[keep]])
    earlier = np.zeros((rows, 0))
    chain = []
    for c in range(labels.shape[1]):
        y = labels[:, c].astype(float)
        chain.append(_fit(found, y, earlier, n_features, min_rows, ridge, weight=weight))
        unseen = np.zeros(rows)
        for fold in np.unique(folds):
            out = folds == fold
            number = np.cumsum(~out) - 1
            inside = ~out[found.row]
            model = _fit(Found(number[found.row[inside]], found.feature[inside]), y[~out],
                         earlier[~out], n_features, min_rows, ridge, weight=weight[~out])
            unseen[out] = _probability(model, found, rows, earlier)[out]
        earlier = np.column_stack([earlier, unseen])
    return [m._replace(features=names[m.features]) for m in chain]


def labelled_sample(docs: DataFrame, labels: DataFrame, categories: list[str], per_class: int,
                    id_col: str, text_col: str
                    ) -> tuple[np.ndarray, Found, np.ndarray, np.ndarray]:
    """Ids, features, labels and weights of at most ``per_class`` labelled rows of each label
    combination; a weight is the inverse of the share taken of its combination, one on average.

    Rows are taken in the order of a hash of the id.  Rows without an id, with a null label or one
    other than 0 and 1 are left out; of an id's several label rows the largest values count, of its
    several texts the smallest, so each id is one row of the sample however often it is listed.
    """
    known = labels.select(F.col(id_col).cast("long").alias("doc_id"), *[
        F.col(c).cast("int") for c in categories]).dropna().groupBy("doc_id").agg(
        *[F.max(c).alias(c) for c in categories])
    total = {tuple(r[c] for c in categories): r["n"] for r in known.groupBy(*categories).agg(
        F.count(F.lit(1)).alias("n")).collect()}  # one row for each label combination
    parts = []
    for values in product((0, 1), repeat=len(categories)):
        same = reduce(lambda a, b: a & b, [F.col(c) == v for c, v in
                                           zip(categories, values, strict=True)])
        parts.append(known.filter(same).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class))
    chosen = reduce(DataFrame.unionByName, parts)  # at most per_class * 2**categories rows
    ship(docs.sparkSession)

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                f = features_of(part["text"])
                ends = np.searchsorted(f.row, np.arange(part.num_rows + 1))
                blobs = [f.feature[a:b].astype("<u4").tobytes()
                         for a, b in zip(ends[:-1], ends[1:], strict=True)]
                yield pa.record_batch([part["doc_id"], *[part[c] for c in categories],
                                       pa.array(blobs, pa.binary())],
                                      names=["doc_id", *categories, "features"])

    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    rows = (texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", *categories).agg(
        F.min("text").alias("text")).mapInArrow(
        trimmed(extract), "doc_id long, " + "".join(f"{c} int, " for c in categories) + "features binary")
        .collect())
    rows.sort(key=lambda r: (r["doc_id"], bytes(r["features"])))
    found = [np.frombuffer(r["features"], "<u4").astype(np.int64) for r in rows]
    weight = np.array([max(1, total[tuple(r[c] for c in categories)] / per_class) for r in rows])
    return (np.array([r["doc_id"] for r in rows], dtype=np.int64),
            Found(np.repeat(np.arange(len(rows)), [len(f) for f in found]).astype(np.int64),
                  np.concatenate([np.empty(0, np.int64), *found])),
            np.array([[r[c] for c in categories] for r in rows],
                     dtype=np.int64).reshape(-1, len(categories)),
            weight / weight.mean() if len(rows) else weight)


def train_chain(docs: DataFrame, labels: DataFrame, categories: list[str], per_class: int = 2000,
                n_folds: int = 5, id_col: str = "doc_id", text_col: str = "text") -> list[Linear]:
    """Fit the chain on a bounded sample of labelled documents.

    Without labelled rows, or where a category has one value only, its model is a constant.
    """
    ids, found, y, weight = labelled_sample(docs, labels, categories, per_class, id_col, text_col)
    folds = np.array([zlib.crc32(int(i).to_bytes(8, "little", signed=True)) % n_folds
                      for i in ids], dtype=np.int64)
    return fit_chain(found, y, folds, weight=weight)


def chain_scores(chain: list[Linear], categories: list[str], text: Column) -> Column:
    """Struct of probabilities, a double for each category; the models are a few kilobytes."""
    only = np.unique(np.concatenate([np.empty(0, np.int64), *[m.features for m in chain]]))

    @F.arrow_udf(", ".join(f"{c} double" for c in categories))
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        yield from trimmed(scores)(batches)

    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        release()
        for texts in batches:
            out = [np.zeros((0, len(categories)))]
            for part in slices(pa.record_batch([texts], names=["text"]), "text"):
                found = features_of(part["text"], only)
                p = np.zeros((part.num_rows, 0))
                for model in chain:
                    p = np.column_stack([p, _probability(model, found, part.num_rows, p)])
                out.append(p)
            p = np.concatenate(out)
            yield pa.StructArray.from_arrays([pa.array(c) for c in p.T], names=categories)

    return score(text)


def score_documents(docs: DataFrame, labels: DataFrame,
                    categories: tuple[str, ...] = ("low_quality", "toxic"),
                    threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text",
                    **training: int) -> DataFrame:
    """All columns of ``docs`` with the struct ``scores`` and the verdict ``rejected``.

    The chain is fitted on ``labels`` (one 0/1 column for each category) and applied to every whole
    text; the last category decides.  Texts without features (null, blank, symbols only) get the
    chain's base probabilities and are never rejected.  Every input row gives one row; columns of
    ``docs`` named ``scores`` or ``rejected`` are replaced.
    """
    names = list(categories)
    ship(docs.sparkSession)
    chain = train_chain(docs, labels, names, id_col=id_col, text_col=text_col, **training)
    scored = docs.withColumn("scores", chain_scores(chain, names, F.col(text_col)))
    bare = F.translate(F.coalesce(F.col(text_col), F.lit("")), EDGES + WS_CHARS, "") == ""
    return scored.withColumn("rejected", ~bare & (F.col("scores")[names[-1]] >= threshold))


def document_labels(labels: DataFrame) -> DataFrame:
    """The categories of the labels table: low quality first, then toxicity."""
    return labels.select("doc_id", (1 - F.col("quality")).alias("low_quality"), "toxic")
