"""Poisson boosting against a plain numpy version; a fit that stopped goes on from its chunks."""
import numpy as np
import pytest

from pyspark.sql import functions as F

from dockhour.ml import models, poisson


def _best_split(x, g, w):
    def loss(m):
        return (w[m] * g[m] ** 2).sum() - (w[m] * g[m]).sum() ** 2 / w[m].sum()

    whole, best = loss(np.ones(len(g), bool)), (0.0, None)
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values[:-1], values[1:]):
            left = x[:, f] <= (a + b) / 2
            gain = whole - loss(left) - loss(~left)
            if gain > best[0] + 1e-12:
                best = (gain, left)
    return best[1]


def _leaves(x, g, w, rows, depth):
    left = _best_split(x[rows], g[rows], w[rows]) if depth else None
    if left is None:
        return [rows]
    return _leaves(x, g, w, rows[left], depth - 1) + _leaves(x, g, w, rows[~left], depth - 1)


def _plain(x, y, w, rounds, step, depth):
    margin = np.full(len(y), np.log((w * y).sum() / w.sum()))
    for _ in range(rounds):
        mu = np.exp(margin)
        for rows in _leaves(x, y - mu, w, np.arange(len(y)), depth):
            margin[rows] += step * (w[rows] * (y - mu)[rows]).sum() / (w[rows] * mu[rows]).sum()
    return np.exp(margin)


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(3)
    n = 300
    x = np.column_stack([rng.integers(0, 24, n), rng.integers(0, 7, n), rng.normal(size=n).round(1)])
    y = rng.poisson(np.exp(0.08 * x[:, 0] - 0.2 * x[:, 1] + 0.5 * x[:, 2]))
    w = rng.uniform(0.5, 2.0, n)
    rows = [(i, float(a), float(b), None if i % 11 == 0 else float(c), int(d), float(e))
            for i, ((a, b, c), d, e) in enumerate(zip(x, y, w))]
    missing = np.arange(n) % 11 == 0
    full = np.column_stack([x[:, 0], x[:, 1], np.where(missing, 0.0, x[:, 2]), missing])
    df = spark.createDataFrame(rows, "id int, hour double, day double, temp double, demand int, wt double")
    return df, full, y.astype(float), w


def test_equals_the_plain_version_and_goes_on(table, tmp_path, monkeypatch):
    df, x, y, w = table
    args = dict(features=["hour", "day", "temp"], folder=str(tmp_path / "fit"), weight="wt",
                rounds=20, step=0.1, depth=2, bins=128, chunk=8)
    real, begun, stops = poisson._fit_chunk, [], [8]

    def chunk(spark, folder, done, *rest):
        if done in stops:
            raise RuntimeError("lost")
        begun.append(done)
        real(spark, folder, done, *rest)

    monkeypatch.setattr(poisson, "_fit_chunk", chunk)
    with pytest.raises(RuntimeError):
        poisson.fit_poisson(df, **args)
    stops.clear()
    model = poisson.fit_poisson(df, **args)
    assert begun == [0, 8, 16]
    shorter = poisson.fit_poisson(df.filter("id < 200"), **{**args, "rounds": 1})
    assert begun == [0, 8, 16, 0] and len(shorter.trees) == 1
    got = [r.prediction for r in model.predict(df).orderBy("id").collect()]
    np.testing.assert_allclose(got, _plain(x, y, w, 20, 0.1, 2), rtol=1e-9)


def test_rows_that_cannot_be_fitted(spark, tmp_path):
    schema = "demand double, x double"
    with pytest.raises(ValueError):
        poisson.fit_poisson(spark.createDataFrame([(None, 1.0)], schema), ["x"], str(tmp_path / "a"))
    with pytest.raises(ValueError):
        poisson.fit_poisson(spark.createDataFrame([(-1.0, 1.0)], schema), ["x"], str(tmp_path / "b"))
    zeros = spark.createDataFrame([(0.0, 1.0), (0.0, None), (float("nan"), 2.0)], schema)
    model = poisson.fit_poisson(zeros, ["x"], str(tmp_path / "c"), rounds=2)
    assert all(r.prediction < 1e-6 for r in model.predict(zeros).collect())


def test_baseline_averages_both_models(table, tmp_path):
    df, x, y, w = table
    model = models.train_boosted_baseline(df, ["hour", "day", "temp"], str(tmp_path / "m1"), iters=2,
                                          step=0.1, depth=2, weight="wt")
    got = model.transform(df.withColumn("fitted", F.lit(1))).orderBy("id").collect()
    for r in got:
        assert r.prediction == max(0.0, 0.5 * (r.pred_base_poisson + r.pred_base))
    poisson_part = [r.pred_base_poisson for r in got]
    assert len(got) == len(y) and len(set(poisson_part)) > 1
    assert abs(np.average(poisson_part, weights=w) - np.average(y, weights=w)) < 0.2 * y.mean()
