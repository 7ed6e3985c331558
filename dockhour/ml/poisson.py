"""Gradient boosting on the Poisson deviance over MLlib regression trees (M1, M4).

Each round fits one MLlib regression tree to the negative gradient ``label - exp(margin)``, then
replaces its leaf values by one Newton step, ``sum(w * (label - mu)) / sum(w * mu)`` of the leaf:
one grouped aggregate of at most 2^depth rows.  Weights enter both.  Rounds are written in chunks,
each with the rows' margins after it, so a fit that dies goes on after its last whole chunk.
"""
from __future__ import annotations

from dataclasses import dataclass
from hashlib import md5
from math import log

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import DataFrame, SparkSession, functions as F

NODES = ("round INT, node INT, left INT, right INT, feature INT, threshold DOUBLE, value DOUBLE")
LEAST_MEAN = 1e-9


@dataclass
class PoissonModel:
    """Trees as rows of (round, node, left, right, feature, threshold, value); a leaf has left -1."""
    features: list
    base: float
    step: float
    trees: list

    def predict(self, df: DataFrame, out: str = "prediction") -> DataFrame:
        """``df`` with the expected count; null and NaN features count as 0 with their indicator set."""
        base, step = self.base, self.step
        trees = [tuple(np.array(c) for c in zip(*t, strict=True)) for t in self.trees]

        @F.pandas_udf("double")
        def expected(*columns: pd.Series) -> pd.Series:
            x = np.column_stack([c.to_numpy(dtype=float) for c in columns])
            rows, margin = np.arange(len(x)), np.full(len(x), base)
            for left, right, feature, threshold, value in trees:
                at = np.zeros(len(x), dtype=np.int64)
                while (inner := left[at] >= 0).any():
                    goes_left = x[rows, np.maximum(feature[at], 0)] <= threshold[at]
                    at = np.where(inner, np.where(goes_left, left[at], right[at]), at)
                margin += step * value[at]
            return pd.Series(np.exp(margin))

        return df.withColumn(out, expected(*_inputs(self.features)))


def _inputs(features) -> list:
    """Value and missing indicator of each feature."""
    out = []
    for c in features:
        v = F.col(f"`{c}`").cast("double")
        missing = v.isNull() | F.isnan(v)
        out += [F.when(missing, 0.0).otherwise(v), missing.cast("double")]
    return out


def _tree_rows(root) -> list:
    """(left, right, feature, threshold) of a fitted tree's nodes in pre-order."""
    rows = []

    def visit(node) -> int:
        at = len(rows)
        rows.append((-1, -1, -1, 0.0))
        if node.subtreeDepth():
            split = node.split()
            left = visit(node.leftChild())
            rows[at] = (left, visit(node.rightChild()), split.featureIndex(), split.threshold())
        return at

    visit(root)
    return rows


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def fit_poisson(train: DataFrame, features, folder: str, label: str = "demand",
                weight: str | None = None, rounds: int = 1500, step: float = 0.03, depth: int = 5,
                bins: int = 64, least_rows: int = 1, chunk: int = 25, seed: int = 42) -> PoissonModel:
    """Fit ``rounds`` trees, in chunks written below ``folder`` (a shared folder).

    Called again on the same rows with the same arguments, it goes on after the last whole chunk;
    other rows or arguments start a fit of their own.  Rows whose label is null or NaN, or whose
    weight is null, NaN or not above 0, do not take part.  A negative label or a table without rows
    raises ``ValueError``.  Other columns of ``train`` are not read.
    """
    spark, features = train.sparkSession, list(features)
    inputs = [f"x{i}" for i in range(2 * len(features))]
    w = F.lit(1.0) if weight is None else F.col(f"`{weight}`").cast("double")
    d = train.select(F.col(f"`{label}`").cast("double").alias("y"), w.alias("w"),
                     *[c.alias(x) for c, x in zip(_inputs(features), inputs, strict=True)])
    d = d.filter("y IS NOT NULL AND NOT isnan(y) AND w IS NOT NULL AND NOT isnan(w) AND w > 0")
    least, mean, count, prints = d.agg(
        F.min("y"), F.sum(F.col("w") * F.col("y")) / F.sum("w"), F.count(F.lit(1)),
        F.sum(F.xxhash64("y", "w", *inputs).cast("decimal(20,0)"))).first()
    if least is None or least < 0:
        raise ValueError("no row to fit on" if least is None else "a count is negative")
    told = repr((features, label, weight, step, depth, bins, least_rows, chunk, seed, count, prints))
    folder = f"{folder}/{md5(told.encode()).hexdigest()}"
    start = f"{folder}/rows-0"
    if not _exists(spark, f"{start}/_SUCCESS"):
        (VectorAssembler(inputCols=inputs, outputCol="x").transform(d)
         .select("x", "y", "w", F.lit(log(max(mean, LEAST_MEAN))).alias("base"))
         .withColumn("margin", F.col("base")).write.mode("overwrite").parquet(start))
    base = spark.read.parquet(start).select("base").first()[0]
    done = 0
    while done < rounds:
        upto = min(done + chunk, rounds)
        if not _exists(spark, f"{folder}/rows-{upto}/_SUCCESS"):
            _fit_chunk(spark, folder, done, upto, step, depth, bins, least_rows, seed)
        done = upto
    return load_poisson(spark, folder, features, base, step, rounds, chunk)


def _fit_chunk(spark: SparkSession, folder: str, done: int, upto: int, step: float, depth: int,
               bins: int, least_rows: int, seed: int) -> None:
    """Rounds ``done`` to ``upto``: the trees are written first, then the rows with their margins."""
    rows = spark.read.parquet(f"{folder}/rows-{done}").withColumn(
        "pull", F.col("y") - F.exp("margin")).persist()
    nodes = []
    for r in range(done, upto):
        tree = DecisionTreeRegressor(
            featuresCol="x", labelCol="pull", weightCol="w", predictionCol="fitted", leafCol="leaf",
            maxDepth=depth, maxBins=bins, minInstancesPerNode=least_rows, seed=seed + r).fit(rows)
        placed = tree.transform(rows)
        newton = {int(leaf): pull / max(mu, LEAST_MEAN) for leaf, pull, mu in placed.groupBy("leaf").agg(
            F.sum(F.col("w") * F.col("pull")), F.sum(F.col("w") * F.exp("margin"))).collect()}
        shape = _tree_rows(tree._java_obj.rootNode())
        number, values = 0, []
        for at, (left, right, feature, threshold) in enumerate(shape):
            value = 0.0
            if left < 0:
                value = newton.get(number, 0.0)
                values.append(value)
                number += 1
            nodes.append((r, at, left, right, feature, threshold, value))
        gain = F.element_at(F.array(*[F.lit(v) for v in values]), F.col("leaf").cast("int") + 1)
        after = placed.withColumn("margin", F.col("margin") + step * gain).select(
            "x", "y", "w", "base", "margin", (F.col("y") - F.exp("margin")).alias("pull")).persist()
        after.count()
        rows.unpersist()
        rows = after
    spark.createDataFrame(nodes, NODES).coalesce(1).write.mode("overwrite").parquet(
        f"{folder}/trees-{upto}")
    rows.drop("pull").write.mode("overwrite").parquet(f"{folder}/rows-{upto}")
    rows.unpersist()


def load_poisson(spark: SparkSession, folder: str, features, base: float, step: float, rounds: int,
                 chunk: int) -> PoissonModel:
    """The model from its chunks; at most ``rounds`` times 2^(depth + 1) rows come to the driver."""
    trees: list = [[] for _ in range(rounds)]
    for upto in [min(a + chunk, rounds) for a in range(0, rounds, chunk)]:
        for r in spark.read.parquet(f"{folder}/trees-{upto}").orderBy("round", "node").collect():
            trees[r["round"]].append((r["left"], r["right"], r["feature"], r["threshold"], r["value"]))
    return PoissonModel(list(features), base, step, trees)
