"""Pooling sources and de-duplication."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window, functions as F


def pool_sources(official: DataFrame, supplemental: list[DataFrame]) -> DataFrame:
    """Official + supplemental rows, tagged ``is_supplementary`` and ``source_rank``
    (0 = official, then the order of ``supplemental``)."""
    frames = [official.withColumns({"is_supplementary": F.lit(False), "source_rank": F.lit(0)})]
    for i, s in enumerate(supplemental, start=1):
        frames.append(s.withColumns({"is_supplementary": F.lit(True), "source_rank": F.lit(i)}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def dedup_prefer_official(pool: DataFrame, keys=("city_key", "station_key", "ts")) -> DataFrame:
    """One row per key, the lowest ``source_rank`` wins (official even when its
    demand is a reconstructed zero).  A window per key holds one row per source."""
    w = Window.partitionBy(*keys).orderBy("source_rank")
    return (pool.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1)
            .drop("_rn"))


def concat_extracts(frames: list[DataFrame]) -> DataFrame:
    """U4: union extracts by column name (missing columns become NULL)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
