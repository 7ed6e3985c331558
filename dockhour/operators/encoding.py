"""Hierarchical target encoding with fallback.

Levels, specific to general: (station, hour-of-week) -> station -> (city,
hour-of-week) -> city -> global.  The station levels are keyed by station id
only (equal ids in two cities share a mean), as in the reference.

Out-of-fold encoding does not loop over folds: sums and counts are
aggregated per (city, station, hour-of-week, fold) once, all levels roll up from
that, totals come from a window over those small aggregates, and each row reads ``(S_all - S_fold) / (N_all - N_fold)``.
The global level is a ``k``-row table.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

LEVELS = {
    "station_how": ["station_key", "how"],
    "station": ["station_key"],
    "city_how": ["city_key", "how"],
    "city": ["city_key"],
}


FINEST = ["city_key", "station_key", "how"]


def _sums(df: DataFrame, *more: str) -> DataFrame:
    """Sum and count of demand per (city, station, hour of week): the one aggregate that reads the
    rows.  It is written once and every level and the global mean roll up from it."""
    d = F.col("demand").cast("double")
    return cut_lineage(df.groupBy(*FINEST, *more).agg(F.sum(d).alias("_s"), F.count(d).alias("_c")))


def te_fit(train: DataFrame) -> dict[str, DataFrame | Column]:
    """Four mean-demand lookups plus the global mean (a scalar-subquery column)."""
    mean = F.sum("_s") / F.nullif(F.sum("_c"), F.lit(0))
    base = _sums(train)
    enc: dict = {}
    for name, keys in LEVELS.items():
        not_null = F.lit(True)
        for k in keys:                      # grouping drops NULL keys, as pandas does
            not_null = not_null & F.col(k).isNotNull()
        enc[name] = base.filter(not_null).groupBy(*keys).agg(mean.alias(f"_te_{name}"))
    enc["global"] = base.select(mean).scalar()
    return enc


def _chain(city, city_how, station, station_how, glob) -> dict[str, Column]:
    city_te = F.coalesce(city, glob)
    station_te = F.coalesce(station, city_te)
    return {"te_city": city_te, "te_city_how": F.coalesce(city_how, city_te),
            "te_station": station_te, "te_station_how": F.coalesce(station_how, station_te)}


def te_transform(df: DataFrame, enc: dict) -> DataFrame:
    """Left-join the lookups and apply the fallback chain."""
    out = df
    for name, keys in LEVELS.items():
        out = out.join(enc[name], keys, "left")
    cols = _chain(F.col("_te_city"), F.col("_te_city_how"), F.col("_te_station"),
                  F.col("_te_station_how"), enc["global"])
    return out.withColumns(cols).drop(*[f"_te_{n}" for n in LEVELS])


def te_oof(df: DataFrame, fold_col: str = "fold") -> DataFrame:
    """Every row encoded from the other folds only, at every level incl. city and global."""
    base = _sums(df, fold_col)

    def others(keys: list[str], name: str) -> DataFrame:
        per = base.groupBy(*keys, fold_col).agg(F.sum("_s").alias("_s"), F.sum("_c").alias("_c"))
        w = Window.partitionBy(*keys)
        return per.select(*keys, fold_col, (
            (F.sum("_s").over(w) - F.col("_s"))
            / F.nullif(F.sum("_c").over(w) - F.col("_c"), F.lit(0))).alias(f"_te_{name}"))

    out = df
    for name, keys in LEVELS.items():
        out = out.join(others(keys, name), keys + [fold_col], "left")
    out = out.join(others([], "global"), fold_col, "left")
    cols = _chain(F.col("_te_city"), F.col("_te_city_how"), F.col("_te_station"),
                  F.col("_te_station_how"), F.col("_te_global"))
    return out.withColumns(cols).drop(*[f"_te_{n}" for n in LEVELS], "_te_global")
