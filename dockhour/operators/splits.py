"""Temporal splits, folds, samples and weights.

Quantile cut.  Spark's exact ``percentile`` keeps a value->count map per
group in one task, which does not survive a hot city with billions of
distinct microsecond timestamps, and ``percentile_approx`` does not
interpolate.  ``exact_quantile`` finds the two order statistics around
``p·(n-1)`` by refining buckets (hour -> second -> microsecond): each level is
a partial-aggregated count per bucket inside the buckets selected by the
previous level, plus a running sum over at most 3,600 / 1,000,000 buckets.
The result equals linear-interpolation quantiles (pandas, DuckDB
``quantile_cont``), rounded to the microsecond.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..schemas import HOLDOUT_CITY, VAL_FRACTION
from ..session import cut_lineage

HOUR_US = 3_600_000_000
SECOND_US = 1_000_000
LEVELS = (HOUR_US, SECOND_US, 1)


def micros(ts) -> Column:
    """Microseconds since 1970-01-01 of a ``timestamp_ntz`` (no time-zone involved)."""
    t = F.col(ts) if isinstance(ts, str) else ts
    return F.timestamp_diff("MICROSECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), t)


def from_micros(us) -> Column:
    us = F.col(us) if isinstance(us, str) else us
    return F.timestamp_add("MICROSECOND", us, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def _bucket(width: float, integer: bool) -> Column:
    """Bucket number of ``_v``.  Buckets nest exactly: integers by whole division, doubles because
    their widths are powers of two, so that dividing by one does not round."""
    if integer:
        w = F.lit(int(width)).cast("bigint")
        return ((F.col("_v") - F.pmod(F.col("_v"), w)) / w).cast("double")
    return F.floor(F.col("_v") / F.lit(width)).cast("double")


def exact_quantile(df: DataFrame, groups, value_col: str, p: float, levels=LEVELS,
                   out: str = "q", integer: bool = True) -> DataFrame:
    """Linear-interpolation quantile per group, exact, with bounded per-task state.

    ``integer``: values are longs and the last level width must be 1 (result rounded
    to an integer).  Otherwise values are doubles, ``levels`` are bucket widths in
    value units, each a power of two, and a final level groups the exact values inside
    the selected finest bucket.  An empty ``groups`` list means one global group."""
    groups = list(groups)
    src = df
    if not groups:
        src, groups = df.withColumn("_g", F.lit(0)), ["_g"]
    vcol = F.col(value_col).cast("bigint" if integer else "double")
    v = src.select(*groups, vcol.alias("_v")).filter(F.col("_v").isNotNull() & ~F.isnan("_v"))
    n = v.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    pos = F.lit(float(p)) * (F.col("_n") - 1)
    base = n.select(*groups, F.floor(pos).alias("_lo"), (pos - F.floor(pos)).alias("_frac"), F.col("_n"))
    targets = base.select(*groups, F.col("_frac"), F.explode(F.array(
        F.struct(F.lit("lo").alias("which"), F.col("_lo").alias("rank")),
        F.struct(F.lit("hi").alias("which"),
                 F.least(F.col("_lo") + 1, F.col("_n") - 1).alias("rank")))).alias("t"))
    targets = targets.select(*groups, "_frac", "t.which", "t.rank",
                             F.lit(None).cast("double").alias("parent"),
                             F.lit(0).cast("bigint").alias("start"))
    steps = [(float(w), False) for w in levels] + ([] if integer else [(None, True)])
    prev_width = None
    for i, (width, exact) in enumerate(steps):
        bucket = F.col("_v").cast("double") if exact else _bucket(width, integer)
        rows = v.withColumn("bucket", bucket)
        if prev_width is None:
            pkeys = groups
        else:
            rows = rows.withColumn("parent", _bucket(prev_width, integer))
            sel = targets.select(*groups, "parent").distinct()      # <= 2 rows per group
            rows = rows.join(sel, groups + ["parent"], "left_semi")
            pkeys = groups + ["parent"]
        counts = rows.groupBy(*pkeys, "bucket").agg(F.count(F.lit(1)).alias("_c"))
        w = Window.partitionBy(*pkeys).orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumn("_before", F.coalesce(F.sum("_c").over(w), F.lit(0)))
        hit = targets.join(counts, pkeys, "inner").filter(
            (F.col("rank") >= F.col("start") + F.col("_before"))
            & (F.col("rank") < F.col("start") + F.col("_before") + F.col("_c")))
        targets = hit.select(*groups, "_frac", "which", "rank", F.col("bucket").alias("parent"),
                             (F.col("start") + F.col("_before")).alias("start"))
        # <= 2 rows per group, read twice by the next level: cut the lineage so the
        # levels do not re-derive each other
        if i < len(steps) - 1:
            targets = cut_lineage(targets)
        prev_width = width
    scale = F.lit(1.0) if not integer else F.lit(float(prev_width))
    val = F.col("parent") * scale
    vals = targets.groupBy(*groups).agg(
        F.first("_frac").alias("_frac"),
        F.max(F.when(F.col("which") == "lo", val)).alias("_a"),
        F.max(F.when(F.col("which") == "hi", val)).alias("_b"))
    q = F.col("_a") + (F.col("_b") - F.col("_a")) * F.col("_frac")
    res = F.round(q).cast("bigint") if integer else q
    keep = [g for g in groups if g != "_g"]
    return vals.select(*keep, res.alias(out))


COORD_LEVELS = (1.0, 2.0 ** -10, 2.0 ** -20)


def exact_median(df: DataFrame, groups, value_col: str, out: str | None = None) -> DataFrame:
    """Exact median of a double column per group (``groups`` may be empty) without a
    per-group value map: buckets of 1, 2**-10 and 2**-20, then the exact values."""
    return exact_quantile(df, groups, value_col, 0.5, levels=COORD_LEVELS, out=out or value_col,
                          integer=False)


def temporal_split_rides(rides: DataFrame, time_col: str = "started_at", city_col: str = "city",
                         val_fraction: float = VAL_FRACTION) -> tuple[DataFrame, DataFrame]:
    """Per city, rides at or before the (1 - val_fraction) time quantile -> train,
    after -> val.  Rows with a NULL city or time fall in neither part."""
    r = rides.filter(F.col(city_col).isNotNull()).withColumn("_us", micros(time_col))
    cuts = exact_quantile(r, [city_col], "_us", 1.0 - val_fraction, out="_cut")
    out = (r.join(cuts, city_col, "inner")
           .withColumn("split", F.when(F.col("_us") <= F.col("_cut"), F.lit("train"))
                       .when(F.col("_us") > F.col("_cut"), F.lit("val")))
           .filter(F.col("split").isNotNull()).drop("_us", "_cut"))
    cutoffs = cuts.select(city_col, from_micros("_cut").alias("cutoff"))
    return out, cutoffs


class LeakageError(AssertionError):
    pass


def leak_guard(splits: DataFrame, holdout_city: str, city_col: str = "city_key") -> None:
    """The holdout city must exist and must be absent from train and val."""
    if not splits.filter(F.col(city_col) == holdout_city).limit(1).count():
        raise ValueError(f"no row belongs to the city held out, {holdout_city!r}")
    leaked = (splits.filter((F.col(city_col) == holdout_city) & F.col("split").isin("train", "val"))
              .limit(1).count())
    if leaked:
        raise LeakageError(f"rows of {holdout_city!r}, which is held out, are among the train or val rows")


def split_table(pool: DataFrame, holdout_city: str = HOLDOUT_CITY,
                val_fraction: float = VAL_FRACTION, materialize: bool = True,
                levels=(HOUR_US,)) -> tuple[DataFrame, DataFrame]:
    """P2 core: holdout city -> test_unseen; other cities cut per city on table rows.

    Table times are hour ticks, so one hour-level bucket pass is already exact
    (pass ``levels=LEVELS`` for arbitrary times).  The pooled table is read by
    the guard, the cut and the tagging, so it is checkpointed once into the
    shared checkpoint folder (the Spark form of the reference's table cache).
    """
    if materialize:
        pool = cut_lineage(pool)
    if not pool.filter(F.col("city_key") == holdout_city).limit(1).count():
        raise ValueError(f"no row belongs to the city held out, {holdout_city!r}")
    pool = pool.withColumn("_us", micros("ts"))
    in_dist = pool.filter(F.col("city_key") != holdout_city)
    cuts = exact_quantile(in_dist, ["city_key"], "_us", 1.0 - val_fraction, levels=levels,
                          out="_cut")
    # One pass tags every row: cities without a cut (no rows with a time) fall in no part.
    split = (F.when(F.col("city_key") == holdout_city, F.lit("test_unseen"))
             .when(F.col("_us") <= F.col("_cut"), F.lit("train"))
             .when(F.col("_us") > F.col("_cut"), F.lit("val")))
    out = (pool.join(cuts, "city_key", "left").withColumn("split", split)
           .filter(F.col("split").isNotNull()).drop("_us", "_cut"))
    cutoffs = cuts.select("city_key", from_micros("_cut").alias("cutoff"))
    return out, cutoffs


def hash_unit(cols, seed: int = 42) -> Column:
    """Deterministic 32-bit integer from md5(seed || key) (same digits in DuckDB)."""
    parts = [F.lit(str(seed))]
    for c in cols:
        parts += [F.lit("|"), (F.col(c) if isinstance(c, str) else c).cast("string")]
    return F.conv(F.substring(F.md5(F.concat(*parts)), 1, 8), 16, 10).cast("bigint")


def kfold_assign(df: DataFrame, key_cols, k: int, seed: int = 42, out: str = "fold") -> DataFrame:
    """Fold in 0..k-1 by hash of the row key (deterministic; not sklearn's draw)."""
    return df.withColumn(out, F.pmod(hash_unit(key_cols, seed), F.lit(k)).cast("int"))


def fraction_sample(df: DataFrame, key_cols, fraction: float, seed: int = 42) -> DataFrame:
    """P5: keep rows whose key hash falls below ``fraction`` (deterministic)."""
    return df.filter(hash_unit(key_cols, seed) / F.lit(float(2 ** 32)) < F.lit(float(fraction)))


def shuffle_rows(df: DataFrame, key_cols, seed: int = 7) -> DataFrame:
    """A different but deterministic row order (range-partitioned sort)."""
    return df.orderBy(hash_unit(key_cols, seed), *key_cols)


def city_balanced_weights(df: DataFrame, city_col: str = "city_key", out: str = "weight") -> DataFrame:
    """1/n_city scaled to mean 1, i.e. N / (K * n_city).

    Counts come from one aggregate; the totals run over the per-city table
    (one row per city), and the weights join back on the city.
    """
    per_city = df.groupBy(city_col).agg(F.count(F.lit(1)).alias("_nc"))
    all_c = Window.partitionBy()
    per_city = per_city.withColumn(
        out, F.sum("_nc").over(all_c) / (F.count(F.lit(1)).over(all_c) * F.col("_nc")))
    return df.join(per_city.select(city_col, out), city_col, "left")


def split_stats(splits: DataFrame) -> DataFrame:
    """Rows, mean demand, zero rate, max demand and supplementary rows per split x city."""
    d = F.col("demand")
    aggs = [F.count(F.lit(1)).alias("rows"), F.avg(d.cast("double")).alias("mean_demand"),
            F.avg((d == 0).cast("double")).alias("zero_rate"), F.max(d).alias("max_demand")]
    if "is_supplementary" in splits.columns:
        aggs.append(F.count_if(F.col("is_supplementary")).alias("supplementary_rows"))
    return splits.groupBy("split", "city_key").agg(*aggs)
