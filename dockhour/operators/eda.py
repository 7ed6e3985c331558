"""Exploratory report numbers (E1-E21, W1-W4, W7), each one distributed aggregate.

They follow the notebook's grain: rides grouped by the *raw* station id and
``hour_ts``; pandas drops NULL group keys, so those rows are filtered first.
Wide per-column statistics are computed in one aggregate and unpivoted with
``DataFrame.unpivot`` (an Expand node, no per-column jobs).
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..schemas import POI_COLS, WEATHER_COLS


def pearson(a, b) -> Column:
    """Pearson r as an aggregate; NULL when either side has zero variance.

    ``corr`` divides by zero under ANSI mode for a constant column; this form
    returns NULL there instead of failing the job."""
    a = F.col(a).cast("double") if isinstance(a, str) else a.cast("double")
    b = F.col(b).cast("double") if isinstance(b, str) else b.cast("double")
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def _nn(df: DataFrame, *cols) -> DataFrame:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def station_hour_demand(rides: DataFrame, extra_keys=()) -> DataFrame:
    """Observed demand per (city, raw station id, hour_ts[, extra keys])."""
    keys = ["city", "start_station_id", "hour_ts", *extra_keys]
    return _nn(rides, *keys).groupBy(*keys).agg(F.count(F.lit(1)).alias("demand"))


def city_overview(rides: DataFrame) -> DataFrame:
    """Rows, share of all rows, distinct stations, first/last date, whole days."""
    per = _nn(rides, "city").groupBy("city").agg(
        F.count(F.lit(1)).alias("rows"), F.countDistinct("start_station_id").alias("stations"),
        F.min("started_at").alias("_lo"), F.max("started_at").alias("_hi"))
    total = F.sum("rows").over(Window.partitionBy())
    return per.select("city", "rows", (F.col("rows") / total).alias("share"), "stations",
                      F.to_date("_lo").alias("first_date"), F.to_date("_hi").alias("last_date"),
                      F.floor(F.timestamp_diff("SECOND", F.col("_lo"), F.col("_hi")) / 86400)
                      .cast("bigint").alias("days"))


def missing_share(rides: DataFrame) -> DataFrame:
    """Percent NULL per column, per city and overall (city = '__all__'), non-zero only."""
    cols = [c for c in rides.columns if c != "city"]
    g = rides.groupingSets([["city"], []], "city")
    wide = g.agg(*[(F.avg(F.col(c).isNull().cast("double")) * 100).alias(c) for c in cols],
                 F.grouping("city").alias("_all"))
    wide = wide.withColumn("scope", F.when(F.col("_all") == 1, F.lit("__all__")).otherwise(F.col("city")))
    long = wide.unpivot(["scope"], cols, "column", "missing_pct")
    return long.filter(F.col("missing_pct") > 0)


def missing_rank(rides: DataFrame) -> DataFrame:
    """Overall missing share per column, ranked (1 = most missing)."""
    ms = missing_share(rides).filter(F.col("scope") == "__all__")
    w = Window.orderBy(F.desc("missing_pct"), "column")       # one row per column: tiny
    return ms.select("column", "missing_pct", F.row_number().over(w).alias("rank"))


def constant_columns(rides: DataFrame) -> DataFrame:
    """Numeric columns with at most one distinct non-null value per city.

    ``min = max`` (or no value at all) is the same test as a distinct count <= 1,
    without a distinct aggregate per column."""
    num = [f.name for f in rides.schema.fields if isinstance(f.dataType, T.NumericType)]
    aggs = []
    for c in num:
        aggs.append(((F.min(c) == F.max(c)) | F.count(c).__eq__(0)).alias(c))
    wide = _nn(rides, "city").groupBy("city").agg(*aggs)
    long = wide.unpivot(["city"], num, "column", "is_constant")
    return long.filter(F.coalesce(F.col("is_constant"), F.lit(True))).select("city", "column")


def demand_distribution(rides: DataFrame) -> DataFrame:
    """Mean, median, std, p95, p99, max of station-hour demand per city."""
    d = station_hour_demand(rides)
    x = F.col("demand").cast("double")
    return d.groupBy("city").agg(
        F.avg(x).alias("mean"), F.median(x).alias("median"), F.stddev_samp(x).alias("std"),
        F.percentile(x, 0.95).alias("p95"), F.percentile(x, 0.99).alias("p99"),
        F.max("demand").alias("max"))


def demand_histogram(rides: DataFrame) -> DataFrame:
    """E4 histogram: number of station-hours per demand value."""
    return station_hour_demand(rides).groupBy("city", "demand").agg(F.count(F.lit(1)).alias("n"))


def _hour(df: DataFrame) -> Column:
    return F.hour("hour_ts")


def hourly_pattern(rides: DataFrame) -> DataFrame:
    """Rides per city and hour of day, and their share of the city's busiest hour."""
    h = _nn(rides, "city", "hour_ts").groupBy("city", _hour(rides).alias("hour")).agg(
        F.count(F.lit(1)).alias("rides"))
    return h.withColumn("share_of_max", F.col("rides") / F.max("rides").over(Window.partitionBy("city")))


def hourly_peaks(rides: DataFrame) -> DataFrame:
    """E5: peak and quietest hour per city (ties -> earliest hour)."""
    h = hourly_pattern(rides)
    return h.groupBy("city").agg(
        F.min_by("hour", F.struct(-F.col("rides"), F.col("hour"))).alias("peak_hour"),
        F.max("rides").alias("peak_rides"),
        F.min_by("hour", F.struct(F.col("rides"), F.col("hour"))).alias("quiet_hour"),
        F.min("rides").alias("quiet_rides"))


def hourly_by_daytype(rides: DataFrame) -> DataFrame:
    """Rides per city, weekend flag and hour."""
    return (_nn(rides, "city", "weekend", "hour_ts")
            .groupBy("city", "weekend", _hour(rides).alias("hour")).agg(F.count(F.lit(1)).alias("rides")))


def rides_by_weekday(rides: DataFrame) -> DataFrame:
    """Seven rows per city, absent weekdays are 0 (dimension made per city, no cross join)."""
    counts = _nn(rides, "city", "weekday").groupBy("city", "weekday").agg(F.count(F.lit(1)).alias("rides"))
    dim = (rides.select("city").filter(F.col("city").isNotNull()).distinct()
           .select("city", F.explode(F.sequence(F.lit(0), F.lit(6))).alias("weekday")))
    return (dim.join(counts, ["city", "weekday"], "left")
            .withColumn("rides", F.coalesce(F.col("rides"), F.lit(0)).cast("bigint")))


def weekday_weekend_ratio(rides: DataFrame) -> DataFrame:
    """Weekday and weekend ride totals and their ratio."""
    r = _nn(rides, "city").groupBy("city").agg(
        F.count_if(F.col("weekend") == 0).alias("weekday_rides"),
        F.count_if(F.col("weekend") == 1).alias("weekend_rides"))
    return r.withColumn("ratio", F.try_divide(F.col("weekday_rides").cast("double"), F.col("weekend_rides")))


def hour_weekday_pivot(rides: DataFrame) -> DataFrame:
    """Hour x weekday ride matrix per city, zero-filled (weekday columns wd_0..wd_6)."""
    p = (_nn(rides, "city", "weekday", "hour_ts").groupBy("city", _hour(rides).alias("hour"))
         .pivot("weekday", list(range(7))).agg(F.count(F.lit(1))))
    p = p.na.fill(0, [str(i) for i in range(7)])
    return p.withColumnsRenamed({str(i): f"wd_{i}" for i in range(7)})


def daily_demand(rides: DataFrame) -> DataFrame:
    """Rides per city and date."""
    return _nn(rides, "city", "date").groupBy("city", "date").agg(F.count(F.lit(1)).alias("rides"))


def daily_summary(rides: DataFrame) -> DataFrame:
    """Min / max / mean daily rides per city."""
    return daily_demand(rides).groupBy("city").agg(
        F.min("rides").alias("min_daily"), F.max("rides").alias("max_daily"),
        F.avg("rides").alias("mean_daily"))


def _per_column(rides: DataFrame, cols, **stats) -> DataFrame:
    """Statistics of each column per city in one pass: one wide row per city, then long form."""
    wide = _nn(rides, "city").groupBy("city").agg(*[
        F.struct(*[f(F.col(c).cast("double")).alias(k) for k, f in stats.items()]).alias(c)
        for c in cols])
    return wide.unpivot(["city"], list(cols), "column", "_s").select(
        "city", "column", *[F.col("_s")[k].alias(k) for k in stats])


def weather_summary(rides: DataFrame, cols=WEATHER_COLS) -> DataFrame:
    """Min / max / mean of each weather column per city (long form)."""
    cols = [c for c in cols if c in rides.columns]
    return _per_column(rides, cols, min=F.min, max=F.max, mean=F.avg)


def density_histogram(rides: DataFrame, cols=WEATHER_COLS, bins: int = 30) -> DataFrame:
    """``bins`` equal-width bins between the city's min and max (last bin closed),
    with density = count / (n * width); a constant column uses [v - 0.5, v + 0.5].

    The ranges are one wide row per city; a ride then carries its columns' bins to one partial
    aggregate, and the few counted bins meet the ranges again."""
    cols = [c for c in cols if c in rides.columns]
    rng = _per_column(rides, cols, _mn=F.min, _mx=F.max, _n=F.count)
    same = F.col("_mn") == F.col("_mx")
    rng = rng.select("city", "column", "_n",
                     F.when(same, F.col("_mn") - 0.5).otherwise(F.col("_mn")).alias("_lo"),
                     F.when(same, F.col("_mx") + 0.5).otherwise(F.col("_mx")).alias("_hi"))
    wide = rng.groupBy("city").agg(F.map_from_entries(F.collect_list(F.struct(
        "column", F.struct("_lo", "_hi")))).alias("_range"))       # one entry per column

    def bin_of(c):
        r = F.col("_range")[c]
        width = (r["_hi"] - r["_lo"]) / bins
        b = F.least(F.floor((F.col(c).cast("double") - r["_lo"]) / width), F.lit(bins - 1))
        return F.struct(F.lit(c).alias("column"),
                        F.when(F.col(c).isNotNull(), b.cast("int")).alias("bin"))

    hit = _nn(rides, "city").join(wide, "city").select(
        "city", F.explode(F.array(*[bin_of(c) for c in cols])).alias("_b")).select("city", "_b.*")
    counts = hit.filter(F.col("bin").isNotNull()).groupBy("city", "column", "bin").agg(
        F.count(F.lit(1)).alias("count")).join(rng, ["city", "column"])
    w = (F.col("_hi") - F.col("_lo")) / bins
    return counts.select("city", "column", "bin", (F.col("_lo") + F.col("bin") * w).alias("bin_lo"),
                         (F.col("_lo") + (F.col("bin") + 1) * w).alias("bin_hi"), "count",
                         (F.col("count") / (F.col("_n") * w)).alias("density"))


def demand_by_weather(rides: DataFrame) -> DataFrame:
    """Station-hour demand keyed with three weather values (rows with a NULL key dropped)."""
    return station_hour_demand(rides, ("temperature_2m", "precipitation", "wind_speed_10m"))


def binned_box_stats(rides: DataFrame, col: str = "temperature_2m", bins: int = 6) -> DataFrame:
    """Right-closed equal-width bins of ``col`` (lowest edge widened by 0.1 % of the
    range) over station-hour demand; quartiles and 1.5-IQR whiskers per bin."""
    d = demand_by_weather(rides)
    rng = d.groupBy("city").agg(F.min(col).alias("_mn"), F.max(col).alias("_mx"))
    j = d.join(rng, "city")
    w = (F.col("_mx") - F.col("_mn")) / bins
    b = F.least(F.greatest(F.lit(1), F.ceil((F.col(col) - F.col("_mn")) / w)), F.lit(bins)).cast("int")
    j = j.withColumn("bin", F.when(w > 0, b).otherwise(F.lit(1)))
    x = F.col("demand").cast("double")
    q = j.groupBy("city", "bin").agg(
        F.count(F.lit(1)).alias("n"), F.percentile(x, 0.25).alias("q1"), F.median(x).alias("median"),
        F.percentile(x, 0.75).alias("q3"), F.first("_mn").alias("_mn"), F.first("_mx").alias("_mx"))
    q = q.withColumns({"bin_lo": F.when(F.col("bin") == 1, F.col("_mn") - (F.col("_mx") - F.col("_mn")) * 0.001)
                       .otherwise(F.col("_mn") + (F.col("bin") - 1) * (F.col("_mx") - F.col("_mn")) / bins),
                       "bin_hi": F.col("_mn") + F.col("bin") * (F.col("_mx") - F.col("_mn")) / bins})
    wk = j.join(q.select("city", "bin", "q1", "q3"), ["city", "bin"]).groupBy("city", "bin").agg(
        F.min(F.when(x >= F.col("q1") - 1.5 * (F.col("q3") - F.col("q1")), x)).alias("whisker_lo"),
        F.max(F.when(x <= F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")), x)).alias("whisker_hi"))
    return q.drop("_mn", "_mx").join(wk, ["city", "bin"])


# The notebook correlates the columns of its station-hour demand table only.
CORR_COLS = ["demand", "temperature_2m", "precipitation", "wind_speed_10m"]


def correlation_matrix(rides: DataFrame) -> DataFrame:
    """Pairwise Pearson r per city over the station-hour demand table (NULL keys
    already dropped), all pairs in one aggregate."""
    d = demand_by_weather(rides)
    pairs = [(x, y) for i, x in enumerate(CORR_COLS) for y in CORR_COLS[i + 1:]]
    wide = d.groupBy("city").agg(*[pearson(x, y).alias(f"{x}|{y}") for x, y in pairs])
    long = wide.unpivot(["city"], [f"{x}|{y}" for x, y in pairs], "pair", "r")
    return long.select("city", F.split("pair", r"\|").getItem(0).alias("col_a"),
                       F.split("pair", r"\|").getItem(1).alias("col_b"), "r")


def metadata_summary(rides: DataFrame, cols=POI_COLS) -> DataFrame:
    """Constant flag, min, max, mean and missing percent per POI column per city."""
    cols = [c for c in cols if c in rides.columns]
    return _per_column(
        rides, cols, is_constant=lambda v: (F.min(v) == F.max(v)) | (F.count(v) == 0),
        min=F.min, max=F.max, mean=F.avg,
        missing_pct=lambda v: F.avg(v.isNull().cast("double")) * 100)


def user_type_share(rides: DataFrame) -> DataFrame:
    """Rides and percent per user type per city, NULL shown as 'missing'."""
    u = (_nn(rides, "city").groupBy("city", F.coalesce(F.col("user_type"), F.lit("missing")).alias("user_type"))
         .agg(F.count(F.lit(1)).alias("rides")))
    return u.withColumn("pct", F.col("rides") * 100.0 / F.sum("rides").over(Window.partitionBy("city")))


def station_variability(rides: DataFrame) -> DataFrame:
    """Mean, sample std and max of observed station-hour demand per station."""
    d = station_hour_demand(rides)
    x = F.col("demand").cast("double")
    return d.groupBy("city", "start_station_id").agg(F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"),
                                                     F.max("demand").alias("max"))


def station_variability_summary(rides: DataFrame) -> DataFrame:
    """Stations per city with mean demand above 5 and below 1."""
    s = station_variability(rides)
    return s.groupBy("city").agg(F.count(F.lit(1)).alias("stations"),
                                 F.count_if(F.col("mean") > 5).alias("stations_mean_gt_5"),
                                 F.count_if(F.col("mean") < 1).alias("stations_mean_lt_1"))


def holiday_days(rides: DataFrame) -> DataFrame:
    """Distinct holiday dates, distinct dates and the sorted holiday names per city."""
    r = _nn(rides, "city")
    return r.groupBy("city").agg(
        F.countDistinct(F.when(F.col("holiday") == 1, F.col("date"))).alias("holiday_dates"),
        F.countDistinct("date").alias("dates"),
        F.array_join(F.array_sort(F.collect_set("holiday_name")), "; ").alias("holiday_names"))


def reconcile_sources(a: DataFrame, b: DataFrame, keys=("city", "station_key")) -> DataFrame:
    """Per station ride counts in two builds of the same rides: overlap and difference."""
    keys = list(keys)
    ca = a.groupBy(*keys).agg(F.count(F.lit(1)).alias("rides_a"))
    cb = b.groupBy(*keys).agg(F.count(F.lit(1)).alias("rides_b"))
    j = ca.join(cb, keys, "full_outer")
    return j.select(*keys, F.coalesce("rides_a", F.lit(0)).alias("rides_a"),
                    F.coalesce("rides_b", F.lit(0)).alias("rides_b"),
                    (F.col("rides_a").isNotNull() & F.col("rides_b").isNotNull()).alias("in_both"),
                    F.abs(F.coalesce("rides_a", F.lit(0)) - F.coalesce("rides_b", F.lit(0))).alias("abs_diff"))


def average_rank(col: str, partition) -> Column:
    """Rank with ties sharing the average position (1-based)."""
    w = Window.partitionBy(*partition).orderBy(col)
    tie = Window.partitionBy(*partition, col)
    return F.rank().over(w) + (F.count(F.lit(1)).over(tie) - 1) / 2.0


def acf_hourly(rides: DataFrame, max_lag: int = 48) -> DataFrame:
    """Autocorrelation of city-hourly ride counts at lags 1..max_lag, by position
    over observed hours only (gaps are skipped); strong = |acf| > 0.2."""
    h = (_nn(rides, "city", "hour_ts").groupBy("city", "hour_ts").agg(F.count(F.lit(1)).alias("n")))
    h = h.withColumn("pos", F.row_number().over(Window.partitionBy("city").orderBy("hour_ts")))
    lagged = h.select("city", F.col("pos").alias("_p"), F.col("n").alias("x"),
                      F.explode(F.sequence(F.lit(1), F.lit(max_lag))).alias("lag"))
    lagged = lagged.withColumn("pos", F.col("_p") + F.col("lag"))
    j = lagged.join(h.select("city", "pos", F.col("n").alias("y")), ["city", "pos"])
    acf = j.groupBy("city", "lag").agg(pearson("y", "x").alias("acf"))
    return acf.withColumn("strong", F.abs("acf") > 0.2)


def top_stations(rides: DataFrame, k: int = 10) -> DataFrame:
    """Top ``k`` raw station ids per city by rides (ties -> smaller id)."""
    c = _nn(rides, "city", "start_station_id").groupBy("city", "start_station_id").agg(
        F.count(F.lit(1)).alias("rides"))
    w = Window.partitionBy("city").orderBy(F.desc("rides"), "start_station_id")
    return c.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)


def top_station_hours(rides: DataFrame, k: int = 20) -> DataFrame:
    """The ``k`` busiest station-hours overall (ties broken by city, station, hour)."""
    return station_hour_demand(rides).orderBy(F.desc("demand"), "city", "start_station_id", "hour_ts").limit(k)
