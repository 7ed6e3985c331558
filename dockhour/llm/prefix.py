"""Global running sums over an ordered table without putting a group into one task.

The rows are dealt by range on (group, order), so a hot group spreads over many partitions.
Each partition's totals are added up first (one row per partition and group), their running sums
give every partition its start, and a window inside each partition gives the rest.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written


def running(df: DataFrame, group: list[str], order: list[str], values: list[str],
            label: str) -> DataFrame:
    """Add ``<v>_before`` for each value and ``row_before``: sums over the rows ahead in the group.

    Null order values come first.  Rows that tie on all of ``order`` take the running sums in any
    order among themselves, so ``order`` should end in columns that tell different rows apart.
    An empty table gives an empty table.
    """
    cols = [*group, *order]
    ranged = written(df.repartitionByRange(*[F.col(c) for c in cols])
                     .withColumn("_part", F.spark_partition_id()), label)
    sums: list[Column] = [F.sum(v).cast("long").alias(f"_t_{v}") for v in values]
    totals = ranged.groupBy(*group, "_part").agg(*sums, F.count(F.lit(1)).alias("_t_row"))
    ahead = Window.partitionBy(*group).orderBy("_part").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = totals.select(
        *[F.col(g).alias(f"_g_{g}") for g in group], F.col("_part").alias("_p"),
        *[F.coalesce(F.sum(f"_t_{v}").over(ahead), F.lit(0)).alias(f"_s_{v}")
          for v in [*values, "row"]])
    same = F.col("_part") == F.col("_p")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"_g_{g}"))
    inside = Window.partitionBy("_part", *group).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1)
    local = ranged.select(
        "*", *[F.coalesce(F.sum(v).over(inside), F.lit(0)).alias(f"_i_{v}") for v in values],
        (F.row_number().over(Window.partitionBy("_part", *group).orderBy(*order)) - 1)
        .alias("_i_row"))
    out = local.join(starts, same, "left")
    keep = [c for c in ranged.columns if c != "_part"]
    return out.select(*keep, *[(F.col(f"_i_{v}") + F.col(f"_s_{v}")).cast("long")
                               .alias(f"{v}_before") for v in [*values, "row"]])
