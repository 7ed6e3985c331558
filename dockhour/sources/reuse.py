"""A10: a built table that is kept while its sources are unchanged.

Beside the table lies a manifest: one row per source file and table partition it feeds, with the
file's length and modification time and the plan's version.  A later call compares it with the
files as they are, reads no rows where nothing changed, and otherwise rebuilds only the partitions
that changed, new or removed files feed, by dynamic partition overwrite.

The manifest is taken away before the table is touched and put back when it is whole, so a job that
dies in between costs a full rebuild and never leaves a table that looks current.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .files import _fs, glob_paths

FILE = "path string, length long, modified timestamp"
STAMP = ["path", "length", "modified"]


@dataclass
class Reused:
    table: DataFrame
    rebuilt: list[str] | None      # partition values; None for the whole table


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def _rename(spark: SparkSession, old: str, new: str) -> None:
    fs, p = _fs(spark, old)
    if not fs.rename(p, _fs(spark, new)[1]):
        raise OSError(f"could not rename {old} to {new}")


def _table(spark: SparkSession, path: str, partition_by: str) -> DataFrame:
    """The stored table; partition values are text, also where they look like numbers."""
    found = spark.read.parquet(path)
    schema = T.StructType([T.StructField(f.name, T.StringType()) if f.name == partition_by else f
                           for f in found.schema.fields])
    return spark.read.schema(schema).parquet(path)


def source_files(spark: SparkSession, sources: list[str]) -> DataFrame:
    """Signature of every data file below ``sources`` (files, folders or globs): path, length and
    modification time.  Only file metadata is read."""
    there = [p for s in sources for p in glob_paths(spark, s)]
    if not there:
        return spark.createDataFrame([], FILE)
    m = F.col("_metadata")
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(there).select(
        m["file_path"].alias("path"), m["file_size"].alias("length"),
        m["file_modification_time"].alias("modified"))


def build_or_reuse(spark: SparkSession, sources: list[str], path: str,
                   read: Callable[[list[str]], DataFrame], build: Callable[[DataFrame], DataFrame],
                   key: Column, partition_by: str = "city_key", version: str = "1") -> Reused:
    """The table ``build(read(sources))``, partitioned by ``partition_by``, kept at ``path``.

    ``key`` is the partition a source row belongs to (an expression over ``read``'s columns); a
    partition must depend on its own rows only.  ``version`` names the plan: another one rebuilds
    everything.  Paths of changed files and values of rebuilt partitions come to the driver, which
    holds the file listing anyway; rows do not.
    """
    kept = f"{path.rstrip('/')}.sources"
    fresh = f"{kept}-next"
    files = {r["path"]: (r["length"], r["modified"])
             for r in source_files(spark, sources).collect()}
    old = None
    if _exists(spark, kept) and _exists(spark, path):
        old = spark.read.parquet(kept)
        if old.filter(F.col("version") != version).isEmpty():
            known = {r["path"]: (r["length"], r["modified"])
                     for r in old.select(*STAMP).distinct().collect()}
        else:
            old = None

    def feeds(paths: list[str]) -> DataFrame:
        return read(paths).select(F.col("_metadata.file_path").alias("path"),
                                  key.alias("part")).distinct()

    def write_manifest(rows: DataFrame) -> None:
        stamps = spark.createDataFrame([(p, *s) for p, s in files.items()], FILE)
        # Files without rows are listed too, so that they do not look new the next time.
        stamps.join(rows, "path", "left").select(
            *STAMP, "part", F.lit(version).alias("version")).write.mode("overwrite").parquet(fresh)

    def swap(write: Callable[[], None]) -> None:
        _remove(spark, kept)
        write()
        _rename(spark, fresh, kept)

    if old is None:
        if not files:
            raise FileNotFoundError(f"no source files in {sources}")
        whole = build(read(sorted(files)))
        write_manifest(feeds(sorted(files)))
        swap(lambda: whole.write.mode("overwrite").partitionBy(partition_by).parquet(path))
        return Reused(_table(spark, path, partition_by), None)

    changed = sorted(p for p in {*files, *known} if files.get(p) != known.get(p))
    if not changed:
        return Reused(_table(spark, path, partition_by), [])
    there = [p for p in changed if p in files]
    lost = old.filter(F.col("path").isin(changed)).select("part")
    gained = feeds(there).select("part") if there else lost.limit(0)
    parts = sorted(r["part"] for r in lost.unionByName(gained).distinct().collect()
                   if r["part"] is not None)
    feeding = {r["path"] for r in old.filter(F.col("part").isin(parts)).select("path").distinct()
               .collect()}
    again = sorted(p for p in {*there, *feeding} if p in files)
    rest = old.filter(~F.col("path").isin(changed)).select("path", "part")
    write_manifest(rest.unionByName(feeds(there)) if there else rest)
    rebuilt = build(read(again).filter(key.isin(parts))) if again and parts else None

    def overwrite() -> None:
        filled = set()
        if rebuilt is not None:
            rebuilt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                partition_by).parquet(path)
            filled = {r["part"] for r in read(again).filter(key.isin(parts)).select(
                key.alias("part")).distinct().collect()}
        for gone in set(parts) - filled:
            for folder in glob_paths(spark, f"{path.rstrip('/')}/{partition_by}={_escaped(spark, gone)}"):
                _remove(spark, folder)

    swap(overwrite)
    return Reused(_table(spark, path, partition_by), parts)


def _escaped(spark: SparkSession, value: str) -> str:
    """The value as Spark writes it in the name of a partition's folder."""
    utils = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    return utils.escapePathName(value)
