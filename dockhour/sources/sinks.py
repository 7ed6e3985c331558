"""Sinks (A11-A14).  Every writer takes a lazy frame; frames written twice are
materialised once first (a written table, so a lost executor recomputes
nothing upstream)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.keys import conform_schema


def write_csv(df: DataFrame, path: str, compression: str | None = None, single_file: bool = False) -> None:
    w = (df.coalesce(1) if single_file else df).write.mode("overwrite").option("header", True)
    w = w.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_targets_labels(public: DataFrame, private: DataFrame, public_path: str, private_path: str) -> None:
    """The two evaluator files (both carry ``id``)."""
    write_csv(public, public_path)
    write_csv(private, private_path)


def write_summary_scored(summary: DataFrame, path: str, scored: DataFrame | None = None,
                         scored_path: str | None = None) -> None:
    """Leaderboard CSV (one small file, in leaderboard order) and optionally the scored rows."""
    write_csv(summary, path, single_file=True)
    if scored is not None and scored_path:
        write_csv(scored, scored_path)


def write_enriched(df: DataFrame, path: str, columns, types: dict | None = None) -> None:
    """Fixed column order, absent columns empty, gzip CSV."""
    write_csv(conform_schema(df, columns, types), path, compression="gzip")


def write_split_files(splits: DataFrame, path: str, split_col: str = "split") -> None:
    """One folder per split (``split=train`` / ``split=val`` ...)."""
    (splits.write.mode("overwrite").option("header", True).partitionBy(split_col).csv(path))


def read_split_files(spark, path: str, schema=None) -> DataFrame:
    r = spark.read.option("header", True)
    if schema is not None:
        r = r.schema(schema)
    return r.csv(path).withColumn("split", F.col("split").cast("string"))


def write_zipped_csv(df: DataFrame, path: str) -> None:
    """One ZIP archive a partition below ``path``, each with one CSV member.

    An archive is written under a temporary name and renamed, so a task that is run again replaces
    it.  Rows stream through; columns are written as text, null as empty text."""
    columns = df.columns

    def write(batches):
        import csv
        import io
        import uuid
        import zipfile

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        name = f"part-{TaskContext.get().partitionId():05d}"
        system, at = fs.FileSystem.from_uri(
            "file:///" + path[5:].lstrip("/") if path.startswith("file:") else path)
        system.create_dir(at, recursive=True)
        loose = f"{at}/_{name}-{uuid.uuid4().hex}"
        with system.open_output_stream(loose) as raw, zipfile.ZipFile(
                raw, "w", zipfile.ZIP_DEFLATED) as z, z.open(f"{name}.csv", "w", force_zip64=True) as m:
            with io.TextIOWrapper(m, "utf-8", newline="") as text:
                out = csv.writer(text)
                out.writerow(columns)
                for b in batches:
                    out.writerows(zip(*[c.to_pylist() for c in b.columns], strict=True))
        system.move(loose, f"{at}/{name}.zip")
        yield pa.RecordBatch.from_arrays([pa.array([f"{name}.zip"])], names=["archive"])

    df.select([df[c].cast("string") for c in columns]).mapInArrow(write, "archive string").count()
