"""File sources.

Readers declare their schema (no inference), read text fields as strings where
the reference coerces later, and parse leniently with ``try_*`` functions
(ANSI mode would make a plain cast of bad text fail the job).  File listing
and header peeking go through the Hadoop FileSystem API, so the same code
reads local disks, HDFS or object stores.
"""
from __future__ import annotations

import csv
import io
import json
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions.keys import floor_hour, nan_to_null
from ..schemas import POI8_COLS, WEATHER_COLS, rides_csv_schema

GZIP_RATIO = 5
NO_NULL_TOKEN = "\u0001"     # CSV: keep empty fields as "" so missing trailing fields stay NULL


# --- Hadoop FileSystem helpers ---------------------------------------------------

def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Sorted paths matching a glob (files or directories); [] when nothing matches."""
    fs, p = _fs(spark, pattern)
    st = fs.globStatus(p)
    if st is None:
        return []
    return sorted(s.getPath().toString() for s in st)


def first_line(spark: SparkSession, path: str) -> str:
    """The first line of a (text) file, read through the Hadoop FileSystem."""
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        return reader.readLine() or ""
    finally:
        stream.close()


def data_files(spark: SparkSession, path: str, suffix: str = ".csv") -> list[str]:
    """Data files under ``path`` (a file, or a directory written by Spark)."""
    fs, p = _fs(spark, path)
    if fs.getFileStatus(p).isFile():
        return [p.toString()]
    out = []
    for s in fs.listStatus(p):
        name = s.getPath().getName()
        if s.isFile() and not name.startswith(("_", ".")) and (suffix is None or suffix in name):
            out.append(s.getPath().toString())
    return sorted(out)


# --- A1, A4, A5 --------------------------------------------------------------------

def scan_rides(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A1: ride CSV with a header and a declared schema; time columns parsed leniently to
    ``timestamp_ntz`` (unparsable -> NULL), NaN -> NULL in numeric columns."""
    schema = schema or rides_csv_schema()
    df = spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE").csv(path)
    repl = {}
    for f in schema.fields:
        if f.name in ("started_at", "ended_at", "hour_ts"):
            repl[f.name] = F.try_to_timestamp(F.col(f.name)).cast("timestamp_ntz")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            repl[f.name] = nan_to_null(f.name)
    return df.withColumns(repl)


def scan_gzip_text(spark: SparkSession, pattern: str, partitions: int | None = None) -> DataFrame:
    """A4: gzip CSV files, every column a string.  A gzip file is one split, so the rows are
    redistributed (round robin) before any per-row work, over as many partitions as the bytes need:
    text is about GZIP_RATIO times its compressed size."""
    df = (spark.read.option("header", True).option("inferSchema", False)
          .option("nullValue", NO_NULL_TOKEN).csv(pattern))
    if not partitions:
        size = (spark.read.format("binaryFile").load(pattern).agg(F.sum("length")).first()[0] or 0)
        most = spark.conf.get("spark.sql.files.maxPartitionBytes")
        unit = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30}.get(most.strip("bB")[-1].lower(), 1)
        share = int("".join(c for c in most if c.isdigit())) * unit
        partitions = max(1, -(-size * GZIP_RATIO // share))
    return df.repartition(partitions)


def scan_station_features(spark: SparkSession, path: str) -> DataFrame:
    """A5: station lookup CSV; ``lat``/``lng`` renamed to ``start_lat``/``start_lng``."""
    schema = T.StructType([T.StructField("start_station_id", T.StringType())] + [
        T.StructField(c, T.DoubleType()) for c in
        ["lat", "lng", *POI8_COLS, "distance_to_city_center"]])
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumnsRenamed({"lat": "start_lat", "lng": "start_lng"})


def scan_weather(spark: SparkSession, path: str) -> DataFrame:
    """A5: hourly weather CSV; ``hour_ts`` parsed and floored to the hour."""
    schema = T.StructType([T.StructField("hour_ts", T.StringType())] +
                          [T.StructField(c, T.DoubleType()) for c in WEATHER_COLS])
    df = spark.read.schema(schema).option("header", True).csv(path)
    return df.withColumn("hour_ts", floor_hour(F.try_to_timestamp("hour_ts").cast("timestamp_ntz")))


# --- A2 --------------------------------------------------------------------------------

def ingest_alias_headers(spark: SparkSession, paths: list[str], aliases: dict[str, list[str]]) -> DataFrame:
    """A2: extracts whose headers differ (names and order).  Each output column is
    resolved by the first of its known names present in a file's header; rows
    shorter than the last needed field are skipped.

    Files are grouped by header (one peek per file), and each header family is
    read by one CSV scan, so the plan has one branch per family, not per file.
    """
    families: dict[tuple, list[str]] = {}
    for p in paths:
        for f in data_files(spark, p, None):
            header = tuple(next(csv.reader(io.StringIO(first_line(spark, f)))))
            families.setdefault(header, []).append(f)
    frames = []
    for header, files in families.items():
        idx = {}
        for out, names in aliases.items():
            hit = [header.index(n) for n in names if n in header]
            if not hit:
                raise ValueError(f"none of {names} among the columns {list(header)}")
            idx[out] = hit[0]
        last = header[max(idx.values())]
        schema = T.StructType([T.StructField(h, T.StringType()) for h in header])
        df = (spark.read.schema(schema).option("header", True).option("nullValue", NO_NULL_TOKEN)
              .option("mode", "PERMISSIVE").csv(files))
        frames.append(df.filter(F.col(f"`{last}`").isNotNull())
                      .select(*[F.col(f"`{header[i]}`").alias(out) for out, i in idx.items()]))
    if not frames:
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in aliases]))
    return reduce(lambda a, b: a.unionByName(b), frames)


# --- A3 --------------------------------------------------------------------------------

def ingest_zipped_trips(spark: SparkSession, pattern: str, columns: list[str],
                        renames: dict[str, str] | None = None) -> DataFrame:
    """A3: ZIP archives -> rows of the first ``.csv`` member not under ``__MACOSX``.

    Each archive is an input partition.  Its task reads the archive's directory and streams the
    member in chunks, so neither archive nor member is ever held.  The requested columns come as
    text (empty text stays empty, bytes that are not UTF-8 become the replacement character), rows
    too short for the last of them are skipped, archives without a member give none; typing and
    filtering happen afterwards in native expressions."""
    spark.dataSource.register(zipped_csv_source())
    # A name with commas and brackets may be part of a path or header, so both travel as JSON.
    out = (spark.read.format("zipped_csv")
           .schema(T.StructType([T.StructField(c, T.StringType()) for c in ("source_archive", *columns)]))
           .option("archives", json.dumps(glob_paths(spark, pattern)))
           .option("columns", json.dumps(columns)).load())
    return out.withColumnsRenamed(renames) if renames else out


def zipped_csv_source(chunk_rows: int = 50_000) -> type:
    """The data source behind ``ingest_zipped_trips``.  Its classes are made here so that they
    travel to the workers by value and need no installed package there."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Archive(InputPartition):
        def __init__(self, path: str) -> None:
            self.path = path

    class Reader(DataSourceReader):
        def __init__(self, archives: list[str], columns: list[str]) -> None:
            self.archives, self.columns = archives, columns

        def partitions(self):
            return [Archive(p) for p in self.archives] or [Archive("")]

        def read(self, partition):
            if not partition.path:
                return
            import csv as text_csv
            import io as text_io
            import zipfile
            from itertools import islice

            import pyarrow as pa
            from pyarrow import fs

            path = partition.path
            if path.startswith("file:"):
                path = "file:///" + path[5:].lstrip("/")
            system, at = fs.FileSystem.from_uri(path)
            with system.open_input_file(at) as raw, zipfile.ZipFile(raw) as z:
                names = [n for n in z.namelist() if n.endswith(".csv") and not n.startswith("__MACOSX")]
                if not names:
                    return
                with z.open(names[0]) as member:
                    rows = text_csv.reader(text_io.TextIOWrapper(
                        member, "utf-8-sig", errors="replace", newline=""))
                    header = next(rows, [])
                    missing = [c for c in self.columns if c not in header]
                    if missing:
                        raise ValueError(f"{partition.path}: no column {missing} in {header}")
                    at = [header.index(c) for c in self.columns]
                    whole = (r for r in rows if len(r) > max(at))
                    while chunk := list(islice(whole, chunk_rows)):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([partition.path] * len(chunk), pa.string()),
                             *[pa.array([r[i] for r in chunk], pa.string()) for i in at]],
                            names=["source_archive", *self.columns])

    class ZippedCsv(DataSource):
        @classmethod
        def name(cls) -> str:
            return "zipped_csv"

        def reader(self, schema):
            return Reader(json.loads(self.options["archives"]), json.loads(self.options["columns"]))

    return ZippedCsv


def cut_timestamp_text(df: DataFrame, col: str = "started_at") -> DataFrame:
    """A3 (D.C. form): keep the first 19 characters of the time text."""
    return df.withColumn(col, F.substring(col, 1, 19))


def reformat_timestamp_text(df: DataFrame, col: str = "started_at") -> DataFrame:
    """A3 (L.A. form): parse leniently, drop unparsable rows, write back as text."""
    t = F.try_to_timestamp(F.col(col))
    return df.filter(t.isNotNull()).withColumn(col, F.date_format(t, "yyyy-MM-dd HH:mm:ss"))


# --- A6 --------------------------------------------------------------------------------

def weather_json_unnest(spark: SparkSession, path: str, cols=WEATHER_COLS) -> DataFrame:
    """JSON documents ``{"hourly": {"time": [...], "<col>": [...], ...}}`` of parallel
    arrays -> one row per hour, ``time`` -> ``hour_ts`` (text ``yyyy-MM-dd HH:mm:ss``)."""
    hourly = T.StructType([T.StructField("time", T.ArrayType(T.StringType()))] +
                          [T.StructField(c, T.ArrayType(T.DoubleType())) for c in cols])
    schema = T.StructType([T.StructField("hourly", hourly)])
    doc = spark.read.schema(schema).json(path)
    zipped = F.arrays_zip(*[F.col(f"hourly.{c}").alias(c) for c in ["time", *cols]])
    rows = doc.select(F.inline(zipped))
    t = F.try_to_timestamp(F.col("time")).cast("timestamp_ntz")
    return rows.select(F.date_format(t, "yyyy-MM-dd HH:mm:ss").alias("hour_ts"), *cols)


# --- A9, A10, A15 ----------------------------------------------------------------------

def discover_sources(spark: SparkSession, directory: str, pattern: str = "*.csv") -> list[str]:
    """Sources in a directory, sorted; a missing directory gives []."""
    return glob_paths(spark, f"{directory.rstrip('/')}/{pattern}")


def read_sources(spark: SparkSession, paths: list[str], schema: T.StructType | None = None) -> DataFrame:
    """Read every source in one scan; ``source`` = the source's own name."""
    if not paths:
        return spark.createDataFrame([], (schema or rides_csv_schema()).add("source", T.StringType()))
    df = spark.read.schema(schema or rides_csv_schema()).option("header", True).csv(paths)
    # A source is a file or a folder of files: the last part of the path that is a source's name.
    bases = F.array(*[F.lit(b) for b in sorted({p.rstrip("/").split("/")[-1] for p in paths})])
    steps = F.split(F.col("_metadata.file_path"), "/")
    names = F.try_element_at(F.filter(steps, lambda x: F.array_contains(bases, x)), F.lit(-1))
    return df.withColumn("source", names)


def materialise_table(df: DataFrame, path: str, partition_by: str | None = "city_key") -> DataFrame:
    """A10: write once as Parquet (partitioned by city) and read back from disk."""
    w = df.write.mode("overwrite")
    (w.partitionBy(partition_by) if partition_by else w).parquet(path)
    return df.sparkSession.read.parquet(path)


def ingest_report(rides: DataFrame, time_col: str = "started_at",
                  station_col: str = "start_station_id") -> tuple[DataFrame, DataFrame]:
    """Rides per month (first 7 characters of the time text) and the totals."""
    month = F.substring(F.col(time_col).cast("string"), 1, 7)
    per_month = rides.groupBy(month.alias("month")).agg(F.count(F.lit(1)).alias("rides"))
    totals = rides.agg(F.count(F.lit(1)).alias("rides"), F.countDistinct(station_col).alias("stations"))
    return per_month, totals
