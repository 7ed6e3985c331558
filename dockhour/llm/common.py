"""Helpers the operators of this subpackage share: scratch tables, let-binding, word rules."""
from __future__ import annotations

import contextlib
import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhour.session import ensure_checkpoint_dir

# White space of the word rule: space, tab, line feed, vertical tab, form feed, carriage return.
WS_CHARS = " \t\n\x0b\x0c\r"
WS_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send the package's source to the Python workers, once for each application."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    target = os.path.join(tempfile.mkdtemp(prefix="dockhour-src-"), "dockhour.zip")
    with zipfile.ZipFile(target, "w") as z:
        for folder, _, names in os.walk(os.path.join(root, "dockhour")):
            for n in sorted(names):
                if n.endswith(".py"):
                    z.write(os.path.join(folder, n),
                            os.path.relpath(os.path.join(folder, n), root))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def trim() -> None:
    """Give memory that this worker has freed back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def trimmed(task: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """The task, after which its worker holds no freed memory; workers outlive their tasks."""
    @wraps(task)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from task(batches)
        finally:
            trim()

    return run


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder of the cluster."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    Cuts the lineage so that a lost executor costs only the stage at hand, freezes ids that
    depend on partitions, and gives the planner measured sizes.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times, inside lambdas too."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    """Array of the words of ``text``; null and blank texts give an empty array."""
    core = F.btrim(F.coalesce(text, F.lit("")), F.lit(WS_CHARS))
    return let(core, lambda t: F.when(t == "", F.array().cast("array<string>"))
               .otherwise(F.split(t, WS_RUN, -1)))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")
