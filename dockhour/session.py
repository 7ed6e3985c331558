"""Session construction and the shared checkpoint folder."""
from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the library relies on: UTC so NTZ <-> zoned conversions are stable,
# AQE so broadcast / skew decisions use measured sizes.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "dockhour", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide.  Tests use
    ``local[*]`` with a small shuffle-partition count.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in {**DEFAULT_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by ``spark.checkpoint.dir``.

    The cluster's setting always wins.  Without one, a local master gets a scratch
    folder; on a cluster that folder would not be shared, so it is an error there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="dockhour-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder (never local)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)

