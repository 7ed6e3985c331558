"""Physical-plan properties that matter at scale."""
import re

from pyspark.sql import functions as F

from dockhour.plans.table import station_hour_table
from dockhour.sources import files as SRC
from dockhour.sources import testdata as TD

SF = "/root/testdata/sf0.001"


def _executed(df):
    """The final (post-AQE) physical plan as text."""
    df.collect()
    s = df._jdf.queryExecution().executedPlan().toString()
    return s.split("== Initial Plan ==")[0]


def test_flagship_reads_rides_once_and_has_no_cartesian(spark):
    plan = _executed(station_hour_table(TD.rides(spark, SF), ["ride_id"]))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # the rides were aggregated once into the checkpointed hour rollup; the table
    # itself reads only that rollup (no second pass over the rides)
    assert "Scan parquet" not in plan and "ExistingRDD" in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_without_materialising_each_consumer_rescans(spark):
    plan = _executed(station_hour_table(TD.rides(spark, SF), ["ride_id"], materialize=False))
    assert plan.count("Scan parquet") > 1         # why the builders checkpoint the rollup


def test_scan_prunes_columns_and_pushes_filters(spark):
    events = TD.table(spark, SF, "events")
    df = events.filter(F.col("event_type") == "view").groupBy("user_id").count()
    plan = _executed(df)
    schema = re.search(r"ReadSchema: struct<([^>]*)>", plan).group(1)
    assert set(schema.replace(" ", "").split(",")) == {"user_id:bigint", "event_type:string"}
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan


def test_ingest_report_is_one_pass(spark):
    months, totals = SRC.ingest_report(TD.start_side_rides(spark, SF))
    plan = _executed(totals)
    assert plan.count("Scan parquet") == 1
    assert "FileScan parquet [event_id#" in plan and "ts#" not in plan.split("FileScan parquet")[1].split("]")[0]
