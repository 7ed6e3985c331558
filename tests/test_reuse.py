"""A10: a table that is rebuilt only where its sources changed."""
import glob
import os
import shutil

import pytest
from pyspark.sql import functions as F

from dockhour.functions.keys import city_key
from dockhour.plans.table import station_hour_table
from dockhour.sources import testdata as TD
from dockhour.sources.reuse import build_or_reuse

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def call(spark, tmpdir_path):
    rides = TD.rides(spark, SF)
    folder, path = f"{tmpdir_path}/rides", f"{tmpdir_path}/table"
    rides.withColumn("_folder", F.col("city")).coalesce(1).write.partitionBy("_folder").parquet(folder)
    reads = []

    def read(paths):
        reads.append(sorted(os.path.basename(os.path.dirname(p)) for p in paths))
        return spark.read.parquet(*paths)

    def run(version="1"):
        reads.clear()
        out = build_or_reuse(spark, [f"{folder}/*"], path, read, lambda r: station_hour_table(
            r.select(*rides.columns), ["ride_id"]), city_key(rides.columns), version=version)
        full = station_hour_table(spark.read.parquet(*glob.glob(f"{folder}/*/*.parquet")), ["ride_id"])
        assert sorted(map(str, out.table.select(*full.columns).collect())) == sorted(
            map(str, full.collect()))
        return out.rebuilt

    return run, reads, folder, path


def parts(path):
    return {p.split("city_key=")[1].split("/")[0]: os.path.getmtime(p)
            for p in glob.glob(f"{path}/city_key=*/*.parquet")}


def folder_of(folder, city):
    return f"{folder}/_folder={city}"


def test_unchanged_sources_are_not_read(call):
    run, reads, _, path = call
    assert run() is None
    before = parts(path)
    assert run() == [] and reads == [] and parts(path) == before
    assert run(version="2") is None                 # another plan builds everything


def test_a_changed_file_rebuilds_its_partition(spark, call):
    run, reads, folder, path = call
    run()
    before = parts(path)
    some = spark.read.parquet(folder_of(folder, "click")).filter("ride_id % 3 = 0")
    some.coalesce(1).write.mode("append").parquet(folder_of(folder, "click"))
    assert run() == ["click"]
    assert all(set(r) == {"_folder=click"} for r in reads)   # nothing else was read
    after = parts(path)
    assert {c for c in before if after[c] != before[c]} == {"click"}
    assert run() == []


def test_new_and_removed_files(spark, call):
    run, _, folder, path = call
    run()
    shutil.copytree(folder_of(folder, "view"), f"{folder}/_folder=more")
    assert run() == ["view"]                        # the copy holds rides of that city
    shutil.rmtree(folder_of(folder, "error"))
    assert run() == ["error"] and "error" not in parts(path)
    other = spark.read.parquet(folder_of(folder, "click")).withColumn("city", F.lit("12"))
    other.coalesce(1).write.parquet(f"{folder}/_folder=12")
    assert run() == ["12"] and "12" in parts(path)


def test_a_job_that_died_rebuilds_everything(call):
    run, _, _, path = call
    run()
    shutil.rmtree(f"{path}.sources")
    assert run() is None
