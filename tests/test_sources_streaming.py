"""Sources, sinks and the streaming demand count."""
import os
import zipfile


from dockhour.operators import aggregates as A
from dockhour.operators.keys import key_rides
from dockhour.sources import files as SRC
from dockhour.sources import sinks as SNK
from dockhour.sources import testdata as TD
from dockhour.streaming import demand_counts_stream, start_demand_sink

SF = "/root/testdata/sf0.001"


def test_alias_headers_skip_short_rows(spark, tmpdir_path):
    a = os.path.join(tmpdir_path, "a.csv")
    b = os.path.join(tmpdir_path, "b.csv")
    with open(a, "w") as f:
        f.write("Number,Start date,Start station number,Start station\n1,2024-06-01 10:00,7,Main\n2,2024-06-01\n")
    with open(b, "w") as f:
        f.write("StartStation Name,Rental Id,Start Date,StartStation Id\nPark,3,2024-07-01 09:00,8\n")
    df = SRC.ingest_alias_headers(spark, [a, b], {
        "rental_id": ["Number", "Rental Id"], "started_at": ["Start date", "Start Date"],
        "start_station_id": ["Start station number", "StartStation Id"],
        "start_station_name": ["Start station", "StartStation Name"]})
    got = sorted(tuple(r) for r in df.collect())
    assert got == [("1", "2024-06-01 10:00", "7", "Main"), ("3", "2024-07-01 09:00", "8", "Park")]


def test_zipped_trips(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "trips.zip")
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("__MACOSX/._x.csv", "junk")
        z.writestr("x.csv", "ride_id,started_at,start_station_id,start_station_name,extra\n"
                            "r1,2024-06-01 10:00:00.123,31,Main,a\nr2,not a time,32,Side,b\n")
    df = SRC.ingest_zipped_trips(spark, path, ["ride_id", "started_at", "start_station_id", "start_station_name"])
    dc = SRC.cut_timestamp_text(df).select("started_at").collect()
    assert sorted(r[0] for r in dc) == ["2024-06-01 10:00:00", "not a time"]
    la = SRC.reformat_timestamp_text(df).collect()
    assert [(r.ride_id, r.started_at) for r in la] == [("r1", "2024-06-01 10:00:00")]


def test_zipped_trips_in_chunks(spark, tmpdir_path):
    """Many chunks, quoted line breaks, short rows, bad bytes, archives without a member; no reader
    task holds more than its chunk."""
    from dockhour.sources.files import zipped_csv_source
    many = [f'{i},"a\nb, {i}",{i % 7}' for i in range(1000)]
    with zipfile.ZipFile(os.path.join(tmpdir_path, "many.zip"), "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("other.txt", "no table")
        z.writestr("in/x.csv", "ride_id,name,k\n" + "\n".join([*many, "short"]) + "\n")
    with zipfile.ZipFile(os.path.join(tmpdir_path, "bytes.zip"), "w") as z:
        z.writestr("y.csv", b"k,ride_id,name\n1,r,\xff\n,,\n")
    with zipfile.ZipFile(os.path.join(tmpdir_path, "none.zip"), "w") as z:
        z.writestr("__MACOSX/z.csv", "ride_id,name\n")
    df = SRC.ingest_zipped_trips(spark, os.path.join(tmpdir_path, "*.zip"), ["ride_id", "name"])
    assert df.rdd.getNumPartitions() == 3
    got = {(r.source_archive.split("/")[-1], r.ride_id, r.name) for r in df.collect()}
    assert got == {("many.zip", str(i), f"a\nb, {i}") for i in range(1000)} | {
        ("bytes.zip", "r", "\ufffd"), ("bytes.zip", "", "")}
    assert SRC.ingest_zipped_trips(spark, os.path.join(tmpdir_path, "*.gone"), ["a"]).count() == 0
    source = zipped_csv_source(chunk_rows=64)(options={
        "archives": f'["{tmpdir_path}/many.zip"]', "columns": '["ride_id", "name"]'})
    reader = source.reader(None)
    sizes = [b.num_rows for p in reader.partitions() for b in reader.read(p)]
    assert max(sizes) == 64 and sum(sizes) == 1000


def test_missing_source_directory_is_empty(spark, tmpdir_path):
    assert SRC.discover_sources(spark, os.path.join(tmpdir_path, "nope")) == []
    assert SRC.read_sources(spark, []).count() == 0


def test_sinks_round_trip(spark, tmpdir_path):
    df = spark.createDataFrame([(1, " 7", "x"), (2, "8", None)], "id long, s string, t string")
    p = os.path.join(tmpdir_path, "out")
    SNK.write_csv(df, p)
    back = spark.read.schema("id long, s string, t string").option("header", True).csv(p)
    assert sorted(tuple(r) for r in back.collect()) == [(1, " 7", "x"), (2, "8", None)]
    splits = spark.createDataFrame([(1, "train"), (2, "val")], "id long, split string")
    SNK.write_split_files(splits, os.path.join(tmpdir_path, "splits"))
    assert {r.split for r in SNK.read_split_files(spark, os.path.join(tmpdir_path, "splits")).collect()} == {"train", "val"}


def test_streaming_counts_equal_batch(spark, tmpdir_path):
    rides = TD.rides(spark, SF).select("ride_id", "city", "start_station_id", "started_at")
    src = os.path.join(tmpdir_path, "rides_in")
    rides.repartition(4).write.parquet(src)
    stream = spark.readStream.schema(rides.schema).option("maxFilesPerTrigger", 1).parquet(src)
    counts = demand_counts_stream(stream, lateness="0 seconds")
    q = counts.writeStream.outputMode("complete").format("memory").queryName("demand_stream_test").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("demand_stream_test")
    batch = A.demand_counts(key_rides(rides, "target_hour_start"), "target_hour_start")
    assert got.count() == batch.count()
    assert got.exceptAll(batch.select(*got.columns)).count() == 0
    # the append sink runs end to end (hours still open at the end stay in state)
    sink = start_demand_sink(demand_counts_stream(spark.readStream.schema(rides.schema).parquet(src)),
                             os.path.join(tmpdir_path, "sink"), os.path.join(tmpdir_path, "ckpt"))
    sink.awaitTermination(120)
