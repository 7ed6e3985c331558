"""Small gathered results and finished components cost few Spark jobs, whatever the partitions."""
import numpy as np

from dockhour.llm import components as comp
from dockhour.llm.bitmaps import cells_of, members
from dockhour.llm.bitmaps import test as holds


def test_bitmap_is_gathered_in_one_job(spark):
    held = spark.conf.get("spark.sql.shuffle.partitions")
    sc, values = spark.sparkContext, spark.range(0, 4000, 1, 2).toDF("value")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    sc.setJobGroup("bitmap", "members")
    try:
        bits = members(values, 22)
        jobs = len(sc.statusTracker().getJobIdsForGroup("bitmap"))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        spark.conf.set("spark.sql.shuffle.partitions", held)
    assert jobs <= 3, jobs
    want = np.unique(cells_of(np.arange(4000, dtype=np.uint64), 22))
    assert np.flatnonzero(np.unpackbits(bits, bitorder="little")).tolist() == want.tolist()
    assert holds(bits, want).all()


def test_stars_take_no_step(spark, monkeypatch):
    labels, write = [], comp.written

    def spy(df, label):
        labels.append(label)
        return write(df, label)

    monkeypatch.setattr(comp, "written", spy)
    stars = [(i, i % 3) for i in range(3, 40)] + [(1, 4), (2, 2)]
    got = {r["node"]: r["root"] for r in comp.components(
        spark.createDataFrame(stars, "a long, b long")).collect()}
    assert got == {i: i % 3 for i in range(3, 40)}
    assert labels == ["edges"]
    labels.clear()
    chain = spark.createDataFrame([(3, 2), (2, 1), (9, 8)], "a long, b long")
    assert sorted(tuple(r) for r in comp.components(chain).collect()) == [(2, 1), (3, 1), (9, 8)]
    assert labels[-1] == "small1"
    none = spark.createDataFrame([(7, 7)], "a long, b long")
    assert comp.components(none).count() == 0
