"""Tables that are read back in order."""

import pytest
from pyspark.sql import functions as F

from tidemark.sources.ordered import ordered_pages, read_ordered, read_range, write_ordered


@pytest.fixture(scope="module")
def root(spark, tmp_path_factory):
    rows = spark.range(5000).select(
        F.pmod(F.xxhash64("id"), F.lit(3000)).alias("k"), F.col("id").alias("v"), F.lit("x").alias("_metadata_")
    )
    path = str(tmp_path_factory.mktemp("ordered") / "table")
    assert write_ordered(rows.unionAll(spark.sql("select cast(null as bigint), -1L, 'x'")), path, ["k", "v"], 7) == 7
    return path


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_rows_come_back_in_order_without_a_shuffle(spark, root):
    rows = read_ordered(spark, root, place="place")
    assert "Exchange" not in plan(rows) and "Sort" not in plan(rows)
    got = [(r["k"], r["v"], r["place"]) for r in rows.collect()]
    assert [p for *_, p in got] == list(range(1, 5002))
    keys = [(-1 if k is None else k, v) for k, v, _ in got]
    assert keys == sorted(keys) and len(keys) == 5001
    assert read_ordered(spark, root).columns == ["k", "v", "_metadata_"]


def test_files_that_are_read_in_several_splits_stay_in_order(spark, root):
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "4096")
    try:
        rows = read_ordered(spark, root, place="place")
        assert rows.rdd.getNumPartitions() > 7
        assert [r["place"] for r in rows.select("place").collect()] == list(range(1, 5002))
    finally:
        spark.conf.set(key, before)


def test_a_range_opens_only_its_files(spark, root):
    rows = read_range(spark, root, 1000, 1100)
    assert len(rows.inputFiles()) <= 2
    got = [r["k"] for r in rows.collect()]
    whole = [r["k"] for r in read_ordered(spark, root).where("k between 1000 and 1100").collect()]
    assert got == whole and got
    assert read_range(spark, root, 5000, 6000).count() == 0


def test_pages_follow_each_other(spark, root):
    pages = list(ordered_pages(spark, root))
    ends = [page.agg(F.min("k"), F.max("k")).first() for page in pages]
    assert len(pages) == 7 and all(a[1] <= b[0] for a, b in zip(ends[1:], ends[2:]))


def test_a_second_write_replaces_the_table(spark, tmp_path):
    path = str(tmp_path / "table")
    with pytest.raises(RuntimeError):
        read_ordered(spark, path)
    write_ordered(spark.range(10), path, ["id"], 3)
    write_ordered(spark.range(4).select((-F.col("id")).alias("id")), path, ["id"], 2)
    assert [r["id"] for r in read_ordered(spark, path).collect()] == [-3, -2, -1, 0]
    write_ordered(spark.range(0), path, ["id"])
    assert read_ordered(spark, path, place="n").collect() == []
