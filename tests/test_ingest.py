"""Log to lake."""

import datetime
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidemark.config import FeatureConfig, IngestConfig
from tidemark.functions.columns import local_event_date
from tidemark.operators import candidates, ingest
from tidemark.operators.skew import HOT_KEYS, hot_keys, skew_join
from tidemark.plans import run_bootstrap
from tidemark.plans.bootstrap import ingest as ingest_plan
from tidemark.registry import inputs
from tidemark.sources.log import (
    LOG_SCHEMA, file_accounts, read_csv_files, read_csv_log, read_raw_events, write_raw_partitions,
)

CFG = IngestConfig()


def log(spark, rows):
    return spark.createDataFrame(rows, LOG_SCHEMA)


def events_of(user, n, start=CFG.ts_min, step=60, item=100):
    return [(user, item + i, 1, "pv", start + i * step) for i in range(n)]


def test_bounds_are_inclusive_and_come_before_the_count(spark):
    rows = (
        events_of(1, 9) + [(1, 1, 1, "pv", CFG.ts_max)]  # ten, the last on the bound
        + events_of(2, 9) + [(2, 1, 1, "pv", CFG.ts_max + 1)]  # nine inside, one after
        + events_of(3, 9) + [(3, 1, 1, "pv", CFG.ts_min - 1)]  # nine inside, one before
        + events_of(4, 10)
        + events_of(5, 9)
        + events_of(6, 12, start=-2134949234)
    )
    found = ingest_plan(log(spark, rows), CFG)
    events, qualified = found.events, found.qualified
    assert {(r["user_id"], r["n"]) for r in qualified.collect()} == {(1, 10), (4, 10)}
    kept = events.collect()
    assert len(kept) == 20
    assert {r["event_date"] for r in kept} == {date(2017, 11, 25), date(2017, 12, 3)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_event_date_does_not_follow_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        rows = [(1511539199,), (1511539200,), (1512316799,), (1512316800,), (-2134949234,)]
        df = spark.createDataFrame(rows, "timestamp long")
        got = [r[0] for r in df.select(local_event_date("Asia/Shanghai")).collect()]
        assert got[:4] == [
            date(2017, 11, 24), date(2017, 11, 25), date(2017, 12, 3), date(2017, 12, 4)
        ]
        assert got[4] == date(1902, 5, 8)
        # New York changes to winter time on 2017-11-05 at 06:00 UTC
        summer = spark.createDataFrame([(1509854399,), (1509944399,), (1509944400,)], "timestamp long")
        dates = [r[0] for r in summer.select(local_event_date("America/New_York")).collect()]
        assert dates == [date(2017, 11, 4), date(2017, 11, 5), date(2017, 11, 6)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_csv_to_lake(spark, tmp_path):
    csv, lake = tmp_path / "log.csv", str(tmp_path / "lake")
    rows = events_of(1, 10) + events_of(3, 11, start=CFG.ts_min + 86400) + events_of(2, 9)
    csv.write_text("\n".join(",".join(map(str, r)) for r in rows) + "\n")
    source = read_csv_log(spark, str(csv))
    assert source.schema == LOG_SCHEMA
    assert run_bootstrap(source, lake) == {"qualified_users": 2, "parquet_files": 2}
    back = read_raw_events(spark, lake)
    assert dict(back.dtypes)["event_date"] == "date"
    assert sorted(tuple(r)[:5] for r in back.collect()) == sorted(r for r in rows if r[0] != 2)
    # a second run replaces the lake, dates that no longer occur included
    run_bootstrap(log(spark, events_of(1, 10)), lake)
    assert {r["event_date"] for r in read_raw_events(spark, lake).collect()} == {date(2017, 11, 25)}


def test_malformed_csv_fails(spark, tmp_path):
    csv = tmp_path / "log.csv"
    csv.write_text("1,2,3,pv,1511539200\n1,two,3,pv,1511539200\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|two"):
        read_csv_log(spark, str(csv)).collect()


def test_the_csv_is_read_once(spark, tmp_path):
    """Everything after the window comes from the table that was written from it."""
    csv = tmp_path / "log.csv"
    csv.write_text("\n".join(",".join(map(str, r)) for r in events_of(1, 12) + events_of(2, 3)))
    source = read_csv_log(spark, str(csv))
    assert len(source.inputFiles()) == 1
    found = ingest_plan(source, CFG)
    csv.unlink()
    assert found.users == found.qualified.count() == 1 and found.rows == 12
    assert found.events.count() == 12


def test_several_files_as_one_log(spark, tmp_path):
    """Files may overlap in time; the same rows under two names are refused, as is a path given twice."""

    def write(name, rows):
        path = tmp_path / name
        path.write_text("\n".join(",".join(map(str, r)) for r in rows))
        return str(path)

    one = write("one.csv", events_of(1, 6))
    two = write("two.csv", events_of(1, 6, step=11)[1:] + events_of(2, 3))
    copy = write("copy.csv", list(reversed(events_of(1, 6))))
    rows = read_csv_files(spark, [one, two])
    accounts = {r["file"].rsplit("/", 1)[1]: r for r in file_accounts(rows).collect()}
    assert {n: a["rows"] for n, a in accounts.items()} == {"one.csv": 6, "two.csv": 8}
    assert accounts["one.csv"]["first"] <= accounts["two.csv"]["last"]
    assert accounts["two.csv"]["first"] <= accounts["one.csv"]["last"]  # an overlapping pair
    lake_root = str(tmp_path / "lake")
    assert run_bootstrap(rows, lake_root, CFG)["qualified_users"] == 1
    assert read_raw_events(spark, lake_root).count() == 11
    with pytest.raises(ValueError, match="given twice"):
        read_csv_files(spark, [one, one + "/"])
    with pytest.raises(ValueError, match="copy.csv.*one.csv"):
        run_bootstrap(read_csv_files(spark, [one, two, copy]), lake_root, CFG)
    assert read_raw_events(spark, lake_root).count() == 11


def test_months_as_partitions(spark):
    cfg = IngestConfig(ts_min=0, ts_max=4_000_000_000, timezone="UTC", min_interactions=1, grain="month")
    rows = [(1, 1, 1, "pv", 1512000000), (1, 1, 1, "pv", 1512316799), (1, 1, 1, "pv", 1509494400)]
    got = {r["event_date"] for r in ingest.dated(log(spark, rows), cfg).collect()}
    assert got == {date(2017, 11, 1), date(2017, 12, 1)}


def test_heavy_users_are_kept_whole(spark):
    """One user with most rows, copies among them: the salted join keeps every row once."""
    rows = events_of(1, 300, step=7) + events_of(1, 1) * 50
    for user in range(2, 40):
        rows += events_of(user, 5 + user % 10)
    source = log(spark, rows)
    qualified = ingest.qualified_users(source, CFG).cache()
    salted = ingest.keep_qualified(source, qualified, CFG, hot_floor=20)
    plain = ingest.keep_qualified(source, qualified, CFG)
    assert "_salt" in salted._jdf.queryExecution().toString()
    assert "_salt" not in plain._jdf.queryExecution().toString()
    assert sorted(map(tuple, salted.collect())) == sorted(map(tuple, plain.collect()))
    assert salted.groupBy("user_id").count().where("user_id = 1").first()["count"] == 350


def test_copies_of_one_row_are_spread(spark):
    """A hot key made of copies only: the copies of different input partitions part ways."""
    left = spark.range(0, 8000, 1, 8).select(F.lit(1).alias("k"))
    right = spark.createDataFrame([(1, 5)], "k int, v int")
    counted = left.groupBy("k").agg(F.count("*").alias("n"))
    hot = hot_keys(counted, ["k"], "n", 8000, floor=500)
    joined = skew_join(left, right, ["k"], "inner", hot)
    assert joined.count() == 8000
    salted = joined._jdf.queryExecution().analyzed().toString()
    assert "SPARK_PARTITION_ID" in salted.upper()
    sizes = left.groupBy(
        F.pmod(F.xxhash64("k", F.spark_partition_id()), F.lit(16)).alias("part")
    ).count().collect()
    assert len(sizes) > 3


@pytest.mark.parametrize("how", ["left", "left_semi", "inner"])
def test_skew_join_equals_join(spark, how):
    r = random.Random(5)
    left = spark.createDataFrame(
        [(min(r.randrange(50), r.randrange(50)) % 20, r.randrange(3), i) for i in range(800)],
        "a long, b long, v long",
    )
    right = spark.createDataFrame(
        [(a, b, a * 10 + b) for a in range(15) for b in range(2)], "a long, b long, w long"
    )
    counted = left.groupBy("a", "b").agg(F.count("*").alias("n"))
    hot = hot_keys(counted, ["a", "b"], "n", left.count(), floor=10)
    assert hot.agg(F.max("_parts")).first()[0] > 1
    joined = skew_join(left, right, ["a", "b"], how, hot)
    plain = left.join(right, ["a", "b"], how)
    assert joined.columns == plain.columns
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, plain.collect()))


def test_hot_keys_are_bounded(spark):
    n = F.floor(F.lit(1_000_000) / (F.col("id") + 1))
    counted = spark.range(5000).select(F.col("id").alias("k"), n.alias("n"))
    total = counted.agg(F.sum("n")).first()[0]
    hot = hot_keys(counted, ["k"], "n", total, floor=1)
    assert 0 < hot.count() <= HOT_KEYS
    assert hot.agg(F.sum("_parts")).first()[0] <= 2 * HOT_KEYS
    assert hot_keys(counted, ["k"], "n", total, floor=total) is None


def test_large_dates_are_written_in_several_files(spark, tmp_path):
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    try:
        rows = spark.range(0, 60000, 1, 8).select(
            F.xxhash64("id").alias("user_id"), F.xxhash64("id", F.lit(1)).alias("item_id"),
            (F.col("id") % 7).alias("category_id"), F.lit("pv").alias("behavior_type"),
            (F.lit(CFG.ts_min) + F.col("id") % 86400).alias("timestamp"),
        )
        root = str(tmp_path / "lake")
        assert write_raw_partitions(ingest.dated(rows, CFG), root) > 3
        assert read_raw_events(spark, root).count() == 60000
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)


def test_all_dates_enter_the_lake(spark):
    folder = "/root/testdata/sf0.01"
    lake = inputs.lake(spark, folder)
    per_user = inputs.daily_log(spark, folder).groupBy("user_id").count().where("count >= 10")
    assert lake.count() == per_user.groupBy().sum("count").first()[0]
    assert lake.select("event_date").distinct().count() == 31


def test_a_long_popular_list_is_allowed(spark):
    cfg = FeatureConfig(top_popular=1500)
    rows = [(1, i, i, 1, datetime.date(2024, 1, 4), 4, 1) for i in range(1200)]
    rows += [(2, 7, 7, 1, datetime.date(2024, 1, 4), 4, 1)]
    columns = "user_id long, item_id long, category_id long, n long, event_date date, day int, engaged long"
    counts = spark.createDataFrame(rows, columns)
    popular = candidates.popular_items(counts, cfg.top_popular)
    found = candidates.unseen_popular(counts, popular, cfg).collect()
    assert sorted((r["user_id"], r["item_id"]) for r in found) == [(2, i) for i in range(1200) if i != 7]
