"""What the physical plans must and must not contain."""

import os
from contextlib import nullcontext

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registry
from tidemark import session
from tidemark.operators import history, matrix
from tidemark.operators.days import day_index, with_day
from tidemark.operators.ingest import in_window
from tidemark.registry import inputs
from tidemark.session import stage

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

LAZY = sorted(set(registry.queries()) - {"train_gbt", "score_candidates"})


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    plan = physical(registry.queries()[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval",
                     "BatchEvalPython"):
        assert operator not in plan


def test_day_index_reads_no_column(spark):
    plan = physical(registry.queries()["day_index"](spark, SF_DIR))
    assert "ReadSchema: struct<>" in plan


def test_lake_scan_reads_only_what_a_count_needs(spark):
    plan = physical(registry.queries()["hist_item_popularity"](spark, SF_DIR))
    assert "ReadSchema: struct<item_id:bigint>" in plan


def test_time_range_reaches_the_scan(spark, tmp_path):
    root = str(tmp_path / "log")
    inputs.daily_log(spark, SF_DIR).write.parquet(root)
    plan = physical(in_window(spark.read.parquet(root), inputs.DAILY))
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan


def test_matrix_deals_the_log_out_by_user_once(spark):
    """Windows, marks and negatives read one exchange by user; the touched rows move once more, by item."""
    counts = matrix.stage_day_counts(inputs.lake(spark, SF_DIR))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        built = matrix.build_matrix(counts, inputs.DAILY_FEATURES)
        built.collect()
        plan = physical(built)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
    dealt = [line for line in final.splitlines() if " Exchange hashpartitioning(" in line]
    exchanges = [line for line in dealt if "ReusedExchange" not in line]
    by_user = [line for line in exchanges if "(user_id#" in line]
    assert len(by_user) == 1 and "REPARTITION_BY_COL" in by_user[0]
    assert sum("ReusedExchange [user_id" in line for line in dealt) == 1
    # the touched rows; the item features that they meet have keys of other names
    by_item = [line for line in exchanges if "coalesce(item_id#" in line]
    assert len(by_item) == 1


def test_shuffles_grow_with_the_input(spark, monkeypatch):
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    size = os.path.getsize(f"{SF_DIR}/lineitem.parquet")
    assert session.input_bytes(lines) == size
    assert session.input_bytes(lines.join(lines.groupBy("l_partkey").count(), "l_partkey")) >= size
    assert session.input_bytes(spark.createDataFrame([(1,)], "a int")) < size
    with session.sized_for(lines):
        assert spark.conf.get(key) == before
    monkeypatch.setattr(session, "SHUFFLE_BYTES", size // 20)
    with session.sized_for(lines):
        assert spark.conf.get(key) in ("20", "21")
    monkeypatch.setattr(session, "MAX_SHUFFLE_PARTITIONS", 11)
    with session.sized_for(lines):
        assert spark.conf.get(key) == "11"
    assert spark.conf.get(key) == before


def test_partitions_of_a_job_are_not_merged_below_what_fits_its_input(spark, monkeypatch):
    """Compressed blocks say little about the rows that a sort holds."""
    lines = spark.read.parquet(f"{SF_DIR}/lineitem.parquet")
    monkeypatch.setattr(session, "SHUFFLE_BYTES", os.path.getsize(f"{SF_DIR}/lineitem.parquet") // 50)
    smallest = "spark.sql.adaptive.coalescePartitions.minPartitionSize"
    spark.conf.set(smallest, "1")
    try:
        with session.sized_for(lines):
            assert lines.select("l_orderkey").repartition("l_orderkey").rdd.getNumPartitions() > 24
        assert lines.select("l_orderkey").repartition("l_orderkey").rdd.getNumPartitions() <= 8
    finally:
        spark.conf.unset(smallest)


def test_users_are_read_once_when_none_is_hot(spark, monkeypatch):
    """With many rows but no hot user there is no second frame of hot users' rows."""
    key = "spark.tidemark.hotRows"
    spark.conf.set(key, "500")
    try:
        rows = [(u, i, i % 3, d, None, 1, 1) for u in range(40) for i in range(10) for d in (1, 2)]
        schema = "user_id long, item_id long, category_id long, day long, event_date date, n long, engaged long"
        pairs = stage(spark.createDataFrame(rows, schema), "pairs")
        counts = matrix.DayCounts(pairs, pairs, len(rows) * 1000, len(rows))
        assert matrix.may_have_hot_keys(spark, counts.pair_rows)
        assert len(matrix._by_user(counts, 2)) == 1
        hot = matrix.DayCounts(pairs.withColumn("user_id", F.lit(1)), pairs, len(rows), len(rows))
        assert len(matrix._by_user(hot, 2)) == 2
    finally:
        spark.conf.unset(key)


def test_joins_in_a_job_are_hashed_when_the_small_side_is_small(spark):
    """Measured at run time: with a zero threshold the same join is sort-merge."""
    left = spark.range(20000).select((F.col("id") % 500).alias("k"), "id").repartition(8, "id")
    right = spark.range(500).select(F.col("id").alias("k"), F.uuid().alias("v")).repartition(8, "v")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for expected, scope in (("ShuffledHashJoin", session.sized_for(left)),
                                ("SortMergeJoin", nullcontext())):
            with scope:
                joined = left.join(right, "k", "left")
                joined.collect()
                plan = physical(joined)
            final = plan[plan.index("Final Plan"):plan.index("Initial Plan")]
            assert expected in final
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_history_window_runs_over_day_counts(spark):
    """The hot key is combined before the shuffle; the window sees one row per key and day."""
    raw = inputs.lake(spark, SF_DIR)
    counts = history.day_counts(with_day(raw, day_index(raw)), "item_id")
    plan = physical(history.item_history(counts))
    top = plan.index("Window")
    assert "partial_count" in plan[top:]
