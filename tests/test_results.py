"""Ranking, the result table, lookups, runs and metrics."""

import json
import math
import random
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.functions import recommendations
from tidemark.operators import audits, metrics, ranking
from tidemark.sources.manifest import ConcurrentWriteError
from tidemark.sources.results import RESULT_SCHEMA, ResultTable, lookup_recommendations, repeated_keys
from tidemark.sources.runs import RUN_SCHEMA, RunRegistry, latest_finished_run

SCORED = "user_id long, item_id long, score double"


def lists(spark, table):
    rows = [(u, [(i, s) for i, s in items]) for u, items in table.items()]
    return spark.createDataFrame(
        rows, "user_id long, recommended_items array<struct<item_id:bigint,score:double>>"
    )


def content(df):
    return {r["user_id"]: [(i["item_id"], i["score"]) for i in r["recommended_items"]] for r in df.collect()}


def test_top_k_orders_ties_by_item_and_cuts(spark):
    rows = [(1, i, 0.5) for i in (8, 3, 5)] + [(1, 9, 0.9), (2, 4, 0.1)]
    top = ranking.top_k(spark.createDataFrame(rows, SCORED), 3)
    assert content(ranking.recommendation_lists(top)) == {
        1: [(9, 0.9), (3, 0.5), (5, 0.5)], 2: [(4, 0.1)]
    }


def test_top_k_is_limited_before_the_shuffle(spark):
    top = ranking.top_k(spark.range(100).select(
        (F.col("id") % 3).alias("user_id"), F.col("id").alias("item_id"), F.rand(1).alias("score")
    ))
    assert "WindowGroupLimit" in top._jdf.queryExecution().executedPlan().toString()


def test_list_longer_than_nine_keeps_rank_order(spark):
    rows = [(1, i, 1.0 - i / 100) for i in range(30)]
    got = content(ranking.recommendation_lists(ranking.top_k(spark.createDataFrame(rows, SCORED), 12)))
    assert [i for i, _ in got[1]] == list(range(12))


def test_json_round_trip(spark):
    df = lists(spark, {1: [(7, 0.25), (8, 1e-9)], 2: [(9, 1.0)]})
    text = df.select("user_id", recommendations.to_json().alias("j"))
    first = json.loads(text.where("user_id = 1").first()["j"])
    assert first == [{"item_id": 7, "score": 0.25}, {"item_id": 8, "score": 1e-9}]
    back = text.select("user_id", recommendations.from_json("j").alias("recommended_items"))
    assert content(back) == content(df)
    bad = spark.createDataFrame([(1, "[{")], "user_id long, j string")
    with pytest.raises(Exception):
        bad.select(recommendations.from_json("j")).collect()


def test_upsert(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "results"))
    with pytest.raises(RuntimeError):
        table.read()
    table.create()
    table.create()
    assert table.read().count() == 0
    assert table.read().dtypes == [(f.name, f.dataType.simpleString()) for f in RESULT_SCHEMA]

    def at(stamp):
        return F.lit(stamp).cast("timestamp")

    table.upsert(lists(spark, {1: [(10, 0.5)], 2: [(20, 0.5)]}), at("2020-01-01 00:00:00"))
    table.upsert(lists(spark, {2: [(21, 0.9)], 3: [(30, 0.1)]}), at("2020-01-02 00:00:00"))
    assert content(table.read()) == {1: [(10, 0.5)], 2: [(21, 0.9)], 3: [(30, 0.1)]}
    stamps = {r["user_id"]: str(r["s"]) for r in table.read().select(
        "user_id", F.col("updated_at").cast("string").alias("s")).collect()}
    assert stamps == {1: "2020-01-01 00:00:00", 2: "2020-01-02 00:00:00", 3: "2020-01-02 00:00:00"}
    # the same batch again changes nothing but the stamp, and nobody is lost
    table.upsert(lists(spark, {2: [(21, 0.9)], 3: [(30, 0.1)]}), at("2020-01-03 00:00:00"))
    assert content(table.read()) == {1: [(10, 0.5)], 2: [(21, 0.9)], 3: [(30, 0.1)]}
    audit = audits.results(table.read(), 10).first().asDict()
    assert audit == {
        "rows": 3, "users": 3, "repeated_users": 0, "null_lists": 0,
        "empty_lists": 0, "long_lists": 0, "lists_with_bad_items": 0,
    }


def test_a_write_that_did_not_commit_is_not_read(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "results"))
    table.upsert(lists(spark, {1: [(10, 0.5)]}))
    left_over = tmp_path / "results" / "data" / "cut-off" / "bucket=1"
    left_over.mkdir(parents=True)
    (left_over / "part-0.parquet").write_text("cut off")
    (tmp_path / "results" / "_manifests" / "draft-1").write_text("{")
    assert content(table.read()) == {1: [(10, 0.5)]}
    table.upsert(lists(spark, {2: [(20, 0.5)]}))
    assert set(content(table.read())) == {1, 2}


def data_files(table):
    return {f for files in table.bucket_files().values() for f in files}


def test_old_versions_are_dropped(spark, tmp_path):
    root = tmp_path / "results"
    table = ResultTable(spark, str(root), keep=1, buckets=2)
    for user in range(1, 9):
        table.upsert(lists(spark, {user: [(user, 0.5)]}))
    assert table.versions() == [8]
    assert set(content(table.read())) == set(range(1, 9))
    stored = {str(p.relative_to(root)) for p in root.glob("data/**/*.parquet")}
    assert stored == data_files(table) and len(stored) == 2
    assert len(list((root / "data").iterdir())) <= 2


def test_an_upsert_rewrites_touched_buckets_only(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "results"), buckets=8)
    table.upsert(lists(spark, {u: [(u, 0.5)] for u in range(100)}))
    before = table.bucket_files()
    assert set(before) == set(range(8)) and all(len(f) == 1 for f in before.values())
    table.upsert(lists(spark, {7: [(70, 0.9)]}))
    after = table.bucket_files()
    changed = [b for b in before if before[b] != after[b]]
    assert len(changed) == 1 and set(after) == set(before)
    assert content(table.read()) == {u: [(70, 0.9)] if u == 7 else [(u, 0.5)] for u in range(100)}
    for files in after.values():
        users = [r[0] for r in spark.read.parquet(f"{table.root}/{files[0]}").select("user_id").collect()]
        assert users == sorted(users)


def test_a_lookup_opens_one_file(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "results"), buckets=8)
    table.upsert(lists(spark, {u: [(u, 0.5)] for u in range(100)}))
    for user in (0, 42, 99):
        found = table.find(user)
        assert len(found.inputFiles()) == 1
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "EqualTo(user_id," in plan
        assert content(found) == {user: [(user, 0.5)]}
    assert table.lookup(100) is None
    empty = ResultTable(spark, str(tmp_path / "none"))
    empty.create()
    assert empty.lookup(1) is None


def test_a_repeated_user_is_refused(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "results"))
    table.upsert(lists(spark, {1: [(10, 0.5)]}))
    twice = lists(spark, {1: [(11, 0.5)], 2: [(20, 0.5)]}).unionByName(lists(spark, {2: [(21, 0.5)]}))
    assert [tuple(r) for r in repeated_keys(twice).collect()] == [(2, 2)]
    with pytest.raises(Exception, match="user_id is not unique: 2"):
        table.upsert(twice)
    assert content(table.read()) == {1: [(10, 0.5)]}
    assert len(list((tmp_path / "results" / "data").iterdir())) == 1


def test_of_two_writers_one_is_refused(spark, tmp_path, monkeypatch):
    root = str(tmp_path / "results")
    first, second = ResultTable(spark, root), ResultTable(spark, root)
    first.upsert(lists(spark, {1: [(10, 0.5)]}))
    merged = first._merged

    def slow(*args):
        out = merged(*args)
        second.upsert(lists(spark, {2: [(20, 0.5)]}))
        return out

    monkeypatch.setattr(first, "_merged", slow)
    with pytest.raises(ConcurrentWriteError):
        first.upsert(lists(spark, {2: [(99, 0.1)], 3: [(30, 0.5)]}))
    assert content(second.read()) == {1: [(10, 0.5)], 2: [(20, 0.5)]}
    monkeypatch.undo()
    first.upsert(lists(spark, {3: [(30, 0.5)]}))
    assert set(content(second.read())) == {1, 2, 3}


def test_writers_side_by_side_lose_nothing(spark, tmp_path):
    """Threads that try until they are let in; every committed batch is in the table."""
    root = str(tmp_path / "results")
    ResultTable(spark, root).create()

    def write(user):
        refused = 0
        while True:
            try:
                ResultTable(spark, root, keep=20, buckets=4).upsert(lists(spark, {user: [(user, 0.5)]}))
                return refused
            except ConcurrentWriteError:
                refused += 1

    with ThreadPoolExecutor(3) as pool:
        list(pool.map(write, range(6)))
    table = ResultTable(spark, root)
    assert set(content(table.read())) == set(range(6)) and table.versions()[-1] == 6


def test_null_list_is_refused(spark, tmp_path):
    table = ResultTable(spark, str(tmp_path / "results"))
    bad = spark.createDataFrame([(1, None)], lists(spark, {1: [(1, 1.0)]}).schema)
    with pytest.raises(Exception, match="recommended_items is null"):
        table.upsert(bad)
    assert table.read().count() == 0


def test_results_audit_counts_faults(spark):
    rows = [(1, [(0, 0.5)], None), (1, [(2, 0.5)] * 3, None), (2, [], None)]
    faulty = spark.createDataFrame(rows, RESULT_SCHEMA)
    audit = audits.results(faulty, 2).first().asDict()
    assert audit == {
        "rows": 3, "users": 2, "repeated_users": 1, "null_lists": 0,
        "empty_lists": 1, "long_lists": 1, "lists_with_bad_items": 1,
    }


def test_lookup_reports_misses_and_keeps_repeats(spark):
    results = lists(spark, {1: [(10, 0.5)], 2: [(20, 0.5)]})
    requests = spark.createDataFrame([(1,), (1,), (9,)], "user_id long")
    got = sorted((r["user_id"], r["found"], r["recommended_items"] is not None)
                 for r in lookup_recommendations(results, requests).collect())
    assert got == [(1, True, True), (1, True, True), (9, False, False)]


def runs(spark, statuses):
    start = datetime(2024, 1, 1)
    return spark.createDataFrame(
        [(f"r{i:02d}", start + timedelta(hours=i), s) for i, s in enumerate(statuses)], RUN_SCHEMA
    )


def test_latest_finished_run(spark):
    got = latest_finished_run(runs(spark, ["FINISHED"] * 5 + ["FAILED"] * 3)).collect()
    assert [r["run_id"] for r in got] == ["r04"]


def test_a_finished_run_behind_ten_failed_ones_is_not_found(spark, tmp_path):
    assert latest_finished_run(runs(spark, ["FINISHED"] + ["FAILED"] * 10)).count() == 0
    assert latest_finished_run(runs(spark, ["FINISHED"] + ["FAILED"] * 9)).count() == 1
    registry = RunRegistry(spark, str(tmp_path))
    with pytest.raises(RuntimeError):
        registry.latest_run_id()


LABELLED = "label int, score double"


def brute_auc(rows):
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return wins / (len(pos) * len(neg))


@pytest.mark.parametrize("slices", [1, 3, 8, 40])
def test_auc_equals_pairwise_count(spark, slices):
    r = random.Random(slices)
    rows = [(int(r.random() < 0.3), round(r.random() ** 3, 2)) for _ in range(500)]
    rows += [(r.randrange(2), 0.5) for _ in range(200)]  # one score holds a third of the rows
    got = metrics.auc_roc(spark.createDataFrame(rows, LABELLED), slices=slices).first()[0]
    assert got == pytest.approx(brute_auc(rows), abs=1e-12)


def test_auc_has_no_unpartitioned_window(spark):
    rows = spark.createDataFrame([(1, 0.5), (0, 0.4)], LABELLED)
    plan = metrics.auc_roc(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert "windowspecdefinition(slice" in plan


def test_auc_of_one_class_is_null(spark):
    for label in (0, 1):
        df = spark.createDataFrame([(label, 0.2), (label, 0.7)], LABELLED)
        assert metrics.auc_roc(df).first()[0] is None


def test_log_loss_clips(spark):
    rows = [(1, 0.0), (0, 1.0), (1, 0.8), (0, 0.3)]
    eps = 2.220446049250313e-16
    clipped = [(y, min(max(p, eps), 1 - eps)) for y, p in rows]
    expected = -sum(y * math.log(p) + (1 - y) * math.log(1 - p) for y, p in clipped) / len(rows)
    got = metrics.log_loss(spark.createDataFrame(rows, LABELLED)).first()[0]
    assert got == pytest.approx(expected, rel=1e-12)


def test_class_metrics_without_predicted_positives_are_zero(spark):
    got = metrics.classification_metrics(
        spark.createDataFrame([(1, 0.1), (0, 0.2), (0, 0.49)], LABELLED)
    ).first()
    assert tuple(got) == (0.0, 0.0, 0.0, pytest.approx(2 / 3))


def test_class_metrics(spark):
    rows = [(1, 0.9), (1, 0.5), (1, 0.2), (0, 0.6), (0, 0.1)]
    got = metrics.classification_metrics(spark.createDataFrame(rows, LABELLED)).first()
    assert got["precision"] == pytest.approx(2 / 3)
    assert got["recall"] == pytest.approx(2 / 3)
    assert got["f1"] == pytest.approx(2 / 3)
    assert got["accuracy"] == pytest.approx(3 / 5)


def test_metrics_in_long_form(spark):
    row = metrics.evaluate(spark.createDataFrame([(1, 0.9), (0, 0.4)], LABELLED))
    long = {r["key"]: r["value"] for r in metrics.long_form(row, "x").collect()}
    assert set(long) == set(metrics.TEST_METRICS)
    assert long["test_auc_roc"] == 1.0 and long["test_accuracy"] == 1.0
