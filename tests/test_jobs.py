"""Model, audits and the four jobs in a row."""

import math

import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tidemark.config import TOP_K, IngestConfig, Splits, TrainConfig
from tidemark.operators import audits, model, trees
from tidemark.plans import run_bootstrap, run_features, run_inference, run_training
from tidemark.sources.log import LOG_SCHEMA
from tidemark.sources.matrices import read_matrices, read_split
from tidemark.sources.results import ResultTable
from tidemark.sources.runs import FAILED, RunRegistry

CFG = TrainConfig(max_rounds=12, rounds_per_table=4, patience=3)


@pytest.fixture(scope="module")
def roots(spark, tmp_path_factory):
    """A log in which users come back to the categories they engage with."""
    base = tmp_path_factory.mktemp("jobs")
    h = lambda salt, n: F.pmod(F.xxhash64(F.col("id"), F.lit(salt)), F.lit(n))
    user = h(1, 60)
    favourite = F.pmod(user * 7, F.lit(12))
    loyal = h(2, 10) < 6
    category = F.when(loyal, favourite).otherwise(h(3, 12))
    behavior = F.when(loyal & (h(4, 10) < 5), "buy").when(h(4, 10) < 1, "fav").otherwise("pv")
    log = spark.range(6000).select(
        user.alias("user_id"),
        (category * 10 + h(5, 10) + 1).alias("item_id"),
        category.alias("category_id"),
        behavior.alias("behavior_type"),
        (F.lit(IngestConfig().ts_min) + h(6, 9 * 86400)).alias("timestamp"),
    )
    paths = {n: str(base / n) for n in ("lake", "matrices", "registry", "results")}
    run_bootstrap(spark.createDataFrame(log.collect(), LOG_SCHEMA), paths["lake"])
    run_features(spark, paths["lake"], paths["matrices"])
    return paths


@pytest.fixture(scope="module")
def trained(spark, roots):
    return run_training(spark, roots["matrices"], roots["registry"], CFG)


def test_training_reports_metrics_and_sizes(spark, roots, trained):
    assert 0.5 < trained["test_auc_roc"] <= 1.0
    for split in ("train", "val", "test"):
        assert trained[f"n_{split}"] == read_split(spark, roots["matrices"], split).count()
    registry = RunRegistry(spark, roots["registry"])
    logged = {r["key"]: r["value"] for r in registry.metrics().collect()}
    assert logged == {k: v for k, v in trained.items() if k.startswith("test_")}
    assert registry.latest_run_id() == trained["run_id"]


def test_failed_training_is_recorded(spark, roots, tmp_path):
    with pytest.raises(Exception):
        run_training(spark, str(tmp_path / "nothing"), str(tmp_path / "registry"), CFG)
    registry = RunRegistry(spark, str(tmp_path / "registry"))
    assert [r["status"] for r in registry.runs().collect()] == [FAILED]


def test_inference_fills_the_table_and_repeats_cleanly(spark, roots, trained):
    infer = read_split(spark, roots["matrices"], "infer")
    users = infer.select("user_id").distinct().count()
    first = run_inference(spark, roots["matrices"], roots["registry"], roots["results"])
    assert first == {"run_id": trained["run_id"], "users": users, "persisted": users}
    table = ResultTable(spark, roots["results"])
    before = {r["user_id"]: r["recommended_items"] for r in table.read().collect()}
    run_inference(spark, roots["matrices"], roots["registry"], roots["results"])
    assert {r["user_id"]: r["recommended_items"] for r in table.read().collect()} == before
    audit = audits.results(table.read(), TOP_K).first().asDict()
    assert audit.pop("rows") == audit.pop("users") == users
    assert set(audit.values()) == {0}
    touched = {(r["user_id"], r["item_id"]) for r in infer.collect()}
    assert {(u, i["item_id"]) for u, items in before.items() for i in items} <= touched


def test_audits_of_sound_matrices(spark, roots):
    rows = read_matrices(spark, roots["matrices"])
    assert all(r["as_expected"] for r in audits.split_days(rows, Splits()).collect())
    assert all(r["shared_dates"] == 0 for r in audits.split_overlaps(rows).collect())
    assert all(r["sound"] for r in audits.labels(rows).collect())


def test_audits_see_faults(spark, roots):
    rows = read_matrices(spark, roots["matrices"])
    moved = rows.withColumn("split", F.when(F.col("day") == 6, "val").otherwise(F.col("split")))
    mixed = rows.withColumn(
        "split", F.when((F.col("day") == 6) & (F.col("label") == 0), "val").otherwise(F.col("split"))
    )
    found = {r["split"]: r["as_expected"] for r in audits.split_days(moved, Splits()).collect()}
    assert found == {"train": False, "val": False, "test": True, "infer": True}
    shared = {r["splits"]: r["shared_dates"] for r in audits.split_overlaps(mixed).collect()}
    assert shared["train/val"] == 1 and sum(shared.values()) == 1
    labelled = rows.withColumn("label", F.coalesce("label", F.lit(0)))
    sound = {r["split"]: r["sound"] for r in audits.labels(labelled).collect()}
    assert sound == {"train": True, "val": True, "test": True, "infer": False}


def test_audits_list_what_is_missing(spark, roots):
    rows = read_matrices(spark, roots["matrices"])
    short = rows.where("split <> 'infer'")
    found = {r["split"]: (list(r["days"]), r["as_expected"]) for r in audits.split_days(short, Splits()).collect()}
    assert found == {"train": ([4, 5, 6], True), "val": ([7], True), "test": ([8], True), "infer": ([], False)}
    sound = {r["split"]: r["sound"] for r in audits.labels(short).collect()}
    assert sound == {"train": True, "val": True, "test": True, "infer": False}
    negatives = rows.where("not (split = 'train' and label = 1)")
    sound = {r["split"]: r["sound"] for r in audits.labels(negatives).collect()}
    assert sound == {"train": False, "val": True, "test": True, "infer": True}
    strange = rows.withColumn("split", F.when(F.col("split") == "val", "dev").otherwise(F.col("split")))
    found = {r["split"]: r["as_expected"] for r in audits.split_days(strange, Splits()).collect()}
    assert found == {"train": True, "val": False, "test": True, "infer": True, "dev": False}


def test_lake_audit_sees_unqualified_rows(spark):
    cfg = IngestConfig()
    raw = spark.createDataFrame(
        [(1, 1, 1, "pv", cfg.ts_min), (2, 1, 1, "pv", cfg.ts_max + 1), (2, 1, 1, "pv", cfg.ts_max)],
        LOG_SCHEMA,
    ).withColumn("event_date", F.lit("2017-11-25").cast("date"))
    qualified = spark.createDataFrame([(1,)], "user_id long")
    got = audits.lake(raw, qualified, cfg).first()
    assert (got["rows"], got["users"]) == (3, 2)
    assert (got["unqualified_rows"], got["rows_outside_window"]) == (2, 1)


def test_stopping_round():
    assert model.stopping_round([0.9, 0.8, 0.7], 3) == (3, False)
    assert model.stopping_round([0.9, 0.8, 0.85, 0.84, 0.83, 0.1], 3) == (2, True)
    assert model.stopping_round([0.9, 0.8, 0.85, 0.84, 0.79, 0.1], 3) == (6, False)
    assert model.stopping_round([0.5, 0.5, 0.5], 2) == (1, True)


def library_booster(rows, rounds, cfg):
    labelled = model.assemble_features(rows).select(F.col("label").cast("double").alias("label"), "features")
    return GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=cfg.max_depth,
        stepSize=cfg.step_size, seed=cfg.seed,
    ).fit(labelled), labelled


def test_growing_trees_equal_the_library_s_booster(spark, roots):
    """The same trees, weights, losses and scores as a fit of the whole number of rounds."""
    train, val = (read_split(spark, roots["matrices"], s) for s in ("train", "val"))
    cfg = TrainConfig(max_rounds=4, rounds_per_table=2, patience=4)
    forest, losses = model.train_gbt(train, val, cfg)
    whole, _ = library_booster(train, 4, cfg)
    held_out = model.assemble_features(val).select(F.col("label").cast("double").alias("label"), "features")
    assert losses == pytest.approx(whole.evaluateEachIteration(held_out), abs=1e-9)
    assert [t.weight for t in forest.trees] == list(whole.treeWeights)[: len(forest.trees)]
    fitted, _ = library_booster(train, len(forest.trees), cfg)
    theirs = fitted.transform(model.assemble_features(val)).select(
        vector_to_array("probability")[1].alias("p"))
    ours = model.score(forest, val)
    assert sorted(r["score"] for r in ours.collect()) == pytest.approx(sorted(r["p"] for r in theirs.collect()), abs=1e-9)


def test_no_round_is_fitted_twice_and_the_best_one_is_kept(spark, roots, monkeypatch):
    fits = []
    plain = model.DecisionTreeRegressor.fit
    monkeypatch.setattr(model.DecisionTreeRegressor, "fit", lambda self, rows: fits.append(1) or plain(self, rows))
    train, val = (read_split(spark, roots["matrices"], s) for s in ("train", "val"))
    long, losses = model.train_gbt(train, val, CFG)
    best, stopped = model.stopping_round(losses, CFG.patience)
    assert len(fits) == len(losses) <= CFG.max_rounds and len(long.trees) == best
    assert stopped or len(losses) == CFG.max_rounds
    # fewer rounds are a prefix of more
    short, few = model.train_gbt(train, val, TrainConfig(max_rounds=2, patience=3, rounds_per_table=1))
    assert few == pytest.approx(losses[:2], abs=1e-12)
    assert short.trees == long.trees[: len(short.trees)]


def plain_score(forest, row):
    margin = 0.0
    for tree in forest.trees:
        by_number = {n.node: n for n in tree.nodes}
        node = tree.nodes[0]
        while node.feature is not None:
            node = by_number[node.left if row[node.feature] <= node.threshold else node.right]
        margin += tree.weight * node.value
    return 1 / (1 + math.exp(-2 * margin))


def test_scores_come_from_the_stored_nodes(spark, roots, trained, tmp_path):
    registry = RunRegistry(spark, roots["registry"])
    forest = trees.read_forest(spark, registry.model_path(trained["run_id"]))
    trees.write_forest(spark, forest, str(tmp_path / "nodes"))
    assert trees.read_forest(spark, str(tmp_path / "nodes")) == forest
    rows = read_split(spark, roots["matrices"], "infer")
    scored = model.score(forest, rows)
    assert "Python" not in scored._jdf.queryExecution().executedPlan().toString()
    keys = ("user_id", "item_id", "category_id", "day")
    got = {tuple(r[k] for k in keys): r["score"] for r in scored.collect()}
    want = {tuple(r[k] for k in keys): plain_score(forest, r) for r in rows.collect()}
    assert got == pytest.approx(want, abs=1e-12)


def test_command_line(spark, roots, trained, tmp_path):
    from tidemark.__main__ import run

    counts = run(spark, ["features", "--lake", roots["lake"], "--matrices", str(tmp_path / "m")])
    assert counts["infer"] == read_split(spark, roots["matrices"], "infer").count()
    results = str(tmp_path / "results")
    done = run(spark, ["infer", "--matrices", roots["matrices"], "--registry", roots["registry"],
                       "--results", results, "--top-k", "2"])
    user = ResultTable(spark, results).read().first()["user_id"]
    answer = run(spark, ["lookup", "--results", results, "--user", str(user)])
    assert done["users"] > 0 and 1 <= len(answer["recommended_items"]) <= 2
    with pytest.raises(SystemExit):
        run(spark, ["lookup", "--results", results, "--user", "-5"])


def test_rows_of_one_file_are_dealt_to_several_tasks(spark, roots, monkeypatch):
    """A split may be one file, which one task would read in each round."""
    parts = []
    plain = model.DecisionTreeRegressor.fit
    monkeypatch.setattr(
        model.DecisionTreeRegressor, "fit",
        lambda self, rows: parts.append((rows.rdd.getNumPartitions(), rows.is_cached)) or plain(self, rows),
    )
    monkeypatch.setattr(model, "LEAST_TASK_BYTES", 1)
    train, val = (read_split(spark, roots["matrices"], s).coalesce(1) for s in ("train", "val"))
    _, losses = model.train_gbt(train, val, TrainConfig(max_rounds=2, rounds_per_table=1))
    assert parts == [(spark.sparkContext.defaultParallelism, True)] * 2
    assert len(losses) == 2 and losses[1] < losses[0]
