"""Trees grown on cells: as many for copies of rows, and the same trees as grown on rows."""

import numpy as np
import pytest
from pyspark.ml.classification import GBTClassifier
from pyspark.sql import functions as F

from tidemark.config import FEATURE_COLS, TrainConfig
from tidemark.operators import cells, model

SCHEMA = ", ".join(f"{c} double" for c in FEATURE_COLS) + ", label int"
CFG = TrainConfig(max_rounds=3, rounds_per_table=2, patience=3)


def matrix(spark, rows, seed):
    """Features with few and with many values, no two of which divide the rows alike."""
    rng = np.random.default_rng(seed)
    table = np.column_stack(
        [rng.integers(0, top, rows) if top else rng.normal(size=rows) for top in (3, 8, 5, 0, 90, 0, 12, 4, 2)]
    )
    label = (table[:, 0] + table[:, 3] + (table[:, 4] > 30) * (table[:, 7] - 1) + rng.normal(size=rows) > 1.5)
    found = [(*map(float, values), int(one)) for values, one in zip(table, label)]
    return spark.createDataFrame(found, SCHEMA).coalesce(1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("cells")
    out = {}
    for name, rows, seed in (("small", 600, 1), ("large", 12_000, 2), ("val", 300, 3)):
        matrix(spark, rows, seed).write.parquet(f"{root}/{name}")
        out[name] = spark.read.parquet(f"{root}/{name}")
    return out


def close(one, other):
    """Two forests with the same splits and, but for rounding, the same values."""
    nodes = [[(n.feature, n.threshold, n.left, n.right) for t in f.trees for n in t.nodes] for f in (one, other)]
    values = [[n.value for t in f.trees for n in t.nodes] for f in (one, other)]
    return nodes[0] == nodes[1] and values[0] == pytest.approx(values[1], abs=1e-12)


@pytest.mark.parametrize("name", ["small", "large"])
def test_losses_equal_the_library_s_where_rows_are_sampled_for_thresholds_too(spark, tables, name):
    train, val = tables[name], tables["val"]
    forest, losses = model.train_gbt(train, val, CFG)
    labelled = [
        model.assemble_features(rows).select(F.col("label").cast("double").alias("label"), "features")
        for rows in (train, val)
    ]
    library = GBTClassifier(
        featuresCol="features", labelCol="label", maxIter=3, maxDepth=CFG.max_depth, stepSize=CFG.step_size,
        seed=CFG.seed,
    ).fit(labelled[0])
    assert losses == pytest.approx(library.evaluateEachIteration(labelled[1]), abs=1e-9)
    assert len(forest.trees) == 3


def test_a_round_s_work_follows_the_cells_and_not_the_rows(spark, tables, monkeypatch):
    """Copies of rows are a weight of their cells: no more is read in a round, and the trees are the same."""
    seen = []
    plain = model.DecisionTreeRegressor.fit

    def fit(self, rows):
        blocks = [(len(r["weight"]) // 8, np.frombuffer(r["weight"]).sum()) for r in rows.collect()]
        seen.append(tuple(map(sum, zip(*blocks))))
        return plain(self, rows)

    monkeypatch.setattr(model.DecisionTreeRegressor, "fit", fit)
    train = tables["small"]
    copies = train.crossJoin(spark.range(10)).drop("id")
    one, _ = model.train_gbt(train, tables["val"], CFG)
    ten, _ = model.train_gbt(copies, tables["val"], CFG)
    assert [count for count, _ in seen] == [seen[0][0]] * 6
    assert [weight for _, weight in seen] == [600] * 3 + [6000] * 3
    assert close(one, ten)


def test_trees_do_not_depend_on_how_the_cells_are_dealt(spark, tables, monkeypatch):
    """One task, many tasks, sums added up in two steps, and a level in several passes."""
    one, losses = model.train_gbt(tables["small"], tables["val"], CFG)
    for module, name, value in ((model, "LEAST_TASK_BYTES", 1), (cells, "FAN_IN", 2), (cells, "NODES_A_PASS", 1)):
        monkeypatch.setattr(module, name, value)
        other, again = model.train_gbt(tables["small"], tables["val"], CFG)
        assert close(one, other) and again == pytest.approx(losses, abs=1e-12)


def test_unknown_values_of_the_held_out_rows_go_right_and_unknown_labels_do_not_count(spark, tables):
    train, val = tables["small"], tables["val"].limit(40)
    largest = val.select(*(F.lit(1e9).alias(c) for c in FEATURE_COLS), "label")
    unknown = val.select(*(F.lit(None).cast("double").alias(c) for c in FEATURE_COLS), "label")
    unlabelled = val.withColumn("label", F.lit(None).cast("int"))
    _, losses = model.train_gbt(train, largest, CFG)
    _, others = model.train_gbt(train, unknown.unionByName(unlabelled), CFG)
    assert others == pytest.approx(losses, abs=1e-12)


def test_rows_to_train_on_are_there_and_labelled(spark, tables):
    train = tables["small"]
    with pytest.raises(ValueError, match="no rows"):
        model.train_gbt(train.limit(0), tables["val"], CFG)
    with pytest.raises(ValueError, match="600 rows to train on have no label"):
        model.train_gbt(train.withColumn("label", F.lit(None).cast("int")), tables["val"], CFG)


def test_a_tree_without_a_split_is_the_mean(spark, tables):
    train = tables["small"]
    forest, _ = model.train_gbt(train, tables["val"], TrainConfig(max_rounds=1, max_depth=0))
    mean = train.agg(F.avg(F.col("label") * 2.0 - 1.0)).first()[0]
    (tree,) = forest.trees
    assert len(tree.nodes) == 1 and tree.nodes[0].value == pytest.approx(mean, abs=1e-12)
    alike = train.select(*(F.lit(3.0).alias(c) for c in FEATURE_COLS), "label")
    forest, _ = model.train_gbt(alike, tables["val"], TrainConfig(max_rounds=1))
    assert [n.feature for n in forest.trees[0].nodes] == [None]
