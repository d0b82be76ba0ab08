"""Boosted trees on the feature matrix: regression trees grown on cells, boosted round by round."""

from __future__ import annotations

from contextlib import closing

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import FEATURE_COLS, TrainConfig
from tidemark.operators.cells import (
    Boosted,
    DecisionTreeRegressor,
    Thresholds,
    blocks_of,
    count_cells,
    find_thresholds,
)
from tidemark.operators.trees import Forest, Tree
from tidemark.session import input_bytes, settings_of, sized_for, stage, staged_tables

# Stored bytes of training rows that a task has: the least that is worth a task, and the most. In between
# they are dealt to as many tasks as the cluster runs at a time. So are the cells that each round reads,
# by bounds of their own: the least is so many times as much, as a task that has all cells grows a tree
# in one job, and the most is less, as a stored cell is several times as large in a block.
LEAST_TASK_BYTES = 256 << 10
MOST_TASK_BYTES = 32 << 20
LEAST_CELLS = 8
MOST_CELL_BYTES = 4 << 20

# Blocks (some 3 MB each) that a worker is handed at a time.
BLOCKS_A_BATCH = 8


def assemble_features(matrix: DataFrame) -> DataFrame:
    """The matrix with the model input as one vector column."""
    return VectorAssembler(inputCols=list(FEATURE_COLS), outputCol="features").transform(matrix)


def _training_rows(matrix: DataFrame) -> DataFrame:
    """Features, and the label as -1 or 1."""
    return matrix.select(*FEATURE_COLS, (F.col("label").cast("double") * 2.0 - 1.0).alias("sign"))


def _parts(rows: DataFrame, least: int, most: int) -> int:
    size, cores = input_bytes(rows), rows.sparkSession.sparkContext.defaultParallelism
    return max(min(-(-size // least), cores), -(-size // most))


def _dealt(rows: DataFrame) -> DataFrame:
    """The rows in as many parts as training has tasks; a split may be one file, which one task reads."""
    parts = _parts(rows, LEAST_TASK_BYTES, MOST_TASK_BYTES)
    return rows.repartition(parts) if parts > 1 else rows


def _blocks(rows: DataFrame, thresholds: Thresholds) -> DataFrame:
    """The cells of the rows, in as many parts as a round has tasks."""
    with sized_for(rows):
        cells = stage(count_cells(rows, FEATURE_COLS, thresholds), "boost-cells")
    parts = _parts(cells, LEAST_CELLS * LEAST_TASK_BYTES, MOST_CELL_BYTES)
    dealt = cells.repartition(parts) if parts > 1 else cells.coalesce(1)
    return blocks_of(dealt, len(FEATURE_COLS))


def stopping_round(losses: list[float], patience: int) -> tuple[int, bool]:
    """The best round (from 1) and whether ``patience`` rounds without gain followed it."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            return best + 1, True
    return best + 1, False


def train_gbt(
    train: DataFrame, validation: DataFrame, cfg: TrainConfig = TrainConfig()
) -> tuple[Forest, list[float]]:
    """Grow trees until the validation loss has not fallen for ``patience`` rounds or the cap is reached.

    Returns the trees up to the best round and the loss of every round. No round is fitted twice: the
    margins of all cells are carried along and written down every ``rounds_per_table`` rounds, and each
    tree is grown on what they leave over. The rows are read for the thresholds and for the cells; what a
    round reads is the cells, dealt out once, and what it learns is worked out once.
    """
    with staged_tables(train.sparkSession):
        return _boosted(train, validation, cfg)


def _boosted(train: DataFrame, validation: DataFrame, cfg: TrainConfig) -> tuple[Forest, list[float]]:
    rows = stage(_dealt(_training_rows(train)), "boost-rows")
    thresholds = find_thresholds(assemble_features(rows), len(FEATURE_COLS), cfg.seed)
    learner = DecisionTreeRegressor(FEATURE_COLS, thresholds, cfg.max_depth)
    trees: list[Tree] = []
    losses: list[float] = []
    given = FEATURE_COLS, thresholds, cfg.rounds_per_table
    with (
        closing(Boosted(_blocks(rows, thresholds), *given)) as learning,
        closing(Boosted(_blocks(_training_rows(validation), thresholds), *given)) as held_out,
        settings_of(rows.sparkSession, {"spark.sql.execution.arrow.maxRecordsPerBatch": str(BLOCKS_A_BATCH)}),
    ):
        while len(trees) < cfg.max_rounds:
            # the fit reads its blocks once for each level
            learned = learning.learned(first=not trees).persist(StorageLevel.MEMORY_AND_DISK)
            try:
                nodes = learner.fit(learned)
            finally:
                learned.unpersist()
            trees.append(Tree(cfg.step_size if trees else 1.0, nodes))
            for side in (learning, held_out):
                side.add(trees[-1])
            losses.append(held_out.loss())
            if stopping_round(losses, cfg.patience)[1]:
                break
    return Forest(tuple(trees)).first(stopping_round(losses, cfg.patience)[0]), losses


def score(forest: Forest, matrix: DataFrame) -> DataFrame:
    """The matrix keys with ``score``, the probability of class 1."""
    keys = [c for c in matrix.columns if c not in FEATURE_COLS]
    return matrix.select(*keys, forest.probability().alias("score"))
