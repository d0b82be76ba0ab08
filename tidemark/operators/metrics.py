"""Exact binary classification metrics as single-row DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import THRESHOLD

# Fixed value: probabilities are clipped by the double precision epsilon before the log.
LOG_LOSS_CLIP = 2.220446049250313e-16

# Names under which a run reports its metrics.
TEST_METRICS = (
    "test_auc_roc",
    "test_logloss",
    "test_precision",
    "test_recall",
    "test_f1",
    "test_accuracy",
)


def auc_roc(
    scored: DataFrame, label: str = "label", score: str = "score", slices: int | None = None
) -> DataFrame:
    """Area under the ROC curve, ties counted half; null when a class is missing.

    The rows collapse to one per distinct score before any ordering. Those are cut into
    score ranges, wins are counted inside each range in parallel, and the ranges (at most
    ``slices`` of them) are chained by the number of negatives below each.
    """
    if slices is None:
        slices = int(scored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    by_score = scored.groupBy(F.col(score).alias("s")).agg(
        F.sum(F.col(label)).cast("double").alias("pos"),
        F.sum(1 - F.col(label)).cast("double").alias("neg"),
    )
    sliced = by_score.repartitionByRange(slices, "s").withColumn("slice", F.spark_partition_id())
    below = Window.partitionBy("slice").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    neg_below = F.coalesce(F.sum("neg").over(below), F.lit(0.0))
    per_slice = (
        sliced.withColumn("wins", F.col("pos") * (neg_below + F.col("neg") / 2))
        .groupBy("slice")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.sum("wins").alias("wins"))
    )
    chain = F.aggregate(
        F.array_sort(F.collect_list(F.struct("slice", "pos", "neg", "wins"))),
        F.struct(
            F.lit(0.0).alias("pos"), F.lit(0.0).alias("neg"), F.lit(0.0).alias("wins")
        ),
        lambda acc, x: F.struct(
            (acc["pos"] + x["pos"]).alias("pos"),
            (acc["neg"] + x["neg"]).alias("neg"),
            (acc["wins"] + x["wins"] + x["pos"] * acc["neg"]).alias("wins"),
        ),
    )
    total = per_slice.agg(chain.alias("t"))
    return total.select(
        F.try_divide(F.col("t.wins"), F.col("t.pos") * F.col("t.neg")).alias("auc_roc")
    )


def log_loss_column(label: str = "label", score: str = "score") -> Column:
    """Mean negative log likelihood, as an aggregate."""
    p = F.least(F.greatest(F.col(score), F.lit(LOG_LOSS_CLIP)), F.lit(1.0 - LOG_LOSS_CLIP))
    y = F.col(label)
    return -F.avg(y * F.log(p) + (1 - y) * F.log(1.0 - p))


def log_loss(scored: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return scored.agg(log_loss_column(label, score).alias("log_loss"))


def class_columns(
    label: str = "label", score: str = "score", threshold: float = THRESHOLD
) -> dict[str, Column]:
    """Precision, recall, F1 and accuracy as aggregates; 0 where a ratio has no basis."""
    hit = F.col(score) >= threshold
    positive = F.col(label) == 1
    tp = F.count_if(hit & positive)

    def ratio(part: Column, whole: Column) -> Column:
        return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))

    return {
        "precision": ratio(tp, F.count_if(hit)),
        "recall": ratio(tp, F.count_if(positive)),
        "f1": ratio(2 * tp, F.count_if(hit) + F.count_if(positive)),
        "accuracy": ratio(F.count_if(hit == positive), F.count("*")),
    }


def classification_metrics(
    scored: DataFrame, label: str = "label", score: str = "score"
) -> DataFrame:
    return scored.agg(*(c.alias(n) for n, c in class_columns(label, score).items()))


def evaluate(scored: DataFrame) -> DataFrame:
    """All six metrics of a scored test split in one row."""
    auc = auc_roc(scored).scalar()
    rest = scored.agg(
        log_loss_column().alias("test_logloss"),
        *(c.alias(f"test_{n}") for n, c in class_columns().items()),
    )
    return rest.withColumn("test_auc_roc", auc).select(*TEST_METRICS)


def long_form(row: DataFrame, run_id: str) -> DataFrame:
    """(run, key, value) rows from one wide row of metrics."""
    return row.withColumn("run_id", F.lit(run_id)).unpivot(
        "run_id", row.columns, "key", "value"
    )


def split_counts(matrix: DataFrame) -> DataFrame:
    """Row counts a feature run reports, in one pass."""

    def of(split: str) -> Column:
        return F.col("split") == split

    return matrix.agg(
        F.count_if(of("train") & (F.col("label") == 1)).alias("train_pos"),
        F.count_if(of("train") & (F.col("label") == 0)).alias("train_neg"),
        F.count_if(of("val")).alias("val"),
        F.count_if(of("test")).alias("test"),
        F.count_if(of("infer")).alias("infer"),
    )


def training_report(scored_test: DataFrame, matrix: DataFrame) -> DataFrame:
    """The six test metrics and the number of rows per split."""
    sizes = matrix.agg(
        *(F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test"))
    )
    counts = (sizes.select(name).scalar().alias(name) for name in sizes.columns)
    return evaluate(scored_test).select(*TEST_METRICS, *counts)
