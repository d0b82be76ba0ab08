"""Checks over the lake, the matrices and the results, as DataFrame jobs."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import IngestConfig, Splits


def split_days(matrix: DataFrame, splits: Splits) -> DataFrame:
    """Days found per split; ``as_expected`` says whether they are the configured ones.

    Every configured split has a row, also one that is missing from ``matrix``, and so has every split
    that is in ``matrix`` and should not be.
    """
    wanted = matrix.sparkSession.createDataFrame(
        [(name, sorted(days)) for name, days in splits.as_dict().items()],
        "split string, wanted array<bigint>",
    )
    found = matrix.groupBy("split").agg(F.array_sort(F.collect_set("day")).alias("found"))
    days = F.coalesce("found", F.array().cast("array<bigint>"))
    as_expected = F.coalesce(days == F.col("wanted"), F.lit(False))
    return found.join(F.broadcast(wanted), "split", "full").select(
        "split", days.alias("days"), as_expected.alias("as_expected")
    )


def split_date_sets(matrix: DataFrame) -> DataFrame:
    return matrix.groupBy("split").agg(F.array_sort(F.collect_set("event_date")).alias("dates"))


def split_overlaps(matrix: DataFrame) -> DataFrame:
    """Dates shared by each pair of splits: one row per pair, zero everywhere when sound."""
    per_date = (
        matrix.groupBy("event_date", "split").agg(F.count("*").alias("n"))
        .groupBy("event_date").agg(F.collect_set("split").alias("splits"))
    )
    shared = [
        F.count_if(F.array_contains("splits", a) & F.array_contains("splits", b)).alias(f"{a}/{b}")
        for a, b in combinations(Splits().as_dict(), 2)
    ]
    wide = per_date.agg(*shared)
    return wide.unpivot([], wide.columns, "splits", "shared_dates")


def labels(matrix: DataFrame) -> DataFrame:
    """Labels per split: both kinds in the rows a model learns from, none in those it scores.

    Validation and test need negatives; a day without any positive may happen. A split without rows is
    listed and not sound.
    """
    counted = matrix.groupBy("split").agg(
        F.count_if(F.col("label") == 1).alias("positives"),
        F.count_if(F.col("label") == 0).alias("negatives"),
        F.count_if(F.col("label").isNull()).alias("unlabelled"),
    )
    every = matrix.sparkSession.createDataFrame([(s,) for s in Splits().as_dict()], "split string")
    listed = counted.join(F.broadcast(every), "split", "full").na.fill(0)
    positives, negatives, unlabelled = (F.col(c) for c in ("positives", "negatives", "unlabelled"))
    sound = (
        F.when(F.col("split") == "infer", (positives + negatives == 0) & (unlabelled > 0))
        .when(F.col("split") == "train", (positives > 0) & (negatives > 0) & (unlabelled == 0))
        .otherwise((negatives > 0) & (unlabelled == 0))
    )
    return listed.withColumn("sound", sound)


def lake(raw: DataFrame, qualified: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Rows of the lake that should not be there, and the dates it spans.

    Users are counted first, so the anti join sees one row per user.
    """
    per_user = raw.groupBy("user_id").agg(
        F.count("*").alias("n"),
        F.count_if(~F.col("timestamp").between(cfg.ts_min, cfg.ts_max)).alias("outside"),
        F.min("event_date").alias("first_date"),
        F.max("event_date").alias("last_date"),
    )
    marked = per_user.join(
        qualified.select("user_id", F.lit(True).alias("known")), "user_id", "left"
    )
    return marked.agg(
        F.sum("n").alias("rows"),
        F.count("*").alias("users"),
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("unqualified_rows"),
        F.sum("outside").alias("rows_outside_window"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )


def results(table: DataFrame, k: int, lowest_item: int = 1) -> DataFrame:
    """Size, validity and key uniqueness of the result table in one row."""
    items = F.col("recommended_items")
    per_user = table.groupBy("user_id").agg(
        F.count("*").alias("rows"),
        F.count_if(items.isNull()).alias("nulls"),
        F.min(F.size(items)).alias("shortest"),
        F.max(F.size(items)).alias("longest"),
        F.count_if(F.exists(items, lambda i: i["item_id"] < lowest_item)).alias("bad"),
    )
    return per_user.agg(
        F.sum("rows").alias("rows"),
        F.count("*").alias("users"),
        F.count_if(F.col("rows") > 1).alias("repeated_users"),
        F.sum("nulls").alias("null_lists"),
        F.count_if(F.col("shortest") < 1).alias("empty_lists"),
        F.count_if(F.col("longest") > k).alias("long_lists"),
        F.sum("bad").alias("lists_with_bad_items"),
    )
