"""Top items per user."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import TOP_K


def top_k(scored: DataFrame, k: int = TOP_K) -> DataFrame:
    """The ``k`` best rows per user, equal scores by item id.

    The rank filter becomes a group limit before the shuffle, so a user with any number
    of scored items sends at most ``k`` rows per task.
    """
    order = Window.partitionBy("user_id").orderBy(F.desc("score"), "item_id")
    return (
        scored.select("user_id", "item_id", "score")
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
    )


def recommendation_lists(top: DataFrame) -> DataFrame:
    """One row per user with the ranked items as a nested list (at most ``k`` long)."""
    ranked = F.array_sort(F.collect_list(F.struct("rank", "item_id", "score")))
    return top.groupBy("user_id").agg(
        F.transform(
            ranked,
            lambda r: F.struct(
                r["item_id"].cast("long").alias("item_id"), r["score"].cast("double").alias("score")
            ),
        ).alias("recommended_items")
    )
