"""Counts per day and the point-in-time history of each key.

Every history looks at days strictly before its own. The frames are RANGE frames over the
day ordinal, so a key may have several rows per day (an item in two categories) and all
of them see the same earlier days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import is_engagement


def day_counts(events: DataFrame, *keys: str) -> DataFrame:
    """Events and engagements per key and day, straight from the events."""
    return events.groupBy(*keys, "day").agg(
        F.count("*").alias("n"), F.count_if(is_engagement()).alias("engaged")
    )


def roll_up(counts: DataFrame, *keys: str) -> DataFrame:
    """Coarser counts from finer ones; ``parts`` is the number of rows they came from."""
    return counts.groupBy(*keys, "day").agg(
        F.sum("n").alias("n"),
        F.sum("engaged").alias("engaged"),
        F.count("*").alias("parts"),
    )


def total_before(value: str, *keys: str) -> Column:
    """Sum of ``value`` over the key's earlier days, 0 when there are none."""
    earlier = (
        f"PARTITION BY {', '.join(keys)} ORDER BY day "
        "RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    )
    return F.expr(f"coalesce(sum({value}) OVER ({earlier}), 0)")


def user_item_history(counts: DataFrame) -> DataFrame:
    return counts.select(
        "user_id",
        "item_id",
        "day",
        total_before("n", "user_id", "item_id").alias("user_item_freq"),
    )


def user_category_history(counts: DataFrame) -> DataFrame:
    """Totals and the counts of the previous two *active* days, from one row per key and day."""
    key = ("user_id", "category_id")
    by_day = Window.partitionBy(*key).orderBy("day")
    return counts.select(
        *key,
        "day",
        total_before("n", *key).alias("user_cat_freq"),
        total_before("engaged", *key).alias("user_cat_eng"),
        F.lag("n", 1).over(by_day).alias("lag_1"),
        F.lag("n", 2).over(by_day).alias("lag_2"),
    )


def item_history(counts: DataFrame) -> DataFrame:
    return counts.select(
        "item_id", "day", total_before("n", "item_id").alias("item_popularity")
    )


def category_history(counts: DataFrame) -> DataFrame:
    """Popularity and smoothed target encoding, from one row per category and day.

    The encoding divides past engagements by past *active days*, so it may exceed 1.
    """
    key = "category_id"
    engaged = total_before("engaged", key).cast("double")
    active_days = total_before("1", key).cast("double")
    return counts.select(
        key,
        "day",
        total_before("n", key).alias("cat_popularity"),
        ((engaged + 1.0) / (active_days + 2.0)).alias("cat_target_enc"),
    )
