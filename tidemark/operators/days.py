"""The day ordinal: dense rank over the dates that occur."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def day_index(raw: DataFrame) -> DataFrame:
    """``event_date`` and its ordinal from 1; a missing date shifts the later ones.

    Distinct first, rank after: the one-task window sees one row per calendar date
    instead of one per event. Over the lake this reads the partition column only.
    """
    dates = raw.select("event_date").distinct()
    rank = F.dense_rank().over(Window.orderBy("event_date"))
    return dates.select("event_date", rank.cast("long").alias("day"))


def with_day(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Attach the ordinal. One row per calendar date is small at any data size."""
    return rows.join(F.broadcast(days), "event_date")
