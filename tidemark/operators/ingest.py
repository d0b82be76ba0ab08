"""From the log to the qualified, dated events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import IngestConfig
from tidemark.functions.columns import event_period, in_time_range
from tidemark.operators.skew import hot_keys, skew_join

LOG_COLS = ("user_id", "item_id", "category_id", "behavior_type", "timestamp")


def in_window(log: DataFrame, cfg: IngestConfig) -> DataFrame:
    return log.where(in_time_range(cfg.ts_min, cfg.ts_max))


def qualified_users(log: DataFrame, cfg: IngestConfig) -> DataFrame:
    """Users with at least ``min_interactions`` rows inside the window, and their count."""
    return (
        in_window(log, cfg)
        .groupBy("user_id")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") >= cfg.min_interactions)
    )


def keep_qualified(
    log: DataFrame,
    qualified: DataFrame,
    cfg: IngestConfig,
    hot_floor: int | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Rows of qualified users inside the window.

    ``qualified`` carries the row count per user, which names the heavy users whose rows
    must not all go to one task. Give it as a staged table so that the log is not counted
    again for it; Catalyst then broadcasts it when its size on disk allows. ``rows`` is the sum
    of its counts, if known.
    """
    if rows is None:
        rows = qualified.agg(F.sum("n")).first()[0] or 0
    return skew_join(
        in_window(log, cfg),
        qualified.select("user_id"),
        ["user_id"],
        "left_semi",
        hot_keys(qualified, ["user_id"], "n", rows, hot_floor),
    )


def dated(log: DataFrame, cfg: IngestConfig) -> DataFrame:
    """The log columns and the partition date ``event_date``."""
    return log.select(*LOG_COLS, event_period(cfg.timezone, cfg.grain).alias("event_date"))
