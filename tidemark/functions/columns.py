"""Column expressions over the interaction log and the feature rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.config import ENGAGEMENT, Splits


def in_time_range(ts_min: int, ts_max: int, ts: str = "timestamp") -> Column:
    """Both bounds belong to the range."""
    return F.col(ts).between(ts_min, ts_max)


def local_event_date(timezone: str, ts: str = "timestamp") -> Column:
    """Calendar date of an epoch second in ``timezone``, whatever the session zone is.

    Days are cut from the shifted epoch second itself, since a cast from timestamp to date
    would follow the session zone.
    """
    local = F.unix_seconds(F.from_utc_timestamp(F.timestamp_seconds(ts), timezone))
    return F.date_from_unix_date(F.floor(local / 86400).cast("int"))


def event_period(timezone: str, grain: str, ts: str = "timestamp") -> Column:
    """The lake's partition date: the local day, or the first day of the local month."""
    date = local_event_date(timezone, ts)
    return F.trunc(date, "month") if grain == "month" else date


def is_engagement(behavior: str = "behavior_type") -> Column:
    return F.col(behavior).isin(*ENGAGEMENT)


def in_days(days: Iterable[int], day: str = "day") -> Column:
    return F.col(day).isin(*days)


def split_label(splits: Splits, day: str = "day") -> Column:
    """Name of the split a day belongs to; null outside all of them."""
    label = F.lit(None).cast("string")
    for name, days in splits.as_dict().items():
        label = F.when(in_days(days, day), name).otherwise(label)
    return label


def intent_score(engaged: Column, total: Column, epsilon: float) -> Column:
    """Smoothed share of engagements; 1.0 without any history."""
    return (engaged + F.lit(float(epsilon))) / (total + F.lit(float(epsilon)))


def feature_columns(epsilon: float) -> list[Column]:
    """The nine model inputs, with the value each takes when there is no history row."""
    freq = F.coalesce("user_cat_freq", F.lit(0))
    engaged = F.coalesce("user_cat_eng", F.lit(0))
    return [
        F.coalesce("user_item_freq", F.lit(0)).alias("user_item_freq"),
        freq.alias("user_cat_freq"),
        engaged.alias("user_cat_eng"),
        intent_score(engaged, freq, epsilon).alias("intent_score"),
        F.coalesce("item_popularity", F.lit(0)).alias("item_popularity"),
        F.coalesce("cat_popularity", F.lit(0)).alias("cat_popularity"),
        F.coalesce("cat_target_enc", F.lit(0.5)).alias("cat_target_enc"),
        F.coalesce("lag_1", F.lit(0)).alias("lag_1"),
        F.coalesce("lag_2", F.lit(0)).alias("lag_2"),
    ]
