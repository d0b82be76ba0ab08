"""Positives, the popular list and the negatives drawn from it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.config import FeatureConfig, Splits
from tidemark.functions.columns import in_days, is_engagement, split_label
from tidemark.operators.skew import hot_keys, skew_join
from tidemark.session import stage

# Rows (of a few numbers) up to which a side whose rows are counted is broadcast.
BROADCAST_ROWS = 1_000_000


def positive_candidates(events: DataFrame, splits: Splits) -> DataFrame:
    """Engaged (user, item, category) per labelled day, once each."""
    return (
        events.where(is_engagement() & in_days(splits.labelled))
        .select("user_id", "item_id", "category_id", "day", "event_date")
        .distinct()
        .withColumn("label", F.lit(1))
    )


def positive_user_days(positives: DataFrame) -> DataFrame:
    return positives.select("user_id", "day", "event_date").distinct()


def popular_items(counts: DataFrame, top: int) -> DataFrame:
    """The ``top`` (item, category) pairs by events over all days, ties by the ids, null ids last.

    ``counts`` has an event count ``n`` at any grain that includes item and category.
    """
    return (
        counts.groupBy("item_id", "category_id")
        .agg(F.sum("n").alias("pop"))
        .orderBy(F.desc("pop"), F.asc_nulls_last("item_id"), F.asc_nulls_last("category_id"))
        .limit(top)
    )


def join_few(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str, most: int
) -> DataFrame:
    """``left`` joined to ``right``, which has ``most`` rows at most and few, hot keys.

    Up to ``BROADCAST_ROWS`` the right side is broadcast. Beyond it the left side is written down and
    counted, and its hot keys are split.
    """
    keys = list(keys)
    if most <= BROADCAST_ROWS:
        return left.join(F.broadcast(right), keys, how)
    rows = stage(left, "hot-join")
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"))
    return skew_join(rows, right, keys, how, hot_keys(counted, keys, "n", rows.count()))


def _places(popular: DataFrame) -> DataFrame:
    """The popular list with the place of each entry from 0: by item then category, nulls last.

    The list has a configured length, so one task may number it.
    """
    order = Window.orderBy(F.asc_nulls_last("item_id"), F.asc_nulls_last("category_id"))
    place = (F.row_number().over(order) - 1).alias("place")
    return popular.select("item_id", "category_id", place)


def _one_row_each(rows: DataFrame, places: DataFrame, size: int) -> DataFrame:
    """A row for each place in ``places_wanted``, with its item and category."""
    others = [c for c in ("carried",) if c in rows.columns]
    entries = rows.select(
        "user_id", "day", "event_date", *others, F.explode("places_wanted").alias("place")
    )
    return join_few(entries, places, ["place"], "inner", size).select(
        "user_id", "item_id", "category_id", "day", "event_date", *others
    )


def offer_popular(user_days: DataFrame, popular: DataFrame) -> DataFrame:
    """Every popular item for every (user, day).

    The places are numbers made in place, and the list is joined to them: no cross join is involved.
    """
    size = popular.count()
    every = F.sequence(F.lit(0), F.lit(max(size, 1) - 1))
    return _one_row_each(user_days.withColumn("places_wanted", every), _places(popular), size)


def _touched_places(
    counts: DataFrame, places: DataFrame, size: int, cfg: FeatureConfig, carried: str | None = None
) -> DataFrame:
    """Per labelled (user, day) with a positive: the places of the popular items it touched.

    The state of a group is as long as what it touched, not as the list. Each place is in it once
    however many events there are, and all of it is combined before the shuffle. With ``carried`` the
    group's different values of that column come along, once each.
    """
    others = [carried] if carried else []
    labelled = counts.where(in_days(cfg.splits.labelled)).select(
        "user_id", "item_id", "day", "event_date", "engaged", *others
    )
    kept = (F.col("engaged") > 0) | F.col("place").isNotNull()
    for name in others:
        kept = kept | F.col(name).isNotNull()
    return (
        join_few(labelled, places.select("item_id", "place"), ["item_id"], "left", size)
        .where(kept)
        .groupBy("user_id", "day", "event_date")
        .agg(
            F.max("engaged").alias("engaged"),
            F.collect_set("place").alias("touched"),
            *(F.collect_set(name).alias("carried") for name in others),
        )
        .where(F.col("engaged") > 0)
    )


def unseen_popular(
    counts: DataFrame,
    popular: DataFrame,
    cfg: FeatureConfig,
    first: int | None = None,
    carried: str | None = None,
) -> DataFrame:
    """Popular items a user with a positive did not touch that day, lowest item ids first.

    ``counts`` has ``engaged`` per user, item and day (any finer grain works too). With ``first``
    only that many are kept per (user, day): among as many places as are wanted and touched together
    there are enough untouched ones, so no more of the list is ever looked at. ``carried`` names a
    column of ``counts`` whose values of that user and day come along as the array ``carried``.
    """
    size = popular.count()
    places = _places(popular)
    rows = _touched_places(counts, places, size, cfg, carried)
    last = F.lit(size - 1)
    if first is not None:
        last = F.least(last, F.lit(first) + F.size("touched") - 1)
    unseen = F.array_except(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), "touched")
    if first is not None:
        unseen = F.slice(unseen, 1, first)
    return _one_row_each(rows.withColumn("places_wanted", unseen), places, size)


def sample_negatives(
    counts: DataFrame, popular: DataFrame, cfg: FeatureConfig, carried: str | None = None
) -> DataFrame:
    """``neg_ratio`` unseen popular items per (user, day) that has a positive."""
    found = unseen_popular(counts, popular, cfg, first=cfg.neg_ratio, carried=carried)
    return found.withColumn("label", F.lit(0))


def labelled_candidates(positives: DataFrame, negatives: DataFrame, splits: Splits) -> DataFrame:
    return positives.unionByName(negatives).withColumn("split", split_label(splits))
