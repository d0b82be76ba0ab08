"""Point-in-time feature matrices: labelled candidates and the rows to be scored."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.config import MATRIX_COLS, MATRIX_KEYS, FeatureConfig, Splits
from tidemark.functions.columns import feature_columns, in_days, is_engagement, split_label
from tidemark.operators.candidates import join_few, popular_items, sample_negatives
from tidemark.operators.days import day_index, with_day
from tidemark.operators.history import (
    category_history,
    roll_up,
    total_before,
    user_category_history,
)
from tidemark.operators.skew import hot_keys, may_have_hot_keys, skew_join
from tidemark.session import stage


@dataclass(frozen=True)
class DayCounts:
    """The log, counted once: everything in the matrices derives from these two tables.

    ``pairs``: one row per (user, item, category, day) with ``n`` and ``engaged``.
    ``items``: the same per (item, category, day); ``parts`` counts the pairs behind it.
    """

    pairs: DataFrame
    items: DataFrame
    pair_rows: int
    item_rows: int


def pair_counts(raw: DataFrame) -> DataFrame:
    """Events and engagements per (user, item, category, day), with the date alongside.

    The count runs per date and the ordinal is joined to the result, not to each event.
    """
    per_date = raw.groupBy("user_id", "item_id", "category_id", "event_date").agg(
        F.count("*").alias("n"), F.count_if(is_engagement()).alias("engaged")
    )
    return with_day(per_date, day_index(raw)).select(
        "user_id", "item_id", "category_id", "day", "event_date", "n", "engaged"
    )


def stage_day_counts(raw: DataFrame) -> DayCounts:
    """Both tables are written to scratch because every branch below reads them.

    Their row counts size the hot-key handling.
    """
    pairs = stage(pair_counts(raw), "pairs")
    items = stage(roll_up(pairs, "item_id", "category_id"), "items")
    rows = items.agg(F.coalesce(F.sum("parts"), F.lit(0)), F.count("*")).first()
    return DayCounts(pairs, items, rows[0], rows[1])


def item_day_features(counts: DayCounts, splits: Splits) -> DataFrame:
    """Item and category history per (item, category, day) of the used days.

    Category features join the item table here, where a row stands for all users, so the
    much larger candidate table needs one join for both. A null item has no history, but its
    row carries the features of its category; a null category has none either.
    """
    per_category = roll_up(counts.items, "category_id")
    popularity = F.when(F.col("item_id").isNotNull(), total_before("n", "item_id"))
    keys = ["category_id", "day"]
    return skew_join(
        counts.items.select("item_id", *keys, popularity.alias("item_popularity")).where(in_days(splits.used)),
        category_history(per_category).where(in_days(splits.used)).dropna(subset=keys),
        keys,
        "left",
        hot_keys(per_category, keys, "parts", counts.item_rows),
        nulls_match=True,
    )


def _category_history(rows: DataFrame) -> DataFrame:
    """``rows`` of pair counts with the user-category history of their day, as ``past``.

    Rows of one user, category and day see the same totals; the counts of the previous two active
    days are those of the last row before the day, and of the last row before that one's day.
    ``past`` is null without a user or a category.
    """
    key = ("user_id", "category_id")
    spec = f"PARTITION BY {', '.join(key)} ORDER BY day RANGE BETWEEN"
    earlier = f"({spec} UNBOUNDED PRECEDING AND 1 PRECEDING)"
    known = F.col("user_id").isNotNull() & F.col("category_id").isNotNull()
    features = ("category_id", "user_cat_freq", "user_cat_eng", "lag_1", "lag_2")
    return (
        rows.withColumns(
            {
                "user_cat_freq": total_before("n", *key),
                "user_cat_eng": total_before("engaged", *key),
                "_day_n": F.expr(f"sum(n) OVER ({spec} CURRENT ROW AND CURRENT ROW)"),
            }
        )
        .withColumn("lag_1", F.expr(f"last(_day_n) OVER {earlier}"))
        .withColumn("lag_2", F.expr(f"last(lag_1) OVER {earlier}"))
        .withColumn("past", F.when(known, F.struct(*features)))
        .drop("_day_n", *features[1:])
    )


def _hot_category_history(rows: DataFrame) -> DataFrame:
    """The same for rows of hot users: from counts per user, category and day, by a salted join."""
    keys = ["user_id", "category_id", "day"]
    per_day = stage(roll_up(rows, "user_id", "category_id"), "user-category")
    total = per_day.agg(F.coalesce(F.sum("parts"), F.lit(0))).first()[0]
    history = user_category_history(per_day).dropna(subset=keys)
    past = F.struct("category_id", "user_cat_freq", "user_cat_eng", "lag_1", "lag_2")
    return skew_join(
        rows,
        history.select(*keys, past.alias("past")),
        keys,
        "left",
        hot_keys(per_day, keys, "parts", total),
        nulls_match=True,
    )


def _by_user(counts: DayCounts, last_day: int) -> list[DataFrame]:
    """The pair counts with ``past``, dealt out once by user for all that is read from them by user.

    The windows over a user's items and categories, and the marks per user and day, need no other
    exchange than this one. Users (or rows without one) that are too many rows for a task are a frame
    of their own, whose windows and marks are dealt out by their own keys.
    """
    pairs = counts.pairs.where(F.col("day") <= last_day)
    spark = pairs.sparkSession
    if not may_have_hot_keys(spark, counts.pair_rows):
        return [_category_history(pairs.repartition("user_id"))]
    per_user = counts.pairs.groupBy("user_id").agg(F.count("*").alias("parts"))
    hot = stage(hot_keys(per_user, ["user_id"], "parts", counts.pair_rows), "hot-users")
    if hot.isEmpty():
        return [_category_history(pairs.repartition("user_id"))]
    other = hot.select(F.col("user_id").alias("_hot"), F.lit(True).alias("_is_hot"))
    marked = pairs.join(F.broadcast(other), F.col("user_id").eqNullSafe(F.col("_hot")), "left")
    few = marked.where("_is_hot is null").drop("_hot", "_is_hot").repartition("user_id")
    many = marked.where("_is_hot").drop("_hot", "_is_hot")
    return [_category_history(few), _hot_category_history(many)]


def touched_rows(by_user: DataFrame, splits: Splits, labelled: bool, infer: bool) -> DataFrame:
    """Positives of the labelled days and all pairs of the scoring days, with the user's history.

    Each such row is itself a row of the pair counts, so the user-item history is a window
    over them and no join. The pairs are distinct already, hence no ``distinct`` either.
    A window puts null keys together, a join does not: such rows have no user-item history.
    """
    labelled_days = splits.labelled if labelled else ()
    infer_days = splits.infer if infer else ()
    wanted = (in_days(labelled_days) & (F.col("engaged") > 0)) | in_days(infer_days)
    known = F.col("user_id").isNotNull() & F.col("item_id").isNotNull()
    return (
        by_user.withColumn("user_item_freq", F.when(known, total_before("n", "user_id", "item_id")))
        .where(wanted)
        .withColumn("label", F.when(in_days(labelled_days), 1).cast("int"))
        .drop("n", "engaged")
    )


def with_item_features(rows: DataFrame, counts: DayCounts, splits: Splits) -> DataFrame:
    """``rows`` with the history of their item and category."""
    keys = ["item_id", "category_id", "day"]
    return skew_join(
        rows,
        item_day_features(counts, splits),
        keys,
        "left",
        hot_keys(counts.items, keys, "parts", counts.pair_rows),
        nulls_match=True,
    )


def negative_rows(by_user: list[DataFrame], counts: DayCounts, cfg: FeatureConfig) -> DataFrame:
    """Sampled negatives with features.

    All of them are popular items, so a handful of items holds every row: a shuffle by item would send
    them to a few tasks. Their features are at most one row for each entry of the popular list and
    labelled day; ``join_few`` checks that bound. A negative was by definition not touched that day, so
    it has no user-item history row. The history of its category is one of those that the user's other
    rows of that day carry.
    """
    popular = stage(popular_items(counts.items, cfg.top_popular), "popular")
    size = popular.count()
    features = size * len(cfg.splits.labelled)
    labelled = in_days(cfg.splits.labelled)

    def of_popular(key: str) -> DataFrame:
        return join_few(counts.items, popular.select(key).distinct(), [key], "left_semi", size)

    items = (
        of_popular("item_id")
        .select("item_id", "day", total_before("n", "item_id").alias("item_popularity"))
        .where(labelled)
        .distinct()
    )
    categories = category_history(roll_up(of_popular("category_id"), "category_id")).where(labelled)
    own = F.filter("carried", lambda past: past["category_id"] == F.col("category_id"))
    negatives = reduce(
        DataFrame.unionByName,
        (
            sample_negatives(rows, popular, cfg, carried="past")
            .withColumn("past", F.get(own, F.lit(0)))
            .drop("carried")
            for rows in by_user
        ),
    )
    known = join_few(negatives, items, ["item_id", "day"], "left", features)
    return join_few(known, categories, ["category_id", "day"], "left", features).withColumn(
        "user_item_freq", F.lit(0).cast("long")
    )


def build_matrix(
    counts: DayCounts, cfg: FeatureConfig, labelled: bool = True, infer: bool = True
) -> DataFrame:
    """The feature matrix of the labelled splits, the scoring split, or both.

    Two exchanges carry rows of the log: the pair counts by user, read by the touched rows and by the
    negatives, and the touched rows by item for the features of items and categories.
    """
    splits = cfg.splits
    days = (splits.labelled if labelled else ()) + (splits.infer if infer else ())
    by_user = _by_user(counts, max(days))
    touched = reduce(
        DataFrame.unionByName, (touched_rows(rows, splits, labelled, infer) for rows in by_user)
    )
    rows = with_item_features(touched, counts, splits)
    if labelled:
        rows = rows.unionByName(negative_rows(by_user, counts, cfg))
    return (
        rows.withColumns({c: F.col("past")[c] for c in ("user_cat_freq", "user_cat_eng", "lag_1", "lag_2")})
        .withColumn("split", split_label(splits))
        .select(*MATRIX_KEYS, *feature_columns(cfg.epsilon))
        .select(*MATRIX_COLS)
    )


def point_in_time_join(
    candidates: DataFrame,
    user_item: DataFrame,
    user_category: DataFrame,
    item: DataFrame,
    category: DataFrame,
    cfg: FeatureConfig,
) -> DataFrame:
    """Features for any candidate rows, by exact day, from the four history tables.

    Unlike ``build_matrix`` nothing is assumed about where the candidates come from. Users,
    items and categories may be skewed among them, so those joins split hot keys. The
    candidates are read several times: give them as a staged table.
    """
    size = candidates.count()
    rows = candidates.join(user_item, ["user_id", "item_id", "day"], "left")
    for keys, history in (
        (["user_id", "category_id", "day"], user_category),
        (["item_id", "day"], item),
        (["category_id", "day"], category),
    ):
        counted = candidates.groupBy(*keys).agg(F.count("*").alias("n"))
        hot = hot_keys(counted, keys, "n", size)
        # null keys find nothing; matched as nulls they are spread when they are many
        rows = skew_join(rows, history.dropna(subset=keys), keys, "left", hot, nulls_match=True)
    return rows.select(*candidates.columns, *feature_columns(cfg.epsilon))
