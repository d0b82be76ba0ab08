"""The given tables seen as interaction logs, and the tables the jobs hand over."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import FeatureConfig, IngestConfig, Splits
from tidemark.functions.scoring import logistic_score
from tidemark.operators.model import train_gbt
from tidemark.operators.skew import hot_keys, skew_join
from tidemark.operators.trees import Forest, Node, Tree, read_forest, write_forest
from tidemark.plans.bootstrap import run_bootstrap
from tidemark.plans.features import run_features
from tidemark.session import scratch_path
from tidemark.sources.log import read_raw_events
from tidemark.sources.matrices import read_matrices, read_split
from tidemark.sources.storage import exists

# Nine local days from 2024-01-01 at UTC+8, for the queries whose feature is the time window.
NINE_DAYS = IngestConfig(ts_min=1704038400, ts_max=1704815999)
# At ten interactions every user of the small tables qualifies; twenty removes some.
DAILY_STRICT = IngestConfig(ts_min=1704038400, ts_max=1704815999, min_interactions=20)

# Every date of the log, 1970 to 2099; the splits are the last of its 31 local days.
DAILY = IngestConfig(ts_min=0, ts_max=4102444799)
DAILY_FEATURES = FeatureConfig(
    splits=Splits(train=tuple(range(4, 29)), val=(29,), test=(30,), infer=(31,))
)
ALL_DATES, ALL_DATES_FEATURES = DAILY, DAILY_FEATURES

# Order dates are sparse per day, so the volume variant counts months: 80 from 1995-01 on.
MONTHLY = IngestConfig(ts_min=788918400, ts_max=1009843199, timezone="UTC", grain="month")
MONTHLY_FEATURES = FeatureConfig(
    splits=Splits(
        train=tuple(range(61, 73)), val=(73, 74, 75), test=(76, 77, 78), infer=(79, 80)
    )
)

MONTHLY_LONG_LIST = replace(MONTHLY_FEATURES, top_popular=50_000)

# Scores are rounded so that two engines order them alike.
SCORE_DIGITS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _epoch_seconds(ts: str) -> F.Column:
    return F.timestamp_diff("SECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), F.col(ts))


def daily_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a log: the item is the ``k`` of ``props``, ten items to a category."""
    item = F.get_json_object("props", "$.k").cast("long")
    kind = F.col("event_type")
    behavior = (
        F.when(kind == "purchase", "buy").when(kind == "signup", "cart").when(kind == "click", "fav")
    ).otherwise("pv")
    return table(spark, sf_dir, "events").select(
        "user_id",
        item.alias("item_id"),
        (item % 10).alias("category_id"),
        behavior.alias("behavior_type"),
        _epoch_seconds("ts").alias("timestamp"),
    )


def monthly_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines as a log: customer, part, the number of its brand, the return flag."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").alias("item_id"), "l_returnflag"
    )
    brand = F.regexp_extract("p_brand", r"(\d+)", 1).cast("long")
    parts = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("item_id"), brand.alias("category_id")
    )
    per_part = lines.groupBy("item_id").agg(F.count("*").alias("n"))
    hot = hot_keys(per_part, ["item_id"], "n", lines.count())
    branded = skew_join(lines, parts, ["item_id"], "inner", hot)
    flag = F.col("l_returnflag")
    return branded.join(orders, "o_orderkey").select(
        F.col("o_custkey").alias("user_id"),
        "item_id",
        "category_id",
        F.when(flag == "R", "buy").when(flag == "A", "cart").otherwise("pv").alias("behavior_type"),
        _epoch_seconds("o_orderdate").alias("timestamp"),
    )


_handed_over: dict[tuple, str] = {}


def _once(spark: SparkSession, key: tuple, name: str, build) -> str:
    """Root of a handed-over table, built at first use in this application."""
    key = (spark.sparkContext.applicationId, *key)
    if key not in _handed_over or not exists(spark, _handed_over[key]):
        root = scratch_path(spark, name)
        build(root)
        _handed_over[key] = root
    return _handed_over[key]


def _lake_root(spark: SparkSession, sf_dir: str, monthly: bool) -> str:
    def build(root: str) -> None:
        if monthly:
            run_bootstrap(monthly_log(spark, sf_dir), root, MONTHLY)
        else:
            run_bootstrap(daily_log(spark, sf_dir), root, DAILY)

    return _once(spark, ("lake", sf_dir, monthly), "lake", build)


def lake(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    """The lake of the whole log, as the ingest job hands it to the feature job."""
    return read_raw_events(spark, _lake_root(spark, sf_dir, monthly))


def with_unknowns(raw: DataFrame) -> DataFrame:
    """The same events, a sixth without an item and a fifth without a category."""
    second = F.col("timestamp")
    return raw.withColumns(
        {
            "item_id": F.when(second % 6 != 0, F.col("item_id")),
            "category_id": F.when(second % 5 != 0, F.col("category_id")),
        }
    )


def all_dates_matrices(spark: SparkSession, sf_dir: str) -> str:
    """Ingest the daily log without a time window and run the feature job, into new roots."""
    lake_root, root = scratch_path(spark, "lake"), scratch_path(spark, "matrices")
    run_bootstrap(daily_log(spark, sf_dir), lake_root, ALL_DATES)
    run_features(spark, lake_root, root, ALL_DATES_FEATURES)
    return root


def fresh_matrices(spark: SparkSession, sf_dir: str, monthly: bool = False) -> str:
    """Run the feature job into a new root."""
    root = scratch_path(spark, "matrices")
    cfg = MONTHLY_FEATURES if monthly else DAILY_FEATURES
    run_features(spark, _lake_root(spark, sf_dir, monthly), root, cfg)
    return root


def matrix_root(spark: SparkSession, sf_dir: str, monthly: bool = False) -> str:
    def build(root: str) -> None:
        cfg = MONTHLY_FEATURES if monthly else DAILY_FEATURES
        run_features(spark, _lake_root(spark, sf_dir, monthly), root, cfg)

    return _once(spark, ("matrices", sf_dir, monthly), "matrices", build)


def matrices(spark: SparkSession, sf_dir: str, monthly: bool = False) -> DataFrame:
    """All splits, as the feature job hands them to training and scoring."""
    return read_matrices(spark, matrix_root(spark, sf_dir, monthly))


def split(spark: SparkSession, sf_dir: str, name: str, monthly: bool = False) -> DataFrame:
    return read_split(spark, matrix_root(spark, sf_dir, monthly), name)


def trained(spark: SparkSession, sf_dir: str) -> Forest:
    """The trees learned from the daily matrices, as training hands them to scoring."""

    def build(root: str) -> None:
        forest, _ = train_gbt(split(spark, sf_dir, "train"), split(spark, sf_dir, "val"))
        write_forest(spark, forest, root)

    return read_forest(spark, _once(spark, ("trees", sf_dir), "trees", build))


# Three small trees that were not learned, so that scoring by a table of nodes has the same result
# everywhere: the scores of a trained model depend on the trainer.
FIXED_TREES = Forest(
    (
        Tree(1.0, (Node(0, "user_cat_freq", 2.0, 1, 2, 0.0), Node(1, "intent_score", 0.6, 3, 4, 0.0),
                   Node(2, None, None, None, None, 0.35), Node(3, None, None, None, None, -0.5),
                   Node(4, "item_popularity", 5.0, 5, 6, 0.0), Node(5, None, None, None, None, -0.125),
                   Node(6, None, None, None, None, 0.25))),
        Tree(0.5, (Node(0, "cat_target_enc", 1.5, 1, 2, 0.0), Node(1, None, None, None, None, -0.75),
                   Node(2, "lag_1", 0.0, 3, 4, 0.0), Node(3, None, None, None, None, 0.1),
                   Node(4, None, None, None, None, 0.9))),
        Tree(0.1, (Node(0, None, None, None, None, 0.5),)),
    )
)


def scored(spark: SparkSession, sf_dir: str, name: str, monthly: bool = False) -> DataFrame:
    """A split scored by the fixed logistic scorer."""
    return split(spark, sf_dir, name, monthly).select(
        "user_id", "item_id", "label", logistic_score(SCORE_DIGITS).alias("score")
    )
