"""One query per operator. Each takes the session and the folder with the given tables.

Dates and lists leave a query as text, so that any client compares them alike.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.config import FEATURE_COLS, TOP_K, TrainConfig
from tidemark.functions import columns, recommendations
from tidemark.functions.scoring import logistic_score
from tidemark.operators import audits, candidates, history, ingest, matrix, metrics, model, ranking, trees
from tidemark.operators.days import day_index, with_day
from tidemark.plans.bootstrap import ingest as ingest_plan
from tidemark.plans.bootstrap import run_bootstrap
from tidemark.plans.inference import recommend
from tidemark.registry import inputs
from tidemark.registry.inputs import DAILY_FEATURES, DAILY_STRICT
from tidemark.session import scratch_path, stage
from tidemark.sources import log as log_source
from tidemark.sources import matrices as matrix_source
from tidemark.sources import ordered as ordered_source
from tidemark.sources import results as result_source
from tidemark.sources.runs import latest_finished_run

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

SPLITS = DAILY_FEATURES.splits
METRIC_DIGITS = 8


def query(fn: Query) -> Query:
    """Register a query under its function name; a trailing underscore only avoids a clash."""
    QUERIES[fn.__name__.rstrip("_")] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    return df.select(
        *(F.col(c).cast("string").alias(c) if t in ("date", "timestamp") else F.col(c)
          for c, t in df.dtypes)
    )


def rounded(df: DataFrame) -> DataFrame:
    return df.select(
        *(F.round(c, METRIC_DIGITS).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes)
    )


def listed(df: DataFrame, name: str) -> DataFrame:
    return df.withColumn(name, F.array_join(F.col(name).cast("array<string>"), ","))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake with its day ordinals."""
    raw = inputs.lake(spark, sf_dir)
    return with_day(raw, day_index(raw))


def daily_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matrix.pair_counts(inputs.lake(spark, sf_dir))


def daily_popular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The popular list, written once because the negatives read it several times."""
    counts = history.day_counts(daily_events(spark, sf_dir), "item_id", "category_id")
    return stage(candidates.popular_items(counts, DAILY_FEATURES.top_popular), "popular")


# --- sources and sinks ---------------------------------------------------------------


@query
def scan_csv_log(spark, sf_dir):
    path = scratch_path(spark, "csv")
    inputs.daily_log(spark, sf_dir).write.csv(path)
    return log_source.read_csv_log(spark, path)


@query
def scan_raw_events(spark, sf_dir):
    return plain(inputs.lake(spark, sf_dir))


@query
def scan_split(spark, sf_dir):
    return plain(inputs.split(spark, sf_dir, "val"))


@query
def write_raw_partitions(spark, sf_dir):
    root = scratch_path(spark, "lake")
    events = ingest.in_window(inputs.daily_log(spark, sf_dir), inputs.NINE_DAYS)
    log_source.write_raw_partitions(ingest.dated(events, inputs.NINE_DAYS), root)
    return plain(log_source.read_raw_events(spark, root))


@query
def write_split_matrices(spark, sf_dir):
    """Two writes to one root: the second leaves the partitions of the first alone."""
    root = scratch_path(spark, "matrices")
    rows = inputs.matrices(spark, sf_dir)
    matrix_source.write_split_matrices(rows.where("split <> 'infer'"), root)
    matrix_source.write_split_matrices(rows.where("split = 'infer'"), root)
    return plain(matrix_source.read_matrices(spark, root))


@query
def upsert_results(spark, sf_dir):
    """Recommendations of the test day, then those of the scoring day on top."""
    table = result_source.ResultTable(spark, scratch_path(spark, "results"))
    for split, stamp in (("test", "2024-01-09 00:00:00"), ("infer", "2024-01-10 00:00:00")):
        recommend(
            inputs.scored(spark, sf_dir, split), table, stamped=F.lit(stamp).cast("timestamp")
        )
    return plain(recommendations.explode_items(table.read()))


@query
def lookup_one(spark, sf_dir):
    """The list of one user, the last one there is, from the one file that can hold it."""
    table = result_source.ResultTable(spark, scratch_path(spark, "results"))
    scored = inputs.scored(spark, sf_dir, "infer")
    recommend(scored, table)
    last = scored.agg(F.max("user_id")).first()[0]
    return recommendations.explode_items(table.find(last).drop("updated_at"))


@query
def repeated_result_keys(spark, sf_dir):
    """Users whose lists of two days would enter the table in one batch."""
    days = [
        ranking.recommendation_lists(ranking.top_k(inputs.scored(spark, sf_dir, split)))
        for split in ("test", "infer")
    ]
    return result_source.repeated_keys(days[0].unionByName(days[1]))


@query
def result_schema_check(spark, sf_dir):
    """Columns of the result table after it was declared twice around an upsert."""
    table = result_source.ResultTable(spark, scratch_path(spark, "results"))
    table.create()
    recommend(inputs.scored(spark, sf_dir, "infer"), table)
    table.create()
    return table.read().agg(
        F.count("user_id").alias("user_ids"),
        F.count("recommended_items").alias("lists"),
        F.count("updated_at").alias("stamps"),
        F.count("*").alias("rows"),
    )


@query
def metrics_unpivot(spark, sf_dir):
    wide = rounded(metrics.evaluate(inputs.scored(spark, sf_dir, "test")))
    return metrics.long_form(wide, "fixed-logistic")


# --- projections, filters, predicates ------------------------------------------------


@query
def filter_time_range(spark, sf_dir):
    return ingest.in_window(inputs.daily_log(spark, sf_dir), inputs.NINE_DAYS)


@query
def local_event_date(spark, sf_dir):
    events = ingest.in_window(inputs.daily_log(spark, sf_dir), inputs.NINE_DAYS)
    return plain(ingest.dated(events, inputs.NINE_DAYS)).select("user_id", "timestamp", "event_date")


@query
def filter_engagement(spark, sf_dir):
    return plain(inputs.lake(spark, sf_dir).where(columns.is_engagement()))


@query
def filter_split_days(spark, sf_dir):
    events = daily_events(spark, sf_dir)
    either = columns.in_days(SPLITS.train) | columns.in_days(SPLITS.val) | columns.in_days(SPLITS.test)
    return plain(events.where(either))


@query
def split_label(spark, sf_dir):
    days = day_index(inputs.lake(spark, sf_dir))
    return plain(days.withColumn("split", columns.split_label(SPLITS)))


@query
def intent_score(spark, sf_dir):
    counts = history.day_counts(daily_events(spark, sf_dir), "user_id", "category_id")
    past = history.user_category_history(counts)
    score = columns.intent_score(
        F.col("user_cat_eng"), F.col("user_cat_freq"), DAILY_FEATURES.epsilon
    )
    return past.select("user_id", "category_id", "day", score.alias("intent_score"))


@query
def feature_projection(spark, sf_dir):
    """Candidates whose category history is missing on some rows, with the defaults in place."""
    events = daily_events(spark, sf_dir)
    past = history.user_category_history(history.day_counts(events, "user_id", "category_id"))
    pairs = daily_pairs(spark, sf_dir)
    negatives = candidates.sample_negatives(pairs, daily_popular(spark, sf_dir), DAILY_FEATURES)
    joined = negatives.join(past, ["user_id", "category_id", "day"], "left").select(
        "*",
        *(F.lit(None).cast("long").alias(c)
          for c in ("user_item_freq", "item_popularity", "cat_popularity")),
        F.lit(None).cast("double").alias("cat_target_enc"),
    )
    return joined.select(
        "user_id", "item_id", "category_id", "day", *columns.feature_columns(DAILY_FEATURES.epsilon)
    )


@query
def assemble_features(spark, sf_dir):
    assembled = model.assemble_features(inputs.split(spark, sf_dir, "train"))
    values = vector_to_array("features")
    return assembled.select(
        "user_id",
        "item_id",
        "day",
        "label",
        *(values[i].alias(f"f{i}") for i in range(len(FEATURE_COLS))),
    )


@query
def lookup_recommendations(spark, sf_dir):
    """Every customer asks; most have no row."""
    results = ranking.recommendation_lists(ranking.top_k(inputs.scored(spark, sf_dir, "infer")))
    requests = inputs.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"))
    answers = result_source.lookup_recommendations(results, requests)
    items = F.col("recommended_items")
    return answers.select(
        "user_id",
        "found",
        F.coalesce(F.size(items), F.lit(0)).alias("items"),
        F.try_element_at(items, F.lit(1))["item_id"].alias("best_item"),
    )


# --- joins -----------------------------------------------------------------------------


@query
def semi_join_qualified(spark, sf_dir):
    log = inputs.daily_log(spark, sf_dir)
    qualified = stage(ingest.qualified_users(log, DAILY_STRICT), "qualified")
    return ingest.keep_qualified(log, qualified, DAILY_STRICT)


@query
def events_with_day(spark, sf_dir):
    return plain(daily_events(spark, sf_dir).drop("timestamp"))


@query
def cross_join_popular(spark, sf_dir):
    positives = candidates.positive_candidates(daily_events(spark, sf_dir), SPLITS)
    popular = daily_popular(spark, sf_dir)
    return plain(candidates.offer_popular(candidates.positive_user_days(positives), popular))


@query
def anti_join_unseen(spark, sf_dir):
    pairs = daily_pairs(spark, sf_dir)
    return plain(candidates.unseen_popular(pairs, daily_popular(spark, sf_dir), DAILY_FEATURES))


@query
def point_in_time_join(spark, sf_dir):
    """The labelled candidates joined to the four history tables."""
    events = daily_events(spark, sf_dir)
    pairs = daily_pairs(spark, sf_dir)
    rows = candidates.labelled_candidates(
        candidates.positive_candidates(events, SPLITS),
        candidates.sample_negatives(pairs, daily_popular(spark, sf_dir), DAILY_FEATURES),
        SPLITS,
    )
    return plain(
        matrix.point_in_time_join(
            stage(rows, "candidates"),
            history.user_item_history(history.day_counts(events, "user_id", "item_id")),
            history.user_category_history(history.day_counts(events, "user_id", "category_id")),
            history.item_history(history.day_counts(events, "item_id")),
            history.category_history(history.day_counts(events, "category_id")),
            DAILY_FEATURES,
        )
    )


@query
def feature_matrix(spark, sf_dir):
    counts = matrix.stage_day_counts(inputs.lake(spark, sf_dir))
    return plain(matrix.build_matrix(counts, DAILY_FEATURES, infer=False))


@query
def feature_matrix_with_nulls(spark, sf_dir):
    """All splits from the same log with some items and categories unknown."""
    raw = inputs.with_unknowns(inputs.lake(spark, sf_dir))
    return plain(matrix.build_matrix(matrix.stage_day_counts(raw), DAILY_FEATURES))


@query
def inference_matrix(spark, sf_dir):
    counts = matrix.stage_day_counts(inputs.lake(spark, sf_dir))
    return plain(matrix.build_matrix(counts, DAILY_FEATURES, labelled=False))


# --- aggregations ------------------------------------------------------------------------


@query
def qualified_users(spark, sf_dir):
    return ingest.qualified_users(inputs.daily_log(spark, sf_dir), DAILY_STRICT)


@query
def qualified_user_count(spark, sf_dir):
    users = ingest.qualified_users(inputs.daily_log(spark, sf_dir), DAILY_STRICT)
    return users.agg(F.count("*").alias("qualified_users"))


@query
def positive_candidates(spark, sf_dir):
    return plain(candidates.positive_candidates(daily_events(spark, sf_dir), SPLITS))


@query
def popular_items(spark, sf_dir):
    counts = history.day_counts(daily_events(spark, sf_dir), "item_id", "category_id")
    return candidates.popular_items(counts, DAILY_FEATURES.top_popular)


@query
def positive_user_days(spark, sf_dir):
    positives = candidates.positive_candidates(daily_events(spark, sf_dir), SPLITS)
    return plain(candidates.positive_user_days(positives))


@query
def split_counts(spark, sf_dir):
    return metrics.split_counts(inputs.matrices(spark, sf_dir))


@query
def split_counts_written(spark, sf_dir):
    """The same counts as the feature job recorded them while it wrote, without reading the rows."""
    counts = matrix_source.written_counts(spark, inputs.matrix_root(spark, sf_dir))
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


@query
def split_date_sets(spark, sf_dir):
    return listed(audits.split_date_sets(inputs.matrices(spark, sf_dir)), "dates")


@query
def topk_lists(spark, sf_dir):
    lists = ranking.recommendation_lists(ranking.top_k(inputs.scored(spark, sf_dir, "infer")))
    items = F.col("recommended_items.item_id").cast("array<string>")
    return lists.select(
        "user_id",
        F.size("recommended_items").alias("items"),
        F.array_join(items, ",").alias("ranked_items"),
    )


# --- windows -------------------------------------------------------------------------------


@query
def day_index_(spark, sf_dir):
    return plain(day_index(inputs.lake(spark, sf_dir)))


@query
def hist_user_item(spark, sf_dir):
    counts = history.day_counts(daily_events(spark, sf_dir), "user_id", "item_id")
    return history.user_item_history(counts)


@query
def hist_user_category(spark, sf_dir):
    counts = history.day_counts(daily_events(spark, sf_dir), "user_id", "category_id")
    return history.user_category_history(counts).drop("lag_1", "lag_2")


@query
def hist_item_popularity(spark, sf_dir):
    return history.item_history(history.day_counts(daily_events(spark, sf_dir), "item_id"))


@query
def hist_category_popularity(spark, sf_dir):
    counts = history.day_counts(daily_events(spark, sf_dir), "category_id")
    return history.category_history(counts).drop("cat_target_enc")


@query
def category_target_encoding(spark, sf_dir):
    counts = history.day_counts(daily_events(spark, sf_dir), "category_id")
    return history.category_history(counts).drop("cat_popularity")


@query
def lag_features(spark, sf_dir):
    counts = history.day_counts(daily_events(spark, sf_dir), "user_id", "category_id")
    return history.user_category_history(counts).drop("user_cat_freq", "user_cat_eng")


@query
def sample_negatives(spark, sf_dir):
    pairs = daily_pairs(spark, sf_dir)
    return plain(candidates.sample_negatives(pairs, daily_popular(spark, sf_dir), DAILY_FEATURES))


@query
def sample_negatives_long_list(spark, sf_dir):
    """Monthly negatives from a popular list of up to 50,000 entries."""
    pairs = matrix.pair_counts(inputs.lake(spark, sf_dir, monthly=True))
    cfg = inputs.MONTHLY_LONG_LIST
    popular = stage(candidates.popular_items(pairs, cfg.top_popular), "popular")
    return plain(candidates.sample_negatives(pairs, popular, cfg))


@query
def topk_per_user(spark, sf_dir):
    return ranking.top_k(inputs.scored(spark, sf_dir, "infer"))


# --- top-n, set operations, nested values ------------------------------------------------


@query
def ordered_results(spark, sf_dir):
    """The lists of the scoring day, written in ranges of users and read back in that order."""
    root = scratch_path(spark, "ordered")
    lists = ranking.recommendation_lists(ranking.top_k(inputs.scored(spark, sf_dir, "infer")))
    ordered_source.write_ordered(lists, root, ["user_id"])
    items = F.col("recommended_items.item_id").cast("array<string>")
    return ordered_source.read_ordered(spark, root, place="place").select(
        "place", "user_id", F.array_join(items, ",").alias("ranked_items")
    )


@query
def union_files(spark, sf_dir):
    """The log from one file per kind of event, as one relation, accounted by file."""
    root = scratch_path(spark, "csv")
    log = inputs.daily_log(spark, sf_dir)
    log.withColumn("kind", F.col("behavior_type")).write.partitionBy("kind").csv(root)
    kinds = ["buy", "cart", "fav", "pv"]
    rows = log_source.read_csv_files(spark, [f"{root}/kind={k}" for k in kinds])
    kind = F.regexp_extract("file", "/kind=([a-z]+)/", 1)
    return rows.select(*log_source.LOG_COLS, kind.alias("file"))


@query
def file_accounts(spark, sf_dir):
    """Rows and times of the log's files, those of one kind of event taken together."""
    root = scratch_path(spark, "csv")
    log = inputs.daily_log(spark, sf_dir)
    log.withColumn("kind", F.col("behavior_type")).write.partitionBy("kind").csv(root)
    accounts = log_source.file_accounts(log_source.read_csv_files(spark, [f"{root}/kind=*"]))
    return accounts.groupBy(F.regexp_extract("file", "/kind=([a-z]+)/", 1).alias("file")).agg(
        F.sum("rows").alias("rows"), F.min("first").alias("first"), F.max("last").alias("last")
    )


@query
def latest_finished_run_(spark, sf_dir):
    """Orders as runs: the date is the start, status F is a finished one."""
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").otherwise("RUNNING")
    runs = inputs.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderdate").cast("date").cast("string").alias("start_time"),
        status.alias("status"),
    )
    return latest_finished_run(runs)


@query
def candidates_(spark, sf_dir):
    events = daily_events(spark, sf_dir)
    pairs = daily_pairs(spark, sf_dir)
    negatives = candidates.sample_negatives(pairs, daily_popular(spark, sf_dir), DAILY_FEATURES)
    positives = candidates.positive_candidates(events, SPLITS)
    return plain(candidates.labelled_candidates(positives, negatives, SPLITS))


@query
def split_overlap_audit(spark, sf_dir):
    return audits.split_overlaps(inputs.matrices(spark, sf_dir))


@query
def recommendations_to_json(spark, sf_dir):
    lists = ranking.recommendation_lists(ranking.top_k(inputs.scored(spark, sf_dir, "infer")))
    return lists.select("user_id", recommendations.to_json().alias("recommended_items"))


@query
def recommendations_from_json(spark, sf_dir):
    text = QUERIES["recommendations_to_json"](spark, sf_dir)
    parsed = text.withColumn("recommended_items", recommendations.from_json("recommended_items"))
    return recommendations.explode_items(parsed)


@query
def explode_recommendations(spark, sf_dir):
    lists = ranking.recommendation_lists(ranking.top_k(inputs.scored(spark, sf_dir, "infer")))
    return recommendations.explode_items(lists)


# --- model and metrics ---------------------------------------------------------------------


@query
def train_gbt(spark, sf_dir):
    """Validation loss per boosting round up to the early stop, and the round chosen."""
    forest, losses = model.train_gbt(
        inputs.split(spark, sf_dir, "train"), inputs.split(spark, sf_dir, "val"), TrainConfig()
    )
    chosen = len(forest.trees)
    return spark.createDataFrame(
        [(i + 1, float(loss), i + 1 == chosen) for i, loss in enumerate(losses)],
        "round int, validation_loss double, chosen boolean",
    )


@query
def score_candidates(spark, sf_dir):
    """The scoring rows by the stored trees of the training job."""
    return plain(model.score(inputs.trained(spark, sf_dir), inputs.split(spark, sf_dir, "infer")))


def _scored_by_fixed_trees(spark, sf_dir):
    """The scoring rows by trees that are written as a table of nodes and read from it."""
    path = scratch_path(spark, "nodes")
    trees.write_forest(spark, inputs.FIXED_TREES, path)
    scored = model.score(trees.read_forest(spark, path), inputs.split(spark, sf_dir, "infer"))
    return scored.withColumn("score", F.round("score", inputs.SCORE_DIGITS))


@query
def score_by_tree_nodes(spark, sf_dir):
    return plain(_scored_by_fixed_trees(spark, sf_dir))


@query
def recommend_by_tree_nodes(spark, sf_dir):
    """The daily job with scores from tree nodes: score, rank, nest, upsert, read back."""
    table = result_source.ResultTable(spark, scratch_path(spark, "results"))
    recommend(_scored_by_fixed_trees(spark, sf_dir), table)
    return recommendations.explode_items(table.read().drop("updated_at"))


@query
def recommend_trained_daily(spark, sf_dir):
    """The daily job with the trees that training stored."""
    table = result_source.ResultTable(spark, scratch_path(spark, "results"))
    recommend(model.score(inputs.trained(spark, sf_dir), inputs.split(spark, sf_dir, "infer")), table)
    return recommendations.explode_items(table.read().drop("updated_at"))


@query
def auc_roc(spark, sf_dir):
    return rounded(metrics.auc_roc(inputs.scored(spark, sf_dir, "test")))


@query
def log_loss(spark, sf_dir):
    return rounded(metrics.log_loss(inputs.scored(spark, sf_dir, "test")))


@query
def classification_metrics(spark, sf_dir):
    return rounded(metrics.classification_metrics(inputs.scored(spark, sf_dir, "test")))


@query
def training_report(spark, sf_dir):
    return rounded(
        metrics.training_report(
            inputs.scored(spark, sf_dir, "test"), inputs.matrices(spark, sf_dir)
        )
    )


@query
def recommend_daily(spark, sf_dir):
    """Score the scoring split, rank, nest, upsert into a new table and read it back."""
    table = result_source.ResultTable(spark, scratch_path(spark, "results"))
    recommend(inputs.scored(spark, sf_dir, "infer"), table)
    return recommendations.explode_items(table.read().drop("updated_at"))


# --- whole jobs ------------------------------------------------------------------------------


@query
def bootstrap_events(spark, sf_dir):
    root = scratch_path(spark, "lake")
    run_bootstrap(inputs.daily_log(spark, sf_dir), root, DAILY_STRICT)
    return plain(log_source.read_raw_events(spark, root))


@query
def run_features(spark, sf_dir):
    return plain(matrix_source.read_matrices(spark, inputs.fresh_matrices(spark, sf_dir)))


# --- audits ----------------------------------------------------------------------------------


@query
def split_days_audit(spark, sf_dir):
    return listed(audits.split_days(inputs.matrices(spark, sf_dir), SPLITS), "days")


def _faulty(spark, sf_dir):
    """The matrices without the scoring rows and without the positives a model would learn from."""
    rows = inputs.matrices(spark, sf_dir).where("split <> 'infer'")
    return rows.where("not (split = 'train' and label = 1)")


@query
def split_days_audit_of_faults(spark, sf_dir):
    return listed(audits.split_days(_faulty(spark, sf_dir), SPLITS), "days")


@query
def label_audit(spark, sf_dir):
    return audits.labels(inputs.matrices(spark, sf_dir))


@query
def label_audit_of_faults(spark, sf_dir):
    return audits.labels(_faulty(spark, sf_dir))


@query
def qualified_users_audit(spark, sf_dir):
    found = ingest_plan(inputs.daily_log(spark, sf_dir), DAILY_STRICT)
    return plain(audits.lake(found.events, found.qualified, DAILY_STRICT))


@query
def results_audit(spark, sf_dir):
    """Item id 0 occurs in the given tables, so it counts as valid here."""
    table = result_source.ResultTable(spark, scratch_path(spark, "results"))
    recommend(inputs.scored(spark, sf_dir, "infer"), table)
    return audits.results(table.read(), TOP_K, lowest_item=0)


# --- volume variant: order lines by month --------------------------------------------------


@query
def monthly_popular_items(spark, sf_dir):
    counts = matrix.pair_counts(inputs.lake(spark, sf_dir, monthly=True))
    return candidates.popular_items(counts, inputs.MONTHLY_FEATURES.top_popular)


@query
def monthly_hist_user_category(spark, sf_dir):
    raw = inputs.lake(spark, sf_dir, monthly=True)
    counts = history.day_counts(with_day(raw, day_index(raw)), "user_id", "category_id")
    return history.user_category_history(counts)


@query
def monthly_hist_item_popularity(spark, sf_dir):
    raw = inputs.lake(spark, sf_dir, monthly=True)
    return history.item_history(history.day_counts(with_day(raw, day_index(raw)), "item_id"))


@query
def monthly_bootstrap_events(spark, sf_dir):
    root = scratch_path(spark, "lake")
    run_bootstrap(inputs.monthly_log(spark, sf_dir), root, inputs.MONTHLY)
    return plain(log_source.read_raw_events(spark, root))


@query
def monthly_run_features(spark, sf_dir):
    root = inputs.fresh_matrices(spark, sf_dir, monthly=True)
    return plain(matrix_source.read_matrices(spark, root))


@query
def monthly_topk_per_user(spark, sf_dir):
    return ranking.top_k(inputs.scored(spark, sf_dir, "infer", monthly=True))


@query
def monthly_training_report(spark, sf_dir):
    return rounded(
        metrics.training_report(
            inputs.scored(spark, sf_dir, "test", monthly=True),
            inputs.matrices(spark, sf_dir, monthly=True),
        )
    )


@query
def all_dates_bootstrap_events(spark, sf_dir):
    root = scratch_path(spark, "lake")
    run_bootstrap(inputs.daily_log(spark, sf_dir), root, inputs.ALL_DATES)
    return plain(log_source.read_raw_events(spark, root))


@query
def all_dates_popular_items(spark, sf_dir):
    counts = matrix.pair_counts(inputs.lake(spark, sf_dir))
    return candidates.popular_items(counts, inputs.ALL_DATES_FEATURES.top_popular)


@query
def all_dates_run_features(spark, sf_dir):
    root = inputs.all_dates_matrices(spark, sf_dir)
    return plain(matrix_source.read_matrices(spark, root))


@query
def all_dates_topk_per_user(spark, sf_dir):
    root = inputs.all_dates_matrices(spark, sf_dir)
    return ranking.top_k(
        matrix_source.read_split(spark, root, "infer").select(
            "user_id", "item_id", "label", logistic_score(inputs.SCORE_DIGITS).alias("score")
        )
    )
