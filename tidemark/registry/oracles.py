"""The registered queries as plain SQL over the given tables.

Written independently of the DataFrame code: one relation per step, history by windows over
day-grain counts, negatives by a join and NOT EXISTS, everything from the base tables.
"""

from __future__ import annotations

import re

from tidemark.config import FEATURE_COLS, TOP_K, FeatureConfig, IngestConfig
from tidemark.functions.scoring import INTERCEPT, WEIGHTS
from tidemark.registry.inputs import (
    ALL_DATES,
    ALL_DATES_FEATURES,
    DAILY,
    DAILY_FEATURES,
    DAILY_STRICT,
    FIXED_TREES,
    MONTHLY,
    MONTHLY_FEATURES,
    MONTHLY_LONG_LIST,
    NINE_DAYS,
    SCORE_DIGITS,
)
from tidemark.registry.queries import METRIC_DIGITS

ORACLES: dict[str, str] = {}

_DAILY_LOG = """
    SELECT user_id,
           CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id,
           CAST(json_extract_string(props, '$.k') AS BIGINT) % 10 AS category_id,
           CASE event_type WHEN 'purchase' THEN 'buy' WHEN 'signup' THEN 'cart'
                           WHEN 'click' THEN 'fav' ELSE 'pv' END AS behavior_type,
           epoch_us(ts) // 1000000 AS timestamp
    FROM events"""

_MONTHLY_LOG = r"""
    SELECT o.o_custkey AS user_id,
           l.l_partkey AS item_id,
           CAST(regexp_extract(p.p_brand, '(\d+)', 1) AS BIGINT) AS category_id,
           CASE l.l_returnflag WHEN 'R' THEN 'buy' WHEN 'A' THEN 'cart' ELSE 'pv' END
               AS behavior_type,
           epoch_us(o.o_orderdate) // 1000000 AS timestamp
    FROM lineitem l
    JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN part p ON p.p_partkey = l.l_partkey"""

_DAILY_DATE = "DATE '1970-01-01' + CAST((timestamp + 28800) // 86400 AS INTEGER)"
_MONTHLY_DATE = (
    "CAST(date_trunc('month', DATE '1970-01-01' + CAST(timestamp // 86400 AS INTEGER)) AS DATE)"
)


def _days(days) -> str:
    return "(" + ", ".join(map(str, days)) + ")"


def _relations(log: str, date: str, ingest: IngestConfig, features: FeatureConfig) -> dict[str, str]:
    """Every intermediate relation, each naming only earlier ones."""
    s = features.splits
    eps = features.epsilon
    window = f"timestamp BETWEEN {ingest.ts_min} AND {ingest.ts_max}"
    past = "ORDER BY day ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"
    total_z = " + ".join(
        [f"CAST({INTERCEPT} AS DOUBLE)"]
        + [
            f"CAST({w} AS DOUBLE) * " + (f"ln(1 + {c})" if logged else c)
            for c, (w, logged) in WEIGHTS.items()
        ]
    )
    return {
        "log": log,
        "qualified": f"""
    SELECT user_id, count(*) AS n FROM log WHERE {window}
    GROUP BY user_id HAVING count(*) >= {ingest.min_interactions}""",
        "raw": f"""
    SELECT user_id, item_id, category_id, behavior_type, timestamp, {date} AS event_date
    FROM log WHERE {window} AND user_id IN (SELECT user_id FROM qualified)""",
        "calendar": """
    SELECT event_date, row_number() OVER (ORDER BY event_date) AS day
    FROM (SELECT DISTINCT event_date FROM raw)""",
        "ev": """
    SELECT raw.*, calendar.day,
           CASE WHEN behavior_type IN ('buy', 'cart', 'fav') THEN 1 ELSE 0 END AS engaged
    FROM raw JOIN calendar ON raw.event_date = calendar.event_date""",
        "ui": f"""
    SELECT user_id, item_id, day,
           CAST(coalesce(sum(n) OVER (PARTITION BY user_id, item_id {past}), 0) AS BIGINT)
               AS user_item_freq
    FROM (SELECT user_id, item_id, day, count(*) AS n FROM ev GROUP BY ALL)""",
        "uc": f"""
    SELECT user_id, category_id, day,
           CAST(coalesce(sum(n) OVER (PARTITION BY user_id, category_id {past}), 0) AS BIGINT)
               AS user_cat_freq,
           CAST(coalesce(sum(e) OVER (PARTITION BY user_id, category_id {past}), 0) AS BIGINT)
               AS user_cat_eng,
           lag(n, 1) OVER (PARTITION BY user_id, category_id ORDER BY day) AS lag_1,
           lag(n, 2) OVER (PARTITION BY user_id, category_id ORDER BY day) AS lag_2
    FROM (SELECT user_id, category_id, day, count(*) AS n, sum(engaged) AS e
          FROM ev GROUP BY ALL)""",
        "it": f"""
    SELECT item_id, day,
           CAST(coalesce(sum(n) OVER (PARTITION BY item_id {past}), 0) AS BIGINT)
               AS item_popularity
    FROM (SELECT item_id, day, count(*) AS n FROM ev GROUP BY ALL)""",
        "ca": f"""
    SELECT category_id, day,
           CAST(coalesce(sum(n) OVER (PARTITION BY category_id {past}), 0) AS BIGINT)
               AS cat_popularity,
           (CAST(coalesce(sum(e) OVER (PARTITION BY category_id {past}), 0) AS DOUBLE) + 1.0)
           / (CAST(coalesce(sum(1) OVER (PARTITION BY category_id {past}), 0) AS DOUBLE) + 2.0)
               AS cat_target_enc
    FROM (SELECT category_id, day, count(*) AS n, sum(engaged) AS e FROM ev GROUP BY ALL)""",
        "positives": f"""
    SELECT DISTINCT user_id, item_id, category_id, day, event_date
    FROM ev WHERE engaged = 1 AND day IN {_days(s.labelled)}""",
        "popular": f"""
    SELECT item_id, category_id, count(*) AS pop FROM ev GROUP BY item_id, category_id
    ORDER BY pop DESC, item_id, category_id LIMIT {features.top_popular}""",
        "user_days": "SELECT DISTINCT user_id, day, event_date FROM positives",
        "offered": """
    SELECT d.user_id, p.item_id, p.category_id, d.day, d.event_date
    FROM user_days d, popular p""",
        "unseen": """
    SELECT o.* FROM offered o
    WHERE NOT EXISTS (SELECT 1 FROM ev
                      WHERE ev.user_id = o.user_id AND ev.item_id = o.item_id
                        AND ev.day = o.day)""",
        "negatives": f"""
    SELECT user_id, item_id, category_id, day, event_date
    FROM (SELECT *, row_number() OVER (PARTITION BY user_id, day
                                       ORDER BY item_id, category_id) AS nth FROM unseen)
    WHERE nth <= {features.neg_ratio}""",
        "cand": f"""
    SELECT *, CASE WHEN day IN {_days(s.train)} THEN 'train'
                   WHEN day IN {_days(s.val)} THEN 'val'
                   WHEN day IN {_days(s.test)} THEN 'test' END AS split
    FROM (SELECT *, 1 AS label FROM positives UNION ALL SELECT *, 0 AS label FROM negatives)""",
        "to_score": f"""
    SELECT DISTINCT user_id, item_id, category_id, day, event_date,
           CAST(NULL AS INTEGER) AS label, 'infer' AS split
    FROM ev WHERE day IN {_days(s.infer)}""",
        "matrix": f"""
    SELECT k.user_id, k.item_id, k.category_id, k.day, k.event_date, k.label, k.split,
           coalesce(user_item_freq, 0) AS user_item_freq,
           coalesce(user_cat_freq, 0) AS user_cat_freq,
           coalesce(user_cat_eng, 0) AS user_cat_eng,
           (coalesce(user_cat_eng, 0) + CAST({eps} AS DOUBLE))
               / (coalesce(user_cat_freq, 0) + CAST({eps} AS DOUBLE)) AS intent_score,
           coalesce(item_popularity, 0) AS item_popularity,
           coalesce(cat_popularity, 0) AS cat_popularity,
           coalesce(cat_target_enc, CAST(0.5 AS DOUBLE)) AS cat_target_enc,
           coalesce(lag_1, 0) AS lag_1,
           coalesce(lag_2, 0) AS lag_2
    FROM (SELECT * FROM cand UNION ALL BY NAME SELECT * FROM to_score) k
    LEFT JOIN ui ON ui.user_id = k.user_id AND ui.item_id = k.item_id AND ui.day = k.day
    LEFT JOIN uc ON uc.user_id = k.user_id AND uc.category_id = k.category_id AND uc.day = k.day
    LEFT JOIN it ON it.item_id = k.item_id AND it.day = k.day
    LEFT JOIN ca ON ca.category_id = k.category_id AND ca.day = k.day""",
        "scored": f"""
    SELECT user_id, item_id, category_id, label, split,
           round(1.0 / (1.0 + exp(-({total_z}))), {SCORE_DIGITS}) AS score
    FROM matrix""",
        "ranked": f"""
    SELECT user_id, item_id, score, rank, split
    FROM (SELECT *, row_number() OVER (PARTITION BY split, user_id
                                       ORDER BY score DESC, item_id) AS rank FROM scored)
    WHERE rank <= {TOP_K}""",
        "top": "SELECT user_id, item_id, score, rank FROM ranked WHERE split = 'infer'",
        "judged": """
    SELECT label, score, CASE WHEN score >= 0.5 THEN 1 ELSE 0 END AS hit
    FROM scored WHERE split = 'test'""",
        "confusion": """
    SELECT CAST(count(*) AS DOUBLE) AS n,
           CAST(sum(hit) AS DOUBLE) AS hits,
           CAST(sum(label) AS DOUBLE) AS pos,
           CAST(sum(hit * label) AS DOUBLE) AS tp,
           CAST(sum(CASE WHEN hit = label THEN 1 ELSE 0 END) AS DOUBLE) AS same
    FROM judged""",
        "auc": """
    SELECT (sum(CASE WHEN label = 1 THEN mid_rank ELSE 0 END)
            - sum(label) * (sum(label) + 1) / 2.0)
           / (CAST(sum(label) AS DOUBLE) * sum(1 - label)) AS auc_roc
    FROM (SELECT label, CAST(rank() OVER (ORDER BY score) AS DOUBLE)
                        + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS mid_rank
          FROM judged)""",
        "report": f"""
    SELECT round((SELECT auc_roc FROM auc), {METRIC_DIGITS}) AS test_auc_roc,
           round((SELECT -avg(label * ln(p) + (1 - label) * ln(1 - p))
                  FROM (SELECT label, least(greatest(score, 2.220446049250313e-16),
                                            1 - 2.220446049250313e-16) AS p FROM judged)),
                 {METRIC_DIGITS}) AS test_logloss,
           round(CASE WHEN hits = 0 THEN 0 ELSE tp / hits END, {METRIC_DIGITS}) AS test_precision,
           round(CASE WHEN pos = 0 THEN 0 ELSE tp / pos END, {METRIC_DIGITS}) AS test_recall,
           round(CASE WHEN hits + pos = 0 THEN 0 ELSE 2 * tp / (hits + pos) END,
                 {METRIC_DIGITS}) AS test_f1,
           round(CASE WHEN n = 0 THEN 0 ELSE same / n END, {METRIC_DIGITS}) AS test_accuracy
    FROM confusion""",
    }


def _sql(relations: dict[str, str], final: str) -> str:
    """``final`` with the relations it needs, directly or through others, as CTEs."""
    names = list(relations)
    needed: set[str] = set()

    def mentioned(text: str, before: int) -> None:
        for name in names[:before]:
            if name not in needed and re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", text):
                needed.add(name)
                mentioned(relations[name], names.index(name))

    mentioned(final, len(names))
    ctes = ",\n".join(f"{n} AS ({relations[n]})" for n in names if n in needed)
    if final.startswith(_TREE_SCORES.strip()):
        return f"WITH RECURSIVE {ctes}{_tree_relations()}\n{final}"
    return f"WITH {ctes}\n{final}" if ctes else final


_daily = _relations(_DAILY_LOG, _DAILY_DATE, DAILY, DAILY_FEATURES)
_strict = _relations(_DAILY_LOG, _DAILY_DATE, DAILY_STRICT, DAILY_FEATURES)
_unknowns = _relations(
    f"""
    SELECT user_id, CASE WHEN timestamp % 6 <> 0 THEN item_id END AS item_id,
           CASE WHEN timestamp % 5 <> 0 THEN category_id END AS category_id,
           behavior_type, timestamp
    FROM ({_DAILY_LOG})""",
    _DAILY_DATE, DAILY, DAILY_FEATURES,
)
_all_dates = _relations(_DAILY_LOG, _DAILY_DATE, ALL_DATES, ALL_DATES_FEATURES)
_monthly = _relations(_MONTHLY_LOG, _MONTHLY_DATE, MONTHLY, MONTHLY_FEATURES)
_long_list = _relations(_MONTHLY_LOG, _MONTHLY_DATE, MONTHLY, MONTHLY_LONG_LIST)

_LOG_COLS = "user_id, item_id, category_id, behavior_type, timestamp"
_DATE = "CAST(event_date AS VARCHAR) AS event_date"
_LAKE = f"{_LOG_COLS}, {_DATE}"
_WINDOW = f"timestamp BETWEEN {NINE_DAYS.ts_min} AND {NINE_DAYS.ts_max}"
_FEATURES = ", ".join(FEATURE_COLS)
_MATRIX = f"user_id, item_id, category_id, day, {_DATE}, label, split, {_FEATURES}"
_S = DAILY_FEATURES.splits
_PAIRS = (
    ("train", "val"), ("train", "test"), ("train", "infer"),
    ("val", "test"), ("val", "infer"), ("test", "infer"),
)


def _unpivot_report() -> str:
    names = ("test_auc_roc", "test_logloss", "test_precision", "test_recall", "test_f1", "test_accuracy")
    return "\nUNION ALL ".join(
        f"SELECT 'fixed-logistic' AS run_id, '{n}' AS key, {n} AS value FROM report" for n in names
    )


def _overlaps() -> str:
    return "\nUNION ALL ".join(
        f"""SELECT '{a}/{b}' AS splits,
       (SELECT count(*) FROM (SELECT event_date FROM matrix WHERE split = '{a}'
                              INTERSECT SELECT event_date FROM matrix WHERE split = '{b}'))
           AS shared_dates"""
        for a, b in _PAIRS
    )


# The matrix without its scoring rows and without the positives that a model would learn from.
_FAULTY = "(SELECT * FROM matrix WHERE split <> 'infer' AND NOT (split = 'train' AND label = 1))"


def _split_days(rows: str) -> str:
    wanted = ", ".join(f"('{s}', '{','.join(map(str, days))}')" for s, days in _S.as_dict().items())
    return f"""
SELECT w.split, coalesce(f.days, '') AS days, coalesce(f.days = w.days, FALSE) AS as_expected
FROM (VALUES {wanted}) AS w(split, days)
LEFT JOIN (SELECT split, string_agg(CAST(day AS VARCHAR), ',' ORDER BY day) AS days
           FROM (SELECT DISTINCT split, day FROM {rows} AS r) GROUP BY split) f ON f.split = w.split"""


def _labels(rows: str) -> str:
    return f"""
SELECT split, positives, negatives, unlabelled,
       CASE split WHEN 'infer' THEN positives = 0 AND negatives = 0 AND unlabelled > 0
                  WHEN 'train' THEN positives > 0 AND negatives > 0 AND unlabelled = 0
                  ELSE negatives > 0 AND unlabelled = 0 END AS sound
FROM (SELECT w.split, count(CASE WHEN label = 1 THEN 1 END) AS positives,
             count(CASE WHEN label = 0 THEN 1 END) AS negatives,
             count(CASE WHEN r.split IS NOT NULL AND label IS NULL THEN 1 END) AS unlabelled
      FROM (VALUES ('train'), ('val'), ('test'), ('infer')) AS w(split)
      LEFT JOIN {rows} AS r ON r.split = w.split GROUP BY w.split)"""


def _tree_relations() -> str:
    """Every scoring row walks down every tree: one step of the recursion is one level."""
    nodes = ",\n           ".join(
        f"({number}, {tree.weight}::DOUBLE, {n.node}, {_text(n.feature)}, {_number(n.threshold)}, "
        f"{_number(n.left)}, {_number(n.right)}, {n.value}::DOUBLE)"
        for number, tree in enumerate(FIXED_TREES.trees)
        for n in tree.nodes
    )
    features = ", ".join(f"'{c}': CAST({c} AS DOUBLE)" for c in FEATURE_COLS)
    return f""",
tree_nodes(tree, weight, node, feature, threshold, left_node, right_node, value) AS (
    VALUES {nodes}),
tree_rows AS (
    SELECT row_number() OVER () AS id, *, MAP {{{features}}} AS f FROM matrix WHERE split = 'infer'),
walk AS (
    SELECT r.id, n.tree, n.node FROM tree_rows r, tree_nodes n WHERE n.node = 0
    UNION ALL
    SELECT w.id, w.tree, CASE WHEN r.f[n.feature] <= n.threshold THEN n.left_node ELSE n.right_node END
    FROM walk w
    JOIN tree_nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NOT NULL
    JOIN tree_rows r ON r.id = w.id),
margins AS (
    SELECT w.id, sum(n.weight * n.value) AS margin
    FROM walk w JOIN tree_nodes n ON n.tree = w.tree AND n.node = w.node AND n.feature IS NULL
    GROUP BY w.id),
tree_scores AS (
    SELECT r.*, round(1.0 / (1.0 + exp(-2.0 * margin)), {SCORE_DIGITS}) AS score
    FROM tree_rows r JOIN margins m ON m.id = r.id)"""


def _text(value: str | None) -> str:
    return "NULL" if value is None else f"'{value}'"


def _number(value: float | None) -> str:
    return "NULL" if value is None else str(value)


# Marks the place of the relations above, after those of the matrix.
_TREE_SCORES = "-- tree scores, FROM matrix\n"

_FINAL_DAILY = {
    "scan_csv_log": f"SELECT {_LOG_COLS} FROM log",
    "scan_raw_events": f"SELECT {_LAKE} FROM raw",
    "scan_split": f"SELECT {_MATRIX} FROM matrix WHERE split = 'val'",
    "write_raw_partitions": (
        f"SELECT {_LOG_COLS}, CAST({_DAILY_DATE} AS VARCHAR) AS event_date FROM log WHERE {_WINDOW}"
    ),
    "write_split_matrices": f"SELECT {_MATRIX} FROM matrix",
    "upsert_results": """
SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score,
       CASE split WHEN 'infer' THEN '2024-01-10 00:00:00' ELSE '2024-01-09 00:00:00' END
           AS updated_at
FROM ranked r
WHERE split = 'infer'
   OR (split = 'test' AND NOT EXISTS (SELECT 1 FROM ranked n
                                      WHERE n.split = 'infer' AND n.user_id = r.user_id))""",
    "lookup_one": """
SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score
FROM top WHERE user_id = (SELECT max(user_id) FROM top)""",
    "repeated_result_keys": """
SELECT user_id, count(*) AS n
FROM (SELECT DISTINCT user_id, split FROM ranked WHERE split = 'test' OR split = 'infer')
GROUP BY user_id HAVING count(*) > 1""",
    "result_schema_check": """
SELECT count(user_id) AS user_ids, count(items) AS lists, count(stamp) AS stamps, count(*) AS rows
FROM (SELECT user_id, list(item_id) AS items, max(DATE '2024-01-01') AS stamp FROM top GROUP BY user_id)""",
    "metrics_unpivot": _unpivot_report(),
    "filter_time_range": f"SELECT {_LOG_COLS} FROM log WHERE {_WINDOW}",
    "local_event_date": (
        f"SELECT user_id, timestamp, CAST({_DAILY_DATE} AS VARCHAR) AS event_date "
        f"FROM log WHERE {_WINDOW}"
    ),
    "filter_engagement": (
        f"SELECT {_LAKE} FROM raw WHERE behavior_type = 'buy' "
        "OR behavior_type = 'cart' OR behavior_type = 'fav'"
    ),
    "filter_split_days": f"SELECT {_LAKE}, day FROM ev WHERE day BETWEEN 4 AND 30",
    "split_label": f"""
SELECT {_DATE}, day,
       CASE WHEN day BETWEEN 4 AND 28 THEN 'train' WHEN day = 29 THEN 'val'
            WHEN day = 30 THEN 'test' WHEN day = 31 THEN 'infer' END AS split
FROM calendar""",
    "intent_score": f"""
SELECT user_id, category_id, day,
       (user_cat_eng + CAST({DAILY_FEATURES.epsilon} AS DOUBLE))
       / (user_cat_freq + CAST({DAILY_FEATURES.epsilon} AS DOUBLE)) AS intent_score
FROM uc""",
    "feature_projection": f"""
SELECT n.user_id, n.item_id, n.category_id, n.day,
       CAST(0 AS BIGINT) AS user_item_freq,
       coalesce(user_cat_freq, 0) AS user_cat_freq,
       coalesce(user_cat_eng, 0) AS user_cat_eng,
       (coalesce(user_cat_eng, 0) + CAST({DAILY_FEATURES.epsilon} AS DOUBLE))
       / (coalesce(user_cat_freq, 0) + CAST({DAILY_FEATURES.epsilon} AS DOUBLE)) AS intent_score,
       CAST(0 AS BIGINT) AS item_popularity,
       CAST(0 AS BIGINT) AS cat_popularity,
       CAST(0.5 AS DOUBLE) AS cat_target_enc,
       coalesce(lag_1, 0) AS lag_1,
       coalesce(lag_2, 0) AS lag_2
FROM negatives n
LEFT JOIN uc ON uc.user_id = n.user_id AND uc.category_id = n.category_id AND uc.day = n.day""",
    "assemble_features": "SELECT user_id, item_id, day, label, "
    + ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(FEATURE_COLS))
    + " FROM matrix WHERE split = 'train'",
    "lookup_recommendations": """
SELECT c.c_custkey AS user_id, t.n IS NOT NULL AS found, coalesce(t.n, 0) AS items, t.best_item
FROM customer c
LEFT JOIN (SELECT user_id, CAST(count(*) AS INTEGER) AS n,
                  max(CASE WHEN rank = 1 THEN item_id END) AS best_item
           FROM top GROUP BY user_id) t ON t.user_id = c.c_custkey""",
    "events_with_day": (
        f"SELECT user_id, item_id, category_id, behavior_type, {_DATE}, day FROM ev"
    ),
    "cross_join_popular": f"SELECT user_id, item_id, category_id, day, {_DATE} FROM offered",
    "anti_join_unseen": f"SELECT user_id, item_id, category_id, day, {_DATE} FROM unseen",
    "point_in_time_join": f"SELECT {_MATRIX} FROM matrix WHERE split <> 'infer'",
    "feature_matrix": f"SELECT {_MATRIX} FROM matrix WHERE split <> 'infer'",
    "inference_matrix": f"SELECT {_MATRIX} FROM matrix WHERE split = 'infer'",
    "positive_candidates": (
        f"SELECT user_id, item_id, category_id, day, {_DATE}, 1 AS label FROM positives"
    ),
    "popular_items": "SELECT item_id, category_id, pop FROM popular",
    "positive_user_days": f"SELECT user_id, day, {_DATE} FROM user_days",
    "split_counts": """
SELECT (SELECT count(*) FROM matrix WHERE split = 'train' AND label = 1) AS train_pos,
       (SELECT count(*) FROM matrix WHERE split = 'train' AND label = 0) AS train_neg,
       (SELECT count(*) FROM matrix WHERE split = 'val') AS val,
       (SELECT count(*) FROM matrix WHERE split = 'test') AS test,
       (SELECT count(*) FROM matrix WHERE split = 'infer') AS infer""",
    "split_counts_written": """
SELECT count(CASE WHEN split = 'train' AND label = 1 THEN 1 END) AS train_pos,
       count(CASE WHEN split = 'train' AND label = 0 THEN 1 END) AS train_neg,
       count(CASE WHEN split = 'val' THEN 1 END) AS val,
       count(CASE WHEN split = 'test' THEN 1 END) AS test,
       count(CASE WHEN split = 'infer' THEN 1 END) AS infer
FROM matrix""",
    "split_date_sets": """
SELECT split, string_agg(event_date, ',' ORDER BY event_date) AS dates
FROM (SELECT DISTINCT split, CAST(event_date AS VARCHAR) AS event_date FROM matrix)
GROUP BY split""",
    "topk_lists": """
SELECT user_id, CAST(count(*) AS INTEGER) AS items,
       string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS ranked_items
FROM top GROUP BY user_id""",
    "ordered_results": """
SELECT row_number() OVER (ORDER BY user_id) AS place, user_id,
       string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY rank) AS ranked_items
FROM top GROUP BY user_id""",
    "union_files": f"SELECT {_LOG_COLS}, behavior_type AS file FROM log",
    "file_accounts": """
SELECT behavior_type AS file, count(*) AS rows, min(timestamp) AS first, max(timestamp) AS last
FROM log GROUP BY behavior_type""",
    "day_index": f"SELECT {_DATE}, day FROM calendar",
    "hist_user_item": "SELECT user_id, item_id, day, user_item_freq FROM ui",
    "hist_user_category": "SELECT user_id, category_id, day, user_cat_freq, user_cat_eng FROM uc",
    "hist_item_popularity": "SELECT item_id, day, item_popularity FROM it",
    "hist_category_popularity": "SELECT category_id, day, cat_popularity FROM ca",
    "category_target_encoding": "SELECT category_id, day, cat_target_enc FROM ca",
    "lag_features": "SELECT user_id, category_id, day, lag_1, lag_2 FROM uc",
    "sample_negatives": (
        f"SELECT user_id, item_id, category_id, day, {_DATE}, 0 AS label FROM negatives"
    ),
    "topk_per_user": "SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM top",
    "latest_finished_run": """
SELECT run_id, start_time, status
FROM (SELECT o_orderkey AS run_id, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS start_time,
             CASE o_orderstatus WHEN 'F' THEN 'FINISHED' ELSE 'RUNNING' END AS status
      FROM orders ORDER BY start_time DESC, run_id DESC LIMIT 10)
WHERE status = 'FINISHED' ORDER BY start_time DESC, run_id DESC LIMIT 1""",
    "candidates": (
        f"SELECT user_id, item_id, category_id, day, {_DATE}, label, split FROM cand"
    ),
    "split_overlap_audit": _overlaps(),
    "recommendations_to_json": """
SELECT user_id,
       CAST(to_json(list({'item_id': item_id, 'score': score} ORDER BY rank)) AS VARCHAR)
           AS recommended_items
FROM top GROUP BY user_id""",
    "recommendations_from_json": (
        "SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score FROM top"
    ),
    "explode_recommendations": (
        "SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score FROM top"
    ),
    "score_by_tree_nodes": _TREE_SCORES
    + f"""
SELECT user_id, item_id, category_id, day, {_DATE}, label, split, score FROM tree_scores""",
    "recommend_by_tree_nodes": _TREE_SCORES
    + f"""
SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, item_id) AS rank
      FROM tree_scores)
WHERE rank <= {TOP_K}""",
    "auc_roc": f"SELECT round(auc_roc, {METRIC_DIGITS}) AS auc_roc FROM auc",
    "log_loss": "SELECT test_logloss AS log_loss FROM report",
    "classification_metrics": (
        "SELECT test_precision AS precision, test_recall AS recall, test_f1 AS f1, "
        "test_accuracy AS accuracy FROM report"
    ),
    "training_report": """
SELECT report.*,
       (SELECT count(*) FROM matrix WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM matrix WHERE split = 'val') AS n_val,
       (SELECT count(*) FROM matrix WHERE split = 'test') AS n_test
FROM report""",
    "recommend_daily": "SELECT user_id, CAST(rank AS INTEGER) AS rank, item_id, score FROM top",
    "run_features": f"SELECT {_MATRIX} FROM matrix",
    "split_days_audit": _split_days("matrix"),
    "split_days_audit_of_faults": _split_days(_FAULTY),
    "label_audit": _labels("matrix"),
    "label_audit_of_faults": _labels(_FAULTY),
    "results_audit": """
SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS users,
       count(CASE WHEN n > 1 THEN 1 END) AS repeated_users,
       CAST(sum(nulls) AS BIGINT) AS null_lists,
       count(CASE WHEN shortest < 1 THEN 1 END) AS empty_lists,
       count(CASE WHEN longest > 10 THEN 1 END) AS long_lists,
       CAST(sum(bad) AS BIGINT) AS lists_with_bad_items
FROM (SELECT user_id, count(*) AS n, count(CASE WHEN items IS NULL THEN 1 END) AS nulls,
             min(len(items)) AS shortest, max(len(items)) AS longest,
             count(CASE WHEN list_min(items) < 0 THEN 1 END) AS bad
      FROM (SELECT user_id, list(item_id) AS items FROM top GROUP BY user_id)
      GROUP BY user_id)""",
}

_FINAL_STRICT = {
    "semi_join_qualified": f"SELECT {_LOG_COLS} FROM raw",
    "qualified_users": "SELECT user_id, n FROM qualified",
    "qualified_user_count": "SELECT count(*) AS qualified_users FROM qualified",
    "bootstrap_events": f"SELECT {_LAKE} FROM raw",
    "qualified_users_audit": f"""
SELECT count(*) AS rows, count(DISTINCT user_id) AS users,
       count(CASE WHEN user_id NOT IN (SELECT user_id FROM qualified) THEN 1 END)
           AS unqualified_rows,
       count(CASE WHEN NOT ({_WINDOW}) THEN 1 END) AS rows_outside_window,
       CAST(min(event_date) AS VARCHAR) AS first_date,
       CAST(max(event_date) AS VARCHAR) AS last_date
FROM raw""",
}

_FINAL_UNKNOWNS = {"feature_matrix_with_nulls": f"SELECT {_MATRIX} FROM matrix"}

_FINAL_LONG_LIST = {
    "sample_negatives_long_list": (
        f"SELECT user_id, item_id, category_id, day, {_DATE}, 0 AS label FROM negatives"
    ),
}

_FINAL_MONTHLY = {
    "monthly_bootstrap_events": f"SELECT {_LAKE} FROM raw",
    "monthly_popular_items": "SELECT item_id, category_id, pop FROM popular",
    "monthly_hist_user_category": (
        "SELECT user_id, category_id, day, user_cat_freq, user_cat_eng, lag_1, lag_2 FROM uc"
    ),
    "monthly_hist_item_popularity": "SELECT item_id, day, item_popularity FROM it",
    "monthly_run_features": f"SELECT {_MATRIX} FROM matrix",
    "monthly_topk_per_user": (
        "SELECT user_id, item_id, score, CAST(rank AS INTEGER) AS rank FROM top"
    ),
    "monthly_training_report": """
SELECT report.*,
       (SELECT count(*) FROM matrix WHERE split = 'train') AS n_train,
       (SELECT count(*) FROM matrix WHERE split = 'val') AS n_val,
       (SELECT count(*) FROM matrix WHERE split = 'test') AS n_test
FROM report""",
}

_FINAL_ALL_DATES = {
    name.replace("monthly_", "all_dates_"): _FINAL_MONTHLY[name]
    for name in (
        "monthly_bootstrap_events", "monthly_popular_items", "monthly_run_features", "monthly_topk_per_user"
    )
}

for _relations_of, _finals in (
    (_daily, _FINAL_DAILY), (_strict, _FINAL_STRICT), (_monthly, _FINAL_MONTHLY),
    (_unknowns, _FINAL_UNKNOWNS), (_all_dates, _FINAL_ALL_DATES), (_long_list, _FINAL_LONG_LIST),
):
    ORACLES.update({name: _sql(_relations_of, final.strip()) for name, final in _finals.items()})
