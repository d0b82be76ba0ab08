"""The feature job against direct counting, on logs with the awkward cases in them."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

import reference_model
from tidemark.config import FEATURE_COLS, MATRIX_COLS, MATRIX_KEYS, FeatureConfig, Splits
from tidemark.operators import candidates, history, matrix, skew
from tidemark.operators.days import day_index, with_day
from tidemark.operators.metrics import split_counts
from tidemark.plans import run_features
from tidemark.session import scratch_root, stage
from tidemark.sources.log import LAKE_SCHEMA, write_raw_partitions
from tidemark.sources.matrices import MATRIX_SCHEMA, read_matrices, read_split, write_split_matrices
from tidemark.sources.storage import subdirectories

START = date(2020, 3, 1)


def lake(spark, events, dates=None):
    """Events (user, item, category, behavior, day) as lake rows; ``dates`` per day ordinal."""
    dates = dates or {d: START + timedelta(days=d) for d in {e[4] for e in events}}
    rows = [(u, i, c, b, 0, dates[d]) for u, i, c, b, d in events]
    return spark.createDataFrame(rows, LAKE_SCHEMA)


def random_events(seed, n=400, users=6, items=14, days=9, two_categories=True):
    r = random.Random(seed)
    events = []
    for day in range(1, days + 1):
        events.append((99, 1, 1, "pv", day))  # every date occurs
    for _ in range(n):
        item = min(r.randrange(items), r.randrange(items))
        category = item % 3
        if two_categories and item in (0, 2):
            category = r.choice((category, 7))
        behavior = r.choice(("pv", "pv", "pv", "buy", "cart", "fav"))
        events.append((r.randrange(users), item, category, behavior, r.randint(1, days)))
    return events


def with_holes(events, seed):
    """Null items, null categories and rows with neither: empty fields of the log."""
    r = random.Random(seed)
    hole = lambda value: None if r.random() < 0.2 else value
    return [(u, hole(i), hole(c), b, d) for u, i, c, b, d in events]


def collected(df):
    return sorted(
        [tuple(r) for r in df.drop("event_date").select(
            "user_id", "item_id", "category_id", "day", "label", "split", *FEATURE_COLS
        ).collect()],
        key=repr,
    )


@pytest.mark.parametrize(
    "seed, cfg",
    [
        (1, FeatureConfig()),
        (2, FeatureConfig(top_popular=5, neg_ratio=2)),
        (3, FeatureConfig(top_popular=3, neg_ratio=4, epsilon=0.5)),
        (4, FeatureConfig(top_popular=100, neg_ratio=9)),
        (5, FeatureConfig(splits=Splits(train=(2, 3), val=(5,), test=(6,), infer=(4,)))),
        (6, FeatureConfig(neg_ratio=0)),
    ],
)
def test_matrix_equals_direct_counting(spark, seed, cfg):
    events = random_events(seed)
    counts = matrix.stage_day_counts(lake(spark, events))
    built = matrix.build_matrix(counts, cfg)
    assert built.columns == list(MATRIX_COLS)
    assert collected(built) == sorted(reference_model.matrix(events, cfg), key=repr)


@pytest.mark.parametrize("floor", [None, 2])
def test_null_items_and_categories_have_no_history(spark, monkeypatch, floor):
    """In the fused path and the join by day, with and without salted joins."""
    if floor is not None:
        monkeypatch.setattr(skew, "HOT_FLOOR", floor)
    events = with_holes(random_events(13), 13)
    cfg = FeatureConfig(top_popular=12, neg_ratio=8)
    raw = lake(spark, events)
    days = with_day(raw, day_index(raw))
    fused = stage(matrix.build_matrix(matrix.stage_day_counts(raw), cfg), "fused")
    wanted = sorted(reference_model.matrix(events, cfg), key=repr)
    assert any(row[1] is None and row[4] == 0 for row in wanted)
    assert collected(fused) == wanted
    joined = matrix.point_in_time_join(
        fused.select(*MATRIX_KEYS),
        history.user_item_history(history.day_counts(days, "user_id", "item_id")),
        history.user_category_history(history.day_counts(days, "user_id", "category_id")),
        history.item_history(history.day_counts(days, "item_id")),
        history.category_history(history.day_counts(days, "category_id")),
        cfg,
    )
    assert collected(joined) == wanted


def test_labelled_and_scoring_matrix_are_parts_of_the_whole(spark):
    events = random_events(7)
    cfg = FeatureConfig()
    counts = matrix.stage_day_counts(lake(spark, events))
    parts = collected(matrix.build_matrix(counts, cfg, infer=False)) + collected(
        matrix.build_matrix(counts, cfg, labelled=False)
    )
    assert sorted(parts, key=repr) == collected(matrix.build_matrix(counts, cfg))


def test_point_in_time_join_equals_the_fused_path(spark):
    events = random_events(8)
    cfg = FeatureConfig()
    raw = lake(spark, events)
    days = with_day(raw, day_index(raw))
    counts = matrix.stage_day_counts(raw)
    fused = matrix.build_matrix(counts, cfg)
    keys = fused.select(*MATRIX_KEYS)
    joined = matrix.point_in_time_join(
        keys,
        history.user_item_history(history.day_counts(days, "user_id", "item_id")),
        history.user_category_history(history.day_counts(days, "user_id", "category_id")),
        history.item_history(history.day_counts(days, "item_id")),
        history.category_history(history.day_counts(days, "category_id")),
        cfg,
    )
    assert collected(joined) == collected(fused)


def test_hot_keys_do_not_change_the_matrix(spark, monkeypatch):
    """The same log with the hot-key threshold so low that most joins are salted."""
    events = [(u, 3 if i % 2 else i, c, b, d) for u, i, c, b, d in random_events(9)]
    cfg = FeatureConfig()
    original = matrix.hot_keys
    seen = {}

    def watched(counted, keys, weight, rows):
        hot = original(counted, keys, weight, rows)
        seen[tuple(keys)] = hot.count()
        return hot

    monkeypatch.setattr(skew, "HOT_FLOOR", 2)
    monkeypatch.setattr(matrix, "hot_keys", watched)
    counts = matrix.stage_day_counts(lake(spark, events))
    assert collected(matrix.build_matrix(counts, cfg)) == sorted(
        reference_model.matrix(events, cfg), key=repr
    )
    assert len(seen) == 4 and all(n > 0 for n in seen.values())


def test_hot_keys_do_not_change_the_point_in_time_join(spark, monkeypatch):
    events = random_events(12)
    cfg = FeatureConfig()
    raw = lake(spark, events)
    days = with_day(raw, day_index(raw))
    fused = matrix.build_matrix(matrix.stage_day_counts(raw), cfg)
    keys = stage(fused.select(*MATRIX_KEYS), "keys")
    monkeypatch.setattr(skew, "HOT_FLOOR", 3)
    joined = matrix.point_in_time_join(
        keys,
        history.user_item_history(history.day_counts(days, "user_id", "item_id")),
        history.user_category_history(history.day_counts(days, "user_id", "category_id")),
        history.item_history(history.day_counts(days, "item_id")),
        history.category_history(history.day_counts(days, "category_id")),
        cfg,
    )
    assert joined._jdf.queryExecution().analyzed().toString().count("_parts") > 3
    assert collected(joined) == collected(fused)


def test_a_missing_date_shifts_the_ordinals(spark):
    events = [(1, 1, 1, "pv", d) for d in (1, 2, 5)]
    days = {r["day"]: r["event_date"] for r in day_index(lake(spark, events)).collect()}
    assert days == {n: START + timedelta(days=d) for n, d in ((1, 1), (2, 2), (3, 5))}


def test_first_active_day_has_no_history(spark):
    events = [(1, 5, 2, "buy", 1), (1, 5, 2, "pv", 3), (1, 5, 2, "pv", 3), (1, 6, 2, "fav", 4)]
    dates = {d: START + timedelta(days=d) for d in (1, 3, 4)}
    raw = lake(spark, events, dates)
    counts = history.day_counts(with_day(raw, day_index(raw)), "user_id", "category_id")
    rows = sorted(tuple(r) for r in history.user_category_history(counts).collect())
    assert rows == [(1, 2, 1, 0, 0, None, None), (1, 2, 2, 1, 1, 1, None), (1, 2, 3, 3, 1, 2, 1)]


def test_cold_intent_is_one_and_negative_ignores_older_touches(spark):
    # user 1 touched item 10 on day 3; on day 4 it is unseen, hence a negative without history
    events = [(1, 10, 1, "buy", 3), (2, 10, 1, "pv", 1), (2, 10, 1, "pv", 2), (1, 11, 2, "buy", 4)]
    counts = matrix.stage_day_counts(lake(spark, events))
    cfg = FeatureConfig(splits=Splits(train=(4,), val=(7,), test=(8,), infer=(9,)))
    rows = {(r["item_id"], r["label"]): r for r in matrix.build_matrix(counts, cfg).collect()}
    negative = rows[10, 0]
    assert negative["user_item_freq"] == 0 and negative["intent_score"] == 1.0
    assert negative["item_popularity"] == 0 and negative["cat_target_enc"] == 0.5
    positive = rows[11, 1]
    assert positive["intent_score"] == 1.0 and positive["cat_target_enc"] == 0.5


def test_popularity_ties_break_by_item(spark):
    events = [(1, i, 1, "pv", 1) for i in (9, 4, 6, 2)]
    raw = lake(spark, events)
    counts = history.day_counts(with_day(raw, day_index(raw)), "item_id", "category_id")
    top = candidates.popular_items(counts, 3).collect()
    assert [r["item_id"] for r in top] == [2, 4, 6]


@pytest.mark.parametrize("few", [1_000_000, 2])
def test_many_popular_items(spark, monkeypatch, few):
    """Also where the list is too long to be broadcast."""
    monkeypatch.setattr(candidates, "BROADCAST_ROWS", few)
    events = [(1, i, 0, "pv", d) for i in range(150) for d in (1, 4)]
    events = [e for e in events if not (e[4] == 4 and e[1] in (149, 70, 64, 63, 62, 0))]
    events += [(1, 500, 3, "buy", 4), (2, 501, 3, "buy", 4)]
    # day 4 is the second date that occurs
    splits = Splits(train=(2,), val=(7,), test=(8,), infer=(9,))
    cfg = FeatureConfig(top_popular=150, neg_ratio=5, splits=splits)
    raw = lake(spark, events)
    pairs = matrix.pair_counts(raw)
    popular = candidates.popular_items(pairs, cfg.top_popular)
    rows = candidates.sample_negatives(pairs, popular, cfg).collect()
    chosen = {u: sorted(r["item_id"] for r in rows if r["user_id"] == u) for u in (1, 2)}
    assert chosen == {1: [0, 62, 63, 64, 70], 2: [0, 1, 2, 3, 4]}
    every = candidates.unseen_popular(pairs, popular, cfg).collect()
    assert sorted(r["item_id"] for r in every if r["user_id"] == 1) == [0, 62, 63, 64, 70, 149]
    assert sorted(r["item_id"] for r in every if r["user_id"] == 2) == list(range(150))


@pytest.mark.parametrize(("top", "ratio"), [(1, 4), (20, 4), (1000, 0), (1000, 7), (50_000, 3)])
def test_negatives_equal_a_direct_search(spark, top, ratio):
    """Items in several categories, users who touched all of the list's head, lists of any length."""
    r = random.Random(top)
    events = [(u, r.randrange(40), r.randrange(2), r.choice(["pv", "buy"]), d)
              for u in range(12) for d in (1, 4, 5) for _ in range(r.randrange(30))]
    events += [(99, i, c, "buy", 4) for i in range(40) for c in (0, 1)]  # nothing unseen
    # days 4 and 5 are the second and third date that occur
    cfg = FeatureConfig(top_popular=top, neg_ratio=ratio, splits=Splits(train=(2, 3), val=(7,), test=(8,), infer=(9,)))
    raw = lake(spark, events)
    pairs = matrix.pair_counts(raw)
    popular = candidates.popular_items(pairs, top)
    menu = sorted((p["item_id"], p["category_id"]) for p in popular.collect())
    want = []
    for user, date in {(e[0], e[4]) for e in events if e[3] == "buy" and e[4] in (4, 5)}:
        touched = {e[1] for e in events if (e[0], e[4]) == (user, date)}
        want += [(user, i, c, date - 2) for i, c in [m for m in menu if m[0] not in touched][:ratio]]
    rows = candidates.sample_negatives(pairs, popular, cfg).collect()
    assert sorted((x["user_id"], x["item_id"], x["category_id"], x["day"]) for x in rows) == sorted(want)


def test_the_state_of_negatives_does_not_grow_with_the_list(spark):
    """One set per group however long the list: no column for each of its parts."""
    raw = lake(spark, random_events(10))
    pairs = matrix.pair_counts(raw)
    plans = []
    for top in (20, 50_000):
        cfg = FeatureConfig(top_popular=top)
        popular = candidates.popular_items(pairs, top)
        rows = candidates.sample_negatives(pairs, popular, cfg)
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString().count("collect_set"))
    assert plans[0] == plans[1] == 1


def test_negatives_are_never_touched_that_day(spark):
    events = random_events(10)
    raw = lake(spark, events)
    cfg = FeatureConfig()
    pairs = matrix.pair_counts(raw)
    rows = candidates.sample_negatives(
        pairs, candidates.popular_items(pairs, cfg.top_popular), cfg
    ).collect()
    touched = {(u, i, d) for u, i, _, _, d in events}
    assert not {(r["user_id"], r["item_id"], r["day"]) for r in rows} & touched
    per_user_day = {}
    for r in rows:
        per_user_day[r["user_id"], r["day"]] = per_user_day.get((r["user_id"], r["day"]), 0) + 1
    assert max(per_user_day.values()) <= cfg.neg_ratio


def test_job_writes_splits_and_reruns_to_the_same_result(spark, tmp_path):
    events = random_events(11)
    lake_root, out = str(tmp_path / "lake"), str(tmp_path / "out")
    assert write_raw_partitions(lake(spark, events), lake_root) == 9
    counts = run_features(spark, lake_root, out)
    first = collected(read_matrices(spark, out))
    assert counts["infer"] == len([r for r in first if r[5] == "infer"])
    assert counts["train_pos"] == len([r for r in first if r[5] == "train" and r[4] == 1])
    area = f"{scratch_root(spark)}/tidemark/{spark.sparkContext.applicationId}"
    before = subdirectories(spark, area)
    assert run_features(spark, lake_root, out) == counts
    assert subdirectories(spark, area) == before  # the job cleared its staged tables
    assert collected(read_matrices(spark, out)) == first
    assert read_split(spark, out, "val").dtypes == [
        (f.name, f.dataType.simpleString()) for f in MATRIX_SCHEMA
    ]
    for rows in (read_split(spark, out, "val"), read_matrices(spark, out).where("split = 'val'")):
        assert rows.inputFiles() and all("/split=val/" in f for f in rows.inputFiles())


def split_names(spark, root):
    return {r["split"] for r in read_matrices(spark, root).select("split").distinct().collect()}


def test_a_rerun_with_fewer_dates_leaves_no_stale_split(spark, tmp_path):
    lake_root, out = str(tmp_path / "lake"), tmp_path / "out"
    write_raw_partitions(lake(spark, random_events(12)), lake_root)
    whole = run_features(spark, lake_root, str(out))
    assert split_names(spark, str(out)) == {"train", "val", "test", "infer"} and whole["infer"] > 0
    short = str(tmp_path / "short")
    write_raw_partitions(lake(spark, [e for e in random_events(12) if e[4] <= 7]), short)
    counts = run_features(spark, short, str(out))
    assert split_names(spark, str(out)) == {"train", "val"}
    assert counts == split_counts(read_matrices(spark, str(out))).first().asDict()
    assert counts["test"] == counts["infer"] == 0 and counts["val"] == whole["val"]
    assert read_split(spark, str(out), "infer").count() == 0


def test_writes_own_their_splits(spark, tmp_path):
    lake_root, out = str(tmp_path / "lake"), tmp_path / "out"
    write_raw_partitions(lake(spark, random_events(13)), lake_root)
    run_features(spark, lake_root, str(out))
    rows = spark.createDataFrame(read_matrices(spark, str(out)).collect(), MATRIX_SCHEMA)
    other = str(tmp_path / "other")
    first = write_split_matrices(rows.where("split <> 'infer'"), other)
    assert set(first) == {"train", "val", "test"}
    kept = set(read_split(spark, other, "val").inputFiles())
    write_split_matrices(rows.where("split = 'infer'"), other)
    assert collected(read_matrices(spark, other)) == collected(rows)
    assert set(read_split(spark, other, "val").inputFiles()) == kept
    # an owned split without rows goes, the files of old versions too
    for _ in range(2):
        write_split_matrices(rows.where("split = 'val'"), other, owned=("val", "test"))
    assert split_names(spark, other) == {"train", "val", "infer"}
    assert len(list((tmp_path / "other" / "data").iterdir())) == 4
    with pytest.raises(ValueError, match="not owned: infer"):
        write_split_matrices(rows, other, owned=("train", "val", "test"))
    with pytest.raises(ValueError, match="in none of the splits"):
        write_split_matrices(rows.withColumn("split", F.lit("dev")), other)
    assert split_names(spark, other) == {"train", "val", "infer"}
    assert len(list((tmp_path / "other" / "data").iterdir())) == 4


def test_bad_parameters_are_refused():
    with pytest.raises(ValueError):
        Splits(train=(4, 5), val=(5,))
    with pytest.raises(ValueError):
        FeatureConfig(top_popular=0)
    with pytest.raises(ValueError):
        FeatureConfig(neg_ratio=-1)
