"""Every registered query against its SQL, row by row."""

import os

import pytest

import __spark_entry__ as registry
from compare import check, duck
from tidemark.registry.oracles import ORACLES
from tidemark.registry.queries import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")

ROWS_ONLY = sorted(set(QUERIES) - set(ORACLES))


@pytest.fixture(scope="module")
def con():
    connection = duck(SF_DIR)
    yield connection
    connection.close()


def test_each_oracle_has_a_query():
    assert set(registry.oracle_sql()) <= set(registry.queries())


def test_only_the_trained_model_has_no_sql():
    assert ROWS_ONLY == ["recommend_trained_daily", "score_candidates", "train_gbt"]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    rows = check(registry.queries()[name](spark, SF_DIR), con, ORACLES[name])
    assert rows > 0


def test_train_gbt_stops_early_at_its_best_round(spark):
    rows = registry.queries()["train_gbt"](spark, SF_DIR).orderBy("round").collect()
    losses = [r["validation_loss"] for r in rows]
    chosen = [r["round"] for r in rows if r["chosen"]]
    assert chosen == [losses.index(min(losses[: chosen[0] + 10])) + 1]


def test_score_candidates_gives_probabilities(spark):
    scored = registry.queries()["score_candidates"](spark, SF_DIR)
    expected = registry.queries()["inference_matrix"](spark, SF_DIR).count()
    rows = [r["score"] for r in scored.select("score").collect()]
    assert len(rows) == expected
    assert all(0.0 <= s <= 1.0 for s in rows)


def test_recommend_trained_daily_ranks_the_scored_rows(spark):
    """At most ten lines a user, by falling score, all of them scored candidates."""
    scored = registry.queries()["score_candidates"](spark, SF_DIR)
    scores = {(r["user_id"], r["item_id"]): r["score"] for r in scored.collect()}
    rows = registry.queries()["recommend_trained_daily"](spark, SF_DIR).collect()
    users = {}
    for r in sorted(rows, key=lambda r: (r["user_id"], r["rank"])):
        assert scores[r["user_id"], r["item_id"]] == r["score"]
        users.setdefault(r["user_id"], []).append((-r["score"], r["item_id"]))
    assert set(users) == {u for u, _ in scores}
    assert all(u == sorted(u) and len(u) <= 10 for u in users.values())


def test_entry_runs_with_the_matrix_schema(spark):
    df = registry.entry(spark)
    assert df.count() > 0
    assert df.columns[:7] == [
        "user_id", "item_id", "category_id", "day", "event_date", "label", "split"
    ]
