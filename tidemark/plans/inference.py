"""Daily scoring: newest model and scoring split to the result table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from tidemark.config import TOP_K
from tidemark.operators.model import score
from tidemark.operators.ranking import recommendation_lists, top_k
from tidemark.operators.trees import read_forest
from tidemark.session import sized_for
from tidemark.sources.matrices import read_split
from tidemark.sources.results import ResultTable
from tidemark.sources.runs import RunRegistry


def recommend(scored: DataFrame, table: ResultTable, k: int = TOP_K, stamped: Column | None = None) -> int:
    """Rank, nest and upsert scored rows; returns the number of users written."""
    with sized_for(scored):
        return table.upsert(recommendation_lists(top_k(scored, k)), stamped)


def run_inference(
    spark: SparkSession,
    matrix_root: str,
    registry_root: str,
    results_root: str,
    k: int = TOP_K,
) -> dict:
    registry = RunRegistry(spark, registry_root)
    run_id = registry.latest_run_id()
    forest = read_forest(spark, registry.model_path(run_id))
    scored = score(forest, read_split(spark, matrix_root, "infer"))
    users = recommend(scored, ResultTable(spark, results_root), k)
    return {"run_id": run_id, "users": users, "persisted": users}
