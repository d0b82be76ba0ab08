"""Training: labelled splits to a model, its test metrics and a run record."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.config import TrainConfig
from tidemark.operators.metrics import training_report
from tidemark.operators.model import score, train_gbt
from tidemark.operators.trees import write_forest
from tidemark.session import stage, staged_tables
from tidemark.sources.matrices import read_matrices, read_split
from tidemark.sources.runs import FAILED, FINISHED, RunRegistry


def run_training(
    spark: SparkSession, matrix_root: str, registry_root: str, cfg: TrainConfig = TrainConfig()
) -> dict:
    registry = RunRegistry(spark, registry_root)
    run_id, started = registry.new_run()
    try:
        with staged_tables(spark):
            forest, _ = train_gbt(
                read_split(spark, matrix_root, "train"), read_split(spark, matrix_root, "val"), cfg
            )
            write_forest(spark, forest, registry.model_path(run_id))
            test = score(forest, read_split(spark, matrix_root, "test"))
            scored = stage(test.select("label", "score"), "scored")
            report = training_report(scored, read_matrices(spark, matrix_root)).first().asDict()
        metrics = {k: v for k, v in report.items() if k.startswith("test_")}
        wide = spark.createDataFrame(
            [tuple(metrics.values())], ", ".join(f"{k} double" for k in metrics)
        )
        registry.log_metrics(run_id, wide)
    except Exception:
        registry.record(run_id, started, FAILED)
        raise
    registry.record(run_id, started, FINISHED)
    return {"run_id": run_id, **report}
