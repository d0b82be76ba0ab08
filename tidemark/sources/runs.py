"""Training runs and their metrics, as append-only tables."""

from __future__ import annotations

import uuid
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import NEWEST_RUNS
from tidemark.operators.metrics import long_form
from tidemark.sources.storage import exists

RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("start_time", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)

METRIC_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("key", T.StringType()),
        T.StructField("value", T.DoubleType()),
    ]
)

FINISHED = "FINISHED"
FAILED = "FAILED"


def latest_finished_run(runs: DataFrame, newest: int = NEWEST_RUNS) -> DataFrame:
    """The newest finished run among the ``newest`` latest ones, so possibly none.

    The cut comes before the status filter: an older finished run behind ``newest``
    unfinished ones is not found.
    """
    order = (F.desc("start_time"), F.desc("run_id"))
    recent = runs.orderBy(*order).limit(newest)
    return recent.where(F.col("status") == FINISHED).orderBy(*order).limit(1)


class RunRegistry:
    """Runs, metrics and models below one root."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def new_run(self) -> tuple[str, datetime]:
        return uuid.uuid4().hex, datetime.now(timezone.utc)

    def model_path(self, run_id: str) -> str:
        return f"{self.root}/models/{run_id}"

    def record(self, run_id: str, started: datetime, status: str) -> None:
        row = self.spark.createDataFrame([(run_id, started, status)], RUN_SCHEMA)
        row.coalesce(1).write.mode("append").parquet(f"{self.root}/runs")

    def log_metrics(self, run_id: str, metrics: DataFrame) -> None:
        """Append one wide row of metrics in long form."""
        long_form(metrics, run_id).coalesce(1).write.mode("append").parquet(
            f"{self.root}/run_metrics"
        )

    def runs(self) -> DataFrame:
        return self._read("runs", RUN_SCHEMA)

    def metrics(self) -> DataFrame:
        return self._read("run_metrics", METRIC_SCHEMA)

    def _read(self, name: str, schema: T.StructType) -> DataFrame:
        path = f"{self.root}/{name}"
        if not exists(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def latest_run_id(self) -> str:
        found = latest_finished_run(self.runs()).first()
        if found is None:
            raise RuntimeError(f"no finished run among the newest at {self.root}")
        return found["run_id"]
