"""Features: lake to split matrices."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tidemark.config import FeatureConfig
from tidemark.operators.matrix import build_matrix, stage_day_counts
from tidemark.session import sized_for, staged_tables
from tidemark.sources.log import read_raw_events
from tidemark.sources.matrices import SPLITS, write_split_matrices, written_counts


def run_features(
    spark: SparkSession, lake_root: str, matrix_root: str, cfg: FeatureConfig = FeatureConfig()
) -> dict[str, int]:
    """Write all four splits in one pass over the day counts; returns the row counts.

    The run owns the root: splits of an earlier run that this one has no rows of are gone after it.
    """
    raw = read_raw_events(spark, lake_root)
    with staged_tables(spark), sized_for(raw):
        counts = stage_day_counts(raw)
        write_split_matrices(build_matrix(counts, cfg), matrix_root, owned=SPLITS)
    return written_counts(spark, matrix_root)
