"""Ingest: log to lake."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.config import IngestConfig
from tidemark.operators.ingest import LOG_COLS, dated, in_window, keep_qualified, qualified_users
from tidemark.session import sized_for, stage, staged_tables
from tidemark.sources.log import file_accounts, refuse_repeated_files, write_raw_partitions


@dataclass(frozen=True)
class Ingested:
    """The dated events of the qualified users, those users with their counts, and how many."""

    events: DataFrame
    qualified: DataFrame
    users: int
    rows: int


def ingest(log: DataFrame, cfg: IngestConfig) -> Ingested:
    """Read the log once: what is in the window is written down, and all else comes from that table.

    A log with a ``file`` column (``read_csv_files``) is refused when two files hold the same rows.
    """
    window = stage(in_window(log, cfg), "window")
    if "file" in log.columns:
        refuse_repeated_files(file_accounts(window))
    # counted on their way into the table, after the last shuffle
    seen = Observation()
    counts = F.count("*").alias("users"), F.coalesce(F.sum("n"), F.lit(0)).alias("rows")
    qualified = stage(qualified_users(window, cfg).observe(seen, *counts), "qualified")
    users, rows = seen.get["users"], seen.get["rows"]
    kept = keep_qualified(window.select(*LOG_COLS), qualified, cfg, rows=rows)
    return Ingested(dated(kept, cfg), qualified, users, rows)


def run_bootstrap(log: DataFrame, lake_root: str, cfg: IngestConfig = IngestConfig()) -> dict[str, int]:
    """Write the lake. The log itself, text as a rule, is read once."""
    with staged_tables(log.sparkSession), sized_for(log):
        found = ingest(log, cfg)
        files = write_raw_partitions(found.events, lake_root)
        return {"qualified_users": found.users, "parquet_files": files}
