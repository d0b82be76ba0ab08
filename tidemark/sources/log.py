"""The raw interaction log (CSV) and the lake it is written to (Parquet by date)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.ingest import LOG_COLS

LOG_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("item_id", T.LongType()),
        T.StructField("category_id", T.LongType()),
        T.StructField("behavior_type", T.StringType()),
        T.StructField("timestamp", T.LongType()),
    ]
)

LAKE_SCHEMA = T.StructType(LOG_SCHEMA.fields + [T.StructField("event_date", T.DateType())])


def read_csv_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The headerless log with declared types; a malformed row fails the job."""
    return spark.read.schema(LOG_SCHEMA).option("mode", "FAILFAST").csv(path, header=False)


def read_csv_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Several files (or folders) of the log as one relation; ``file`` says where a row comes from.

    A path that is given twice is refused. Files that hold the same rows under two names are found by
    ``refuse_repeated_files``.
    """
    names = [path.rstrip("/") for path in paths]
    if twice := sorted({n for n in names if names.count(n) > 1}):
        raise ValueError(f"given twice: {', '.join(twice)}")
    return read_csv_log(spark, names).select(*LOG_COLS, F.col("_metadata.file_path").alias("file"))


def file_accounts(rows: DataFrame) -> DataFrame:
    """Rows, first and last time of each file, and a digest of its rows in any order."""
    return rows.groupBy("file").agg(
        F.count("*").alias("rows"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
        F.bit_xor(F.xxhash64(*LOG_COLS)).alias("odd"),
        F.sum(F.xxhash64(*LOG_COLS).cast("decimal(38,0)")).alias("sum"),
    )


def refuse_repeated_files(accounts: DataFrame) -> None:
    """Raise if two files hold the same rows: one of them is a copy, and its events would count twice."""
    same = ["rows", "first", "last", "odd", "sum"]
    repeated = (
        accounts.groupBy(*same)
        .agg(F.sort_array(F.collect_list("file")).alias("files"))
        .where(F.size("files") > 1)
        .first()
    )
    if repeated is not None:
        raise ValueError(f"files with the same rows: {', '.join(repeated['files'])}")


def write_raw_partitions(events: DataFrame, root: str) -> int:
    """Replace the lake at ``root``, partitioned by date; returns the number of files.

    Rebalancing by date gives one file for a small date and several of the advisory size
    for a large one, so no task has to write a whole date.
    """
    (
        events.hint("rebalance", F.col("event_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("event_date")
        .parquet(root)
    )
    # the length of the array on the JVM side: the names themselves stay there
    return len(read_raw_events(events.sparkSession, root)._jdf.inputFiles())


def read_raw_events(spark: SparkSession, root: str) -> DataFrame:
    """The lake with the date taken from the directory names."""
    return spark.read.schema(LAKE_SCHEMA).parquet(root).select(*LOG_COLS, "event_date")
