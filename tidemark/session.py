"""Session set-up and the shared scratch area for tables written between stages."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.storage import delete

# Input bytes per shuffle partition, and the most partitions a job asks for: beyond that the
# number of map-reduce blocks costs more than larger, spilling partitions do. A row of a log takes
# some ten bytes in Parquet and a hundred in a sort: 16 MB are about as many rows as one sort holds.
SHUFFLE_BYTES = 16 << 20
MAX_SHUFFLE_PARTITIONS = 50_000
MAX_SHUFFLE_SETTING = "spark.tidemark.maxShufflePartitions"

_staged: ContextVar[list[str] | None] = ContextVar("staged", default=None)


def local_session(
    cores: int | str = "*", shuffle_partitions: int = 8, options: dict[str, str] | None = None
) -> SparkSession:
    """A single-machine session for tests and the bench; a cluster brings its own."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": str(shuffle_partitions),
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": os.environ.get("TIDEMARK_DRIVER_MEMORY", "12g"),
        # list a few hundred lake directories on the driver rather than in a job
        "spark.sql.sources.parallelPartitionDiscovery.threshold": "512",
        # a session runs more distinct stages than the 100 whose code is kept by default
        "spark.sql.codegen.cache.maxEntries": "2000",
        # no Python call site for every column expression: halves the time to build a plan
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **(options or {}),
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tidemark")
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder the cluster shares for checkpoints, from ``spark.checkpoint.dir``.

    Only a local master may go without the setting; it then gets a temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    root = tempfile.mkdtemp(prefix="tidemark-")
    spark.sparkContext.setCheckpointDir(root)
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path nobody has written to yet."""
    app = spark.sparkContext.applicationId
    return f"{scratch_root(spark)}/tidemark/{app}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a scratch table and return the scan over it.

    For frames that several branches read: the work is done once, the lineage is cut,
    and a lost executor costs a re-read instead of a recompute. Unlike a cached frame
    the table keeps column pruning, filter pushdown and a known size for join planning.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    if (staged := _staged.get()) is not None:
        staged.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Delete the tables staged inside at the end, for jobs that return no frame over them."""
    paths: list[str] = []
    token = _staged.set(paths)
    try:
        yield
    finally:
        _staged.reset(token)
        for path in paths:
            delete(spark, path)


def input_bytes(df: DataFrame) -> int:
    """Size of the files ``df`` reads, from the statistics of the leaves of its plan."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = (int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    # a leaf without statistics reports the largest long
    return sum(size for size in sizes if size < 1 << 60)


@contextmanager
def sized_for(df: DataFrame) -> Iterator[None]:
    """Planner settings for a job that reads ``df``, put back at the end.

    The number of shuffle partitions rises to fit the input and never falls: the adaptive
    planner merges partitions that turn out small, but cannot make more. Where it rose, partitions are
    not merged below that number: the advisory size is of compressed blocks, of which a sort makes
    fifteen times as many bytes, and two sorts of one task are held at a time. And a join whose
    smaller side measures no more than the advisory size in every partition is hashed, so
    that the large side need not be sorted; beyond that size it is a sort-merge join.
    """
    conf = df.sparkSession.conf
    shuffles = "spark.sql.shuffle.partitions"
    most = int(conf.get(MAX_SHUFFLE_SETTING, str(MAX_SHUFFLE_PARTITIONS)))
    wanted = min(-(-input_bytes(df) // SHUFFLE_BYTES), most)
    merged = "spark.sql.adaptive.coalescePartitions.minPartitionNum"
    least = int(conf.get(merged, None) or df.sparkSession.sparkContext.defaultParallelism)
    settings = {
        shuffles: str(max(int(conf.get(shuffles)), wanted)),
        merged: str(max(least, wanted)),
        "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": conf.get(
            "spark.sql.adaptive.advisoryPartitionSizeInBytes"
        ),
    }
    with settings_of(df.sparkSession, settings):
        yield


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Those settings for what runs inside, put back at the end."""
    conf = spark.conf
    before = {key: conf.get(key, None) for key in settings}
    for key, value in settings.items():
        conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            conf.unset(key) if value is None else conf.set(key, value)
