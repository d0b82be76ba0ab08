"""What several operators of this package share."""

from __future__ import annotations

import ctypes
import sys
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

# A table of counters travels in this many slices; as many tables are added up at a time.
SLICES = 64
FAN_IN = 32

# Entries a per-task word cache holds before it starts again; bounds a task's memory.
CACHE_WORDS = 1 << 17

# Rows of whole texts that a worker is handed at a time: Spark holds them outside its heap, beside the worker.
TEXT_ROWS = 1024

# Fixed value: what separates words, in the syntax of Java's and RE2's patterns.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions_for(df: DataFrame, bytes_each: int) -> int:
    """Partitions that hold about ``bytes_each`` of the input, at least the shuffle setting."""
    from tidemark.session import input_bytes

    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(least, -(-input_bytes(df) // bytes_each))


@contextmanager
def arrow_batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most so many rows for what runs inside: for rows that are large themselves."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def give_back() -> None:
    """Memory that a task no longer uses, back to the system: an idle worker would keep it beside the next."""
    pa.default_memory_pool().release_unused()
    if sys.platform == "linux":
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
        if trim is not None:
            trim(0)


class WordHashes(dict):
    """64-bit hashes of words (bytes), remembered while there is room."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def array(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit changes about half of the output bits."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the ``k``-word shingles; of the whole sequence when it has fewer words."""
    n = len(words)
    if n == 0:
        return words
    width = min(k, n)
    acc = mix(words[: n - width + 1] + np.uint64(width))
    for j in range(1, width):
        acc = mix(acc + words[j : n - width + 1 + j])
    return acc


def text_rows(batch: pa.RecordBatch, key: str, text: str, step: int = 256) -> Iterator:
    """(key, UTF-8 bytes) pairs of a batch; null texts are empty. Few rows are unpacked at once."""
    keys = batch.column(batch.schema.get_field_index(key))
    texts = batch.column(batch.schema.get_field_index(text)).cast(pa.binary())
    for start in range(0, batch.num_rows, step):
        rows = zip(keys.slice(start, step).to_pylist(), texts.slice(start, step).to_pylist())
        for k, t in rows:
            yield k, t or b""


def _add_up(tables: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(c, np.int64) for c in tables["counts"].to_pylist())
    return pa.table(
        {
            "slice": tables["slice"][:1],
            "part": pa.array([tables["part"][0].as_py() // FAN_IN], pa.int32()),
            "counts": pa.array([total.tobytes()], pa.binary()),
        }
    )


def count_table(
    rows: DataFrame, count: Callable[[Iterator[pa.RecordBatch]], np.ndarray], cells: int
) -> np.ndarray:
    """The sum over all tasks of the ``cells`` counters that ``count`` makes of a task's rows.

    The size of the table is fixed beforehand, so it may come to the driver. Tables are added up
    in groups of ``FAN_IN``: no task holds more than that many slices of one.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = count(batches).reshape(SLICES, -1)
        yield pa.RecordBatch.from_pydict(
            {
                "slice": pa.array(range(SLICES), pa.int32()),
                "part": pa.array([TaskContext.get().partitionId()] * SLICES, pa.int32()),
                "counts": pa.array([s.tobytes() for s in slices], pa.binary()),
            }
        )
        give_back()

    schema = "slice int, part int, counts binary"
    parts = max(1, rows.rdd.getNumPartitions())
    tables = rows.mapInArrow(emit, schema)
    while True:
        group = F.floor(F.col("part") / FAN_IN).cast("int").alias("group")
        tables = tables.groupBy("slice", group).applyInArrow(_add_up, schema)
        parts = -(-parts // FAN_IN)
        if parts == 1:
            break
    with arrow_batches_of(rows.sparkSession, TEXT_ROWS):
        found = {r["slice"]: r["counts"] for r in tables.collect()}
    if not found:
        return np.zeros(cells, np.int64)
    return np.concatenate([np.frombuffer(found[s], np.int64) for s in range(SLICES)])


def clear_name(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, whatever its case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(text: str) -> F.Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def let(value: F.Column, body: Callable[[F.Column], F.Column]) -> F.Column:
    """``body`` of a value that is computed once, even where a lambda inside uses it again."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
