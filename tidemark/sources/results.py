"""The result table: one nested recommendation list per user, upserted in batches.

Users are hashed to a fixed number of buckets, each a file sorted by user. A manifest names the files of
a version. An upsert reads and writes the buckets of its batch only and takes all other files over by
name; a lookup opens the one file its user can be in.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.recommendations import ITEM_LIST
from tidemark.operators.skew import hot_keys, skew_join
from tidemark.session import scratch_path
from tidemark.sources.manifest import ConcurrentWriteError, Manifests
from tidemark.sources.storage import data_files, delete

# Buckets of a new table: at some 200 bytes a user 64 of them hold a hundred million users in files
# of 300 MB. Give more for more users.
BUCKETS = 64

RESULT_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType(), False),
        T.StructField("recommended_items", ITEM_LIST, False),
        T.StructField("updated_at", T.TimestampType()),
    ]
)


def repeated_keys(batch: DataFrame) -> DataFrame:
    """Users that break the key of the table: more than one row, or null."""
    counted = batch.groupBy("user_id").agg(F.count("*").alias("n"))
    return counted.where((F.col("n") > 1) | F.col("user_id").isNull())


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int")


def merge_results(existing: DataFrame, batch: DataFrame, buckets: int, tasks: int) -> DataFrame:
    """Users of the batch take its list and time stamp, all others stay as they are.

    Both sides have the columns of the table; ``bucket`` is added. One shuffle by bucket brings a
    user's rows together and deals the files out, each to one task. A user who is in the batch twice
    fails the job.
    """
    value = F.struct("recommended_items", "updated_at")
    rows = existing.withColumn("new", F.lit(0)).unionByName(batch.withColumn("new", F.lit(1)))
    repeated = F.concat(F.lit("user_id is not unique: "), F.col("user_id").cast("string"))
    return (
        rows.withColumn("bucket", bucket_of(buckets))
        .repartition(tasks, "bucket")
        .groupBy("bucket", "user_id")
        .agg(F.max_by(value, "new").alias("value"), F.sum("new").alias("times"))
        .select(
            F.when(F.col("times") > 1, F.raise_error(repeated).cast("long"))
            .otherwise(F.col("user_id"))
            .alias("user_id"),
            "value.recommended_items",
            "value.updated_at",
            "bucket",
        )
        .sortWithinPartitions("bucket", "user_id")
    )


def lookup_recommendations(results: DataFrame, requests: DataFrame) -> DataFrame:
    """The list of every requested user; ``found`` is false for an unknown one.

    Requests may repeat a user any number of times, so hot users are split.
    """
    counted = requests.groupBy("user_id").agg(F.count("*").alias("n"))
    known = results.select("user_id", "recommended_items", F.lit(True).alias("hit"))
    joined = skew_join(
        requests, known, ["user_id"], "left", hot_keys(counted, ["user_id"], "n", requests.count())
    )
    return joined.withColumn("found", F.coalesce("hit", F.lit(False))).drop("hit")


def _files(content: dict) -> list[str]:
    return [f for files in content["files"].values() for f in files]


class ResultTable:
    """The table below one root; ``user_id`` is its unique key, and nothing but the stamp may be null.

    A version counts once its manifest is committed, so a failed, repeated or refused write never
    touches what is being read. The ``keep`` newest versions stay for readers that have them open.
    Writers may run side by side: the second to commit is refused with ``ConcurrentWriteError`` and
    leaves nothing behind; see ``Manifests`` on the file systems that this holds for.
    """

    def __init__(self, spark: SparkSession, root: str, keep: int = 3, buckets: int = BUCKETS):
        """``buckets`` counts for a table that does not exist yet."""
        if keep < 1:
            raise ValueError("keep must be at least 1")
        if buckets < 1:
            raise ValueError("buckets must be at least 1")
        self.spark = spark
        self.root = root.rstrip("/")
        self.keep = keep
        self.buckets = buckets
        self._manifests = Manifests(spark, self.root)

    def versions(self) -> list[int]:
        return self._manifests.versions()

    def _latest(self) -> tuple[int, dict]:
        found = self._manifests.latest()
        if found is None:
            raise RuntimeError(f"no result table at {self.root}")
        return found

    def _scan(self, files: list[str]) -> DataFrame:
        if not files:
            return self.spark.createDataFrame([], RESULT_SCHEMA)
        return self.spark.read.schema(RESULT_SCHEMA).parquet(*(f"{self.root}/{f}" for f in files))

    def create(self) -> None:
        """Declare the table; does nothing when it is there already."""
        if not self.versions():
            try:
                self._manifests.commit(0, {"buckets": self.buckets, "files": {}})
            except ConcurrentWriteError:
                pass  # declared by another writer in between

    def read(self) -> DataFrame:
        return self._scan(sorted(_files(self._latest()[1])))

    def bucket_files(self) -> dict[int, list[str]]:
        """The files of each bucket that has any, relative to the root."""
        return {int(b): files for b, files in self._latest()[1]["files"].items()}

    def find(self, user_id: int) -> DataFrame:
        """The row of one user, or none: a scan of the one file it can be in, pruned by its key."""
        content = self._latest()[1]
        key = F.lit(user_id).cast("long")
        # a constant is evaluated by the planner, without a job
        bucket = self.spark.sql("SELECT 1").select(key.alias("user_id")).select(bucket_of(content["buckets"])).first()[0]
        return self._scan(content["files"].get(str(bucket), [])).where(F.col("user_id") == key)

    def lookup(self, user_id: int) -> Row | None:
        return self.find(user_id).first()

    def upsert(self, batch: DataFrame, stamped: Column | None = None) -> int:
        """Commit the merge of the table and ``batch`` as the next version; returns the batch's rows."""
        self.create()
        version, content = self._latest()
        staged, rows, touched = self._staged(batch, stamped, content["buckets"])
        folder = f"data/{uuid.uuid4().hex}"
        try:
            written = self._merged(staged, content, touched, folder)
            files = {b: f for b, f in content["files"].items() if int(b) not in touched}
            self._manifests.commit(version + 1, {"buckets": content["buckets"], "files": {**files, **written}})
        except Exception:
            delete(self.spark, f"{self.root}/{folder}")
            raise
        finally:
            delete(self.spark, staged)
        self._manifests.drop_old(self.keep, _files)
        return rows

    def _staged(self, batch: DataFrame, stamped: Column | None, buckets: int) -> tuple[str, int, set[int]]:
        """The checked batch as a scratch table, its rows, and the buckets that it touches."""
        at = F.current_timestamp() if stamped is None else stamped
        checked = batch.select(
            F.coalesce("user_id", F.raise_error(F.lit("user_id is null"))).alias("user_id"),
            F.coalesce(
                "recommended_items", F.raise_error(F.lit("recommended_items is null"))
            ).alias("recommended_items"),
            at.alias("updated_at"),
        )
        path = scratch_path(self.spark, "batch")
        checked.write.parquet(path)
        # one row for each bucket at most
        counted = self._read_staged(path).groupBy(bucket_of(buckets).alias("b")).agg(F.count("*").alias("n"))
        found = counted.collect()
        return path, sum(r["n"] for r in found), {r["b"] for r in found}

    def _read_staged(self, path: str) -> DataFrame:
        return self.spark.read.schema(RESULT_SCHEMA).parquet(path)

    def _merged(self, staged: str, content: dict, touched: set[int], folder: str) -> dict[str, list[str]]:
        """Write the touched buckets anew; their files by bucket."""
        if not touched:
            return {}
        old = self._scan([f for b in touched for f in content["files"].get(str(b), [])])
        # a task may write several buckets, one after the other
        tasks = min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        merged = merge_results(old, self._read_staged(staged), content["buckets"], tasks)
        merged.write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        out: dict[str, list[str]] = {}
        for name in data_files(self.spark, f"{self.root}/{folder}"):
            out.setdefault(name.split("/")[0].split("=")[1], []).append(f"{folder}/{name}")
        return out
