"""Tables in key order: range-partitioned files, and a manifest of their ranges in order.

Reading back in order needs no shuffle and no sort, a range of keys opens only the files it can be in,
and the place of a row in the whole order is its file's first place plus its row number in the file.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import input_bytes
from tidemark.sources.manifest import Manifests
from tidemark.sources.storage import delete

# Input bytes for each file. A whole read has a branch of the plan per file; page through very many.
FILE_BYTES = 256 << 20

KEEP = 2


def _files(content: dict) -> list[str]:
    return [f["file"] for f in content["files"]]


def write_ordered(rows: DataFrame, root: str, keys: Sequence[str], files: int | None = None) -> int:
    """Replace the table at ``root`` by ``rows`` in the order of ``keys``; returns its number of files.

    Rows with equal keys stay in one file: give further keys where one value has a large share. Nulls
    come first. Equal keys of two files do not occur.
    """
    keys, spark = list(keys), rows.sparkSession
    manifests = Manifests(spark, root)
    version = (manifests.latest() or (-1, None))[0]
    folder = f"data/{uuid.uuid4().hex}"
    path = f"{manifests.root}/{folder}"
    parts = files or max(1, -(-input_bytes(rows) // FILE_BYTES))
    rows.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).write.parquet(path)
    try:
        # the key columns of what was written: one row for each file
        first = F.struct(*keys)
        ranges = (
            spark.read.schema(rows.schema).parquet(path)
            .select(F.col("_metadata.file_name").alias("file"), first.alias("key"))
            .groupBy("file")
            .agg(F.min("key").alias("low"), F.max("key").alias("high"), F.count("*").alias("rows"))
            .orderBy("low")
            .select("file", F.to_json("low").alias("low"), F.to_json("high").alias("high"), "rows")
        ).collect()
        content = {
            "schema": rows.schema.json(),
            "keys": keys,
            "files": [{**r.asDict(), "file": f"{folder}/{r['file']}"} for r in ranges],
        }
        manifests.commit(version + 1, content)
    except Exception:
        delete(spark, path)
        raise
    manifests.drop_old(KEEP, _files)
    return len(ranges)


def _content(spark: SparkSession, root: str) -> dict:
    found = Manifests(spark, root).latest()
    if found is None:
        raise RuntimeError(f"no ordered table at {root}")
    return found[1]


def ordered_pages(spark: SparkSession, root: str, place: str | None = None) -> Iterator[DataFrame]:
    """The files in order, each a frame whose rows are in order."""
    content = _content(spark, root)
    schema, before = T.StructType.fromJson(json.loads(content["schema"])), 0
    for entry in content["files"]:
        rows = spark.read.schema(schema).parquet(f"{root.rstrip('/')}/{entry['file']}")
        if place is not None:
            at = F.col("_metadata.row_index") + F.lit(before + 1).cast("long")
            rows = rows.select(*schema.names, at.alias(place))
        before += entry["rows"]
        yield rows


def read_ordered(spark: SparkSession, root: str, place: str | None = None) -> DataFrame:
    """All rows in order: partitions follow each other as their keys do.

    With ``place`` a column of that name numbers the rows from 1.
    """
    pages = list(ordered_pages(spark, root, place))
    if pages:
        return reduce(DataFrame.unionAll, pages)
    schema = T.StructType.fromJson(json.loads(_content(spark, root)["schema"]))
    return spark.createDataFrame([], schema.add(place, T.LongType()) if place else schema)


def read_range(spark: SparkSession, root: str, low, high) -> DataFrame:
    """The rows whose first key is from ``low`` to ``high``, in order, from the files they can be in."""
    content = _content(spark, root)
    key, schema = content["keys"][0], T.StructType.fromJson(json.loads(content["schema"]))

    def meets(entry: dict) -> bool:
        first, last = (json.loads(entry[end]).get(key) for end in ("low", "high"))
        return last is not None and last >= low and (first is None or first <= high)

    paths = [f"{root.rstrip('/')}/{e['file']}" for e in content["files"] if meets(e)]
    pages = [spark.read.schema(schema).parquet(p).where(F.col(key).between(low, high)) for p in paths]
    return reduce(DataFrame.unionAll, pages) if pages else spark.createDataFrame([], schema)
