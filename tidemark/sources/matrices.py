"""Feature matrices, Parquet partitioned by split.

Each write makes new files, and a manifest says which folder a split's rows are in and how many they
are. Splits that a write owns are replaced or, where it has no rows for them, removed; the others keep
their files. Readers see the matrices before or after a write.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.config import MATRIX_COLS, Splits
from tidemark.sources.manifest import Manifests
from tidemark.sources.storage import delete

# The splits there can be.
SPLITS = tuple(Splits().as_dict())

# Versions whose files stay for readers that have them open.
KEEP = 2

_TYPES = {
    "event_date": T.DateType(),
    "label": T.IntegerType(),
    "split": T.StringType(),
    "intent_score": T.DoubleType(),
    "cat_target_enc": T.DoubleType(),
}

MATRIX_SCHEMA = T.StructType(
    [T.StructField(c, _TYPES.get(c, T.LongType())) for c in MATRIX_COLS]
)


def _folders(content: dict) -> list[str]:
    return [split["folder"] for split in content["splits"].values()]


def _counts() -> list:
    out = [F.count_if(~F.coalesce(F.col("split").isin(*SPLITS), F.lit(False))).alias("other")]
    for split in SPLITS:
        mine = F.col("split") == split
        out.append(F.count_if(mine).alias(f"{split}_rows"))
        out.append(F.count_if(mine & (F.col("label") == 1)).alias(f"{split}_pos"))
        out.append(F.count_if(mine & (F.col("label") == 0)).alias(f"{split}_neg"))
    return out


def write_split_matrices(
    matrix: DataFrame, root: str, owned: Iterable[str] | None = None
) -> dict[str, dict[str, int]]:
    """Replace the splits in ``owned`` by the rows of ``matrix``; returns the counts of each split written.

    By default the write owns the splits that ``matrix`` has rows of. The counts are taken from the rows
    on their way into the files, after the last shuffle, so that no second scan is needed and a repeated
    task counts once.
    """
    spark = matrix.sparkSession
    manifests = Manifests(spark, root)
    version, before = manifests.latest() or (-1, {"splits": {}})
    folder, seen = f"data/{uuid.uuid4().hex}", Observation()
    rows = matrix.select(*MATRIX_COLS).hint("rebalance", F.col("split"))
    rows.observe(seen, *_counts()).write.partitionBy("split").parquet(f"{manifests.root}/{folder}")
    found = seen.get
    try:
        if found["other"]:
            raise ValueError(f"{found['other']} rows are in none of the splits {', '.join(SPLITS)}")
        written = {
            split: {
                "folder": f"{folder}/split={split}",
                **{kind: found[f"{split}_{kind}"] for kind in ("rows", "pos", "neg")},
            }
            for split in SPLITS
            if found[f"{split}_rows"]
        }
        mine = set(written) if owned is None else set(owned)
        if strange := set(written) - mine:
            raise ValueError(f"rows of splits that are not owned: {', '.join(sorted(strange))}")
        kept = {split: entry for split, entry in before["splits"].items() if split not in mine}
        manifests.commit(version + 1, {"splits": {**kept, **written}})
    except Exception:
        delete(spark, f"{manifests.root}/{folder}")
        raise
    manifests.drop_old(KEEP, _folders)
    return {split: {k: v for k, v in entry.items() if k != "folder"} for split, entry in written.items()}


def _splits(spark: SparkSession, root: str) -> dict[str, dict]:
    found = Manifests(spark, root).latest()
    if found is None:
        raise RuntimeError(f"no matrices at {root}")
    return found[1]["splits"]


def written_counts(spark: SparkSession, root: str) -> dict[str, int]:
    """The five counts of a feature run as its writes recorded them; no data is read."""
    splits = _splits(spark, root)
    train = splits.get("train", {})
    rest = {split: splits.get(split, {}).get("rows", 0) for split in SPLITS[1:]}
    return {"train_pos": train.get("pos", 0), "train_neg": train.get("neg", 0), **rest}


def _read(spark: SparkSession, root: str, split: str, entry: dict) -> DataFrame:
    stored = T.StructType([f for f in MATRIX_SCHEMA.fields if f.name != "split"])
    rows = spark.read.schema(stored).parquet(f"{root.rstrip('/')}/{entry['folder']}")
    return rows.withColumn("split", F.lit(split)).select(*MATRIX_COLS)


def read_split(spark: SparkSession, root: str, split: str) -> DataFrame:
    """One split; only its files are opened. Empty when it has no rows."""
    entry = _splits(spark, root).get(split)
    return spark.createDataFrame([], MATRIX_SCHEMA) if entry is None else _read(spark, root, split, entry)


def read_matrices(spark: SparkSession, root: str) -> DataFrame:
    """All splits; a filter on ``split`` leaves out the others' files."""
    parts = [_read(spark, root, split, entry) for split, entry in _splits(spark, root).items()]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], MATRIX_SCHEMA)
