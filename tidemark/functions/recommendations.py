"""The nested recommendation list and its JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ITEM_LIST = T.ArrayType(
    T.StructType(
        [T.StructField("item_id", T.LongType()), T.StructField("score", T.DoubleType())]
    )
)


def to_json(items: str = "recommended_items") -> Column:
    return F.to_json(F.col(items))


def from_json(text: str) -> Column:
    """Malformed text fails the job instead of turning into nulls."""
    return F.from_json(F.col(text), ITEM_LIST, {"mode": "FAILFAST"})


def explode_items(results: DataFrame, items: str = "recommended_items") -> DataFrame:
    """One row per recommended item, ``rank`` counting from 1."""
    others = [c for c in results.columns if c != items]
    return results.select(*others, F.posexplode(items).alias("pos", "item")).select(
        *others,
        (F.col("pos") + 1).alias("rank"),
        F.col("item.item_id").alias("item_id"),
        F.col("item.score").alias("score"),
    )
