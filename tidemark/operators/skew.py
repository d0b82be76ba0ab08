"""Equi joins whose left side may have a few keys with a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A key is hot above rows / HOT_KEYS, or above the rows of an even shuffle partition where there are
# more of those. So there can never be more hot keys than the larger of the two.
HOT_KEYS = 1024

# Below this many rows a key is not worth splitting, unless the session sets another number.
HOT_FLOOR = 1_000_000
HOT_FLOOR_SETTING = "spark.tidemark.hotRows"

_PARTS = "_parts"
_SALT = "_salt"


def _limit(spark: SparkSession, rows: int, floor: int | None) -> int:
    parts = max(HOT_KEYS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    least = int(spark.conf.get(HOT_FLOOR_SETTING, str(HOT_FLOOR))) if floor is None else floor
    return max(-(-rows // parts), least)


def may_have_hot_keys(spark: SparkSession, rows: int) -> bool:
    """Whether a key of a table with so many rows can be hot at all."""
    return rows > _limit(spark, rows, None)


def hot_keys(
    counted: DataFrame, keys: Sequence[str], weight: str, rows: int, floor: int | None = None
) -> DataFrame | None:
    """The keys of ``counted`` (one row per key) whose ``weight`` makes them hot.

    ``rows`` is the sum of all weights. Each hot key has more than an even partition's share of
    it (at least 1 / ``HOT_KEYS`` where partitions are few), so there are at most as many as shuffle
    partitions and they are safe to broadcast at any data size. None when so few rows exist that no
    key can be hot.
    """
    limit = _limit(counted.sparkSession, rows, floor)
    if rows <= limit:
        return None
    parts = F.ceil(F.col(weight) / limit).cast("int")
    return counted.where(F.col(weight) > limit).select(*keys, parts.alias(_PARTS))


def _join(
    left: DataFrame, right: DataFrame, keys: list[str], how: str, nulls_match: bool
) -> DataFrame:
    if not nulls_match:
        return left.join(right, keys, how)
    other = {key: f"_other_{key}" for key in keys}
    same = [F.col(key).eqNullSafe(F.col(name)) for key, name in other.items()]
    joined = left.join(right.withColumnsRenamed(other), reduce(and_, same), how)
    return joined.drop(*other.values())


def skew_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str,
    hot: DataFrame | None,
    nulls_match: bool = False,
) -> DataFrame:
    """``left`` joined to ``right`` with the rows of every hot key spread over several tasks.

    Hot rows of ``left`` get a part number from a hash of the row and its input partition,
    so copies of one row spread too, and a retried task gives the same numbers again. The
    matching rows of ``right`` are repeated once per part; the parts of all hot keys add up
    to at most twice the number of hot keys there can be. With ``nulls_match`` a null key equals a null key, and a hot
    one is spread like any other.
    """
    if how not in ("left", "left_semi", "inner"):
        raise ValueError(f"unsupported join type {how!r}")
    keys = list(keys)
    if hot is None:
        return _join(left, right, keys, how, nulls_match)
    hot = F.broadcast(hot)
    spread = F.xxhash64(*left.columns, F.spark_partition_id())
    part_of = F.when(
        F.col(_PARTS).isNotNull(), F.pmod(spread, F.col(_PARTS)).cast("int")
    ).otherwise(0)
    marked = _join(left, hot, keys, "left", nulls_match)
    salted = marked.withColumn(_SALT, part_of).drop(_PARTS)
    all_parts = F.sequence(F.lit(0), F.coalesce(F.col(_PARTS), F.lit(1)) - 1)
    copied = _join(right, hot, keys, "left", nulls_match)
    repeated = copied.withColumn(_SALT, F.explode(all_parts)).drop(_PARTS)
    return _join(salted, repeated, keys + [_SALT], how, nulls_match).drop(_SALT)
