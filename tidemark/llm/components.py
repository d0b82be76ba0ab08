"""Connected components of a table of links, by repeated joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.session import stage

MOST_ROUNDS = 100


def _state(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, label) of every node with a link; the label is the smallest node reachable.

    Alternates two steps until the links are stars around the smallest nodes: every node
    passes its larger neighbours, then its smaller ones, on to the smallest. Each step is
    written to the shared folder, so a lost executor costs one step at most.
    """
    edges = stage(
        links.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "components",
    )
    state = _state(edges)
    for _ in range(MOST_ROUNDS):
        if not state[0]:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = (
            both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        kept = larger.where("u != v").distinct()
        lowest = kept.groupBy("u").agg(F.min("v").alias("m"))
        smaller = kept.join(lowest, "u")
        edges = stage(
            smaller.select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(lowest.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct(),
            "components",
        )
        before, state = state, _state(edges)
        if state == before:
            break
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(
        roots.select(F.col("v").alias("node"), F.col("v").alias("label"))
    )
