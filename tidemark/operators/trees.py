"""Boosted trees as a relation of nodes, and their scores as one native expression.

A model is a table with a row per node: the feature and threshold of a split with its two children, or
the value of a leaf. It is small (rounds times two to the depth) and is read by the driver, which turns
it into a column expression; scoring is then a projection without a join, a vector or Python.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "tree int, weight double, node int, feature string, threshold double, "
    "left_node int, right_node int, value double"
)


@dataclass(frozen=True)
class Node:
    """A split (rows with ``feature <= threshold`` go left) or, without a feature, a leaf."""

    node: int
    feature: str | None
    threshold: float | None
    left: int | None
    right: int | None
    value: float


@dataclass(frozen=True)
class Tree:
    """Nodes of one tree, the root first, and the weight of its value in the sum."""

    weight: float
    nodes: tuple[Node, ...]

    def column(self) -> Column:
        by_number = {n.node: n for n in self.nodes}

        def value(node: Node) -> Column:
            if node.feature is None:
                return F.lit(node.value)
            left, right = value(by_number[node.left]), value(by_number[node.right])
            return F.when(F.col(node.feature).cast("double") <= node.threshold, left).otherwise(right)

        return value(self.nodes[0]) * self.weight


@dataclass(frozen=True)
class Forest:
    trees: tuple[Tree, ...]

    def margin(self) -> Column:
        """The weighted sum of the trees' values."""
        return reduce(add, (tree.column() for tree in self.trees), F.lit(0.0))

    def probability(self) -> Column:
        """Of class 1, for trees grown on the loss 2 log(1 + exp(-2 y margin)) with y = -1 or 1."""
        return probability(self.margin())

    def first(self, trees: int) -> Forest:
        return Forest(self.trees[:trees])

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [
            (number, tree.weight, n.node, n.feature, n.threshold, n.left, n.right, n.value)
            for number, tree in enumerate(self.trees)
            for n in tree.nodes
        ]
        return spark.createDataFrame(rows, NODE_SCHEMA)

    @staticmethod
    def of(rows: Iterable) -> Forest:
        """From the rows of the table, in any order."""
        trees: dict[int, list] = {}
        for row in sorted(rows, key=lambda r: (r["tree"], r["node"])):
            trees.setdefault(row["tree"], []).append(row)
        return Forest(
            tuple(
                Tree(
                    own[0]["weight"],
                    tuple(
                        Node(r["node"], r["feature"], r["threshold"], r["left_node"], r["right_node"], r["value"])
                        for r in own
                    ),
                )
                for own in trees.values()
            )
        )


def probability(margin: Column) -> Column:
    return 1.0 / (1.0 + F.exp(margin * -2.0))


def read_forest(spark: SparkSession, path: str) -> Forest:
    return Forest.of(spark.read.schema(NODE_SCHEMA).parquet(path).collect())


def write_forest(spark: SparkSession, forest: Forest, path: str) -> None:
    forest.table(spark).coalesce(1).write.parquet(path)
