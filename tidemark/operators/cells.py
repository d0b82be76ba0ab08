"""Training rows as cells, and regression trees grown on them.

A tree only asks on which side of a threshold a value lies, and the thresholds are candidates that are
chosen once. So rows whose values all lie between the same candidates, with the same label, stay together
in every tree and have the same margin: they are counted once, as a cell with a weight. Cells travel in
blocks of a few arrays, which the workers sum up without handling a row by itself.

What of this module runs on workers goes there by value, as they need not have the library.
"""

from __future__ import annotations

import pickle
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.trees import Node, Tree
from tidemark.session import scratch_path
from tidemark.sources.storage import delete

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Candidates of a feature are at most one fewer than this, and rows looked at for them at least so many:
# the rule of Spark ML's trees.
MAX_BINS = 32
SAMPLED_ROWS = 10_000

# Bits of a feature's bin in the key of a cell. A drawn sample can be larger than expected and give a
# candidate more than MAX_BINS - 1.
BIN_BITS = 6

# Rows that a task counts at a time, and cells of a block.
COUNTED_ROWS = 1 << 20
BLOCK_CELLS = 1 << 16

# Nodes whose sums a task holds at a time, and tables of sums that are added up at a time.
NODES_A_PASS = 256
FAN_IN = 64

# A split that takes away less than this share of what its node's sums come to is rounding.
LEAST_GAIN = 1e-14

# Splits whose gains differ by less than this share divide the rows alike; the first one is taken.
SAME_GAIN = 1e-10

BLOCK_SCHEMA = "bins binary, sign binary, weight binary, margin binary"
LEARNED_SCHEMA = f"{BLOCK_SCHEMA}, residual binary"

Thresholds = Sequence[Sequence[float]]

# A node, its feature, the last bin that goes left, and the left child. The right child has the next
# number, and parents come before their children.
Split = tuple[int, int, int, int]


def _candidates(drawn: np.ndarray, expected: float, most: int) -> list[float]:
    """Thresholds of one feature, of which ``drawn`` are the values of a sample.

    Midpoints of neighbouring values: of all of them, or of those next to ``most`` even shares of the
    ``expected`` sample. Zeros are what the other values lack to that size.
    """
    values, counts = np.unique(drawn[drawn != 0.0], return_counts=True)
    if not len(values):
        return []
    counts = counts.astype(float)
    zeros = expected - counts.sum()
    if zeros > 100 * np.finfo(float).eps * counts.sum():
        at = int(np.searchsorted(values, 0.0))
        values, counts = np.insert(values, at, 0.0), np.insert(counts, at, zeros)
    middles = (values[:-1] + values[1:]) / 2.0
    if len(middles) <= most:
        return middles.tolist()
    out, stride, seen = [], expected / (most + 1), np.cumsum(counts)
    target = stride
    for before, after, middle in zip(seen[:-1].tolist(), seen[1:].tolist(), middles.tolist()):
        if abs(before - target) < abs(after - target):
            out.append(middle)
            target += stride
    return out


def find_thresholds(assembled: DataFrame, features: int, seed: int) -> list[list[float]]:
    """The candidates of each feature, as Spark ML's trees find them: from all rows when they are few and
    from a sample of about ``SAMPLED_ROWS`` otherwise. Fails when a row has an unknown value or label."""
    rows, labelled = assembled.agg(F.count("*"), F.count("sign")).first()
    if not rows:
        raise ValueError("there are no rows to train on")
    if labelled < rows:
        raise ValueError(f"{rows - labelled} rows to train on have no label")
    spark, vector = assembled.sparkSession, vector_to_array("features")
    values = assembled.select(*(vector[i].alias(f"f{i}") for i in range(features)))
    fraction = min(1.0, max(MAX_BINS**2, SAMPLED_ROWS) / rows)
    if fraction < 1.0:
        # the sampler of RDDs, whose choice differs from that of frames
        drawn = spark.sparkContext._jvm.org.apache.spark.util.random.XORShiftRandom(seed).nextInt()
        sample = values._jdf.toJavaRDD().sample(False, fraction, drawn)
        values = DataFrame(spark._jsparkSession.createDataFrame(sample, values._jdf.schema()), spark)
    table = np.array(values.collect(), float).reshape(-1, features)
    return [_candidates(column, fraction * rows, min(MAX_BINS, rows) - 1) for column in table.T]


def count_cells(rows: DataFrame, features: Sequence[str], thresholds: Thresholds) -> DataFrame:
    """The different cells of the rows with a label: ``cell`` (the bins), ``sign`` and ``weight``.

    A bin is how many candidates lie below the value: all of them below an unknown one, as in a tree's
    column. A task counts its rows before the shuffle, ``COUNTED_ROWS`` at a time.
    """
    own = [np.asarray(t, float) for t in thresholds]

    def counted(held: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        cells = np.concatenate(held, axis=1)
        for sign in np.unique(cells[1]):
            cell, weight = np.unique(cells[0][cells[1] == sign].view(np.int64), return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {"cell": cell, "sign": np.full(len(cell), sign), "weight": weight.astype(np.int64)}
            )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            cell = np.zeros(batch.num_rows, np.int64)
            for i, below in enumerate(own):
                cell |= np.searchsorted(below, batch.column(i).to_numpy(zero_copy_only=False)) << (BIN_BITS * i)
            held.append(np.stack([cell.view(float), batch.column(len(own)).to_numpy(zero_copy_only=False)]))
            size += batch.num_rows
            if size >= COUNTED_ROWS:
                yield from counted(held)
                held, size = [], 0
        if size:
            yield from counted(held)

    values = rows.where(F.col("sign").isNotNull()).select(*(F.col(f).cast("double") for f in features), "sign")
    cells = values.mapInArrow(emit, "cell long, sign double, weight long")
    return cells.groupBy("cell", "sign").agg(F.sum("weight").alias("weight"))


def _one_value(value: bytes) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([value], pa.binary())], ["value"])


def _kind(name: str) -> type:
    return np.uint8 if name == "bins" else np.float64


def _record(arrays: dict[str, np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {k: pa.array([v.astype(_kind(k), copy=False).tobytes()], pa.binary()) for k, v in arrays.items()}
    )


def blocks_of(cells: DataFrame, features: int) -> DataFrame:
    """Cells in blocks: a row of bins for each feature, and the margin of no trees."""
    shifts = (np.arange(features, dtype=np.int64) * BIN_BITS)[:, None]

    def packed(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        cell = table["cell"].to_numpy()
        return _record(
            {
                "bins": (cell[None, :] >> shifts) & ((1 << BIN_BITS) - 1),
                "sign": table["sign"].to_numpy(),
                "weight": table["weight"].to_numpy(),
                "margin": np.zeros(len(cell)),
            }
        )

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows
            if size >= BLOCK_CELLS:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)

    return cells.select("cell", "sign", "weight").mapInArrow(emit, BLOCK_SCHEMA)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    for batch in batches:
        columns = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for row in range(batch.num_rows):
            block = {k: np.frombuffer(v[row].as_buffer(), _kind(k)) for k, v in columns.items()}
            block["bins"] = block["bins"].reshape(-1, len(block["sign"]))
            yield block


def _places(bins: np.ndarray, splits: list[Split], nodes: int) -> np.ndarray:
    """The node that each cell comes to, of so many."""
    kind = np.min_scalar_type(nodes)
    at = np.zeros(bins.shape[1], kind)
    for node, feature, last, left in splits:
        there = (bins[feature] > last).astype(kind)
        there += kind.type(left - node)
        there *= at == node
        at += there
    return at


def _steps(tree: Tree, features: Sequence[str], thresholds: Thresholds) -> tuple[list, np.ndarray]:
    """A tree's splits in bins, and the weighted value of each node."""
    by_number, splits, values = {n.node: n for n in tree.nodes}, [], [0.0]
    waiting = [(tree.nodes[0], 0)]
    for node, number in waiting:
        values[number] = node.value * tree.weight
        if node.feature is not None:
            feature, left = features.index(node.feature), len(values)
            splits.append((number, feature, bisect_left(thresholds[feature], node.threshold), left))
            values += [0.0, 0.0]
            waiting += [(by_number[node.left], left), (by_number[node.right], left + 1)]
    return splits, np.array(values)


def _moved(block: dict[str, np.ndarray], steps: list[tuple[list, np.ndarray]]) -> np.ndarray:
    """The margins of a block with those trees."""
    margin = block["margin"].copy()
    for splits, values in steps:
        margin += values[_places(block["bins"], splits, len(values))]
    return margin


class Boosted:
    """Blocks with the margins of trees: those of a table, and of the trees added since it was written.

    Every ``rounds_per_table`` trees the blocks are written down anew, so that neither the lineage nor the
    trees to be walked grow, and the table before is deleted.
    """

    def __init__(self, blocks: DataFrame, features: Sequence[str], thresholds: Thresholds, rounds_per_table: int):
        self.features, self.thresholds, self.rounds_per_table = tuple(features), thresholds, rounds_per_table
        self.one_task = blocks.rdd.getNumPartitions() == 1
        self.table: str | None = None
        self._write(blocks)

    def _write(self, blocks: DataFrame) -> None:
        spark, before = blocks.sparkSession, self.table
        self.table, self.trees = scratch_path(spark, "boost-blocks"), []
        blocks.write.parquet(self.table)
        written = spark.read.schema(BLOCK_SCHEMA).parquet(self.table)
        # of a large file Spark would make several parts, all but one of them empty
        self.blocks = written.coalesce(1) if self.one_task else written
        if before is not None:
            delete(spark, before)

    def close(self) -> None:
        delete(self.blocks.sparkSession, self.table)

    def add(self, tree: Tree) -> None:
        self.trees.append(tree)
        if len(self.trees) >= self.rounds_per_table:
            self._write(self._moved())

    def _steps(self) -> list[tuple[list, np.ndarray]]:
        return [_steps(tree, self.features, self.thresholds) for tree in self.trees]

    def _mapped(self, compute: Callable[[dict, np.ndarray], pa.RecordBatch], schema: str) -> DataFrame:
        steps = self._steps()

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for block in _blocks(batches):
                yield compute(block, _moved(block, steps))

        return self.blocks.mapInArrow(emit, schema)

    def _moved(self) -> DataFrame:
        """The blocks with the margins of all trees."""
        return self._mapped(lambda block, margin: _record(block | {"margin": margin}), BLOCK_SCHEMA)

    def learned(self, first: bool) -> DataFrame:
        """With what the next tree learns: the signs first, then the downhill slope of the loss."""

        def compute(block: dict[str, np.ndarray], margin: np.ndarray) -> pa.RecordBatch:
            sign = block["sign"]
            with np.errstate(over="ignore"):
                residual = sign if first else sign * 4.0 / (np.exp(sign * margin * 2.0) + 1.0)
            return _record(block | {"margin": margin, "residual": residual})

        return self._mapped(compute, LEARNED_SCHEMA)

    def loss(self) -> float:
        """Mean of 2 log(1 + exp(-2 y margin)), without overflow for large margins."""

        steps = self._steps()

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros(2)
            for block in _blocks(batches):
                x = block["sign"] * _moved(block, steps) * -2.0
                one = np.maximum(x, 0.0) + np.log1p(np.exp(-np.abs(x)))
                total += one @ block["weight"], block["weight"].sum()
            yield pa.RecordBatch.from_arrays([pa.array([t]) for t in total], ["loss", "weight"])

        sums = self.blocks.mapInArrow(emit, "loss double, weight double").collect()
        weight = sum(row["weight"] for row in sums)
        return 2.0 * sum(row["loss"] for row in sums) / weight if weight else float("nan")


def _summed(
    blocks: Iterable[dict[str, np.ndarray]],
    splits: list[Split],
    nodes: Sequence[int],
    count: int,
    widths: Sequence[int],
) -> np.ndarray:
    """Sum of weights and of weighted residuals per node, feature and bin, for ``nodes`` out of ``count``."""
    features, width = len(widths), max(widths)
    slots = np.full(count, len(nodes), np.int64)
    slots[list(nodes)] = np.arange(len(nodes))
    # two features at a time: their sums are those of the table of both, along its rows and its columns
    pairs = [(i, min(i + 1, features - 1)) for i in range(0, features, 2)]
    total = np.zeros((len(nodes), features, width, 2))
    for block in blocks:
        bins, weights = block["bins"], (block["weight"], block["weight"] * block["residual"])
        slot = slots[_places(bins, splits, count)] * (width * width)
        for one, other in pairs:
            cell = bins[one].astype(np.int64)
            cell *= width
            cell += bins[other]
            cell += slot
            for k, weight in enumerate(weights):
                table = np.bincount(cell, weight, (len(nodes) + 1) * width * width)
                table = table.reshape(-1, width, width)[:-1]
                total[:, one, :, k] += table.sum(axis=2)
                if other != one:
                    total[:, other, :, k] += table.sum(axis=1)
    return total


def _histograms(
    learned: DataFrame,
    parts: int,
    splits: list[Split],
    nodes: Sequence[int],
    count: int,
    widths: Sequence[int],
) -> np.ndarray:
    """The same sums over the blocks of all tasks."""
    shape = (len(nodes), len(widths), max(widths), 2)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield _one_value(_summed(_blocks(batches), splits, nodes, count, widths).tobytes())

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            for row in batch.column(0):
                total += np.frombuffer(row.as_buffer()).reshape(shape)
        yield _one_value(total.tobytes())

    tables = learned.mapInArrow(emit, "value binary")
    while parts > FAN_IN:
        parts = -(-parts // FAN_IN)
        tables = tables.repartition(parts).mapInArrow(added, "value binary")
    total = np.zeros(shape)
    for row in tables.collect():
        total += np.frombuffer(row["value"]).reshape(shape)
    return total


def _best_split(sums: np.ndarray, splits: np.ndarray) -> tuple[int, int, float, float] | None:
    """Feature, last bin to the left and both means of the split that takes most variance away.

    ``sums`` has weights and weighted residuals per feature and bin, ``splits`` which (feature, bin) are
    candidates. None when no split takes any away.
    """
    left = np.cumsum(sums, axis=1)
    total = left[:, -1:, :]
    right = total - left
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0]
        gain = apart - total[..., 1] ** 2 / total[..., 0]
        means = left[..., 1] / left[..., 0], right[..., 1] / right[..., 0]
    gain[~splits | (left[..., 0] == 0) | (right[..., 0] == 0)] = -np.inf
    most = gain.max()
    # without a second value there is nothing to take away but rounding
    if not most > LEAST_GAIN * apart.flat[int(gain.argmax())]:
        return None
    feature, last = np.unravel_index(int((gain >= most * (1.0 - SAME_GAIN)).argmax()), gain.shape)
    return int(feature), int(last), float(means[0][feature, last]), float(means[1][feature, last])


def _grown(
    sums_of: Callable[[list[Split], Sequence[int], int, Sequence[int]], np.ndarray],
    widths: Sequence[int],
    max_depth: int,
) -> tuple[list[Split], list[float]]:
    """The splits of a tree, level by level, and the mean of each node. ``sums_of`` sums up as ``_summed``."""
    candidates = np.arange(max(widths)) < np.array(widths)[:, None] - 1
    splits: list[Split] = []
    means, level = [0.0], [0]
    for depth in range(max(max_depth, 1)):
        known, above, grown, level = len(means), level, list(splits), []
        for start in range(0, len(above), NODES_A_PASS):
            nodes = above[start : start + NODES_A_PASS]
            for node, sums in zip(nodes, sums_of(grown, nodes, known, widths)):
                if node == 0:
                    means[0] = float(sums[0, :, 1].sum() / sums[0, :, 0].sum())
                if depth < max_depth and (best := _best_split(sums, candidates)) is not None:
                    feature, last, *children = best
                    splits.append((node, feature, last, len(means)))
                    level += [len(means), len(means) + 1]
                    means += children
    return splits, means


class DecisionTreeRegressor:
    """Regression trees by the least variance on learned blocks, as Spark ML's of that name grows on rows.

    A level of the tree is a pass over the blocks that sums the residuals up by node, feature and bin. The
    sums, as many for any number of rows, come to the driver, which chooses the splits. Where one task has
    all blocks it does all passes itself.
    """

    def __init__(self, features: Sequence[str], thresholds: Thresholds, max_depth: int):
        self.features, self.thresholds, self.max_depth = tuple(features), thresholds, max_depth

    def fit(self, learned: DataFrame) -> tuple[Node, ...]:
        widths, max_depth = [len(own) + 1 for own in self.thresholds], self.max_depth
        parts = learned.rdd.getNumPartitions()
        if parts > 1:
            return self._nodes(*_grown(partial(_histograms, learned, parts), widths, max_depth))

        def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield _one_value(pickle.dumps(_grown(partial(_summed, list(_blocks(batches))), widths, max_depth)))

        # read to its end, after which the worker takes the next task
        (grown,) = learned.mapInArrow(emit, "value binary").collect()
        return self._nodes(*pickle.loads(grown["value"]))

    def _nodes(self, splits: list[Split], means: list[float]) -> tuple[Node, ...]:
        """Numbered from the root by depth-first order; two leaves of one value are one leaf."""
        by_node, out = {node: rest for node, *rest in splits}, []

        def visit(node: int) -> int:
            number = len(out)
            out.append(Node(number, None, None, None, None, means[node]))
            if node in by_node:
                feature, last, child = by_node[node]
                left, right = visit(child), visit(child + 1)
                if out[left].feature is None and out[right].feature is None and out[left].value == out[right].value:
                    out[number:] = [Node(number, None, None, None, None, out[left].value)]
                else:
                    name, threshold = self.features[feature], float(self.thresholds[feature][last])
                    out[number] = Node(number, name, threshold, left, right, means[node])
            return number

        visit(0)
        return tuple(out)
