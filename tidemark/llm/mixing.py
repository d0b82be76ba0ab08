"""Mixing sources to target weights by drawing fixed-length blocks of words.

1. Sources, in code-point order with null last, get the weights ``WEIGHTS`` in turn and share
   ``share`` times the size of all rows. A target stops at ``most`` times its source's size, and
   the excess is shared again by weight until no target is above.
2. The words of a source, in the order of its documents, are packed into blocks of ``BLOCK``
   words. A target is so many slots, each a block; the last one is cut to meet the target.
3. The slots of a source are spread over the output shards by a multinomial draw.
4. Slot ``k`` of a source with ``m`` blocks takes the block at place ``k mod m`` of a
   pseudorandom permutation of its indices, a new one each time the source is used up. So no
   block is used more often than ``ceil(target / size)`` times.
5. Slots and blocks are joined by (source, index), a key without skew.

Draws depend on the seed, the source and its size only: reruns agree.

Defined cases: a null text has size 0; rows of size 0 are never taken. Rows with equal ids are
ordered by a hash of their text, so equal rows are interchangeable. With no words at all every
target is 0. Extra columns are ignored. The table of sources has one row for each and is ordered
in one task; documents never are.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import WORD, clear_name
from tidemark.session import stage

# Fixed values of the mix: weights in turn, the share of all words, the most uses of a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0

# Words of a block, slots of an output shard on average, and the seed of all draws.
BLOCK = 256
SHARD_SLOTS = 4096
SEED = 20240607

# A Feistel network of this many rounds permutes the indices of a source.
ROUNDS = 6


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(source, source_no, source_size, target) from rows of (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    numbered = per.withColumn(
        "source_no", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weights = F.array(*(F.lit(float(w)) for w in WEIGHTS))
    weighed = numbered.withColumn(
        "weight", F.get(weights, F.col("source_no") % len(WEIGHTS))
    ).withColumn("cap", F.col("source_size") * most)
    everything = Window.partitionBy()
    by_ratio = Window.orderBy(F.col("cap") / F.col("weight"), "source_no")
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    spent = F.coalesce(F.sum("cap").over(earlier), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(
        F.sum("weight").over(earlier), F.lit(0.0)
    )
    budget = F.sum("source_size").over(everything) * share
    level = (
        weighed.withColumn("level", (budget - spent) / weight_left)
        .withColumn("capped", F.col("cap") <= F.col("level") * F.col("weight"))
        .withColumn(
            "common",
            # of the first source that is not capped, in the same order as ``spent``
            F.min(
                F.when(~F.col("capped"), F.struct(F.col("cap") / F.col("weight"), "source_no", "level"))
            ).over(everything)["level"],
        )
    )
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("common") * F.col("weight"))
    return level.select(
        "source", F.col("source_no").cast("long"), "source_size", target.alias("target")
    )


class IndexPermutation:
    """A pseudorandom permutation of 0 .. n-1, evaluated for any index without a table.

    A Feistel network permutes the next power of four; values at or above ``n`` go round again.
    """

    def __init__(self, n: int, key: int):
        self.n = n
        self.half = np.uint64(max(1, (max(n - 1, 1).bit_length() + 1) // 2))
        self.mask = np.uint64((1 << int(self.half)) - 1)
        self.keys = [
            np.uint64(xxhash.xxh3_64_intdigest(f"{key}:{r}".encode())) for r in range(ROUNDS)
        ]

    def _round(self, x: np.ndarray, key: np.uint64) -> np.ndarray:
        x = (x + key) * np.uint64(0x9E3779B97F4A7C15)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        return (x >> np.uint64(33)) & self.mask

    def _forward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in self.keys:
            left, right = right, left ^ self._round(right, key)
        return left << self.half | right

    def _backward(self, x: np.ndarray) -> np.ndarray:
        left, right = x >> self.half, x & self.mask
        for key in reversed(self.keys):
            left, right = right ^ self._round(left, key), left
        return left << self.half | right

    def _walk(self, x, step) -> np.ndarray:
        out = step(np.asarray(x, np.uint64))
        while (outside := out >= self.n).any():
            out[outside] = step(out[outside])
        return out.astype(np.int64)

    def __call__(self, x) -> np.ndarray:
        return self._walk(x, self._forward)

    def inverse(self, x) -> np.ndarray:
        return self._walk(x, self._backward)


def _key(source: str | None, size: int, epoch: int, seed: int) -> int:
    name = "n" if source is None else "s" + source
    return xxhash.xxh3_64_intdigest(f"{seed}:{epoch}:{size}:{name}".encode())


def source_slots(
    source: str | None, size: int, target: float, block: int = BLOCK, seed: int = SEED
) -> tuple[int, int, int]:
    """(blocks, slots, words of the last slot) of a source, so that it gives its target."""
    words, blocks = int(round(target)), -(-size // block)
    if not words or not size:
        return blocks, 0, 0
    full, rest = divmod(words, size)
    tail = size - (blocks - 1) * block
    if not rest:
        last = int(IndexPermutation(blocks, _key(source, size, full - 1, seed))([blocks - 1])[0])
        return blocks, full * blocks, tail if last == blocks - 1 else block
    # where the short last block comes in the unfinished pass
    order = IndexPermutation(blocks, _key(source, size, full, seed))
    short = int(order.inverse([blocks - 1])[0])
    count = -(-rest // block)
    if count > short:
        count = short + 1 + max(0, -(-(rest - short * block - tail) // block))
    before = (count - 1) * block - (block - tail if count - 1 > short else 0)
    return blocks, full * blocks + count, rest - before


def _cells(shard_slots: int, block: int, seed: int, shards: int):
    """For each source and shard, how many of the source's slots the shard draws."""

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                blocks, slots, last = source_slots(
                    row["source"], row["source_size"], row["target"], block, seed
                )
                if not slots:
                    continue
                rng = np.random.default_rng(_key(row["source"], row["source_size"], -1, seed))
                if slots >= shards:
                    counts = rng.multinomial(slots, np.full(shards, 1 / shards))
                    shard = np.flatnonzero(counts)
                    counts = counts[shard]
                else:
                    shard, counts = np.unique(rng.integers(0, shards, slots), return_counts=True)
                first = np.cumsum(counts) - counts
                n = len(shard)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["source"]] * n, pa.string()),
                        pa.array([row["source_no"]] * n, pa.int64()),
                        pa.array([row["source_size"]] * n, pa.int64()),
                        pa.array([blocks] * n, pa.int64()),
                        pa.array([slots] * n, pa.int64()),
                        pa.array([last] * n, pa.int64()),
                        pa.array(shard, pa.int64()),
                        pa.array(first, pa.int64()),
                        pa.array(counts, pa.int64()),
                    ],
                    names=[c.split()[0] for c in CELLS.split(", ")],
                )

    return draw


CELLS = (
    "source string, source_no long, source_size long, blocks long, slots long, last long, "
    "shard long, first long, count long"
)
SLOTS = "source_no long, shard long, slot long, pass int, block long, words long"


def _slots(block: int, seed: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                k = np.arange(row["first"], row["first"] + row["count"])
                turn, place = np.divmod(k, row["blocks"])
                index = np.empty(len(k), np.int64)
                for e in np.unique(turn):
                    own = turn == e
                    key = _key(row["source"], row["source_size"], int(e), seed)
                    index[own] = IndexPermutation(row["blocks"], key)(place[own])
                tail = row["source_size"] - (row["blocks"] - 1) * block
                words = np.where(index == row["blocks"] - 1, tail, block)
                words[k == row["slots"] - 1] = row["last"]
                n = len(k)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["source_no"]] * n, pa.int64()),
                        pa.array([row["shard"]] * n, pa.int64()),
                        pa.array(k, pa.int64()),
                        pa.array(turn, pa.int32()),
                        pa.array(index, pa.int64()),
                        pa.array(words, pa.int64()),
                    ],
                    names=[c.split()[0] for c in SLOTS.split(", ")],
                )

    return fill


@dataclass(frozen=True)
class Mix:
    """``sized``: (doc_id, key, source_no, size, start, source_size, target), a row for each
    document; ``start`` is its place among the words of its source.
    ``slots``: (source_no, shard, slot, pass, block, words), the mix itself.
    ``pieces``: (source_no, start, pass, shard, slot, low, high): words ``low`` to ``high`` of the
    document there, for each of its blocks that a slot took.
    """

    sized: DataFrame
    slots: DataFrame
    pieces: DataFrame


def _sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.col(source_col).cast("string").alias("source"),
        F.col(text_col).cast("string").alias("text"),
    )
    key = F.xxhash64("doc_id", "source", "text")
    return rows.select("doc_id", key.alias("key"), "source", word_count("text").alias("size"))


def _with_starts(sized: DataFrame) -> DataFrame:
    """The words of the source before each document.

    Rows are dealt by ranges of (source, id), so a large source is many parts; parts are added
    up, then each part orders its own rows.
    """
    order = ("doc_id", "key", "size")
    least = int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = sized.repartitionByRange(least, F.col("source").asc_nulls_last(), *order)
    parts = stage(dealt.withColumn("part", F.spark_partition_id()), "mix-sizes")
    before = Window.partitionBy("source_no").orderBy("part")
    own = Window.partitionBy("source_no", "part").orderBy(*order)
    earlier = (Window.unboundedPreceding, -1)
    targets = source_targets(parts.select("source", "size"))
    # a small table for a small number of sources; the planner measures it
    rows = parts.join(targets, parts["source"].eqNullSafe(targets["source"]), "left").drop("source")
    totals = (
        rows.groupBy("source_no", "part")
        .agg(F.sum("size").alias("t"))
        .select(
            "source_no",
            "part",
            F.coalesce(F.sum("t").over(before.rowsBetween(*earlier)), F.lit(0)).alias("base"),
        )
    )
    inside = F.coalesce(F.sum("size").over(own.rowsBetween(*earlier)), F.lit(0))
    return (
        rows.withColumn("inside", inside)
        .join(totals, ["source_no", "part"])
        .withColumn("start", F.col("base") + F.col("inside"))
        .drop("base", "inside", "part")
    )


def mix_sources(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    block: int = BLOCK,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    sized = stage(_with_starts(_sized(docs, id_col, text_col, source_col)), "mix-starts")
    named = docs.select(F.col(source_col).cast("string").alias("source"))
    # the sources again, now from the staged rows: number, size and target are on each
    per_source = sized.groupBy("source_no").agg(
        F.first("source_size").alias("source_size"), F.first("target").alias("target")
    )
    numbers = Window.orderBy(F.col("source").asc_nulls_last())
    names = named.distinct().select(
        "source", (F.row_number().over(numbers) - 1).cast("long").alias("source_no")
    )
    words = per_source.agg(F.sum("target")).first()[0] or 0.0
    shards = max(1, round(words / block / shard_slots))
    parallel = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cells = names.join(per_source, "source_no").mapInArrow(
        _cells(shard_slots, block, seed, shards), CELLS
    )
    slots = cells.repartition(parallel, "source_no", "shard").mapInArrow(
        _slots(block, seed), SLOTS
    )
    slots = stage(slots, "mix-slots")
    first = F.floor(F.col("start") / block)
    last = F.floor((F.col("start") + F.col("size") - 1) / block)
    covered = (
        sized.where("size > 0")
        .select("source_no", "start", "size", F.explode(F.sequence(first, last)).alias("block"))
        .withColumn("from", F.greatest(F.col("start") - F.col("block") * block, F.lit(0)))
        .withColumn(
            "to", F.least(F.col("start") + F.col("size") - F.col("block") * block, F.lit(block))
        )
    )
    low = F.col("block") * block + F.col("from") - F.col("start")
    pieces = (
        covered.join(slots, ["source_no", "block"])
        .withColumn("to", F.least("to", "words"))
        .where("to > from")
        .select("source_no", "start", "pass", "shard", "slot",
                low.alias("low"), (low + F.col("to") - F.col("from")).alias("high"))
    )
    return Mix(sized, slots, pieces)


def taken_words(mix: Mix) -> DataFrame:
    """(doc_id, size, source_size, target, taken), a row for each document."""
    taken = mix.pieces.groupBy("source_no", "start").agg(
        F.sum(F.col("high") - F.col("low")).alias("taken")
    )
    has_words = F.when(F.col("size") > 0, F.col("start"))
    return (
        mix.sized.withColumn("start", has_words)
        .join(taken, ["source_no", "start"], "left")
        .select(
            "doc_id", "size", "source_size", "target",
            F.coalesce("taken", F.lit(0)).alias("taken"),
        )
    )


def _cut(texts, spans):
    import pandas as pd

    word = re.compile(r"[^\x20\x09-\x0D]+")
    out = []
    for text, own in zip(texts, spans):
        places = [m.span() for m in word.finditer(text)]
        merged: list[list[int]] = []
        for low, high in sorted((int(s["low"]), int(s["high"])) for s in own):
            if merged and merged[-1][1] == low:
                merged[-1][1] = high
            else:
                merged.append([low, high])
        if merged == [[0, len(places)]]:
            out.append(text)
        else:
            out.append("\n".join(text[places[a][0] : places[b - 1][1]] for a, b in merged))
    return pd.Series(out)


def mixed_texts(docs: DataFrame, mix: Mix, text_col: str = "text", length_col: str | None = None,
                id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The mix as rows of ``docs``: one for each pass of a document, with the words it takes.

    A whole document keeps its text unchanged; of a partly taken one the taken stretches are
    kept, on lines of their own. Documents no slot took are left out.
    """
    key, spans = clear_name(docs, "mix_key", "mix_spans")
    per_pass = (
        mix.pieces.groupBy("source_no", "start", "pass")
        .agg(F.collect_list(F.struct("low", "high")).alias(spans))
        .join(mix.sized.where("size > 0").select("source_no", "start", "key"), ["source_no", "start"])
        .select(F.col("key").alias(key), spans)
    )
    own = F.xxhash64(
        F.col(id_col).cast("long"), F.col(source_col).cast("string"), F.col(text_col).cast("string")
    )
    cut = F.pandas_udf(_cut, "string")
    out = (
        docs.withColumn(key, own)
        .dropDuplicates([key])
        .join(per_pass, key)
        .withColumn(text_col, cut(F.col(text_col), F.col(spans)))
    )
    if length_col:
        out = out.withColumn(length_col, F.length(text_col).cast(docs.schema[length_col].dataType))
    return out.select(docs.columns)
