"""SimHash near duplicates by tiled exact comparison.

Different fingerprints are laid into tiles by the population counts of their four 16-bit parts. The
counts of two fingerprints differ, summed over the parts, by no more than their differing bits, so a
pair of tiles whose counts differ beyond the radius is skipped whole. All other pairs of tiles are
compared exactly, with exclusive-or and bit counts over whole arrays.

A pair of tiles gives no list of its links but a tree over each of its components: as many rows as
fingerprints at most, however many copies a group has. The components of all trees together are those
of all links.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import arrow_batches_of, text_rows
from tidemark.llm.components import components
from tidemark.operators.skew import hot_keys, skew_join
from tidemark.session import stage

# The shingle width, the hash seed, the radius.
SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3

# Parts of a fingerprint whose bits are counted, and the bits of one.
PARTS = 4
PART_BITS = 16

# Fingerprints in a tile. Tiles of equal counts are split by a hash beyond that.
TILE = 2048

# Pairs of tiles handed to Python at a time.
PAIRS_AT_ONCE = 256

# Rows with one fingerprint from which on they are split over tasks.
HOT_ROWS = 10_000

# Shingles hashed at a time.
STEP = 1 << 18

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LANES = np.uint64(0x0101010101010101)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each of the 64 bits, lowest first.

    One bit of every byte at a time: eight counters live in one integer, which 255 hashes cannot
    overflow.
    """
    padded = np.zeros(-(-len(hashes) // 255) * 255, np.uint64)
    padded[: len(hashes)] = hashes
    rows = padded.reshape(-1, 255)
    counts = np.empty((8, 8), np.int64)
    for bit in range(8):
        sums = ((rows >> np.uint64(bit)) & _LANES).sum(axis=1, dtype=np.uint64)
        counts[:, bit] = sums.astype("<u8").view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return counts.ravel()


def simhash(text: bytes) -> int:
    """The fingerprint of a whole text as an unsigned 64-bit integer."""
    words = text.translate(_LOWER).split()
    if not words:
        return 0
    n = len(words)
    width = min(SHINGLE_WORDS, n)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, n) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    total, counts = n - width + 1, np.zeros(64, np.int64)
    for at in range(0, total, STEP):
        upto = min(at + STEP, total)
        spans = zip(starts[at:upto].tolist(), ends[at + width - 1 : upto + width - 1].tolist())
        pieces = [joined[a:b] for a, b in spans]
        hashes = map(xxhash.xxh64_intdigest, pieces, repeat(SEED))
        counts += _bit_counts(np.fromiter(hashes, np.uint64, upto - at))
    bits = np.packbits(2 * counts > total, bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp) of every row; ``fp`` holds the 64 bits as a signed long, zero for no words or no text."""
    kind = docs.schema[id_col].dataType.simpleString()

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (simhash(text) for _, text in text_rows(batch, id_col, text_col))
            prints = np.fromiter(found, np.uint64, batch.num_rows).view(np.int64)
            ids = batch.column(batch.schema.get_field_index(id_col))
            yield pa.RecordBatch.from_arrays([ids, pa.array(prints)], names=["id", "fp"])

    return docs.select(id_col, text_col).mapInArrow(emit, f"id {kind}, fp long")


def _offsets() -> list[tuple[int, ...]]:
    """Differences of the counts within the radius, one of each pair of opposite ones."""
    steps = range(-RADIUS, RADIUS + 1)
    near = (o for o in product(steps, repeat=PARTS) if sum(map(abs, o)) <= RADIUS)
    return [o for o in near if o >= (0,) * PARTS]


def tile_pairs(prints: DataFrame) -> DataFrame:
    """(a, b, same) for every pair of tiles that may hold a link; ``same`` for a tile with itself.

    ``prints`` has different values of ``fp``. The table of counts has at most 17**4 rows.
    """
    counts = [f"count_{i}" for i in range(PARTS)]
    part = lambda i: F.shiftrightunsigned("fp", i * PART_BITS).bitwiseAND((1 << PART_BITS) - 1)
    counted = prints.select("fp", *(F.bit_count(part(i)).alias(c) for i, c in enumerate(counts)))
    sizes = counted.groupBy(*counts).agg(F.ceil(F.count("*") / TILE).alias("chunks"))
    chunk = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    tiles = (
        counted.join(F.broadcast(sizes), counts)
        .groupBy(*counts, chunk.alias("chunk"))
        .agg(F.collect_list("fp").alias("tile"))
    )
    tiles = stage(tiles, "simhash-tiles")
    offsets = F.array(*(F.array(*map(F.lit, o)) for o in _offsets()))
    moved = tiles.select("*", F.explode(offsets).alias("offset"))
    at_home = F.forall("offset", lambda o: o == 0)
    left = moved.select(
        *((F.col(c) + F.col("offset")[i]).alias(c) for i, c in enumerate(counts)),
        F.col("chunk").alias("own"),
        F.col("tile").alias("a"),
        at_home.alias("home"),
    )
    inside = [F.col(c).between(0, PART_BITS) for c in counts]
    for condition in inside:
        left = left.where(condition)
    joined = left.join(tiles.withColumnRenamed("tile", "b"), counts)
    return joined.where("not home or own <= chunk").select("a", "b", F.expr("home and own = chunk").alias("same"))


def _roots(u: np.ndarray, v: np.ndarray, n: int) -> np.ndarray:
    """The smallest number reachable from each of ``n`` numbers over the links (u, v)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _trees(a: np.ndarray, b: np.ndarray, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Links within the radius between two tiles, as trees over their components."""
    near = np.bitwise_count(a[:, None] ^ b[None, :]) <= RADIUS
    u, v = near.nonzero()
    if same:
        keep = u < v
        u, v, nodes = u[keep], v[keep], a
    else:
        v, nodes = v + len(a), np.concatenate([a, b])
    if not len(u):
        return u, v
    root = _roots(u, v, len(nodes))
    leaf = (root != np.arange(len(nodes))).nonzero()[0]
    return nodes[leaf], nodes[root[leaf]]


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        left, right, same = batch.columns
        us, vs = [], []
        for i in range(batch.num_rows):
            a, b = (c[i].values.to_numpy().view(np.uint64) for c in (left, right))
            u, v = _trees(a, b, same[i].as_py())
            if len(u):
                us.append(u.view(np.int64))
                vs.append(v.view(np.int64))
        if us:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(us)), pa.array(np.concatenate(vs))], names=["a", "b"]
            )


def simhash_links(prints: DataFrame) -> DataFrame:
    """(a, b): trees over the components of the different fingerprints in ``prints``, written down."""
    with arrow_batches_of(prints.sparkSession, PAIRS_AT_ONCE):
        return stage(tile_pairs(prints).mapInArrow(_compare, "a long, b long"), "simhash-links")


def simhash_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row's fingerprint and the smallest id that its links reach.

    Two rows link when their fingerprints differ in ``RADIUS`` bits at most. A null, empty or blank
    text has fingerprint zero and links like any other. A null id is never the smallest: its row joins
    its group, or has a null component where no row of the group has an id. Repeated rows are returned
    as often as they occur; other columns are left out, whatever their names. An empty table gives an
    empty result.
    """
    rows = stage(fingerprints(docs, id_col, text_col), "simhash-rows")
    per_print = rows.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    prints = stage(per_print, "simhash-prints")
    nodes = components(simhash_links(prints.select("fp"))).withColumnRenamed("node", "fp")
    linked = stage(nodes.join(prints.select("fp", "first"), "fp"), "simhash-linked")
    groups = linked.groupBy("label").agg(F.min("first").alias("lowest"), F.count("*").alias("n"))
    hot = hot_keys(groups, ["label"], "n", linked.count(), floor=HOT_ROWS)
    member = skew_join(linked.select("fp", "label"), groups.select("label", "lowest"), ["label"], "inner", hot)
    grouped = prints.join(member, "fp", "left").select(
        "fp", F.when(F.col("label").isNotNull(), F.col("lowest")).otherwise(F.col("first")).alias("component_id")
    )
    hot = hot_keys(prints, ["fp"], "n", rows.count(), floor=HOT_ROWS)
    return skew_join(rows, grouped, ["fp"], "inner", hot).select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )
