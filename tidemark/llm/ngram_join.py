"""N-gram Jaccard self-join by vertical partitioning, with the components of its links.

``ngram_jaccard_links`` and ``ngram_jaccard_join`` compare all candidates and give every link.
``ngram_jaccard_components`` is a component search: it skips pairs that are in one component
already (step 3), so it knows the components and not the links.

Every text is the set of its distinct word n-grams, written in one global order: n-grams that
are frequent in the corpus come last. A set is cut into fragments at fixed pivots of that order.

1. Frequencies are counted over all rows in a table of ``2**TABLE_BITS`` counters, whose size
   does not depend on the data; only the rough order matters, never the value.
2. Equal sets are merged into one class. A class posts its *prefix*, the first
   ``n - ceil(t * n) + 1`` n-grams: two sets with Jaccard similarity ``t`` share one of them.
   As frequent n-grams come last, a passage in a third of all rows is in few prefixes, and a
   copy whose own edits outnumber the allowed difference posts only those edits.
3. In the join, all classes that post one n-gram are candidates of each other; postings of more
   than ``BLOCK`` classes are split into blocks, and pairs of blocks are dealt out.
   In the component search, all are compared with one centre. Classes then in one
   component need no further comparison; the rest of the posting is compared in further rounds,
   at last pair by pair between different components. No link between components is lost.
4. Every set has a bitmap of parities, as long as the set is large. Two bitmaps differ in no more
   bits than their sets in n-grams, so pairs whose bitmaps differ too much are left out before any set moves.
5. The remaining pairs are dealt to buckets by groups of near copies, and the sets are copied to the
   buckets that need them, not to each pair. There they are compared fragment by fragment: each
   fragment counts its partial overlap, and the sum per pair decides.

Defined cases: a null or empty text has no n-grams and is linked with nothing; it is its own
component. Repeated rows are kept, each with its component. A row whose id is null makes no
links, but gets the ids of a row with an equal set. Extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import TEXT_ROWS, WordHashes, arrow_batches_of, count_table, mix, shingles, text_rows
from tidemark.llm.components import components
from tidemark.session import stage

TABLE_BITS = 20

# The key of an n-gram: five bits of frequency class, then 58 of its hash. Pivots cut the keys of
# rare n-grams into four fragments; the frequent ones are a fragment of their own.
CLASS_SHIFT = 58
PIVOTS = tuple(range(1 << 56, (1 << 58) + 1, 1 << 56))

# Bits of a set's parity bitmap for each of its n-grams, before rounding up.
BITS_EACH = 2

# Classes of a posting that one key of the join holds; larger postings are split.
BLOCK = 1024

# Comparisons with a centre are repeated while pair-by-pair work would exceed this many pairs
# for each posted row, but no more often than STAR_ROUNDS. A round moves all open postings; the
# places of the shared n-gram leave a fraction of these pairs.
PAIRS_PER_ROW = 16
STAR_ROUNDS = 2

# N-grams of eight bytes in a block of near copies that are compared with each other or another
# block, and the buckets made for as many: small groups are dealt over more tasks than blocks are.
BLOCK_KEYS = 1 << 18
BUCKETS_EACH = 8

# N-grams of eight bytes that a task of a counter or of fragments holds before it hands them on.
KEYS_HELD = 1 << 18

# Rows whose sets are handed back at a time.
ROWS_OUT = 1024


def _bucket(x: np.ndarray) -> np.ndarray:
    return (x >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def _counter(k: int):
    def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        hashes, total = WordHashes(), np.zeros(1 << TABLE_BITS, np.int64)
        found, held = [], 0
        for batch in batches:
            for _, text in text_rows(batch, "id", "text"):
                # repeats within a text count too: only the rough order matters
                found.append(_bucket(shingles(hashes.array(text.lower().split()), k)))
                held += len(found[-1])
                if held > KEYS_HELD:
                    total += np.bincount(np.concatenate(found), minlength=len(total))
                    found, held = [], 0
        if found:
            total += np.bincount(np.concatenate(found), minlength=len(total))
        return total

    return count


def frequency_classes(texts: DataFrame, k: int) -> bytes:
    """A frequency class (0: rare) for each of ``2**TABLE_BITS`` hash ranges of n-grams."""
    counts = count_table(texts, _counter(k), 1 << TABLE_BITS)
    usual = max(1.0, float(np.median(counts)))
    return np.clip(np.log2(np.maximum(counts / usual, 1)), 0, 30).astype(np.uint8).tobytes()


def _keys(text: bytes, k: int, hashes: WordHashes, classes: np.ndarray) -> np.ndarray:
    """The n-grams of a text as ascending keys of the global order."""
    grams = shingles(hashes.array(text.lower().split()), k)
    rank = classes[_bucket(grams)].astype(np.uint64) << np.uint64(CLASS_SHIFT)
    return np.unique(rank | (grams >> np.uint64(64 - CLASS_SHIFT)))


def _digest(keys: np.ndarray, seed: int) -> int:
    return int(mix(keys + np.uint64(seed)).sum(dtype=np.uint64).view(np.int64))


def _bitmap(keys: np.ndarray) -> np.ndarray:
    """For each of some hash values, whether an odd number of the n-grams has it.

    The length is the power of two at or above ``BITS_EACH`` for every n-gram.
    """
    length = max(64, 1 << (BITS_EACH * len(keys) - 1).bit_length())
    places = ((keys >> np.uint64(8)) % np.uint64(length)).astype(np.int64)
    odd = (np.bincount(places, minlength=length) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def _set_writer(k: int, percent: int, classes: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = WordHashes(), np.frombuffer(classes, np.uint8)
        pieces = (b.slice(at, ROWS_OUT) for b in batches for at in range(0, b.num_rows, ROWS_OUT))
        for batch in pieces:
            ids, sizes, d1, d2, prefixes, bits = [], [], [], [], [], []
            for key, text in text_rows(batch, "id", "text"):
                keys = _keys(text, k, hashes, ranks)
                n = len(keys)
                ids.append(key)
                sizes.append(n)
                d1.append(_digest(keys, 1))
                d2.append(_digest(keys, 2))
                bits.append(_bitmap(keys))
                prefixes.append(keys[: n + n * -percent // 100 + 1 if n else 0].view(np.int64))
            ends = np.cumsum([0, *map(len, prefixes)])
            flat = np.concatenate([np.zeros(0, np.int64), *prefixes])
            words = np.concatenate([np.zeros(0, np.int64), *bits])
            word_ends = np.cumsum([0, *map(len, bits)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    batch.column(batch.schema.get_field_index("text_key")),
                    pa.array(sizes, pa.int64()),
                    pa.array(d1, pa.int64()),
                    pa.array(d2, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
                    pa.ListArray.from_arrays(pa.array(word_ends, pa.int32()), pa.array(words)),
                ],
                names=["id", "text_key", "n", "node", "check", "prefix", "bits"],
            )

    return write


def _fragment_writer(k: int, classes: bytes):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ranks = WordHashes(), np.frombuffer(classes, np.uint8)
        pivots = np.array(PIVOTS, np.uint64)
        for batch in batches:
            nodes, fragments, parts, held = [], [], [], 0
            for _, text in text_rows(batch, "id", "text"):
                keys = _keys(text, k, hashes, ranks)
                node = _digest(keys, 1)
                cuts = [0, *np.searchsorted(keys, pivots), len(keys)]
                for f, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    if a < b:
                        nodes.append(node)
                        fragments.append(f)
                        parts.append(keys[a:b].view(np.int64))
                held += len(keys)
                if held > KEYS_HELD:
                    yield _fragments(nodes, fragments, parts)
                    nodes, fragments, parts, held = [], [], [], 0
            yield _fragments(nodes, fragments, parts)

    def _fragments(nodes, fragments, parts) -> pa.RecordBatch:
        ends = np.cumsum([0, *map(len, parts)])
        flat = np.concatenate([np.zeros(0, np.int64), *parts])
        return pa.RecordBatch.from_arrays(
            [
                pa.array(nodes, pa.int64()),
                pa.array(fragments, pa.int32()),
                pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat)),
            ],
            names=["node", "fragment", "grams"],
        )

    return write


def _may_link(percent: int) -> Column:
    """Sizes, and the places of the shared n-gram as the first shared one, allow the similarity.

    The first n-gram that a similar pair shares is in both prefixes, so the pair is found there.
    """
    least, most = F.least("a_n", "b_n"), F.greatest("a_n", "b_n")
    # nothing is shared before the first shared n-gram
    reach = F.least(F.col("a_n") - F.col("a_pos"), F.col("b_n") - F.col("b_pos"))
    # intersection i of a similar pair: 100 * i >= percent * (a + b - i)
    return (least * 100 >= most * percent) & (
        reach * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    )


def _folded(own: str, other: str) -> Column:
    """A bitmap twice as long as the other one is folded: its halves are the parities of one."""
    bits, half = F.col(f"{own}_bits"), F.size(f"{other}_bits")
    longer = F.size(bits) > half
    halves = (F.slice(bits, 1, half), F.slice(bits, half + 1, half))
    return F.when(longer, F.zip_with(*halves, lambda x, y: x.bitwiseXOR(y))).otherwise(bits)


def _by_bitmap(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose bitmaps do not rule out the similarity."""
    if percent < 50:
        # sizes may differ so much that one fold does not make the bitmaps equally long
        return pairs.select("a", "b", "a_n", "b_n")
    bits = nodes.select("node", "bits")
    differing = F.aggregate(
        F.zip_with(_folded("a", "b"), _folded("b", "a"), lambda x, y: F.bit_count(x.bitwiseXOR(y))),
        F.lit(0),
        lambda total, n: total + n,
    )
    size = F.col("a_n") + F.col("b_n")
    return (
        pairs.join(bits.withColumnsRenamed({"node": "a", "bits": "a_bits"}), "a")
        .join(bits.withColumnsRenamed({"node": "b", "bits": "b_bits"}), "b")
        # an intersection is at most half of what the sizes leave after the difference
        .where((size - differing) * (100 + percent) >= size * 2 * percent)
        .select("a", "b", "a_n", "b_n")
    )


def _dealt(pairs: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """(pairs, copies): the bucket that compares each pair, and the buckets that need each class.

    Classes have a home, the smallest class among themselves and those they are paired with, and
    homes of many n-grams are cut into blocks. A bucket compares the pairs of some two blocks, so a
    class moves once for each block it meets, however many classes are in it.
    """
    names = ("node", "n", "other")
    ends = pairs.select("a", "a_n", "b").toDF(*names).unionAll(pairs.select("b", "b_n", "a").toDF(*names))
    homes = ends.groupBy("node").agg(F.max("n").alias("n"), F.least(F.min("other"), "node").alias("home"))
    blocks = homes.groupBy("home").agg(F.ceil(F.sum("n") / BLOCK_KEYS).alias("blocks"))
    block = F.pmod(F.xxhash64("node"), "blocks")
    placed = stage(
        homes.join(blocks, "home").select("node", "n", F.xxhash64("home", block).alias("home")),
        f"ngram-homes-{turn}",
    )
    home = placed.drop("n")
    keyed = (
        pairs.join(home.withColumnsRenamed({"node": "a", "home": "a_home"}), "a")
        .join(home.withColumnsRenamed({"node": "b", "home": "b_home"}), "b")
        .withColumn("key", F.xxhash64(F.least("a_home", "b_home"), F.greatest("a_home", "b_home")))
    )
    total = placed.agg(F.sum("n")).first()[0] or 0
    bucket = F.pmod("key", F.lit(-(-total * BUCKETS_EACH // BLOCK_KEYS) or 1)).alias("bucket")
    keyed = stage(keyed.select(bucket, "a", "b", "a_n", "b_n"), f"ngram-dealt-{turn}")
    copies = keyed.select(F.col("bucket").alias("to"), F.col("a").alias("node"))
    return keyed, copies.union(keyed.select("bucket", "b")).distinct()


def _shared(copies: pa.Table, pairs: pa.Table) -> np.ndarray:
    """The n-grams that each pair of a bucket shares: partial overlaps by fragment, summed per pair."""
    grams = copies["grams"].combine_chunks()
    values, ends = grams.values.to_numpy(), grams.offsets.to_numpy()
    # a fragment that is there twice, as its row is, counts once
    places = zip(copies["fragment"].to_pylist(), copies["node"].to_pylist())
    parts = {place: values[i:j] for place, i, j in zip(places, ends, ends[1:])}
    total, none = np.zeros(pairs.num_rows, np.int64), np.zeros(0, np.int64)
    both = list(zip(pairs["a"].to_pylist(), pairs["b"].to_pylist()))
    for f in range(len(PIVOTS) + 1):
        for at, (a, b) in enumerate(both):
            x, y = parts.get((f, a), none), parts.get((f, b), none)
            if len(x) and len(y):
                total[at] += len(np.intersect1d(x, y, assume_unique=True))
    return total


def _comparer(percent: int, every: bool):
    def links(copies: pa.Table, pairs: pa.Table) -> pa.Table:
        total = _shared(copies, pairs)
        sizes = pairs["a_n"].to_numpy() + pairs["b_n"].to_numpy()
        return pairs.select(["a", "b"]).filter(pa.array(total * 100 >= (sizes - total) * percent))

    def stars(copies: pa.Table, pairs: pa.Table) -> pa.Table:
        found = links(copies, pairs)
        root, counts = {}, Counter()

        def top(x):
            while root.setdefault(x, x) != x:
                root[x] = x = root[root[x]]
            return x

        for a, b in zip(found["a"].to_pylist(), found["b"].to_pylist()):
            counts.update((a, b))
            low, high = sorted((top(a), top(b)))
            root[high] = low
        columns = (list(counts), map(top, counts), counts.values())
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "b", "n_links"])

    return links if every else stars


def _overlaps(pairs: DataFrame, copies: DataFrame, percent: int, every: bool) -> DataFrame:
    """The pairs (a, b) that are similar, each compared in the bucket it is dealt to.

    Not ``every`` one: for each bucket and class ``a`` with a link there, the smallest class ``b`` that
    its links in the bucket reach, and their number ``n_links``.
    """
    schema = "a long, b long" if every else "a long, b long, n_links long"
    both = copies.groupBy("to").cogroup(pairs.groupBy("bucket"))
    return both.applyInArrow(_comparer(percent, every), schema)


def _first_shared() -> Column:
    """Not so where the n-grams before the shared one are shared too: the pair is found there."""
    return F.coalesce(F.col("a_prev") != F.col("b_prev"), F.lit(True))


def _stars(posts: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of each posted class with the centre of its posting.

    The centre is the class whose n-gram stands first: it has the fewest rare ones, so it is
    the most typical.
    """
    first = F.min(F.struct("pos", "node", "n")).over(Window.partitionBy("gram"))
    both = posts.withColumn("c", first).where("node != c.node")
    return _pairs(both.select(
        F.col("c.node").alias("a"), F.col("c.n").alias("a_n"), F.col("c.pos").alias("a_pos"),
        F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("pos").alias("b_pos"),
    ), percent)


def _rest(posts: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs within a posting whose classes are in different components."""
    a = posts.select("gram", *(F.col(c).alias(f"a_{c}") for c in ("node", "n", "pos", "prev", "comp")))
    b = posts.select("gram", *(F.col(c).alias(f"b_{c}") for c in ("node", "n", "pos", "prev", "comp")))
    other = (F.col("a_comp") != F.col("b_comp")) & (F.col("a_node") < F.col("b_node"))
    both = a.join(b, "gram").where(other & _first_shared())
    return _pairs(both.withColumnsRenamed({"a_node": "a", "b_node": "b"}), percent)


def _all_pairs(posts: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs of all classes that post one n-gram."""
    big = posts.groupBy("gram").agg(F.count("*").alias("m")).where(F.col("m") > BLOCK)
    blocks = F.ceil(F.coalesce("m", F.lit(1)) / BLOCK)
    dealt = (
        posts.join(big, "gram", "left")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("node"), "blocks"))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select(
            "gram", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
            "block", "node", "n", "pos", "prev",
        )
    )
    names = ("block", "node", "n", "pos", "prev")
    a = dealt.withColumnsRenamed({c: f"a_{c}" for c in names})
    b = dealt.withColumnsRenamed({c: f"b_{c}" for c in names})
    # pairs within a block meet where it is paired with itself
    here = (F.col("low") == F.col("high")) | (F.col("a_block") != F.col("b_block"))
    both = a.join(b, ["gram", "low", "high"]).where(
        here & (F.col("a_node") < F.col("b_node")) & _first_shared()
    )
    return _pairs(both.withColumnsRenamed({"a_node": "a", "b_node": "b"}), percent)


def _pairs(both: DataFrame, percent: int) -> DataFrame:
    swap = F.col("a") > F.col("b")
    pick = lambda x, y: F.when(swap, F.col(y)).otherwise(F.col(x))
    return both.where(_may_link(percent)).select(
        pick("a", "b").alias("a"), pick("b", "a").alias("b"),
        pick("a_n", "b_n").alias("a_n"), pick("b_n", "a_n").alias("b_n"),
    ).distinct()


def _prepared(
    docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, every: bool = False
) -> tuple:
    """(sets, nodes, posts, verified): rows, classes, shared postings, and the test of candidates."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text")
    )
    classes = frequency_classes(texts, k)
    rows = texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _set_writer(k, percent, classes),
        "id long, text_key long, n long, node long, check long, prefix array<long>, bits array<long>",
    )
    with arrow_batches_of(docs.sparkSession, TEXT_ROWS):
        sets = stage(rows, "ngram-sets")
    named = sets.where("n > 0 and id is not null").groupBy("node", "n", "check")
    nodes = stage(
        named.agg(F.min("id").alias("class_id"), F.first("bits").alias("bits")), "ngram-nodes"
    )
    posted = (
        named.agg(F.first("prefix").alias("prefix"))
        .select("node", "n", "prefix", F.posexplode("prefix").alias("pos", "gram"))
        .select("node", "n", "pos", "gram", F.get("prefix", F.col("pos") - 1).alias("prev"))
    )
    shared = F.count("*").over(Window.partitionBy("gram")) > 1
    posts = stage(
        posted.withColumn("shared", shared).where("shared").drop("shared"), "ngram-posts"
    )

    def verified(candidates: DataFrame, turn: int) -> DataFrame:
        pairs = stage(_by_bitmap(candidates, nodes, percent), f"ngram-pairs-{turn}")
        dealt, copies = _dealt(pairs, turn)
        chosen = nodes.join(copies.select("node"), "node", "left_semi").select(F.col("class_id").alias("id"))
        # staged, so that the planner knows whether the texts have to move at all
        chosen = stage(chosen.distinct(), f"ngram-chosen-{turn}")
        fragments = texts.join(chosen, "id", "left_semi").mapInArrow(
            _fragment_writer(k, classes), "node long, fragment int, grams array<long>"
        )
        # what the fragments decide is all that is written down
        with arrow_batches_of(docs.sparkSession, TEXT_ROWS):
            found = _overlaps(dealt, fragments.join(copies, "node"), percent, every)
            return stage(found, f"ngram-fragments-{turn}")

    return sets, nodes, posts, verified


def _with_components(
    sets: DataFrame, nodes: DataFrame, links: DataFrame, id_col: str
) -> DataFrame:
    """(id, n_shingles, class_id, component_id, text_key, node) of every row."""
    labels = components(links)
    by_node = nodes.drop("bits").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    smallest = by_node.groupBy("label").agg(F.min("class_id").alias("component_id"))
    result = by_node.join(smallest, "label").drop("label")
    out = sets.select("id", "text_key", "n", "node", "check").join(result, ["node", "n", "check"], "left")
    empty = F.col("n") == 0
    return out.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(empty, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(empty, F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
        "text_key",
        F.when(~empty, F.col("node")).alias("node"),
    )


def ngram_jaccard_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90
) -> DataFrame:
    """(id, n_shingles, class_id, component_id, text_key), a row for each row of ``docs``.

    ``text_key`` is Spark's ``xxhash64`` of the text, which tells rows of one id apart.

    Words are lower-cased in A-Z and separated by ASCII white space. Two rows link when
    ``100 * |intersection| >= percent * |union|`` of their sets of ``k``-word n-grams.
    ``class_id`` is the smallest id with the same set, ``component_id`` the smallest id
    reachable over links. Only the pairs that this needs are compared.
    """
    sets, nodes, posts, verified = _prepared(docs, id_col, text_col, k, percent)
    links = verified(_stars(posts, percent), 0)
    labels = components(links)
    rows = posts.count()
    for turn in range(STAR_ROUNDS + 1):
        own = F.coalesce("comp", "node").alias("comp")
        marked = posts.join(labels.withColumnRenamed("label", "comp"), "node", "left").select(
            "gram", "node", "n", "pos", "prev", own
        )
        undecided = stage(
            marked.join(_open_grams(marked).select("gram"), "gram", "left_semi"),
            f"ngram-open-{turn}",
        )
        # components only grow, so a posting that is decided stays so and is not read again
        posts = undecided.drop("comp")
        unequal = F.sum((F.col("m") * F.col("m") - F.col("same")) / 2)
        left = _open_grams(undecided).agg(unequal).first()[0]
        if not left:
            break
        last = turn == STAR_ROUNDS or left <= PAIRS_PER_ROW * rows
        found = _rest(undecided, percent) if last else _next_stars(undecided, percent)
        links = links.unionByName(verified(found, turn + 1))
        labels = components(links)
        if last:
            break
    return _with_components(sets, nodes, links, id_col).drop("node")


def ngram_jaccard_links(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90
) -> DataFrame:
    """(a, b), the ``class_id`` of every two different sets that link, ``a < b``."""
    _, nodes, posts, verified = _prepared(docs, id_col, text_col, k, percent, every=True)
    links = verified(_all_pairs(posts, percent), 0)
    a = nodes.select(F.col("node").alias("a"), F.col("class_id").alias("a_id"))
    b = nodes.select(F.col("node").alias("b"), F.col("class_id").alias("b_id"))
    return (
        links.join(a, "a")
        .join(b, "b")
        .select(F.least("a_id", "b_id").alias("a"), F.greatest("a_id", "b_id").alias("b"))
    )


def ngram_jaccard_join(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, percent: int = 90
) -> DataFrame:
    """The columns of ``ngram_jaccard_components`` and ``n_links``, from all links.

    ``n_links`` counts the different sets that a row's set links to; a row with an equal set is in
    its class and no link.
    """
    sets, nodes, posts, verified = _prepared(docs, id_col, text_col, k, percent)
    links = verified(_all_pairs(posts, percent), 0)
    counted = links.groupBy(F.col("a").alias("node")).agg(F.sum("n_links").alias("n_links"))
    rows = _with_components(sets, nodes, links, id_col)
    n_links = F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links")
    return rows.join(counted, "node", "left").select(
        id_col, "n_shingles", "class_id", "component_id", n_links
    )


def _open_grams(marked: DataFrame) -> DataFrame:
    """Postings with classes of different components: all their rows, and squares per component."""
    per_comp = marked.groupBy("gram", "comp").agg(F.count("*").alias("m"))
    return (
        per_comp.groupBy("gram")
        .agg(F.sum("m").alias("m"), F.sum(F.col("m") * F.col("m")).alias("same"))
        .where(F.col("m") * F.col("m") > F.col("same"))
    )


def _next_stars(undecided: DataFrame, percent: int) -> DataFrame:
    """Pairs with a new centre: the most typical class outside the largest component."""
    size = F.count("*").over(Window.partitionBy("gram", "comp"))
    largest = F.max(F.struct("size", "comp")).over(Window.partitionBy("gram"))
    outside = F.when(F.col("largest.comp") != F.col("comp"), F.struct("pos", "node", "n", "comp"))
    both = (
        undecided.withColumn("size", size)
        .withColumn("largest", largest)
        .withColumn("c", F.min(outside).over(Window.partitionBy("gram")))
        .where("c.comp != comp")
    )
    return _pairs(both.select(
        F.col("c.node").alias("a"), F.col("c.n").alias("a_n"), F.col("c.pos").alias("a_pos"),
        F.col("node").alias("b"), F.col("n").alias("b_n"), F.col("pos").alias("b_pos"),
    ), percent)
