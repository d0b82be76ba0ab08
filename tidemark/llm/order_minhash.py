"""Order MinHash fingerprints of texts, with Spark's own functions only.

The k-mers are runs of ``K`` words (fewer at the end of the text), each numbered by its earlier
occurrences. The hash of a k-mer names one of ``SLOTS`` slots; in each slot the two smallest
hashes of (k-mer, occurrence number) are selected, put back into their order in the text, and
hashed as a tuple. So a slot changes with the words themselves and with their order. Likeness is
the share of equal tuples among the slots that either text fills.

One sort and one pass over the sorted k-mers of a row make the fingerprint; nothing is exploded or
shuffled. Sorted numbers hold 34 bits of hash and 30 bits of position.

Defined cases: a null or empty text has an empty fingerprint; two empty ones are alike (1.0), an
empty and another one are not (0.0). Equal texts have equal fingerprints, also texts that differ
in white space only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let, partitions_for
from tidemark.session import stage

K = 3
SLOTS = 64
RANGE_BYTES = 16 << 20

_PLACE = (1 << 30) - 1
_STATE = (
    "struct<slot:int,kmer:bigint,seen:int,h1:bigint,p1:bigint,k1:bigint,"
    "h2:bigint,p2:bigint,k2:bigint,out:array<int>>"
)


def _kmers(words: Column, k: int) -> Column:
    def numbers(h: Column) -> Column:
        def packed(x: Column, i: Column) -> Column:
            kmer = F.xxhash64(x, *(F.get(h, i + j) for j in range(1, k)))
            return kmer.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(i.cast("bigint"))

        return F.sort_array(F.transform(h, packed))

    return let(F.transform(words, lambda w: F.xxhash64(w)), numbers)


def _tuple(a: Column) -> Column:
    """The finished slot of the state: its number in the high bits, 16 bits of the tuple's hash."""
    first = F.when(a["p1"] < a["p2"], a["k1"]).otherwise(a["k2"])
    then = F.when(a["p1"] < a["p2"], a["k2"]).otherwise(a["k1"])
    h = F.when(a["h2"].isNull(), F.xxhash64(a["k1"])).otherwise(F.xxhash64(first, then))
    low = h.bitwiseAND(F.lit(0xFFFF)).cast("int")
    return F.shiftleft(a["slot"], 16).bitwiseOR(low)


def _step(a: Column, x: Column) -> Column:
    def state(slot, kmer, seen, one, two, out) -> Column:
        names = ("h1", "p1", "k1", "h2", "p2", "k2")
        return F.struct(
            slot.alias("slot"), kmer.alias("kmer"), seen.alias("seen"),
            *(c.alias(n) for n, c in zip(names, (*one, *two))), out.alias("out"),
        )

    def with_kmer(b: Column) -> Column:
        slot, kmer, seen = b["slot"], b["kmer"], b["seen"]
        new = (F.xxhash64(kmer, seen), x.bitwiseAND(F.lit(_PLACE)), kmer)
        one, two = (a["h1"], a["p1"], a["k1"]), (a["h2"], a["p2"], a["k2"])
        nothing = tuple(F.lit(None).cast("bigint") for _ in range(3))

        def insert(n: Column) -> Column:
            own = (n["h"], n["p"], n["k"])
            return (
                F.when(
                    a["slot"] != slot,
                    state(slot, kmer, seen, own, nothing,
                          F.when(a["slot"] < 0, a["out"]).otherwise(F.array_append(a["out"], _tuple(a)))),
                )
                .when(n["h"] < a["h1"], state(slot, kmer, seen, own, one, a["out"]))
                .when(a["h2"].isNull() | (n["h"] < a["h2"]), state(slot, kmer, seen, one, own, a["out"]))
                .otherwise(state(slot, kmer, seen, one, two, a["out"]))
            )

        return let(F.struct(*(c.alias(m) for m, c in zip("hpk", new))), insert)

    kmer = x.bitwiseAND(F.lit(~_PLACE))
    seen = F.when(a["kmer"] == kmer, a["seen"] + 1).otherwise(F.lit(0))
    slot = F.shiftrightunsigned(x, 64 - (SLOTS - 1).bit_length()).cast("int")
    return let(F.struct(slot.alias("slot"), kmer.alias("kmer"), seen.alias("seen")), with_kmer)


def order_minhash(text: Column, k: int = K) -> Column:
    """The fingerprint as an array of slots, each its number and 16 bits of its tuple's hash."""
    found = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    words = F.filter(found, lambda w: w != "")
    unset = ", ".join(f"'{c}', null" for c in ("h1", "p1", "k1", "h2", "p2", "k2"))
    start = F.expr(f"named_struct('slot', -1, 'kmer', null, 'seen', 0, {unset}, 'out', array())")
    start = start.cast(_STATE)
    end = lambda a: F.when(a["slot"] < 0, a["out"]).otherwise(F.array_append(a["out"], _tuple(a)))
    return F.aggregate(_kmers(words, k), start, _step, end)


def as_string(slots: Column) -> Column:
    """Six hexadecimal digits for each filled slot."""
    return F.array_join(F.transform(slots, lambda s: F.lpad(F.hex(s), 6, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    numbers = lambda s: F.transform(s, lambda x: F.shiftright(x, 16))
    filled = F.size(F.array_union(numbers(a), numbers(b)))
    equal = F.size(F.array_intersect(a, b))
    return F.when(filled == 0, F.lit(1.0)).otherwise(equal / filled)


def _following(firsts: DataFrame, value: str) -> DataFrame:
    """For every range, ``value`` of the first row of the next one; after the last, of the first.

    One row for each range, so ordering them in one task is bounded by the number of ranges.
    """
    w = Window.orderBy("range")
    around = F.first(value).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    after = F.coalesce(F.lead(value).over(w), around)
    return firsts.select("range", after.alias(f"after_{value}"))


def edited_fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = K
) -> DataFrame:
    """(doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next).

    The edited text of a row is its own, with the last half of its characters replaced by as many
    from the start of the next row in the order of (id, text), null ids first; the first row
    follows the last. Rows are dealt by ranges of ids, ordered in each, and the few rows at the
    ends of ranges get the first row of the next range.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("place", F.coalesce("doc_id", F.lit(-(1 << 63))))
    ranges = partitions_for(docs, RANGE_BYTES)
    shares = [i / ranges for i in range(1, ranges)] or [0.5]
    # as many numbers as ranges
    cuts = rows.agg(F.percentile_approx("place", shares, 10 * ranges)).first()[0] or []
    bounds = F.array(*(F.lit(c) for c in sorted(set(cuts)))).cast("array<bigint>")
    ranged = rows.withColumn("range", F.size(F.filter(bounds, lambda c: c <= F.col("place"))))
    least = ranged.groupBy("range").agg(F.min("place").alias("place"))
    # a row for each range: the texts stay where they are
    firsts = ranged.join(F.broadcast(least), ["range", "place"], "left_semi").groupBy("range").agg(
        F.min("text").alias("text")
    )
    order = Window.partitionBy("range").orderBy("place", "text")
    next_text = F.coalesce("next_text", "after_text")
    half = F.floor(F.length("text") / 2).cast("int")
    texts = (
        ranged.withColumn("next_text", F.lead("text").over(order))
        .withColumn("row", F.row_number().over(order))
        .join(_following(firsts, "text"), "range")
        .withColumn("edited", F.concat(F.left("text", F.length("text") - half), F.left(next_text, half)))
    )
    prints = stage(
        texts.select(
            "doc_id", "range", "row", F.length("text").cast("long").alias("n_chars"),
            F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
            order_minhash(F.col("text"), k).alias("own"),
            order_minhash(F.col("edited"), k).alias("changed"),
        ),
        "order-minhash",
    )
    heads = prints.where(F.col("row") == 1).select("range", "own")
    in_range = Window.partitionBy("range").orderBy("row")
    after = F.coalesce("next_own", "after_own")
    return (
        prints.withColumn("next_own", F.lead("own").over(in_range))
        .join(_following(heads, "own"), "range")
        .select(
            F.col("doc_id").alias(id_col), "n_chars", "edited_sha256",
            as_string(F.col("own")).alias("fingerprint"),
            as_string(F.col("changed")).alias("edited_fingerprint"),
            likeness(F.col("own"), F.col("changed")).alias("near_edited"),
            likeness(F.col("own"), after).alias("near_next"),
        )
    )
