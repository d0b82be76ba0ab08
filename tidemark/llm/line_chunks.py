"""Removing line chunks that repeat across the corpus, with Spark's own functions only.

A text is cut into lines: at line feeds, and after the end of a sentence, so that a long physical
line is several. A rolling hash is taken over the hashes of every ``WINDOW`` adjoining lines. Of two
neighbouring windows the one with the smaller hash is a boundary: whether a window is one depends on
it and its two neighbours alone, so boundaries inside a passage are found again wherever the passage
stands, and of ``WINDOW + 1`` lines in a row one window at least is a boundary for its content alone.

The chunk at a boundary is the lines of its window. Chunks are grouped by digest over the whole
corpus; the first in the order of (id, text, place) is kept. Every other is laid over the kept one
together with the line before and the line after it, and the bytes are compared line by line. As
neighbouring boundaries are at most two lines apart, chunks and the lines beside them cover a
repeated passage of ``WINDOW + 1`` lines or more from its first line to its last. Equal lines are
removed where ``WINDOW`` of them or more, of ``LEAST_CHARS`` characters or more together, stand side
by side. Each has an equal line at an earlier place, so the first copy of every line stays.

Digests and places are shuffled for the chunks, bytes only where a digest repeats: once for each such
line and kept line, in blocks of ``2 ** BLOCK_BITS`` kept lines. Digests with many chunks and kept
blocks with many copies are salted in the joins.

Defined cases: null texts stay null, empty ones empty. A repeated line between lines that do not
repeat with it is no chunk and stays; a passage of only two lines goes where its window is a boundary
in both places. Lines are compared with the first copy of the chunk, so a line that repeats only
beside a later copy stays. Rows with one id and text are treated alike: what one loses the other
loses too. A chunk that repeats within a document keeps its first place. Extra columns are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import clear_name, let
from tidemark.operators.skew import hot_keys, skew_join
from tidemark.session import stage

WINDOW = 2
LEAST_CHARS = 40
# Kept lines that travel together.
BLOCK_BITS = 5

_CUT = r"(?<=\n)|(?<=[.!?] )"


def lines_of(text: Column) -> Column:
    """The lines, each with what ends it, so that joined they are the text again."""
    return F.split(text, _CUT, -1)


def boundary_chunks(lines: Column) -> Column:
    """Array of (first, digest) of the windows that are boundaries."""

    def rolled(hashes: Column) -> Column:
        firsts = F.slice(hashes, 1, F.greatest(F.size(hashes) - (WINDOW - 1), F.lit(0)))
        return F.transform(firsts, lambda _, i: F.xxhash64(*(F.get(hashes, i + j) for j in range(WINDOW))))

    def chosen(digests: Column) -> Column:
        def is_boundary(x: Column, i: Column) -> Column:
            beside = (x <= F.get(digests, i + 1)) | (x <= F.get(digests, i - 1))
            return F.coalesce(beside, F.size(digests) == 1)

        marked = F.transform(
            digests,
            lambda x, i: F.when(is_boundary(x, i), F.struct(i.alias("first"), x.alias("digest"))),
        )
        return F.filter(marked, lambda s: s.isNotNull())

    return let(let(F.transform(lines, lambda x: F.xxhash64(x)), rolled), chosen)


def _runs(places: Column) -> Column:
    """Ascending (first, count) of the adjoining numbers in a set."""

    def moved(by: int) -> Column:
        return F.transform(places, lambda x: x + by)

    starts = F.array_sort(F.array_except(places, moved(1)))
    ends = F.array_sort(F.array_except(places, moved(-1)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("count")))


def _covered(firsts: Column) -> Column:
    """Runs of the lines in the chunks at ``firsts`` and beside them."""
    around = F.array(*(F.transform(firsts, lambda x: x + j) for j in range(-1, WINDOW + 1)))
    return let(F.array_distinct(F.flatten(around)), _runs)


def _spans(runs: Column, lines: Column) -> Column:
    """The runs that are long enough to remove, as (first, count, chars)."""

    def measured(s: Column) -> Column:
        own = F.array_join(F.slice(lines, s["first"] + 1, s["count"]), "")
        return s.withField("chars", F.length(own))

    return F.filter(F.transform(runs, measured), lambda s: s["chars"] >= LEAST_CHARS)


def _without(lines: Column, spans: Column) -> Column:
    """(text, lines, chars): the text without the spans, and how much they are."""

    def before(s: Column, j: Column) -> Column:
        last = F.get(spans, j - 1)
        start = F.when(j == 0, 0).otherwise(last["first"] + last["count"])
        return F.array_join(F.slice(lines, start + 1, s["first"] - start), "")

    none = F.struct(
        F.size(lines).alias("first"), F.lit(0).alias("count"), F.lit(0).alias("chars")
    )

    def total(c: str) -> Column:
        return F.aggregate(spans, F.lit(0), lambda a, s: a + s[c])

    rest = let(
        F.concat(spans, F.array(none)),
        lambda every: F.array_join(F.transform(every, before), ""),
    )
    return F.struct(rest.alias("text"), total("count").alias("lines"), total("chars").alias("chars"))


def _overlays(rows: DataFrame) -> DataFrame:
    """Where a text is to be laid over a kept one: lines from ``start`` to ``stop``, in blocks of kept lines.

    Line ``i`` lies over line ``i + shift`` of the kept text. ``copies`` counts the rows that share the
    document's id and text.
    """
    chunks = stage(
        rows.where("text is not null")
        .select("id", "key", F.explode(boundary_chunks(lines_of(F.col("text")))).alias("s"))
        .select("id", "key", "s.*"),
        "line-chunks",
    )
    place = F.struct("id", "key", "first")
    groups = stage(
        chunks.groupBy("digest")
        .agg(F.count("*").alias("n"), F.min(place).alias("kept"))
        .where("n > 1"),
        "line-chunk-groups",
    )
    total = groups.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = hot_keys(groups, ["digest"], "n", total)
    others = skew_join(chunks, groups.drop("n"), ["digest"], "inner", hot).where(~place.eqNullSafe(F.col("kept")))
    laid = (
        others.groupBy(
            "id", "key", F.col("kept.id").alias("kept_id"), F.col("kept.key").alias("kept_key"),
            (F.col("kept.first") - F.col("first")).alias("shift"),
        )
        .agg(F.collect_set("first").alias("firsts"), F.count("*").alias("n"))
        .withColumn("copies", F.ceil(F.col("n") / F.size("firsts")))
        .withColumn("run", F.explode(_covered(F.col("firsts"))))
        .withColumn("first", F.greatest("run.first", F.lit(0), -F.col("shift")))
        .withColumn("end", F.col("run.first") + F.col("run.count"))
    )

    def block_of(line: Column) -> Column:
        return F.shiftright(line + F.col("shift"), BLOCK_BITS)

    def line_of(block: Column) -> Column:
        return F.shiftleft(block, BLOCK_BITS) - F.col("shift")

    blocks = F.sequence(block_of(F.col("first")), block_of(F.col("end") - 1))
    return laid.withColumn("block", F.explode(blocks)).select(
        "id", "key", "kept_id", "kept_key", "shift", "block", "copies",
        F.greatest("first", line_of(F.col("block"))).alias("start"),
        F.least("end", line_of(F.col("block") + 1)).alias("stop"),
    )


def _repeated_lines(rows: DataFrame) -> DataFrame:
    """(r_id, r_key, runs): the lines of each text that equal lines of a kept chunk's surroundings."""
    overlays = stage(_overlays(rows), "line-chunk-overlays")
    block = ["kept_id", "kept_key", "block"]
    counted = overlays.groupBy(*block).agg(F.sum("copies").alias("n"))
    total = overlays.agg(F.coalesce(F.sum("copies"), F.lit(0))).first()[0]
    hot = hot_keys(counted, block, "n", total)
    kept_first = F.shiftleft("block", BLOCK_BITS)
    kept_blocks = overlays.select(
        F.col("kept_id").alias("id"), F.col("kept_key").alias("key"), "kept_id", "kept_key",
        F.lit(None).cast("int").alias("shift"), "block",
        kept_first.alias("start"), (kept_first + (1 << BLOCK_BITS)).alias("stop"),
    ).distinct()
    wanted = stage(
        overlays.select(kept_blocks.columns)
        .unionByName(kept_blocks)
        .groupBy(F.col("id").alias("r_id"), F.col("key").alias("r_key"))
        .agg(F.collect_list(F.struct(*kept_blocks.columns[2:])).alias("list")),
        "line-chunk-wanted",
    )
    own = F.col("id").eqNullSafe(F.col("r_id")) & (F.col("key") == F.col("r_key"))
    cut = let(
        lines_of(F.col("text")),
        lambda lines: F.transform(
            "list",
            lambda s: s.withField("lines", F.slice(lines, s["start"] + 1, s["stop"] - s["start"])),
        ),
    )
    with_bytes = stage(
        rows.join(wanted, own).select("id", "key", F.explode(cut).alias("s")).select("id", "key", "s.*"),
        "line-chunk-bytes",
    )
    kept = with_bytes.where("shift is null").groupBy(*block).agg(F.first("lines").alias("kept_lines"))
    laid = skew_join(with_bytes.where("shift is not null"), kept, block, "inner", hot, nulls_match=True)
    offset = F.col("shift") - F.shiftleft("block", BLOCK_BITS)
    equal = F.filter(
        F.sequence(F.col("start"), F.col("stop") - 1),
        lambda i: F.get("lines", i - F.col("start")) == F.get("kept_lines", i + offset),
    )
    found = laid.select("id", "key", equal.alias("equal")).where(F.size("equal") > 0)
    per_doc = found.groupBy(F.col("id").alias("r_id"), F.col("key").alias("r_key")).agg(
        F.collect_set("equal").alias("sets")
    )
    runs = let(F.array_distinct(F.flatten("sets")), _runs)
    long_enough = F.filter(runs, lambda s: s["count"] >= WINDOW)
    return per_doc.select("r_id", "r_key", long_enough.alias("runs")).where(F.size("runs") > 0)


def remove_repeated_chunks(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with shorter texts, and the columns ``removed_lines``, ``removed_chars``."""
    spark_id, key, runs, rest, r_id, r_key = clear_name(
        docs, "chunk_id", "chunk_key", "chunk_runs", "chunk_rest", "r_id", "r_key"
    )
    text = F.col(text_col).cast("string")
    keyed = docs.withColumn(spark_id, F.col(id_col).cast("long")).withColumn(key, F.xxhash64(text))
    rows = keyed.select(F.col(spark_id).alias("id"), F.col(key).alias("key"), text.alias("text"))
    repeated = stage(_repeated_lines(rows), "line-chunk-removed").toDF(r_id, r_key, runs)
    same = F.col(spark_id).eqNullSafe(F.col(r_id)) & (F.col(key) == F.col(r_key))
    cleaned = let(
        lines_of(text),
        lambda lines: let(_spans(F.col(runs), lines), lambda spans: _without(lines, spans)),
    )
    joined = keyed.join(repeated, same, "left").withColumn(rest, F.when(F.col(runs).isNotNull(), cleaned))
    n_lines, n_chars = clear_name(docs, "removed_lines", "removed_chars")
    untouched = F.col(rest).isNull()
    cut_text = F.when(untouched, text).otherwise(F.col(rest)["text"])
    return joined.select(
        *(cut_text.alias(text_col) if c == text_col else F.col(c) for c in docs.columns),
        F.when(untouched, 0).otherwise(F.col(rest)["lines"]).alias(n_lines),
        F.when(untouched, 0).otherwise(F.col(rest)["chars"]).alias(n_chars),
    )
