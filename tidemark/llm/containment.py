"""Benchmark items inside documents: size-partitioned MinHash search, exact check.

Items are parted by the power of two of their number of shingles. The sketch of an item is its
``m`` smallest shingle hashes, where ``m`` depends on the part alone: the largest size ``u`` of
the part may lack ``u - ceil(t * u)`` shingles, and one more makes ``m``. So a document that
contains the share ``t`` of an item, however long it is, holds one of the ``m`` minima for sure;
no document has to be sketched, and no candidate is lost. Candidates are then checked by their
exact containment: distinct shingles of the item found in the document, over all of the item.

Words are runs of letters and digits, in lower case; a shingle is ``k`` of them, or the whole
sequence of a shorter text.

Defined cases: null and empty texts, and items without words, match nothing. Repeated rows of
documents give one pair; items with equal ids are one item with the shingles of all its rows.
Null ids are kept as they are. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import let
from tidemark.session import stage

K = 5
PERCENT = 80

_SEPARATOR = r"[^\p{L}\p{N}]+"


def _shingle_hashes(words: Column, k: int) -> Column:
    """Hashes of the ``k``-word shingles of an array of words, in order, with repeats."""

    def joined(array: Column) -> Column:
        starts = F.slice(array, 1, F.greatest(F.size(array) - (k - 1), F.lit(1)))
        return F.transform(
            starts, lambda h, i: F.xxhash64(h, *(F.get(array, i + j) for j in range(1, k)))
        )

    return let(F.transform(words, lambda w: F.xxhash64(w)), joined)


def _words(text: str) -> Column:
    found = F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SEPARATOR)
    return F.filter(found, lambda w: w != "")


def _with_hashes(rows: DataFrame, text: str, k: int, name: str) -> DataFrame:
    return rows.withColumn(name, _shingle_hashes(_words(text), k)).drop(text)


def find_contained(
    docs: DataFrame,
    items: DataFrame,
    k: int = K,
    percent: int = PERCENT,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(doc_id, text_key, item_id, n_item, n_shared): pairs with ``percent`` or more contained.

    ``text_key`` is a hash of the text, to tell rows with equal ids apart.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(F.col(text_col).cast("string")).alias("text_key"),
        F.col(text_col).cast("string").alias("text"),
    )
    item_rows = items.select(
        F.col(item_col).cast("long").alias("item_id"),
        F.col(item_text_col).cast("string").alias("text"),
    )
    grams = (
        _with_hashes(item_rows, "text", k, "grams")
        .select("item_id", F.explode("grams").alias("gram"))
        .distinct()
    )
    grams = stage(
        grams.withColumn("n_item", F.count("*").over(Window.partitionBy("item_id"))), "item-grams"
    )
    largest = F.pow(F.lit(2.0), F.floor(F.log2("n_item")) + 1) - 1
    minima = largest - F.ceil(largest * percent / 100) + 1
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("gram"))
    sketch = grams.withColumn("rank", rank).where(F.col("rank") <= minima).select("item_id", "gram")

    doc_grams = _with_hashes(rows, "text", k, "grams")
    candidates = stage(
        doc_grams.select("doc_id", "text_key", F.explode("grams").alias("gram"))
        .join(sketch, "gram")
        .select("doc_id", "text_key", "item_id")
        .distinct(),
        "leak-candidates",
    )
    keys = candidates.select(
        F.col("doc_id").alias("c_id"), F.col("text_key").alias("c_key")
    ).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("c_id")) & (F.col("text_key") == F.col("c_key"))
    suspects = rows.join(keys, same, "left_semi")
    shared = (
        _with_hashes(suspects, "text", k, "grams")
        .select("doc_id", "text_key", F.explode("grams").alias("gram"))
        .join(grams, "gram")
        .distinct()
    )
    counted = shared.groupBy("doc_id", "text_key", "item_id", "n_item").agg(
        F.count("*").alias("n_shared")
    )
    return counted.where(F.col("n_shared") * 100 >= F.col("n_item") * percent)


def leaking_documents(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared, containment), once for each pair."""
    per_pair = (
        find_contained(docs, items, **options)
        .groupBy("doc_id", "item_id", "n_item")
        .agg(F.max("n_shared").alias("n_shared"))
    )
    share = F.col("n_shared") / F.col("n_item")
    return per_pair.withColumn("containment", share)


def without_leaks(
    docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options
) -> DataFrame:
    """The rows of ``docs``, unchanged, that contain no item."""
    found = find_contained(docs, items, id_col=id_col, text_col=text_col, **options)
    leaks = stage(
        found.select(F.col("doc_id").alias("leak_id"), F.col("text_key").alias("leak_key")).distinct(),
        "leaks",
    )
    own_key = F.xxhash64(docs[text_col].cast("string"))
    same = docs[id_col].cast("long").eqNullSafe(leaks["leak_id"]) & (own_key == leaks["leak_key"])
    return docs.join(leaks, same, "left_anti")


def containment_sql(k: int = K, percent: int = PERCENT) -> str:
    """The result of ``leaking_documents`` over ``documents`` and ``benchmark`` as plain SQL."""
    grams = f"""
        SELECT DISTINCT id, unnest(CASE WHEN len(w) = 0 THEN []
            WHEN len(w) <= {k} THEN [array_to_string(w, ' ')]
            ELSE list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))
            END) AS gram
        FROM (SELECT :id AS id, list_filter(
            regexp_split_to_array(lower(coalesce(text, '')), '{_SEPARATOR}'), lambda x: x <> '') AS w
            FROM :table)"""
    return f"""
        WITH d AS ({grams.replace(":id", "doc_id").replace(":table", "documents")}),
             b AS ({grams.replace(":id", "item_id").replace(":table", "benchmark")}),
             n AS (SELECT id, count(*) AS n_item FROM b GROUP BY id)
        SELECT d.id AS doc_id, b.id AS item_id, n_item, count(*) AS n_shared,
               count(*) / n_item AS containment
        FROM d JOIN b USING (gram) JOIN n ON n.id = b.id
        GROUP BY d.id, b.id, n_item
        HAVING count(*) * 100 >= n_item * {percent}"""
