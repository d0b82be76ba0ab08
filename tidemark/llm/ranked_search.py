"""Ranked lexical search by MaxScore with pair bounds.

Documents are dealt into blocks. A block keeps, for each term that the queries ask for, its list of
documents, and for pairs of terms that stand side by side in a query's order their intersection list
with the largest joint impact. A document that holds both terms of a pair adds at most that joint
maximum, one that holds only one of them at most that term's own maximum. At query time the bounds of
a query's weakest terms are combined, pairs or single terms, whichever is tighter. Documents that hold
none but terms whose bound stays below the threshold are skipped, and a candidate is given up as soon
as its score and the bound of what is left cannot reach the threshold.

The results are those of scoring every document.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from tidemark.llm.common import arrow_batches_of, text_rows
from tidemark.session import stage

# Documents and bytes of text in a block.
BLOCK_DOCS = 8192
BLOCK_BYTES = 64 << 20

# Bytes of query text answered in one pass over the documents; longer query sets take several.
# A query counts for its text and ROW_BYTES.
ROUND_BYTES = 8 << 20
ROW_BYTES = 64

# Strongest terms of a query whose partial scores give the first threshold.
LEAD_TERMS = 8

# Letters, digits and all that is not ASCII make terms; only A-Z are lower-cased.
_TERM_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)
# The same in the syntax of RE2.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


@dataclass(frozen=True)
class QuerySet:
    """Queries of one pass: their ids, and the numbers of their terms in ``terms``."""

    ids: list
    queries: list[np.ndarray]
    terms: list[bytes]


def query_sets(items: DataFrame, id_col: str, text_col: str) -> Iterator[QuerySet]:
    """The different (id, text) rows of ``items`` in rounds of some bytes of text."""
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).where("text <> ''").distinct()
    total = rows.agg(F.sum(F.octet_length("text") + ROW_BYTES)).first()[0] or 0
    rounds = -(-total // ROUND_BYTES)
    for number in range(rounds):
        mine = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(rounds)) == number)
        numbers: dict[bytes, int] = {}
        ids, queries = [], []
        for row in mine.sort("id", "text").collect():
            found = sorted(set(terms_of(row["text"].encode())))
            ids.append(row["id"])
            queries.append(np.array([numbers.setdefault(t, len(numbers)) for t in found], np.int64))
        yield QuerySet(ids, queries, list(numbers))


_LISTS = "block long, ids array<{0}>, lengths binary, terms binary, sizes binary, docs binary, counts binary"


def term_lists(docs: DataFrame, terms: list[bytes], id_col: str, text_col: str) -> DataFrame:
    """A row for each block of documents with the lists of ``terms``.

    ``lengths`` has the terms of each document, with repeats and whether asked for or not. List
    ``terms[i]`` holds the next ``sizes[i]`` of ``docs`` (places in the block, rising) and ``counts``.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    numbers = {t: i for i, t in enumerate(terms)}
    schema = _LISTS.format(kind)

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids, lengths, found = [], [], []
        size = 0

        def packed() -> pa.RecordBatch:
            each = np.fromiter(map(len, found), np.int64, len(found))
            places = np.repeat(np.arange(len(found), dtype=np.int32), each)
            total = int(each.sum())
            term = np.fromiter((t for f in found for t in f), np.int32, total)
            count = np.fromiter((c for f in found for c in f.values()), np.int32, total)
            order = np.argsort(term, kind="stable")
            used, sizes = np.unique(term, return_counts=True)
            values = (np.array(lengths, np.int64), used, sizes.astype(np.int32), places[order], count[order])
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), pa.array([ids], arrow_ids)]
                + [pa.array([v.tobytes()], pa.binary()) for v in values],
                names=["block", "ids", "lengths", "terms", "sizes", "docs", "counts"],
            )

        arrow_ids = None
        for batch in batches:
            arrow_ids = pa.list_(batch.schema.field(id_col).type)
            for key, text in text_rows(batch, id_col, text_col):
                words = terms_of(text)
                ids.append(key)
                lengths.append(len(words))
                asked = Counter(map(numbers.get, words))
                asked.pop(None, None)
                found.append(asked)
                size += len(text)
                if len(ids) == BLOCK_DOCS or size >= BLOCK_BYTES:
                    yield packed()
                    ids, lengths, found, size, block = [], [], [], 0, block + 1
        if ids:
            yield packed()

    return docs.select(id_col, text_col).mapInArrow(emit, schema)


def _rows(batches: Iterator[pa.RecordBatch], *names: str) -> Iterator[list]:
    for batch in batches:
        columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
        for i in range(batch.num_rows):
            yield [c[i] for c in columns]


def _array(value: pa.Scalar, kind: str) -> np.ndarray:
    return np.frombuffer(value.as_py(), kind)


def collection_counts(lists: DataFrame, terms: int) -> tuple[int, int, np.ndarray]:
    """Documents with a term, terms of all documents, and documents holding each asked term."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, holding = np.zeros(2, np.int64), np.zeros(terms, np.int64)
        for lengths, used, sizes in _rows(batches, "lengths", "terms", "sizes"):
            n = _array(lengths, "<i8")
            total += ((n > 0).sum(), n.sum())
            holding[_array(used, "<i4")] += _array(sizes, "<i4")
        some = holding.nonzero()[0]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], some])), pa.array(np.concatenate([total, holding[some]]))],
            names=["term", "n"],
        )

    counted = lists.mapInArrow(emit, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    found = {r["term"]: r["n"] for r in counted.collect()}
    holding = np.array([found.get(t, 0) for t in range(terms)], np.int64)
    return found.get(-2, 0), found.get(-1, 0), holding


def term_weights(documents: int, holding: np.ndarray) -> np.ndarray:
    ratio = [(2 * documents + 2) / (2 * int(df) + 1) for df in holding]
    return np.array([math.floor(1000 * math.log(r)) for r in ratio], np.int64)


def _norms(lengths: np.ndarray, documents: int, total: int) -> np.ndarray:
    """Ten and ninety times the length over the mean length, rounded down."""
    if 90 * int(lengths.max(initial=0)) * documents < 1 << 63:
        return 10 + (90 * lengths * documents) // total
    return np.array([10 + 90 * int(n) * documents // total for n in lengths], np.int64)


@dataclass(frozen=True)
class Plan:
    """Queries with their terms in rising order of weight, and the pairs of neighbours in it."""

    queries: list[np.ndarray]
    pairs: list[np.ndarray]
    first: np.ndarray
    second: np.ndarray


def plan_queries(queries: list[np.ndarray], weights: np.ndarray, holding: np.ndarray) -> Plan:
    """Terms that no document holds, or that weigh nothing, add nothing and are left out."""
    numbers: dict[tuple[int, int], int] = {}
    ordered, pairs = [], []
    for query in queries:
        query = query[(holding[query] > 0) & (weights[query] > 0)]
        query = query[np.lexsort((query, weights[query]))]
        beside = zip(query[:-1].tolist(), query[1:].tolist())
        ordered.append(query)
        pairs.append(np.array([numbers.setdefault(p, len(numbers)) for p in beside], np.int64))
    both = np.array(list(numbers), np.int64).reshape(-1, 2)
    return Plan(ordered, pairs, both[:, 0], both[:, 1])


_IMPACTS = "block long, ids array<{0}>, terms binary, sizes binary, docs binary, impacts binary, " \
    "pair_sizes binary, pair_docs binary, pair_most binary, leads binary"  # fmt: skip


class _Lists:
    """The lists of a block by term number: places of documents and a value for each."""

    def __init__(self, terms: np.ndarray, sizes: np.ndarray, docs: np.ndarray, values: np.ndarray):
        self.ends = np.cumsum(sizes, dtype=np.int64)
        self.at = {t: i for i, t in enumerate(terms.tolist())}
        self.docs, self.values = docs, values

    def _span(self, term: int) -> slice:
        i = self.at.get(term)
        return slice(0, 0) if i is None else slice(self.ends[i - 1] if i else 0, self.ends[i])

    def get(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        span = self._span(term)
        return self.docs[span], self.values[span]

    def docs_of(self, term: int) -> np.ndarray:
        return self.docs[self._span(term)]


def _highest(scores: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` highest of some values, or all."""
    return scores if len(scores) <= k else np.partition(scores, len(scores) - k)[-k:]


def impact_lists(
    lists: DataFrame, plan: Plan, weights: np.ndarray, documents: int, total: int, k: int
) -> DataFrame:
    """The blocks with impacts in place of counts, and the lists of the plan's pairs.

    Pair ``i`` has the next ``pair_sizes[i]`` of ``pair_docs``, the documents of the block that hold
    both terms, and their largest joint impact ``pair_most[i]``. ``leads`` has for each query the ``k``
    highest scores of the block over its strongest terms alone.
    """
    ids = lists.schema["ids"].dataType.elementType.simpleString()
    schema = _IMPACTS.format(ids)
    names = ["block", "ids", "lengths", "terms", "sizes", "docs", "counts"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, keys, *rest in _rows(batches, *names):
            lengths, used, sizes, docs, counts = (
                _array(v, t) for v, t in zip(rest, ("<i8", "<i4", "<i4", "<i4", "<i4"))
            )
            tf = counts.astype(np.int64)
            norm = _norms(lengths, documents, total)
            impacts = weights[np.repeat(used, sizes)] * (
                (1_000_000_000 * tf) // (1000 * tf + 8 * norm[docs])
            )
            held = _Lists(used, sizes, docs, impacts)
            pair_sizes = np.zeros(len(plan.first), np.int32)
            pair_most = np.zeros(len(plan.first), np.int64)
            pair_docs = []
            dense = np.zeros(len(lengths), np.int64)
            for i, (a, b) in enumerate(zip(plan.first.tolist(), plan.second.tolist())):
                (short, value), (long, more) = sorted((held.get(a), held.get(b)), key=lambda x: len(x[0]))
                if not len(short):
                    continue
                dense[long] = more
                both = dense[short]
                dense[long] = 0
                inside = both > 0
                if inside.any():
                    pair_sizes[i] = inside.sum()
                    pair_most[i] = (value + both)[inside].max()
                    pair_docs.append(short[inside])
            leads = np.zeros((len(plan.queries), k), np.int64)
            for q, query in enumerate(plan.queries):
                for term in query[-LEAD_TERMS:].tolist():
                    places, value = held.get(term)
                    dense[places] += value
                best = _highest(dense, k)
                leads[q, : len(best)] = best
                dense[:] = 0
            values = (used, sizes, docs, impacts, pair_sizes,
                      np.concatenate([*pair_docs, np.zeros(0, np.int32)]).astype(np.int32), pair_most, leads)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block.as_py()], pa.int64()), pa.array([keys.as_py()], keys.type)]
                + [pa.array([v.tobytes()], pa.binary()) for v in values],
                names=["block", "ids", "terms", "sizes", "docs", "impacts",
                       "pair_sizes", "pair_docs", "pair_most", "leads"],
            )

    return lists.mapInArrow(emit, schema)


def first_thresholds(blocks: DataFrame, queries: int, k: int) -> np.ndarray:
    """For each query a score that ``k`` documents are known to reach, else zero."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = np.zeros((queries, k), np.int64)
        for (leads,) in _rows(batches, "leads"):
            own = _array(leads, "<i8").reshape(queries, k)
            best = np.sort(np.concatenate([best, own], axis=1), axis=1)[:, -k:]
        query, _ = (some := best > 0).nonzero()
        yield pa.RecordBatch.from_arrays([pa.array(query), pa.array(best[some])], names=["query", "score"])

    found = blocks.select("leads").mapInArrow(emit, "query long, score long")
    place = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score")))
    out = np.zeros(queries, np.int64)
    for row in found.withColumn("place", place).where(F.col("place") <= k).where(F.col("place") == k).collect():
        out[row["query"]] = row["score"]
    return out


def combined_bounds(single: np.ndarray, joint: np.ndarray) -> np.ndarray:
    """Bounds of the first 0, 1, 2, ... terms of a query.

    ``single`` has each term's largest impact, ``joint`` each pair's of neighbours. Of all ways to cover
    the first terms by pairs and single ones the smallest sum is taken.
    """
    out = [0]
    for i, one in enumerate(single.tolist()):
        bound = out[-1] + one
        if i:
            pair = max(int(joint[i - 1]), one, int(single[i - 1]))
            bound = min(bound, out[-2] + pair)
        out.append(bound)
    return np.array(out, np.int64)


def _search(
    query: np.ndarray, lists: _Lists, pairs: np.ndarray, both: _Lists, size: int, threshold: int, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Documents of a block that may be among the best ``k`` and reach the threshold, with scores."""
    held = [lists.get(t) for t in query.tolist()]
    single = np.array([v.max(initial=0) for _, v in held], np.int64)
    joint = both.values[pairs]
    bounds = combined_bounds(single, joint)
    threshold = max(threshold, 1)
    if bounds[-1] < threshold:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    # the most terms that together stay below the threshold: alone they make no candidate
    weak = int(np.searchsorted(bounds, threshold)) - 1
    more = np.zeros(0, np.int32)
    if weak and bounds[weak - 1] + max(single[weak - 1 : weak + 1]) < threshold:
        # nor does one term more, but in documents that hold both terms of the last pair
        more = both.docs_of(int(pairs[weak - 1]))
        weak += 1
    scores = np.zeros(size, np.int64)
    for places, value in held[weak:]:
        scores[places] += value
    found = np.union1d(scores.nonzero()[0], more)
    for i in range(weak - 1, -1, -1):
        if len(found) > k:
            threshold = max(threshold, int(_highest(scores[found], k).min()))
        found = found[scores[found] + bounds[i + 1] >= threshold]
        places, value = held[i]
        if not len(places) or not len(found):
            continue
        at = np.minimum(np.searchsorted(places, found), len(places) - 1)
        hit = places[at] == found
        scores[found[hit]] += value[at[hit]]
    if len(found) > k:
        threshold = max(threshold, int(_highest(scores[found], k).min()))
    found = found[scores[found] >= threshold]
    return found, scores[found]


def search_blocks(blocks: DataFrame, plan: Plan, thresholds: np.ndarray, k: int) -> DataFrame:
    """(query, doc_id, score): each block's documents that may be among a query's best ``k``."""
    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    names = ["ids", "terms", "sizes", "docs", "impacts", "pair_sizes", "pair_docs", "pair_most"]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, *rest in _rows(batches, *names):
            used, sizes, docs, impacts, pair_sizes, pair_docs, most = (
                _array(v, t) for v, t in zip(rest, ("<i4", "<i4", "<i4", "<i8", "<i4", "<i4", "<i8"))
            )
            lists = _Lists(used, sizes, docs, impacts)
            both = _Lists(np.arange(len(pair_sizes)), pair_sizes, pair_docs, most)
            numbers, places, scores = [], [], []
            for q, query in enumerate(plan.queries):
                if len(query):
                    found, score = _search(query, lists, plan.pairs[q], both, len(keys), int(thresholds[q]), k)
                    numbers.append(np.full(len(found), q))
                    places.append(found)
                    scores.append(score)
            if numbers:
                ids = keys.values.take(pa.array(np.concatenate(places)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(numbers)), ids, pa.array(np.concatenate(scores))],
                    names=["query", "doc_id", "score"],
                )

    return blocks.mapInArrow(emit, f"query long, doc_id {kind}, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    doc_id: str = "doc_id",
    doc_text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """The ``k`` highest-scoring documents of every item, equal scores by rising id, null ids last.

    Only documents with a score above zero are returned, so an item that is null, empty or shares no
    term with a document has no row, nor has any item where documents are empty. Every row of ``docs``
    is a document of its own, also where rows repeat. Items that repeat id and text are one, items that
    share only the id or have a null id each have their own list. Other columns are left out.
    """
    spark = docs.sparkSession
    schema = f"item_id {items.schema[item_id].dataType.simpleString()}, rank int, " \
        f"doc_id {docs.schema[doc_id].dataType.simpleString()}, score long"  # fmt: skip
    out = spark.createDataFrame([], schema)
    for asked in query_sets(items, item_id, item_text):
        lists = stage(term_lists(docs, asked.terms, doc_id, doc_text), "search-lists")
        # a row is a whole block
        with arrow_batches_of(spark, 1):
            documents, total, holding = collection_counts(lists, len(asked.terms))
            if not total:
                break
            weights = term_weights(documents, holding)
            plan = plan_queries(asked.queries, weights, holding)
            blocks = stage(impact_lists(lists, plan, weights, documents, total, k), "search-impacts")
            thresholds = first_thresholds(blocks, len(plan.queries), k)
            found = stage(search_blocks(blocks, plan, thresholds, k), "search-found")
        order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        ids = spark.createDataFrame(list(enumerate(asked.ids)), f"query long, {schema.split(', ')[0]}")
        best = ranked.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")
        out = out.unionByName(best)
    return out


def search_sql(k: int = 10) -> str:
    """The registered query over ``documents`` and ``benchmark`` as SQL."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH words AS (
    SELECT doc, doc_id, unnest(regexp_extract_all({lower}, '{TERM}')) AS term
    FROM (SELECT row_number() OVER () AS doc, doc_id, text FROM documents)),
asked AS (
    SELECT DISTINCT item_id, text, unnest(regexp_extract_all({lower}, '{TERM}')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)),
sizes AS (SELECT doc, doc_id, count(*) AS n FROM words GROUP BY doc, doc_id),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM sizes),
counts AS (SELECT doc, term, count(*) AS tf FROM words
           WHERE term IN (SELECT term FROM asked) GROUP BY doc, term),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM counts, whole GROUP BY term, docs),
norms AS (SELECT doc, doc_id, 10 + (90 * n * docs) // total AS m FROM sizes, whole),
scores AS (
    SELECT a.item_id, a.text, c.doc, m.doc_id,
           CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked a JOIN counts c ON c.term = a.term JOIN weights g ON g.term = a.term
    JOIN norms m ON m.doc = c.doc
    GROUP BY a.item_id, a.text, c.doc, m.doc_id)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id, text
                                   ORDER BY score DESC, doc_id NULLS LAST) AS rank
      FROM scores WHERE score > 0)
WHERE rank <= {k}"""
