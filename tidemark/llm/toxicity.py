"""Toxic passages as maximum-scoring segments of token log-odds, with extreme-value calibration.

* Tokens are hashed into ``2**TABLE_BITS`` cells. Three tables of that fixed size count the rows
  that have a cell: all rows, labelled toxic, labelled clean. The corpus counts, scaled to the sum
  of the toxic ones, are the Dirichlet prior of both classes.
* A cell's score is the lower ``Z`` bound of its log-odds ratio, if at least ``LEAST_GAIN``; every
  token costs ``COST``. So a stretch of text scores high only where toxic tokens are dense.
* A linear scan finds all maximal scoring segments of a text: segments whose score no extension
  and no other segment can raise.
* With ``lambda`` solved from the background distribution and ``K`` fitted on clean rows, a segment
  of score S in a text of n tokens has the evidence ``lambda * S - ln(K * n)``, the extreme-value
  exponent; segments with positive evidence are significant and add up.
* A logistic curve, fitted on the labelled rows, turns the evidence into the score.

At most ``LABEL_ROWS`` labelled rows are learned from (those with the smallest hash of their id);
counts of the prior, the scan and the scores cover all rows.

Defined cases: a null or empty text has no tokens and the score of no evidence. Repeated rows score
alike. A document with several labels is toxic if one says so; null labels or ids teach nothing.
With only one class of labels, every score is the share of toxic labels. Extra columns stay.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import CACHE_WORDS, clear_name, count_table

TABLE_BITS = 18
# Bound of the labelled rows learned from; 64 thousand narrow rows may be broadcast.
LABEL_ROWS = 1 << 16
Z = 2.1
LEAST_GAIN = 0.7
COST = 0.05
THRESHOLD = 0.7

_TOKEN = re.compile(r"\w+")


class _Cells(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[token] = zlib.crc32(token.encode()) >> (32 - TABLE_BITS)
        return value

    def of(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text.lower())
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


def _counter(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
    cells, total = _Cells(), np.zeros((3, 1 << TABLE_BITS), np.int64)
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            rows = batch.slice(start, 512)
            found: list[list[np.ndarray]] = [[], [], []]
            for text, toxic in zip(*(rows.column(i).to_pylist() for i in range(2))):
                own = np.unique(cells.of(text or ""))
                found[0].append(own)
                if toxic is not None:
                    found[1 if toxic else 2].append(own)
            for t, parts in zip(total, found):
                if parts:
                    np.add.at(t, np.concatenate(parts), 1)
    return total.ravel()


@dataclass(frozen=True)
class ToxicityModel:
    scores: np.ndarray
    scale: float
    log_k: float
    bias: float
    slope: float

    def chance(self, evidence) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.bias + self.slope * np.log1p(evidence))))


def maximal_segments(hits: list[int], gains: list[float], cost: float) -> list[tuple]:
    """All maximal scoring segments (first token, token after the last, score), in text order.

    ``hits`` are the ascending places of tokens that gain; all others cost ``cost``. The scan keeps
    segments that might still grow. A new one is joined to the last whose running total before it
    was lower, if the totals behind it rise; every segment is put on the list and taken off once.
    """
    # first token, end, total before, total after, and the last earlier segment that starts lower
    kept: list[tuple] = []
    total, at = 0.0, 0
    for place, gain in zip(hits, gains):
        low = total - cost * (place - at)
        first, total, at = place, low + gain, place + 1
        if gain <= 0:
            continue
        j = len(kept) - 1
        while True:
            while j >= 0 and kept[j][2] >= low:
                j = kept[j][4]
            if j < 0 or kept[j][3] >= total:
                break
            first, low, before = kept[j][0], kept[j][2], kept[j][4]
            del kept[j:]
            j = before
        kept.append((first, place + 1, low, total, j))
    return [(a, b, high - low) for a, b, low, high, _ in kept]


def _evidence(cells: np.ndarray, model: ToxicityModel) -> tuple[float, list[tuple]]:
    hits = np.flatnonzero(model.scores[cells] > 0) if len(cells) else []
    if not len(hits):
        return 0.0, []
    gains = model.scores[cells[hits]] - COST
    level = model.log_k + np.log(len(cells))
    found = [
        (a, b, model.scale * s - level)
        for a, b, s in maximal_segments(hits.tolist(), gains.tolist(), COST)
        if model.scale * s > level
    ]
    return float(sum(e for _, _, e in found)), found


def _log_odds(counts: np.ndarray) -> np.ndarray:
    corpus, toxic, clean = (c.astype(float) for c in counts.reshape(3, -1))
    n_toxic, n_clean = toxic.sum(), clean.sum()
    if not n_toxic or not n_clean:
        return np.zeros(len(corpus))
    prior = corpus / corpus.sum() * n_toxic + 0.5
    a, b = toxic + prior, clean + prior
    ratio = np.log(a / (2 * n_toxic - a)) - np.log(b / (n_toxic + n_clean - b))
    lower = ratio - Z * np.sqrt(1 / a + 1 / b)
    return np.where(lower >= LEAST_GAIN, lower, 0)


def _scale(scores: np.ndarray, background: np.ndarray) -> float:
    """The positive root of ``sum(p * exp(x * s)) = 1``; exists as the mean score is negative."""
    own = np.flatnonzero(scores)
    p, s = background[own], scores[own] - COST
    rest = 1 - p.sum()

    def above(x):
        return (p * np.exp(x * s)).sum() + rest * np.exp(-x * COST) > 1

    low, high = 1e-6, 50.0 / max(1e-9, s.max(initial=1e-9))
    if not len(own) or above(low):
        return 0.0
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (low, mid) if above(mid) else (mid, high)
    return (low + high) / 2


def _fit_logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Maximum likelihood by Newton steps, with a light ridge so that separable rows converge."""
    design, weights = np.stack([np.ones(len(x)), x], axis=1), np.zeros(2)
    ridge = np.diag([1e-3, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-design @ weights))
        slope = design.T @ (y - p) - ridge @ weights
        curve = (design * (p * (1 - p))[:, None]).T @ design + ridge
        step = np.linalg.solve(curve, slope)
        weights = weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return float(weights[0]), float(weights[1])


def held_out(id_col: str | Column) -> Column:
    """Rows whose labels are never learned: crc32 of the id as text, mod 3, is 1; null ids too."""
    rest = F.crc32(F.col(id_col).cast("string").cast("binary")) % 3
    return F.coalesce(rest == 1, F.lit(True))


def _known_labels(labels: DataFrame, rows: int) -> DataFrame:
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out("doc_id"))
    per_doc = known.groupBy(F.col("doc_id").cast("long").alias("_label_id")).agg(
        (F.max("toxic") > 0).alias("_toxic")
    )
    return per_doc.orderBy(F.xxhash64("_label_id"), "_label_id").limit(rows)


def _seen(batches: Iterator[pa.RecordBatch], model: ToxicityModel) -> Iterator[pa.RecordBatch]:
    """Evidence of labelled rows, and the best raw score and length for the fit of K."""
    cells = _Cells()
    for batch in batches:
        lengths, segments = [], []
        for text in batch.column(1).to_pylist():
            own = cells.of(text or "")
            hits = np.flatnonzero(model.scores[own] > 0) if len(own) else np.zeros(0, np.int64)
            gains = model.scores[own[hits]] - COST if len(hits) else hits
            found = maximal_segments(hits.tolist(), gains.tolist(), COST)
            lengths.append(len(own))
            segments.append([s for _, _, s in found])
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(lengths, pa.int64()),
                pa.array(segments, pa.list_(pa.float64())),
                batch.column(2),
            ],
            names=["id", "n", "segments", "toxic"],
        )


def fit_toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_rows: int = LABEL_ROWS,
) -> ToxicityModel:
    """Learn from ``labels`` (doc_id, toxic) of rows that are not held out.

    Counts are over all rows. The evidence is weighed once for each labelled id: of rows that share one,
    the shortest counts (of equally long ones that with the smaller segments).
    """
    texts = docs.select(
        F.col(text_col).cast("string").alias("text"), F.col(id_col).cast("long").alias("_label_id")
    )
    known = F.broadcast(_known_labels(labels, label_rows))
    counted = texts.join(known, "_label_id", "left").select("text", "_toxic")
    counts = count_table(counted, _counter, 3 << TABLE_BITS)
    scores = _log_odds(counts)
    corpus, _, clean = counts.reshape(3, -1)
    share = corpus / max(1, corpus.sum())
    prior = share * max(1, counts.reshape(3, -1)[1].sum())
    background = (clean + prior) / max(1.0, clean.sum() + prior.sum())
    scale = _scale(scores, background)
    raw = ToxicityModel(scores, scale, 0.0, 0.0, 0.0)
    # at most ``label_rows`` ids of a few numbers, in their order so that reruns fit alike
    found = texts.join(known, "_label_id").select("_label_id", "text", "_toxic").mapInArrow(
        lambda it: _seen(it, raw), "id long, n long, segments array<double>, toxic boolean"
    )
    one = found.groupBy("id").agg(F.min(F.struct("n", "segments", "toxic")).alias("one"))
    seen = [r["one"] for r in sorted(one.collect(), key=lambda r: r["id"])]
    n_toxic = sum(r["toxic"] for r in seen)
    if not n_toxic or n_toxic == len(seen):
        share_toxic = (n_toxic + 0.5) / (len(seen) + 1)
        return ToxicityModel(scores, scale, 0.0, float(np.log(share_toxic / (1 - share_toxic))), 0.0)
    clean_rows = [r for r in seen if not r["toxic"] and r["n"]]
    best = [scale * max(r["segments"], default=0.0) - np.log(r["n"]) for r in clean_rows]
    log_k = float(np.mean(best) - np.euler_gamma) if best else 0.0

    def evidence(r) -> float:
        level = log_k + np.log(r["n"]) if r["n"] else 0.0
        return sum(max(0.0, scale * s - level) for s in r["segments"])

    x = np.log1p([evidence(r) for r in seen])
    bias, slope = _fit_logistic(x, np.array([float(r["toxic"]) for r in seen]))
    return ToxicityModel(scores, scale, log_k, bias, max(0.0, slope))


def _mapper(model: ToxicityModel, text_at: int, passages: bool) -> Callable:
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells()
        for batch in batches:
            values, spans = [], []
            for start in range(0, batch.num_rows, 512):
                for text in batch.column(text_at).slice(start, 512).to_pylist():
                    value, found = _evidence(cells.of(text or ""), model)
                    values.append(value)
                    if passages:
                        spans.append([{"first": a, "last": b - 1, "evidence": e} for a, b, e in found])
            columns = [c for i, c in enumerate(batch.columns) if passages or i != text_at]
            names = [c for i, c in enumerate(batch.schema.names) if passages or i != text_at]
            columns.append(pa.array(model.chance(np.array(values)), pa.float64()))
            names.append("score")
            if passages:
                kind = pa.struct(
                    [("first", pa.int64()), ("last", pa.int64()), ("evidence", pa.float64())]
                )
                columns.append(pa.array(spans, pa.list_(kind)))
                names.append("passages")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return score


def score_toxicity(
    docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, held_out, score, predicted), a row for each row of ``docs``."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_mapper(model, 1, False), "id long, score double").select(
        F.col("id").alias(id_col),
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def toxic_passages(docs: DataFrame, model: ToxicityModel, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score`` and ``passages``: the significant segments by token number."""
    score, passages = clear_name(docs, "score", "passages")
    at = docs.columns.index(text_col)
    names = docs.columns
    plain = docs.toDF(*(f"c{i}" for i in range(len(names))))
    fields = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    schema = (
        f"{fields}, score double, passages array<struct<first: long, last: long, evidence: double>>"
    )
    return plain.mapInArrow(_mapper(model, at, True), schema).toDF(*names, score, passages)


def keep_clean(
    docs: DataFrame, model: ToxicityModel, text_col: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The rows of ``docs`` below the threshold, unchanged."""
    scored = toxic_passages(docs, model, text_col)
    return scored.where(F.col(scored.columns[-2]) < threshold).select(docs.columns)
