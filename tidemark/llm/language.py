"""Language of texts by Bayesian fusion of text, declared language, address suffix and host.

* Text: word counts per language over all labelled rows, hashed into ``2**TABLE_BITS`` cells of a
  table of fixed size. The log-likelihood of a text is its mean over tokens, times at most
  ``MOST_TOKENS``: neighbouring words are not independent, so a long text is not worth more.
* Host: a grouped aggregation adds up the text-only posteriors per host, domain and in all. The
  prior of a host is smoothed towards that of its domain, and that towards the corpus. A row's own
  posterior is taken out of its host and domain first, so no row is evidence for itself.
* Declared language and address suffix: how often a language goes with each value, from the same
  posteriors, smoothed towards the language's share; a missing value says nothing.
* The logarithms are added and normalised.

Every label is a language. The model is a table of languages times cells of four bytes that every worker
holds (1 MB for each language); counting takes ``LANGUAGES_AT_ONCE`` languages to a pass over their rows.

Defined cases: a null or empty text has no text evidence; null or malformed addresses have no host
and no suffix. Repeated rows are equal evidence, each counted. Null ids are kept. An empty table
gives an empty result. With no labelled text there are no languages and the result is null. Extra
columns of any name are kept; the result's own get a leading underscore where a name is taken.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import CACHE_WORDS, TEXT_ROWS, arrow_batches_of, clear_name, count_table, give_back
from tidemark.session import stage

TABLE_BITS = 18
LANGUAGES_AT_ONCE = 16
MOST_TOKENS = 40.0
# Smoothing weights, in rows: of the domain for a host, of the corpus for a domain, of a cue.
HOST_WEIGHT = 5.0
DOMAIN_WEIGHT = 20.0
CUE_WEIGHT = 2.0
# Copies of each host's row in the join, so that one host with a third of all rows is spread.
SALTS = 16

_TOKEN = re.compile(r"\w+")
_MARKUP = re.compile(r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>")


class _Cells(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[token] = zlib.crc32(token.encode()) >> (32 - TABLE_BITS)
        return value

    def of(self, text: str) -> np.ndarray:
        tokens = _TOKEN.findall(text.lower())
        return np.fromiter(map(self.__getitem__, tokens), np.int64, len(tokens))


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    logs: np.ndarray


def fit_languages(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang"
) -> LanguageModel:
    """Word likelihoods of the labels of ``docs``. Null labels and texts say nothing."""
    lang = F.col(lang_col).cast("string")
    names = tuple(sorted(r[0] for r in docs.where(lang.isNotNull()).select(lang).distinct().collect()))
    if not names:
        return LanguageModel((), np.zeros((0, 1 << TABLE_BITS)))
    rows = docs.select(F.col(text_col).cast("string").alias("text"), lang.alias("lang"))

    def counts_of(some: tuple[str, ...]) -> np.ndarray:
        index = {n: i for i, n in enumerate(some)}

        def count(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            cells, total = _Cells(), np.zeros((len(some), 1 << TABLE_BITS), np.int64)
            for batch in batches:
                for start in range(0, batch.num_rows, 512):
                    part = batch.slice(start, 512)
                    for text, label in zip(*(part.column(i).to_pylist() for i in range(2))):
                        np.add.at(total[index[label]], cells.of(text or ""), 1)
            return total.ravel()

        own = rows.where(F.col("lang").isin(*some))
        return count_table(own, count, len(some) << TABLE_BITS).reshape(len(some), -1)

    groups = [names[i : i + LANGUAGES_AT_ONCE] for i in range(0, len(names), LANGUAGES_AT_ONCE)]
    counts = np.concatenate([counts_of(g) for g in groups])
    corpus = (counts.sum(axis=0) + 0.01) / (counts.sum() + 0.01 * counts.shape[1])
    weight = 1000.0
    smoothed = (counts + weight * corpus) / (counts.sum(axis=1, keepdims=True) + weight)
    return LanguageModel(names, np.log(smoothed).astype(np.float32))


def _text_evidence(model: LanguageModel, html: bool):
    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = _Cells()
        for batch in batches:
            out = np.zeros((batch.num_rows, len(model.languages)))
            row = 0
            for start in range(0, batch.num_rows, 256):
                for text in batch.column(0).slice(start, 256).to_pylist():
                    text = text or ""
                    own = cells.of(_MARKUP.sub(" ", text) if html else text)
                    if len(own):
                        found = model.logs[:, own].mean(axis=1, dtype=np.float64)
                        found = found * min(len(own), MOST_TOKENS)
                        out[row] = found - found.max()
                    row += 1
            flat = pa.array(out.ravel(), pa.float64())
            ends = pa.array(np.arange(batch.num_rows + 1) * out.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[1:], pa.ListArray.from_arrays(ends, flat)],
                names=[*batch.schema.names[1:], "logs"],
            )
        give_back()

    return score


def _softmax(logs: Column) -> Column:
    """Normalised exponentials of an array whose largest value is brought to zero first."""
    top = F.transform(logs, lambda x: F.exp(x - F.array_max(logs)))
    return F.transform(top, lambda x: x / F.aggregate(top, F.lit(0.0), lambda a, b: a + b))


def host_of(url: str | Column) -> Column:
    host = F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)
    return F.when(host != "", host)


def domain_of(host: Column) -> Column:
    return F.coalesce(F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)


def suffix_of(host: Column) -> Column:
    suffix = F.regexp_extract(host, r"\.([a-z][a-z0-9-]*)$", 1)
    return F.when(suffix != "", suffix)


def declared_language(html: str | Column) -> Column:
    """The main subtag of the ``lang`` of the ``html`` element."""
    lang = F.regexp_extract(html, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    return F.when(lang != "", F.lower(lang))


def identify_languages(records: DataFrame, model: LanguageModel, html: bool) -> DataFrame:
    """``records`` without their text, with ``lang``, ``probability`` and ``text_lang``.

    ``records`` has the columns ``text``, ``declared``, ``suffix``, ``host``, ``domain`` (each may
    be null) and any others, which are kept.
    """
    from pyspark.sql import types as T

    names, n = list(model.languages), len(model.languages)
    given = [c for c in records.columns if c != "text"]
    out_lang, out_probability, out_text = clear_name(records.select(given), "lang", "probability", "text_lang")
    if not n:
        return records.select(
            *given, F.lit(None).cast("string").alias(out_lang),
            F.lit(None).cast("double").alias(out_probability),
            F.lit(None).cast("string").alias(out_text),
        )
    # other columns travel under names of ours
    inside = {c: f"kept_{i}" for i, c in enumerate(given) if c not in ("declared", "suffix", "host", "domain")}
    records = records.withColumnsRenamed(inside)
    others = [inside.get(c, c) for c in given]
    fields = [records.schema[c] for c in others]
    schema = T.StructType([*fields, T.StructField("logs", T.ArrayType(T.DoubleType()))])
    scored = records.select("text", *others).mapInArrow(_text_evidence(model, html), schema)
    with arrow_batches_of(records.sparkSession, TEXT_ROWS):
        rows = stage(scored.withColumn("post", _softmax(F.col("logs"))), "language-text")

    # one row for each language, not a column: plans do not grow with the number of languages
    where = ["host", "domain", "declared", "suffix"]
    added = stage(
        rows.select(*where, F.posexplode("post").alias("at", "p"))
        .groupBy(*where, "at")
        .agg(F.sum("p").alias("p"), F.count("*").alias("rows")),
        "language-sums",
    )

    def sums(*keys: str) -> DataFrame:
        each = added.groupBy(*keys, "at").agg(F.sum("p").alias("p"), F.sum("rows").alias("rows"))
        by_place = F.array_sort(F.collect_list(F.struct("at", "p")))
        return each.groupBy(*keys).agg(
            F.transform(by_place, lambda s: s["p"]).alias("sums"), F.max("rows").alias("rows")
        )

    everything = sums().first()
    total = max(1, everything["rows"] or 0)
    share = [(s + 1.0) / (total + n) for s in everything["sums"] or [0.0] * n]
    shares = F.array(*map(F.lit, share))

    def spread(df: DataFrame, key: str) -> DataFrame:
        salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
        return df.where(F.col(key).isNotNull()).withColumn("salt", F.explode(salts))

    # with the input partition, so that equal rows are spread as well
    spread_by = F.xxhash64(*others, F.spark_partition_id())
    salted = rows.withColumn("salt", F.pmod(spread_by, F.lit(SALTS)).cast("int"))
    hosts = spread(sums("host", "domain"), "host").withColumnsRenamed(
        {"sums": "host_sums", "rows": "host_rows"}
    )
    domains = spread(sums("domain"), "domain").withColumnsRenamed(
        {"sums": "domain_sums", "rows": "domain_rows"}
    )
    joined = salted.join(hosts, ["host", "domain", "salt"], "left").join(
        domains, ["domain", "salt"], "left"
    )
    for cue in ("declared", "suffix"):
        seen = spread(sums(cue), cue).withColumnsRenamed({"sums": f"{cue}_sums", "rows": f"{cue}_rows"})
        joined = joined.join(seen, [cue, "salt"], "left")

    def prior(i: Column) -> Column:
        """Host towards domain towards corpus, without the row's own posterior."""
        own, of_all = F.get("post", i), F.get(shares, i)
        domain = (F.get("domain_sums", i) - own + DOMAIN_WEIGHT * of_all) / (
            F.col("domain_rows") - 1 + DOMAIN_WEIGHT
        )
        domain = F.coalesce(domain, of_all)
        host = (F.get("host_sums", i) - own + HOST_WEIGHT * domain) / (
            F.col("host_rows") - 1 + HOST_WEIGHT
        )
        return F.log(F.greatest(F.coalesce(host, domain), F.lit(1e-9)))

    def cue(name: str, i: Column) -> Column:
        """ln P(value | language), up to a constant: P(language | value) over P(language)."""
        own, of_all = F.get("post", i), F.get(shares, i)
        given = (F.get(f"{name}_sums", i) - own + CUE_WEIGHT * of_all) / (
            F.col(f"{name}_rows") - 1 + CUE_WEIGHT
        )
        # greatest() passes nulls over, and a missing value is to say nothing
        return F.when(given.isNull(), 0.0).otherwise(F.log(F.greatest(given, F.lit(1e-9)) / of_all))

    fused = F.transform("logs", lambda x, i: x + prior(i) + cue("declared", i) + cue("suffix", i))
    best = lambda a: F.get(
        F.array(*map(F.lit, names)), F.array_position(a, F.array_max(a)).cast("int") - 1
    )
    return (
        joined.withColumn("fused", fused)
        .withColumn("all", _softmax(F.col("fused")))
        .select(
            *(F.col(inside.get(c, c)).alias(c) for c in given), best(F.col("all")).alias(out_lang),
            F.array_max("all").alias(out_probability), best(F.col("post")).alias(out_text),
        )
    )


def page_records(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    host = host_of(F.col(url_col).cast("string"))
    html = F.col(html_col).cast("string")
    return pages.select(
        F.col(id_col).cast("long").alias(id_col),
        html.alias("text"),
        declared_language(html).alias("declared"),
        suffix_of(host).alias("suffix"),
        host.alias("host"),
        domain_of(host).alias("domain"),
    )


def document_records(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source"
) -> DataFrame:
    """Documents have a source for a host, and nothing that declares a language."""
    source = F.col(source_col).cast("string")
    nothing = F.lit(None).cast("string")
    return docs.select(
        F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"),
        nothing.alias("declared"), nothing.alias("suffix"), source.alias("host"),
        source.alias("domain"),
    )
