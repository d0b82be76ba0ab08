"""The registered queries of this package, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    containment,
    language,
    licences,
    line_chunks,
    mixing,
    ngram_join,
    order_minhash,
    ranked_search,
    simhash_tiles,
    token_files,
    toxicity,
    warc,
    whitening,
)
from tidemark.llm.common import table
from tidemark.session import scratch_path


def op1_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages and documents; the text likelihoods are learned from the labels of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    model = language.fit_languages(docs)
    pages = language.page_records(table(spark, sf_dir, "pages"))
    own = language.document_records(docs)
    found = language.identify_languages(pages, model, html=True)
    of_docs = language.identify_languages(own, model, html=False)
    return found.unionByName(of_docs, allowMissingColumns=True)


def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_jaccard_join(table(spark, sf_dir, "documents"), k=3, percent=90)


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, tokenizer, end_id=2)
    return token_files.read_token_documents(spark, path)


def op4_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.edited_fingerprints(table(spark, sf_dir, "documents"))


def op5_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_chunks.remove_repeated_chunks(table(spark, sf_dir, "documents")).select(
        "doc_id", "text", "removed_lines", "removed_chars"
    )


def op6_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.write_warc(table(spark, sf_dir, "pages"), path)
    return warc.read_warc(spark, path).drop("intact")


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(mixing.mix_sources(table(spark, sf_dir, "documents")))


def op8_contained_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return containment.leaking_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, model)


def op10_license_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licenses(table(spark, sf_dir, "documents"), licences.known_digests(spark))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return whitening.whiten(rows, whitening.fit_whitening(rows))


def op12_pair_maxscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.simhash_groups(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_fusion": op1_language_fusion,
    "op2_ngram_jaccard_join": op2_ngram_jaccard_join,
    "op3_token_files": op3_token_files,
    "op4_order_minhash": op4_order_minhash,
    "op5_line_chunks": op5_line_chunks,
    "op6_warc_revisits": op6_warc_revisits,
    "op7_mix_sources": op7_mix_sources,
    "op8_contained_items": op8_contained_items,
    "op9_toxicity": op9_toxicity,
    "op10_license_digests": op10_license_digests,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_pair_maxscore": op12_pair_maxscore,
    "op13_simhash_tiles": op13_simhash_tiles,
}

# Plain SQL for the queries that it can express.
ORACLES: dict[str, str] = {
    "op8_contained_items": containment.containment_sql(),
    "op10_license_digests": licences.licenses_sql(),
    "op12_pair_maxscore": ranked_search.search_sql(),
}
