"""From raw documents to token files: toxicity, near duplicates, leaks, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, written as Parquet and read again
for the next one. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import containment, mixing, ngram_join, token_files, toxicity
from tidemark.llm.common import clear_name, table
from tidemark.session import scratch_path

# Word shingles of near duplicates: five words, similarity 0.8 or more.
SHINGLE_WORDS = 5
SIMILAR_PERCENT = 80
# Memory of pieces for the token stage, which runs beside what the stages before it left in the workers.
CACHE_BYTES = 32 << 20


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents below the toxicity threshold, learned from the labels of rows not held out."""
    model = toxicity.fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows are told apart by id and text: of rows that share an id each stays or goes with the group of its
    own text. Texts without words are linked with nothing and stay. Rows with a null id are in no group
    and stay. Of rows that repeat both id and text one stays. An empty table gives an empty one.
    """
    groups = ngram_join.ngram_jaccard_components(docs, k=SHINGLE_WORDS, percent=SIMILAR_PERCENT)
    key = clear_name(docs, "text_key")[0]
    kept = groups.where("doc_id = component_id").select("doc_id", F.col("text_key").alias(key)).distinct()
    named = docs.withColumn(key, F.xxhash64(F.col("text").cast("string"))).join(kept, ["doc_id", key], "left_semi")
    # dealt by id and key already, so that whole texts do not move once more
    once = named.dropDuplicates(["doc_id", key, "text"]).select(docs.columns)
    return once.unionByName(docs.where("doc_id is null").dropDuplicates(["text"]))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return containment.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words that the mix takes: a row for each pass over a document, with those words."""
    mix = mixing.mix_sources(docs)
    return mixing.mixed_texts(docs, mix, length_col="n_chars")


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: a row for each of its documents."""
    path = scratch_path(spark, "corpus-tokens")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_files.write_token_files(docs, path, tokenizer, end_id=2, cache_bytes=CACHE_BYTES)
    return token_files.read_token_documents(spark, path)


STAGES = [
    ("toxicity", drop_toxic),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_leaks),
    ("mixing sources to target weights", mix_to_targets),
    ("token-ID / binary output", write_tokens),
]

# The stages learn, draw and tokenise; SQL cannot express them. tests/llm compares what the second and
# third stage keep, the counts of the mix and the token rows with brute force, and runs ``run``.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        path = scratch_path(spark, f"corpus-stage-{number}")
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
