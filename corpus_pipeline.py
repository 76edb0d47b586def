"""A corpus pipeline: language ID, exact dedup, near dedup, mixing, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; ``run``
writes it as Parquet in the shared checkpoint folder and hands the written
copy to the next stage.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import bpe, exact_dedup, langid, mixing
from tripmart.llm.ngram_join import ngram_join
from tripmart.llm.queries import language_model, shared_vocabulary
from tripmart.session import cut_lineage, scratch_path

#: A language is taken from this posterior probability on.
LEAST_LANGUAGE_SCORE = 0.5
#: Near copies: words of a shingle, and Jaccard similarity in percent.
NEAR_SHINGLE = 5
NEAR_PERCENT = 80


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a language: no text, no letter, or no clear winner."""
    predict = langid.predictor(spark, language_model(docs))
    found = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"))
    found = found.withColumn("p", predict(F.col("doc.text")))
    return (found.filter((F.col("p.lang") != langid.UNKNOWN)
                         & (F.col("p.score") >= LEAST_LANGUAGE_SCORE)).select("doc.*"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each text (white space aside)."""
    index = exact_dedup.open_index(spark, scratch_path(spark, f"digest_index/{uuid.uuid4().hex}"))
    decisions = exact_dedup.exact_dedup(docs, index)
    index.close()
    return exact_dedup.keep_rows(docs, decisions)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps of each group of near copies the document with the smallest doc_id.
    Rows that share a doc_id stay or go together; a row without one is a
    document by itself, known by a hash above all ids."""
    unnamed = F.lit(1 << 62) + F.xxhash64("text", "source", "lang").bitwiseAND(
        F.lit((1 << 62) - 1))
    key = F.coalesce(F.col("doc_id").cast("long"), unnamed)
    groups = ngram_join(docs.select(key.alias("doc_id"), "text"), shingle=NEAR_SHINGLE,
                        percent=NEAR_PERCENT)
    stay = groups.filter(F.col("doc_id") == F.col("component_id")).select(
        F.col("doc_id").alias("stay_id")).distinct()
    rows = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("doc"),
                       key.alias("row_id"))
    return rows.join(stay, F.col("row_id") == F.col("stay_id"), "left_semi").select("doc.*")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as the mix reads them, a row per pass, in training order."""
    return mixing.mixed_stream(docs, cut_lineage(mixing.mixing_plan(docs), "mix_plan"))


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every row, with the digests of a decoding round trip."""
    return bpe.tokenize(docs, shared_vocabulary(spark), ["doc_id", "source", "lang"])


STAGES = [
    ("language_id", language_stage),
    ("exact_dedup", exact_stage),
    ("near_dedup", near_stage),
    ("source_mix", mix_stage),
    ("bpe_tokens", token_stage),
]

#: Naive Bayes and BPE have no SQL form: the stages are tested against
#: brute-force versions in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = cut_lineage(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
