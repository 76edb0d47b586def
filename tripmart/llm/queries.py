"""The registered queries of this subpackage (their SQL is in ``oracle_sql``).

Each query applies one operator, with its production parameters, to a whole
table and returns its full result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmart.llm import bpe, exact_dedup, langid, mixing, warc
from tripmart.llm.cover_dedup import cover_dedup
from tripmart.llm.divergence import quality_rules
from tripmart.llm.hard_negatives import hard_negatives, noisy_label
from tripmart.llm.licenses import scan_licenses
from tripmart.llm.ngram_join import ngram_join
from tripmart.llm.oracle_sql import ORACLE_SQL
from tripmart.llm.spelling import spelling_variants
from tripmart.llm.suffix_dedup import suffix_dedup
from tripmart.llm.toxicity import toxicity_chain, train as train_toxicity
from tripmart.session import scratch_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op2_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality_rules(_table(spark, sf_dir, "documents"))
    return rows.withColumns({c: F.round(c, 6)
                             for c in ("char_distance", "word_distance", "word_limit")})


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.mixing_plan(_table(spark, sf_dir, "documents"))
    first, second = (F.element_at("positions", k) for k in (1, 2))
    return mixing.training_order(plan).select(
        "doc_id", "source", "size", "source_size", "target", "taken", "offset",
        F.round(first, 6).alias("position"), F.round(second, 6).alias("second_position"))


def op4_toxicity_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity_chain(docs, train_toxicity(docs, _table(spark, sf_dir, "labels")))


def language_model(docs: DataFrame) -> langid.LanguageModel:
    """Learned from the documents that are not held out."""
    return langid.train(docs.filter(~langid.held_out(F.col("doc_id"))))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    predict = langid.predictor(spark, language_model(docs))
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                      langid.held_out(F.col("doc_id")).alias("held_out"),
                      predict(F.col("text")).alias("p"))
    return out.select("doc_id", "held_out", F.col("p.lang").alias("lang_pred"),
                      F.col("p.score").alias("score"))


def op6_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = exact_dedup.open_index(spark, scratch_path(spark, f"digest_index/{uuid.uuid4().hex}"))
    decisions = exact_dedup.exact_dedup(_table(spark, sf_dir, "documents"), index)
    index.close()  # decisions come from written tables
    return decisions.drop("row_tag")


def op7_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, f"warc/{uuid.uuid4().hex}")
    warc.write_warc(_table(spark, sf_dir, "pages"), target)
    return warc.read_warc(spark, target)


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents"))


def op9_cover_anchor_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_dedup(_table(spark, sf_dir, "documents"))


def shared_vocabulary(spark: SparkSession):
    import public_tokenizers

    return bpe.share_vocabulary(spark, public_tokenizers.path(VOCABULARY),
                                public_tokenizers.PATTERN)


def op10_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    digests = bpe.round_trip(shared_vocabulary(spark))
    return (_table(spark, sf_dir, "documents")
            .select(F.col("doc_id").cast("long").alias("doc_id"),
                    digests(F.col("text")).alias("d"))
            .select("doc_id", "d.n_tokens", "d.ids_sha256", "d.decoded_sha256"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    rows = rows.withColumn("label", noisy_label(F.col("vec_id"), F.col("label")))
    return hard_negatives(rows, F.col("vec_id") % 50 == 0)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_suffix_array_dedup": op1_suffix_array_dedup,
    "op2_distribution_divergence": op2_distribution_divergence,
    "op3_curriculum_mix": op3_curriculum_mix,
    "op4_toxicity_chain": op4_toxicity_chain,
    "op5_language_id": op5_language_id,
    "op6_digest_index": op6_digest_index,
    "op7_warc_round_trip": op7_warc_round_trip,
    "op8_ngram_jaccard_join": op8_ngram_jaccard_join,
    "op9_cover_anchor_dedup": op9_cover_anchor_dedup,
    "op10_bpe_round_trip": op10_bpe_round_trip,
    "op11_license_scan": op11_license_scan,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_spelling_variants": op13_spelling_variants,
}

__all__ = ["ORACLE_SQL", "QUERIES"]
