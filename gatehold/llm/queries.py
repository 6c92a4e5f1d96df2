"""The text operators as registered queries over the whole tables."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatehold.llm import (
    attention_lm, fill_middle, langid, ngram_join, oracle, packing, paragraphs, perplexity, quality_rules,
    sentencepiece_codec, suffix_dedup, token_counts, vector_codes, vector_graph,
)
from gatehold.llm.storage import Rounds

BPE = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
WORDS = "word_bpe_49k.json"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.jaccard_components(_documents(spark, folder))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    held_out = langid.held_out("doc_id", 1)
    scored = attention_lm.score(docs, ~held_out, public_tokenizers.path(BPE), lang_col="lang")
    return scored.withColumn("held_out", held_out)


def op3_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graph.near_duplicates(spark.read.parquet(f"{folder}/embeddings.parquet"))


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    cleaned = paragraphs.remove_paragraphs(_documents(spark, folder).select("doc_id", "text"))
    digest = F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    return cleaned.select("doc_id", "n_paragraphs", "n_removed", "removed", "n_passages", digest)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder)
    held_out = langid.held_out("doc_id", 0)
    training = docs.filter(~held_out).select("doc_id", "lang", "text")
    # Limits for rejection come from a part of the training rows that a first fit leaves out; models from all of them.
    aside = langid.held_out("doc_id", 1)
    tuning = training.filter(aside & F.col("lang").isNotNull()).select("lang", "text")
    judged = langid.predict(tuning, langid.fit(training.filter(~aside))).drop("text")
    limits = langid.limits(Rounds(spark).store(judged, "calibration"))
    predicted = langid.rejecting(langid.predict(docs.select("doc_id", "text"), langid.fit(training)), limits)
    return predicted.select("doc_id", held_out.alias("held_out"), "lang_pred", "rejected", "score", "cross_entropy")


def op6_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.packed(_documents(spark, folder), public_tokenizers.path(BPE))


def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _documents(spark, folder).select("doc_id", "text", "lang")
    judge = perplexity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    return perplexity.judged(docs, judge).select("doc_id", "cross_entropy", "limit", "kept")


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeated(_documents(spark, folder).select("doc_id", "text")).drop("text", "kept_text")


def op9_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return sentencepiece_codec.checked(_documents(spark, folder), public_tokenizers.path(PIECES))


def op10_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_rules.line_first(_documents(spark, folder).select("doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts.counted(_documents(spark, folder), public_tokenizers.path(WORDS))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    cut = fill_middle.fill_in_middle(_documents(spark, folder))
    digests = {
        "output_sha256": F.sha2(F.col("output").cast("binary"), 256),
        "restored_sha256": F.sha2(fill_middle.restored(F.col("output"), F.col("form")).cast("binary"), 256),
    }
    return cut.withColumns(digests).drop("output")


def op13_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = vector_codes.compressed(spark.read.parquet(f"{folder}/embeddings.parquet"))
    return coded.drop("label").withColumn("codebooks_sha256", F.lit(vector_codes.digest(books)))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard_join, op2_lm_scoring, op3_embedding_near_dedup, op4_substring_dedup, op5_language_id, op6_best_fit_packing,
        op7_quality_classifier, op8_suffix_array_dedup, op9_sentencepiece, op10_quality_rules, op11_token_counts,
        op12_fill_in_middle, op13_vector_codes,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLE_SQL = oracle.ORACLE_SQL
