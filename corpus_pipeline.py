"""A corpus from raw documents to packed sequences, stage by stage.

Each stage takes what the one before it kept, written as Parquet and read again, and works on all of it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gatehold.llm import ngram_join, packing, perplexity, quality_rules, suffix_dedup
from gatehold.llm.columns import fresh, quoted
from gatehold.llm.storage import Rounds
from gatehold.session import scratch_path

TOKENIZER = "byte_bpe_50k.json"
PASSAGE = 250  # bytes of a passage, about 45 words, that may stand in the corpus once only


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the perplexity limits of trusted text keep.

    A null or empty text has no perplexity and goes. Repeated rows, and rows without an id, are judged one by one.
    """
    judge = perplexity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = perplexity.judged(docs, judge)
    return scored.filter(scored.columns[-1]).select(*map(quoted, docs.columns))


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line-first rules keep, with their whole text.

    A null or empty text has no words and goes. Repeated rows, and rows without an id, are judged one by one.
    """
    measured = quality_rules.line_first(docs)
    kept = measured.columns[-2]
    judged = measured.select(*map(quoted, [*docs.columns, kept]))
    # Pushed below the measures, the filter would repeat their expressions many times over; it does not pass a count.
    judged = judged.observe("judged by rules", F.count(F.lit(1)).alias("rows"))
    return judged.filter(quoted(kept)).select(*map(quoted, docs.columns))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links of similar 3-word shingle sets make: the one with the least id.

    Rows without an id are in no group and all stay. Of rows that repeat an id and its text one stays; rows that share an
    id with other texts are one document of several rows and stay together.
    """
    first, rows = fresh(docs, "__first", "__rows")
    joined = Rounds(spark)
    found = ngram_join.jaccard_components(docs, rounds=joined).filter("doc_id = component_id")
    kept = Rounds(spark).store(found.groupBy(F.col("doc_id").alias(first)).agg(F.count(F.lit(1)).alias(rows)), "kept")
    del found
    joined.clear()
    same = F.col("doc_id") == F.col(first)
    # Only the few that repeat an id are grouped by their texts.
    single = docs.join(kept.filter(F.col(rows) == 1), same, "left_semi")
    repeated = docs.join(kept.filter(F.col(rows) > 1), same, "left_semi").dropDuplicates(["doc_id", "text"])
    return single.union(repeated).union(docs.filter("doc_id is null"))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their bytes that are part of a repeated string of PASSAGE bytes.

    Documents that are null, empty or emptied go. A row without an id is a text like any other; rows with equal texts
    empty each other, so of repeated rows the stage before has to leave one.
    """
    names = fresh(docs, "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text")
    left = suffix_dedup.remove_repeated(docs, PASSAGE).withColumn("text", quoted(names[-1]))
    left = left.withColumn("n_chars", F.length("text").cast("long"))
    return left.filter(F.length("text") > 0).select(*map(quoted, docs.columns))


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and their places in sequences of 2048 tokens.

    A null text counts as empty and gives a piece of its end alone; repeated rows, and rows without an id, are each packed.
    """
    return packing.packed(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", rules),
    ("n-gram Jaccard join", near_copies),
    ("suffix-array dedup", repeated_passages),
    ("best-fit packing", packed_sequences),
]

# The first stage's models and the last one's tokens are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of `sf_dir`; what each but the last keeps is stored under the scratch folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
