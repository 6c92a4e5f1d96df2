"""Quality of a text: perplexity under a modified Kneser-Ney model of trusted text, with a limit for each language.

Models and limits are fitted on all trusted documents, one for each language and one for all; their counts are
tables that are joined by n-gram and context. The models themselves are bounded by their number of n-grams, so documents
are not shuffled to meet the counts: each task looks up the distinct n-grams of its texts. A word's probability is the
mean of those that the model of its document's language and the model of all give it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.llm.charlm import BLOCK, Model, Words, count_grams, estimate
from gatehold.llm.columns import extended, fresh, quoted
from gatehold.llm.rolling import blocks
from gatehold.llm.storage import Rounds

IDS = 2_000_000  # of trusted documents in one broadcast
QUANTILE = 0.999  # of the trusted documents outside the fit
SLACK = 1.03  # times the quantile is the limit
STEADY = 60  # bytes at the language's usual entropy that are added to each text, so that short ones vary less
ALL = "*"  # the part for all languages, also for rows without a language or with an unknown one

_BITS = "part string, bits double, size double"


@dataclass
class Judge:
    models: dict[str, Model]
    usual: dict[str, float]  # bits a byte
    limits: dict[str, float]


def trusted(rounds: Rounds, docs: DataFrame, labels: DataFrame, ids: int = IDS) -> DataFrame:
    """The rows of `docs` with a text that are labelled as good and not as toxic, stored.

    Texts are not shuffled: of each `ids` labels, a part by the hash of the document's id, one broadcast and pass finds its rows.
    """
    good = labels.filter("quality = 1 and coalesce(toxic, 0) = 0").select(F.col("doc_id").cast("long").alias("doc_id"))
    good = good.dropna().distinct()
    parts = max(1, -(-good.count() // ids))
    part = F.pmod(F.xxhash64(F.col("doc_id").cast("long"), F.lit(3)), F.lit(parts))
    texts = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang")).filter("text is not null")
    found = [texts.filter(part == p).join(F.broadcast(good.filter(part == p)), "doc_id", "left_semi") for p in range(parts)]
    return reduce(DataFrame.union, [rounds.store(rows, f"trusted-{p}") for p, rows in enumerate(found)])


def _bits(models: dict[str, Model], parts: list[str | None], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(bits, bytes with one more for each word) of each text of a block."""
    size = words.per_row(words.sizes.astype(float))
    bits = np.zeros(len(parts))
    if ALL not in models:
        return bits, size
    general = words.per_word(models[ALL].log10(words.grams))
    known = np.array([p if p in models else ALL for p in parts], object)
    for part in sorted(set(known)):
        log10 = general
        if part != ALL:
            log10 = np.logaddexp2(general / np.log10(2), words.per_word(models[part].log10(words.grams)) / np.log10(2))
            log10 = (log10 - 1) * np.log10(2)
        own = known == part
        bits[own] = -words.per_row(log10)[own] / np.log10(2)
    return bits, size


def fit(docs: DataFrame, labels: DataFrame) -> Judge:
    """Models and limits from documents (doc_id, text, lang) and labels (doc_id, quality, toxic).

    One half of the trusted documents is for the models, the other for the limits. Without trusted text there is no
    model and no limit, and nothing with a word is rejected.
    """
    spark = docs.sparkSession
    rounds = Rounds(spark)
    good = trusted(rounds, docs, labels)
    first = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)) == 0
    parts = F.explode(F.when(F.col("lang").isNull(), F.array(F.lit(ALL))).otherwise(F.array("lang", F.lit(ALL))))
    models = estimate(rounds, count_grams(good.filter(first).select(parts.alias("part"), "text"), fold=False))
    shared = spark.sparkContext.broadcast(models)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, stop, data, offsets in blocks(batch.column(1), BLOCK):
                parts = batch.column(0).slice(start, stop - start)
                bits, size = _bits(shared.value, parts.to_pylist(), Words(data, offsets, False))
                yield pa.RecordBatch.from_arrays([parts, pa.array(bits), pa.array(size)], ["part", "bits", "size"])

    scored = good.filter(~first).select("lang", "text").mapInArrow(run, _BITS).filter("size > 0")
    part = F.explode(F.when(F.col("part").isNull(), F.array(F.lit(ALL))).otherwise(F.array("part", F.lit(ALL))))
    scored = rounds.store(scored.select(part.alias("part"), "bits", "size"), "trusted-bits")
    usual = {r["part"]: r["usual"] for r in scored.groupBy("part").agg((F.sum("bits") / F.sum("size")).alias("usual")).collect()}
    limits = {}
    if usual:
        mean = F.create_map(*(F.lit(x) for pair in usual.items() for x in pair))[F.col("part")]
        steady = (F.col("bits") + mean * STEADY) / (F.col("size") + STEADY)
        found = scored.groupBy("part").agg(F.percentile_approx(steady, QUANTILE, 10_000).alias("limit"))
        limits = {r["part"]: r["limit"] * SLACK for r in found.collect()}
    rounds.clear()
    return Judge(models, usual, limits)


def judged(docs: DataFrame, judge: Judge, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """All rows and columns of `docs` with cross_entropy and limit (bits a byte, double) and kept (boolean).

    The entropy is that of the text and `STEADY` usual bytes. A null or empty text, or one without words, has a null
    entropy and is not kept. A null or unknown language has the limit of all. Repeated rows are judged one by one.
    Where `docs` has such a column, underscores are added to the new one.
    """
    names, own = fresh(docs, "cross_entropy", "limit", "kept"), docs.columns
    text, lang = fresh(docs, "__text", "__lang")
    shared = docs.sparkSession.sparkContext.broadcast(judge)  # bounded by the number of n-grams a model keeps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge: Judge = shared.value
        for batch in batches:
            entropies, limits, kept = [], [], []
            for start, stop, data, offsets in blocks(batch.column(len(own)), BLOCK):
                parts = batch.column(len(own) + 1).slice(start, stop - start).to_pylist()
                for part, bits, size in zip(parts, *_bits(judge.models, parts, Words(data, offsets, False))):
                    known = part if part in judge.limits else ALL
                    limit = judge.limits.get(known)
                    entropy = None
                    if size:
                        entropy = float((bits + judge.usual.get(known, 0.0) * STEADY) / (size + STEADY))
                    entropies.append(entropy)
                    limits.append(limit)
                    kept.append(bool(size) and (limit is None or entropy <= limit))
            new = [pa.array(entropies, pa.float64()), pa.array(limits, pa.float64()), pa.array(kept, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), *new], [*own, *names])

    schema = extended(docs.schema, *zip(names, ("double", "double", "boolean")))
    extra = docs.withColumns({text: quoted(text_col).cast("string"), lang: quoted(lang_col).cast("string")})
    return extra.select(*map(quoted, own), text, lang).mapInArrow(run, schema)
