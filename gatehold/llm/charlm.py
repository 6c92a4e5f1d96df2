"""Character n-gram models with modified Kneser-Ney smoothing, estimated by Spark and looked up in sorted arrays.

A model sees words: the bytes of a word between spaces, `ORDER` - 1 before and one behind it. Counts of all n-grams are
tables; the counts of shorter n-grams are the numbers of n-grams that extend them to the left, discounts come from the
counts of counts, and the probability parts of an n-gram from a join of its count with the totals of its context.
Inside a task each distinct word of a block, and each distinct n-gram of these words, is scored once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.llm.rolling import blocks, distinct, lower, span_hashes, word_spans
from gatehold.llm.storage import Rounds

ORDER = 5
CHUNKS = 16  # pieces that each array of a model is brought to the driver in
BLOCK = 2 << 20
_PAD = 0x20

_COUNTS = "part string, gram long, n long"


class Words:
    """The distinct words of a block of texts and the n-grams of these words."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, fold: bool):
        data = lower(data) if fold else data
        starts, ends, self.rows = word_spans(data, offsets)
        hashes = span_hashes(data, starts, ends)
        self.hashes, index, self.word = distinct(hashes)
        self.starts, self.ends = starts[index], ends[index]
        begin, size = self.starts, self.ends - self.starts
        count = size + 1
        self.grams_of = np.concatenate(([0], np.cumsum(count)))
        at = np.arange(self.grams_of[-1]) - np.repeat(self.grams_of[:-1], count)
        begin, size = np.repeat(begin, count), np.repeat(size, count)
        gram = np.zeros(len(at), np.int64)
        for k in range(-ORDER + 1, 1):
            inside = (at + k >= 0) & (at + k < size)
            byte = np.full(len(at), _PAD, np.int64)
            byte[inside] = data[(begin + at + k)[inside]]
            gram = (gram << 8) | byte
        self.grams, _, self.gram = distinct(gram)
        self.sizes = count

    def per_word(self, per_gram: np.ndarray) -> np.ndarray:
        """Sums over the n-grams of each distinct word."""
        total = np.concatenate(([0.0], np.cumsum(per_gram[self.gram])))
        return total[self.grams_of[1:]] - total[self.grams_of[:-1]]

    def per_row(self, per_word: np.ndarray) -> np.ndarray:
        """Sums over the words of each text, from a value for each distinct word."""
        total = np.concatenate(([0.0], np.cumsum(per_word[self.word])))
        return total[self.rows[1:]] - total[self.rows[:-1]]


def _emit_counts(fold: bool):
    """n-gram counts of each part in this task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for first, stop, data, offsets in blocks(batch.column(1), BLOCK):
                parts, code = np.unique(np.array(batch.column(0).slice(first, stop - first).to_pylist(), object).astype(str), return_inverse=True)
                words = Words(data, offsets, fold)
                row = np.repeat(np.arange(stop - first), np.diff(words.rows))
                for p, part in enumerate(parts):
                    of_word = np.bincount(words.word[code[row] == p], minlength=len(words.sizes))
                    n = np.bincount(words.gram, np.repeat(of_word, words.sizes), len(words.grams)).astype(np.int64)
                    grams, n = words.grams[n > 0], n[n > 0]
                    if part in totals:
                        old, m = totals[part]
                        grams, at = np.unique(np.concatenate((old, grams)), return_inverse=True)
                        n = np.bincount(at, np.concatenate((m, n)), len(grams)).astype(np.int64)
                    totals[part] = grams, n
                    if len(grams) > 1_000_000:  # let Spark add up the rest
                        yield _counts(part, *totals.pop(part))
        for part, (grams, n) in totals.items():
            yield _counts(part, grams, n)

    return run


def _counts(part: str, grams: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([str(part)] * len(grams), pa.string()), pa.array(grams), pa.array(n)], ["part", "gram", "n"])


def count_grams(texts: DataFrame, fold: bool) -> DataFrame:
    """(part, gram, n) of texts (part, text): how often each packed n-gram of the full order is there."""
    counted = texts.mapInArrow(_emit_counts(fold), _COUNTS)
    return counted.groupBy("part", "gram").agg(F.sum("n").alias("n"))


def _discounts(level: DataFrame) -> DataFrame:
    """Modified Kneser-Ney discounts of each part for counts of 1, 2 and more."""
    counts = level.groupBy("part").agg(*(F.count_if(F.col("n") == k).cast("double").alias(f"n{k}") for k in range(1, 5)))
    y = F.try_divide("n1", F.col("n1") + 2 * F.col("n2"))

    def of(k: int):
        value = k - (k + 1) * y * F.try_divide(F.col(f"n{k + 1}"), F.col(f"n{k}"))
        return F.greatest(F.lit(0.1), F.least(F.lit(k - 0.1), F.coalesce(value, F.lit(k / 2))))

    return counts.select("part", *(of(k).alias(f"d{k}") for k in (1, 2, 3)))


class Model:
    """The parts of interpolated probabilities of one group, as sorted arrays by order."""

    def __init__(self):
        self.seen: list[tuple[np.ndarray, np.ndarray]] = []
        self.contexts: list[tuple[np.ndarray, np.ndarray]] = []

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of the last byte of each packed n-gram after the bytes before it."""
        p = np.full(len(grams), 1 / 256)
        for order, (seen, contexts) in enumerate(zip(self.seen, self.contexts), 1):
            gram = grams & ((1 << 8 * order) - 1)
            p = _look(*seen, gram, 0.0) + _look(*contexts, gram >> 8, 1.0) * p
        return np.log10(p)


def _look(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, missing: float) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), missing)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, values[at], missing)


def _rows(arrays: DataFrame) -> Iterator[tuple[int, str, int, np.ndarray, np.ndarray]]:
    """(order, part, kind, keys, values) of each array of a model."""
    table = arrays.select("order", "part", "kind", "items.key", "items.value").toArrow()
    for batch in table.to_batches():
        for i in range(len(batch)):
            keys, values = (batch.column(c)[i].values.to_numpy(zero_copy_only=False).copy() for c in (3, 4))
            yield *(batch.column(c)[i].as_py() for c in range(3)), keys, values


def estimate(rounds: Rounds, counts: DataFrame) -> dict[str, Model]:
    """A model for each part of (part, gram, n), with all its n-grams and contexts.

    What reaches the driver grows with the distinct n-grams of the language, 16 bytes for each, not with the texts.
    """
    level = rounds.store(counts, f"grams-{ORDER}")
    found: dict[tuple[int, str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    for order in range(ORDER, 0, -1):
        context = level.withColumn("context", F.shiftright("gram", 8))
        totals = context.groupBy("part", "context").agg(
            F.sum("n").cast("double").alias("total"),
            *(F.count_if(F.col("n") == k).alias(f"k{k}") for k in (1, 2)), F.count_if(F.col("n") > 2).alias("k3"),
        )
        discounts = F.broadcast(_discounts(level))  # a row for each part
        taken = F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))
        seen = context.join(totals.select("part", "context", "total"), ["part", "context"]).join(discounts, "part")
        seen = seen.select("part", F.col("gram").alias("key"), ((F.col("n") - taken) / F.col("total")).alias("value"))
        back = totals.join(discounts, "part").select(
            "part", F.col("context").alias("key"),
            ((F.col("k1") * F.col("d1") + F.col("k2") * F.col("d2") + F.col("k3") * F.col("d3")) / F.col("total")).alias("value"),
        )
        both = seen.withColumn("kind", F.lit(0)).union(back.withColumn("kind", F.lit(1))).withColumn("order", F.lit(order))
        chunk = F.pmod(F.xxhash64("key"), F.lit(CHUNKS)).alias("chunk")
        arrays = both.groupBy("order", "part", "kind", chunk).agg(F.collect_list(F.struct("key", "value")).alias("items"))
        for *of, keys, values in _rows(arrays):
            found.setdefault(tuple(of), []).append((keys, values))
        if order > 1:
            shorter = level.groupBy("part", F.col("gram").bitwiseAND((1 << 8 * (order - 1)) - 1).alias("gram"))
            level = rounds.store(shorter.agg(F.count(F.lit(1)).alias("n")), f"grams-{order - 1}")
    models: dict[str, Model] = {}
    for part in sorted({part for _, part, _ in found}):
        models[part] = Model()
        for order in range(1, ORDER + 1):
            for kind, into in ((0, models[part].seen), (1, models[part].contexts)):
                keys, values = map(np.concatenate, zip(*found[order, part, kind]))
                by_key = np.argsort(keys)
                into.append((keys[by_key], values[by_key]))
    rounds.drop(*(f"grams-{o}" for o in range(1, ORDER + 1)))
    return models
