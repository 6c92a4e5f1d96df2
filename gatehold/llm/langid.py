"""Language of a text: a Kneser-Ney character model for each language, lowest cross-entropy wins."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehold.llm.charlm import BLOCK, Model, Words, count_grams, estimate
from gatehold.llm.columns import extended, fresh, quoted
from gatehold.llm.rolling import blocks
from gatehold.llm.storage import Rounds

UNKNOWN = "und"
STEADY = 40  # bytes of text that say as much about the language as a long text
REJECTED = 0.01  # share of the texts of known language, kept apart for this, that may be rejected


def held_out(id_col: str, remainder: int, of: int = 5) -> Column:
    """Whether a document is held out: crc32 of its id as text leaves this remainder. A null id is not."""
    return F.coalesce(F.pmod(F.crc32(quoted(id_col).cast("string").cast("binary")), F.lit(of)) == remainder, F.lit(False))


def fit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, Model]:
    """A model for each language, from all rows with a text and a language."""
    texts = docs.select(quoted(lang_col).cast("string").alias("part"), quoted(text_col).alias("text")).dropna()
    return estimate(Rounds(docs.sparkSession), count_grams(texts, fold=True))


def predict(docs: DataFrame, models: dict[str, Model], text_col: str = "text") -> DataFrame:
    """All rows and columns of `docs` with lang_pred, score and cross_entropy.

    The language with the lowest cross-entropy (bits a byte) is predicted, the first by name on ties; the score is its
    share when each language weighs by that of `STEADY` bytes. A null text, or one without a letter, is `und` with score
    0 and a null cross-entropy, as is everything when no language was learned. Where `docs` has such a column,
    underscores are added to the new one.
    """
    names = fresh(docs, "lang_pred", "score", "cross_entropy")
    text, letters = fresh(docs, "__text", "__letters")
    known, own = sorted(models), docs.columns
    shared = docs.sparkSession.sparkContext.broadcast(models)  # bounded by the number of n-grams a model keeps

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        models = shared.value
        for batch in batches:
            langs, scores, bits = [], [], []
            has = batch.column(len(own) + 1).to_numpy(zero_copy_only=False)
            for first, stop, data, offsets in blocks(batch.column(len(own)), BLOCK):
                words = Words(data, offsets, True)
                size = np.maximum(words.per_row(words.sizes.astype(float)), 1)
                entropy = [-words.per_row(words.per_word(models[k].log10(words.grams))) / np.log10(2) / size for k in known]
                entropy = np.array(entropy).reshape(len(known), stop - first)
                usable = has[first:stop] & bool(known)
                if known:
                    best = entropy.argmin(axis=0)
                    least = entropy.min(axis=0)
                    share = 1 / np.exp2((least - entropy) * np.minimum(size, STEADY)).sum(axis=0)
                for i in range(stop - first):
                    langs.append(known[best[i]] if usable[i] else UNKNOWN)
                    scores.append(float(share[i]) if usable[i] else 0.0)
                    bits.append(float(least[i]) if usable[i] else None)
            new = [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(bits, pa.float64())]
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(own))), *new], [*own, *names])

    schema = extended(docs.schema, *zip(names, ("string", "double", "double")))
    given = quoted(text_col).cast("string")
    letter = F.coalesce(F.rlike(given, F.lit(r"\p{L}")), F.lit(False))
    return docs.withColumns({text: given, letters: letter}).select(*map(quoted, own), text, letters).mapInArrow(run, schema)


@dataclass(frozen=True)
class Limits:
    """The least score, and the most cross-entropy of a text in each language, that are not rejected."""

    score: float
    entropy: dict[str, float]


def limits(calibration: DataFrame, lang_col: str = "lang", share: float = REJECTED) -> Limits:
    """Limits that reject about `share` of the rightly predicted rows of `calibration`, half by each kind.

    `calibration` is what `predict` returns for rows with their language, which the models must not have seen. Limits of
    cross-entropy allow for how few rows they come from. Without rightly predicted rows nothing is rejected for its score,
    and a language with fewer than two has no limit. Acts at once.
    """
    lang, score, entropy = (quoted(c) for c in _own(calibration, "lang_pred", "score", "cross_entropy"))
    right = calibration.filter(quoted(lang_col) == lang)
    least = right.agg(F.percentile_approx(score, share / 2, 1000)).first()[0]
    most = right.groupBy(lang.alias("of")).agg(
        F.percentile_approx(entropy, 1 - share / 2, 1000).alias("most"),
        F.avg(entropy).alias("mean"),
        F.stddev_samp(entropy).alias("deviation"),
        F.count(entropy).alias("n"),
    )
    bounds = {}
    for r in most.filter("n > 1").collect():  # one row per language
        # The quantile of a few rows is their largest value, which a new row exceeds far more often than wanted.
        apart = _student(1 - share / 2, r["n"] - 1) * r["deviation"] * (1 + 1 / r["n"]) ** 0.5
        bounds[r["of"]] = max(r["most"], r["mean"] + apart)
    return Limits(least or 0.0, bounds)


def _student(share: float, freedom: int) -> float:
    """About the quantile of Student's distribution, by its expansion around the normal one."""
    z = NormalDist().inv_cdf(share)
    first, second = (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96
    return z + first / freedom + second / freedom**2


def _own(predicted: DataFrame, *names: str) -> list[str]:
    """The columns that `predict` added under these names: the last ones that begin so, as underscores may follow."""
    return [[c for c in predicted.columns if c.rstrip("_") == n][-1] for n in names]


def rejecting(predicted: DataFrame, known: Limits) -> DataFrame:
    """`predicted`, as `predict` returns it, with rejected: whether the text is likely in no language that was learned.

    A score below its limit, or a cross-entropy above that of the predicted language, rejects, as does `und`. Where
    `predicted` has such a column, underscores are added to the new one.
    """
    lang, score, entropy = (quoted(c) for c in _own(predicted, "lang_pred", "score", "cross_entropy"))
    far = F.lit(False)
    for name, most in sorted(known.entropy.items()):
        far = far | ((lang == name) & (entropy > most))
    rejected = (lang == UNKNOWN) | (score < known.score) | F.coalesce(far, F.lit(False))
    return predicted.withColumn(fresh(predicted, "rejected")[0], rejected)
