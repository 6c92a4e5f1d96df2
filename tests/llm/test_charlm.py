"""The n-gram models against a direct computation, and predictions on held-out text."""

from __future__ import annotations

import math
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from gatehold.llm import charlm, langid, queries
from gatehold.llm.storage import Rounds
from tests.llm.conftest import SMALL


def direct(words):
    """Probabilities by the textbook, from a list of words."""
    n = charlm.ORDER
    grams = Counter()
    for w in words:
        padded = b" " * (n - 1) + w.encode() + b" "
        grams.update(padded[i : i + n] for i in range(len(padded) - n + 1))
    levels = {n: grams}
    for m in range(n - 1, 0, -1):
        levels[m] = Counter(g[1:] for g in levels[m + 1])
    d = {}
    for m, c in levels.items():
        k = Counter(c.values())
        y = k[1] / (k[1] + 2 * k[2]) if k[1] + 2 * k[2] else None
        d[m] = [min(i - 0.1, max(0.1, i - (i + 1) * y * k[i + 1] / k[i])) if y is not None and k[i] else i / 2 for i in (1, 2, 3)]

    def p(gram, m):
        if m == 0:
            return 1 / 256
        gram = gram[-m:]
        same = {g: c for g, c in levels[m].items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram, m - 1)
        total, c = sum(same.values()), same.get(gram, 0)
        off = sum(d[m][min(x, 3) - 1] for x in same.values()) / total
        return (max(0, c - d[m][min(c, 3) - 1]) / total if c else 0) + off * p(gram, m - 1)

    return lambda gram: p(gram, n)


def test_probabilities(spark, frame):
    rng = random.Random(2)
    words = ["".join(rng.choice("abcé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    texts = [" ".join(words[i : i + 7]) for i in range(0, 300, 7)]
    df = frame(enumerate(texts)).select(F.lit("x").alias("part"), "text")
    model = charlm.estimate(Rounds(spark), charlm.count_grams(df, True))["x"]
    want = direct(words)
    for gram in [b"    a", b"aabac", b" abca", b"zzzzz", b"abcaa", "aéa".encode() + b"b", b"aaab "]:
        code = np.array([int.from_bytes(gram, "big")])
        assert model.log10(code)[0] == pytest.approx(math.log10(want(gram)), abs=1e-9)
    for context in (b"    ", b"abca", b"qqqq"):
        codes = np.array([int.from_bytes(context + bytes([i]), "big") for i in range(256)])
        assert (10 ** model.log10(codes)).sum() == pytest.approx(1)


def test_models_keep_all_ngrams(spark, frame):
    rng = random.Random(3)
    words = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(7)) for _ in range(9_000)]
    df = frame(enumerate(" ".join(words[i : i + 50]) for i in range(0, 9_000, 50))).select(F.lit("x").alias("part"), "text")
    model = charlm.estimate(Rounds(spark), charlm.count_grams(df, True))["x"]
    padded = [b" " * 4 + w.encode() + b" " for w in words]
    grams = {p[i : i + 5] for p in padded for i in range(len(p) - 4)}
    assert len(grams) > 50_000 and len(model.seen[4][0]) == len(grams)
    assert len(model.contexts[4][0]) == len({g[:4] for g in grams})
    for gram in sorted(grams)[::5_000]:
        codes = np.array([int.from_bytes(gram[:4] + bytes([i]), "big") for i in range(256)])
        assert (10 ** model.log10(codes)).sum() == pytest.approx(1)


def test_language_edges(spark, frame):
    rows = [(i, t) for i, t in enumerate(["the cat and the dog"] * 20 + ["le chat et le chien"] * 20)]
    df = frame(rows).withColumn("lang", F.when(F.col("doc_id") < 20, "en").otherwise("fr"))
    models = langid.fit(df)
    odd = frame({1: None, 2: "", 3: "12 ... 7", 4: "the dog", 5: "LE CHIEN", 6: "the " * 5000, None: "le chat"})
    got = {r["doc_id"]: r for r in langid.predict(odd, models).collect()}
    assert [got[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 6, None)] == ["und"] * 3 + ["en", "fr", "en", "fr"]
    assert all(0 <= r["score"] <= 1 for r in got.values()) and got[6]["score"] > 0.9
    assert langid.predict(frame({}), models).count() == 0
    assert [r["lang_pred"] for r in langid.predict(odd, langid.fit(frame({}))).collect()] == ["und"] * 7
    clash = odd.withColumn("score", F.lit("s"))
    assert langid.predict(clash, models).columns[-3:] == ["lang_pred", "score_", "cross_entropy"]


def test_query_is_right_on_held_out_rows(spark, documents):
    got = queries.op5_language_id(spark, SMALL).join(documents.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == documents.count()
    judged = [r for r in got if r["held_out"] and r["lang"]]
    assert judged and sum(r["lang"] == r["lang_pred"] for r in judged) >= 0.95 * len(judged)


def test_texts_of_other_languages_are_rejected(spark, frame, documents):
    got = queries.op5_language_id(spark, SMALL).join(documents.select("doc_id", "lang"), "doc_id").collect()
    judged = [r for r in got if r["held_out"] and r["lang"]]
    assert sum(r["rejected"] for r in judged) <= 0.1 * len(judged)
    models = langid.fit(documents)
    calibration = langid.predict(documents.filter("lang is not null").select("lang", "text"), models)
    other = frame({1: "zażółć gęślą jaźń " * 5, 2: "съешь же ещё этих мягких французских булок " * 3, 3: None})
    known = langid.limits(calibration)
    found = {r["doc_id"]: r for r in langid.rejecting(langid.predict(other, models), known).collect()}
    clash = other.withColumnsRenamed({"lang": "lang_pred", "source": "rejected"}).withColumn("score", F.lit(-1.0))
    again = {r["doc_id"]: r["rejected_"] for r in langid.rejecting(langid.predict(clash, models), known).collect()}
    assert again == {i: r["rejected"] for i, r in found.items()}
    assert [found[i]["rejected"] for i in (1, 2, 3)] == [True] * 3 and found[1]["lang_pred"] in models


def test_held_out_labels_are_not_read(spark, documents, tmp_path):
    """Wrong languages on all held-out rows change no column."""
    wrong = F.when(langid.held_out("doc_id", 0), F.lit("xx")).otherwise(F.col("lang"))
    documents.withColumn("lang", wrong).write.parquet(str(tmp_path / "documents.parquet"))
    first, second = (sorted(map(tuple, queries.op5_language_id(spark, f).collect())) for f in (SMALL, str(tmp_path)))
    for a, b in zip(first, second, strict=True):
        assert a[:4] == b[:4] and a[4:] == pytest.approx(b[4:], abs=1e-9, nan_ok=True)
