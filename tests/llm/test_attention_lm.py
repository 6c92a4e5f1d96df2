"""Scores against a direct computation of the base, proper probabilities, and held-out texts."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gatehold.llm import attention_lm, queries
from tests.llm.conftest import SMALL

BPE = public_tokenizers.path("byte_bpe_50k.json")


def tokens(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w] + [None]


def check(rows, texts, held_out):
    counts = Counter(t for i, text in texts if not held_out(i) for t in tokens(text))
    total, distinct = sum(counts.values()), len(counts)
    for r in rows:
        own = tokens(dict(texts)[r["doc_id"]])
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(own), sum(counts[t] > 0 for t in own), total)
        want = sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in own)
        assert r["base_score"] == pytest.approx(want) and math.isfinite(r["score"]) and r["score"] < 0


def test_query(spark, documents):
    texts = [(r["doc_id"], r["text"]) for r in documents.collect()]
    rows = queries.op2_lm_scoring(spark, SMALL).collect()
    assert len(rows) == len(texts)
    check(rows, texts, lambda i: zlib.crc32(str(i).encode()) % 5 == 1)


def test_held_out_texts_are_likelier_than_by_word_counts(spark):
    held = queries.op2_lm_scoring(spark, SMALL.replace("0.001", "0.01")).filter("held_out")
    sums = held.agg(F.sum("score").alias("score"), F.sum("base_score").alias("base")).first()
    assert sums["score"] > sums["base"]


def test_edges(spark, frame):
    texts = [(1, "a b a"), (2, None), (3, ""), (4, "A b\tc"), (5, "x" * 5000), (6, "a " * 3000)]
    rows = attention_lm.score(frame(texts), F.col("doc_id") < 5, BPE).collect()
    check(rows, texts, lambda i: i >= 5)
    none = attention_lm.score(frame(texts), F.lit(False), BPE).collect()
    assert len(none) == 6 and {r["train_tokens"] for r in none} == {0} and all(math.isfinite(r["score"]) for r in none)
    assert attention_lm.score(frame({}), F.lit(True), BPE).count() == 0


def test_texts_and_counts_of_a_block_meet_without_a_shuffle(frame):
    texts = [(i, f"a b {i}") for i in range(50)]
    scored = attention_lm.score(frame(texts), F.col("doc_id") < 40, BPE)
    plan = scored._jdf.queryExecution().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    check(scored.collect(), texts, lambda i: i >= 40)


def test_words_of_a_block_are_packed_into_one_row():
    block, word = np.repeat([7, 5, 7], [2, 1, 1]), np.arange(4)
    n = pa.ListArray.from_arrays(pa.array([0, 2, 4, 6, 8], pa.int32()), pa.array(range(8)))
    batch = pa.RecordBatch.from_arrays([pa.array(block), pa.array(word), n], ["block", "word", "n"])
    (packed,) = attention_lm._packed(iter([batch.slice(0, 3), batch.slice(3)]))
    assert packed.to_pydict() == {"block": [5, 7], "word": [[2], [0, 1, 3]], "n": [[4, 5], [0, 1, 2, 3, 6, 7]]}
    assert not list(attention_lm._packed(iter([batch.slice(0, 0)])))


def _sequence(words, rows, vocabulary):
    n = len(words)
    share = np.full((n, 1), 1 / vocabulary)
    ids = (words % 7).astype(np.int64)
    return attention_lm.Sequence(words, rows, ids, ids, ids, 0 * ids, share, np.full((n, 1), -math.log(vocabulary)))


def test_probabilities_of_the_next_word_add_up_and_ignore_what_follows():
    rng = np.random.default_rng(0)
    words = rng.integers(0, 5, 90).astype(np.uint64)
    network = attention_lm.Network.start(1)
    for at in (0, 1, 31, 32, 70):
        total = 0
        for w in range(5):
            changed = words.copy()
            changed[at] = w
            changed[at + 1 :] = 3
            total += math.exp(attention_lm.log_probabilities(network, _sequence(changed, np.array([0, 90]), 5))[at])
        assert total == pytest.approx(1, abs=1e-5)


def test_training_learns_to_copy():
    rng = np.random.default_rng(0)
    words = np.concatenate([np.repeat(rng.integers(0, 500, 4), 25) for _ in range(30)]).astype(np.uint64)
    seq = _sequence(words, np.arange(0, 3001, 100), 500)
    before = attention_lm.log_probabilities(attention_lm.Network.start(1), seq).mean()
    assert attention_lm.log_probabilities(attention_lm.train(seq), seq).mean() > before + 1


def test_network_is_trained_on_all_windows_of_all_training_texts(frame, monkeypatch):
    found, fit = [], attention_lm.fit_network
    monkeypatch.setattr(attention_lm, "fit_network", lambda *a: found.append(fit(*a)) or found[-1])
    texts = [(i, "a b c") for i in range(400)] + [(400, "word " * 3_200), (401, None)]
    for tail in ("x y z", "y " * 6_000):
        rows = [*texts, (402, "start " * 1_000 + tail), (500, "held out " * 1_000)]
        assert attention_lm.score(frame(rows), F.col("doc_id") < 500, BPE).count() == len(rows)
    windows = lambda n: -(-(n + 1) // attention_lm.TARGETS)
    assert [n for _, n in found] == [401 + windows(3_200) + windows(1_000 + k) for k in (3, 6_000)]
    assert not np.allclose(found[0][0].flat(), found[1][0].flat())
