"""Counts against the tokenizers library."""

from __future__ import annotations

import json

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gatehold.llm import queries, token_counts
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("word_bpe_49k.json")
KNOWN = token_counts.vocabulary(PATH)
TABLE = token_counts.table_of({w.encode(): 1 for w in ("the", "don", "'s", "\0", "\0\0", "é", "中", "!!", "straße", "a" * 23)}, PATH)
TEXTS = st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text(" ''sStTmdreLVlKéÉΣσİ̱́HǅẞK中½1\n\t\0\x1c !<|", max_size=30)


def library(texts):
    return [len(e.ids) for e in KNOWN.library.encode_batch(texts, add_special_tokens=False)]


def by_tiers(texts, table=TABLE):
    parts = token_counts.cut(texts, KNOWN)
    sizes = parts.ends - parts.starts
    lengths = table.lookup(parts.raw, parts.starts, sizes).astype(np.int64)
    missed = np.flatnonzero(lengths == 0)
    lengths[missed] = KNOWN.remembered([parts.raw[parts.starts[i] : parts.ends[i]] for i in missed])
    return (parts.extra + np.diff(np.concatenate(([0], np.cumsum(lengths)))[parts.first])).tolist()


@settings(max_examples=600, deadline=None)
@given(st.lists(TEXTS, max_size=5))
def test_counts_of_any_texts(texts):
    assert by_tiers(texts) == library(texts)


def test_special_strings_contractions_and_new_characters():
    texts = [
        "<|endoftext|>", "a<|endoftext|><|startoftext|>'s", "<|endoftext", "'sound ''s x'LL 'Re's'", "H̱ T̈ ǰ ΣΑΣ İ",
        "\U0001cc00 \U00010d50", "’s", "a" * 23 + " " + "a" * 24, "\0\0 \0 \0\0\0", "'", "",
    ]
    assert by_tiers(texts) == library(texts)
    assert [by_tiers([t])[0] for t in texts] == library(texts)


@settings(max_examples=50, deadline=None)
@given(st.dictionaries(st.binary(min_size=1, max_size=30), st.integers(1, 300), max_size=200), st.lists(st.binary(min_size=1, max_size=30), max_size=50))
def test_table_has_what_fits_and_nothing_else(lengths, others):
    table = token_counts.Table(lengths)
    asked = [*lengths, *others]
    sizes = np.array([len(a) for a in asked], np.int64)
    got = table.lookup(b"".join(asked), np.cumsum(sizes) - sizes, sizes).tolist()
    kept = {p: n for p, n in lengths.items() if len(p) <= token_counts.LONG and n < 256}
    assert got == [kept.get(a, 0) for a in asked]


def test_edges(spark, frame):
    rows = [(1, None), (2, ""), (3, "word " * 300_000), (3, "word " * 300_000), (None, "a b"), (4, "x" * 5_000), (5, "中" * 3_000)]
    df = frame(rows).withColumnRenamed("source", "n_tokens")
    got = sorted((tuple(r) for r in token_counts.counted(df, PATH).collect()), key=repr)
    counts = library([t or "" for _, t in rows])
    assert got == sorted(((i, len((t or "").encode()), n, n > 2048) for (i, t), n in zip(rows, counts)), key=repr)
    assert token_counts.counted(frame({}), PATH).count() == 0
    assert token_counts.frequent(frame({}), PATH) == {}
    assert token_counts.counted(frame([(1, None)]), PATH).first()["n_tokens"] == 0


def test_counts_do_not_depend_on_the_table(spark, frame):
    found = token_counts.frequent(frame([(i, "The cat's the CAT") for i in range(50)]).repartition(5), PATH)
    assert found == {b"the": 100, b"cat": 100, b"'s": 50}
    text = "The cat's the CAT"
    assert by_tiers([text], token_counts.Table({})) == by_tiers([text], token_counts.table_of(found, PATH)) == library([text])


def test_summaries_keep_the_most_frequent():
    counts = {b"%d" % i: i for i in range(100)}
    assert token_counts._trim(counts, 3) == {b"99": 99, b"98": 98, b"97": 97}
    assert token_counts._row({b"%d" % i: 1 for i in range(2 * token_counts.FREQUENT)}).column(0).flatten().to_pylist()[0]
    assert len(token_counts._trim({b"%d" % i: 1 for i in range(50)}, 7)) == 7


def test_other_normalisers_are_refused(tmp_path):
    with open(PATH, encoding="utf-8") as file:
        spec = json.load(file)
    spec["normalizer"]["normalizers"].pop()
    (tmp_path / "other.json").write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        token_counts.Vocabulary(str(tmp_path / "other.json"))


def test_query(spark, documents):
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    rows = queries.op11_token_counts(spark, SMALL).collect()
    counts = dict(zip(texts, library(list(texts.values()))))
    assert len(rows) == len(texts)
    assert {r["doc_id"]: (r["n_tokens"], r["n_bytes"]) for r in rows} == {i: (counts[i], len(t.encode())) for i, t in texts.items()}
