"""Forms and cuts against a plain rendering of the rules, and the index against all offsets."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gatehold.llm import fill_middle, queries
from gatehold.llm.rolling import blocks
from tests.llm.conftest import SMALL


def plainly(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (len(tokens) + 1), h2 % (len(tokens) + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        return doc_id, len(tokens), "plain", None, None, text
    if h4 % 100 < 20:
        return doc_id, len(tokens), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(tokens), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 3_000), max_size=300), min_size=1, max_size=6), st.sampled_from([0, 1, 9, 126]))
def test_index_gives_every_offset(steps, error):
    offsets = [np.concatenate(([0], np.cumsum(np.array(s, np.int64)))) for s in steps]
    first = np.concatenate(([0], np.cumsum([len(o) for o in offsets])))
    flat = np.concatenate(offsets)
    index = fill_middle.fit(flat, first, error)
    ranks = np.random.default_rng(0).permutation(len(flat))
    assert (index.offsets(ranks) == flat[ranks]).all()
    assert np.abs(flat - index.predicted(np.arange(len(flat)))).max() <= error + 1
    assert np.isin(first[:-1], index.starts).all()


def test_even_offsets_need_one_segment_and_uneven_ones_few():
    even = np.arange(0, 700_000, 7)
    assert len(fill_middle.fit(even, np.array([0, len(even)])).starts) == 1
    words = np.concatenate(([0], np.cumsum(np.random.default_rng(0).integers(1, 9, 100_000))))
    assert len(fill_middle.fit(words, np.array([0, len(words)])).starts) < 2_000


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("aZé中🎉 .\n", max_size=30), min_size=1, max_size=5))
def test_boundaries(texts):
    for _, _, data, offsets in blocks(pa.array(texts)):
        ends, first = fill_middle.boundaries(data, offsets)
        got = [ends[a:b].tolist() for a, b in zip(first, first[1:])]
    assert got == [[m.start() for m in re.finditer("[A-Za-z]+|[^A-Za-z]", t)] + [len(t)] for t in texts]


def test_edges(spark, frame):
    rows = [(1, None), (2, ""), (3, "word é中🎉 " * 100_000), (4, "x <P> y"), (5, "<P"), (5, "<P"), (None, "a b c")]
    rows += [(i, f"some words <S <{'S' * i} and <M<P {i} >M> <"[: 5 * i]) for i in range(10, 60)]
    df = frame(rows).withColumnsRenamed({"source": "output", "lang": "form"})
    out = fill_middle.fill_in_middle(df).withColumn("back", fill_middle.restored(F.col("output"), F.col("form")))
    got = out.collect()
    assert sorted((tuple(r)[:6] for r in got), key=repr) == sorted((plainly(*r) for r in rows), key=repr)
    assert sorted(r["back"] for r in got) == sorted(t or "" for _, t in rows)
    assert {"plain", "psm", "spm"} == {r["form"] for r in got}
    assert fill_middle.fill_in_middle(frame({})).count() == 0


def test_query(spark, documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    rows = {r["doc_id"]: r for r in queries.op12_fill_in_middle(spark, SMALL).collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        *head, output = plainly(i, t)
        assert tuple(rows[i])[:5] == tuple(head)
        assert rows[i]["output_sha256"] == hashlib.sha256(output.encode()).hexdigest()
        assert rows[i]["restored_sha256"] == hashlib.sha256((t or "").encode()).hexdigest()
