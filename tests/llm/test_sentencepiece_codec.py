"""Ids against the sentencepiece library, and round trips."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from gatehold.llm import queries, sentencepiece_codec
from tests.llm.conftest import SMALL

PATH = public_tokenizers.path("piece_bpe_32k.model")
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


@settings(max_examples=400, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"], exclude_characters="▁\0"), max_size=60) | st.text(" abéé\n\t1.", max_size=60))
def test_parity(text):
    ids = sentencepiece_codec.codec(PATH).encode(text, add_special_tokens=False).ids
    assert ids == LIBRARY.encode(text)
    assert sentencepiece_codec.codec(PATH).decode(ids, skip_special_tokens=False) == text


def test_edges(spark, frame):
    df = frame([(20, None), (40, ""), (60, "word " * 20_000), (None, "a b"), (1, "<s> é 中")])
    rows = {r["doc_id"]: r for r in sentencepiece_codec.checked(df, PATH).collect()}
    assert [rows[i]["n_ids"] for i in (20, 40)] == [0, 0] and all(r["round_trip"] for r in rows.values())
    assert [rows[i]["parity"] for i in (20, 40, 60, None, 1)] == [True] * 5
    ids = sentencepiece_codec.encoded(df, PATH)
    back = {r["doc_id"]: r["text"] for r in sentencepiece_codec.decoded(ids, PATH).collect()}
    assert back[1] == "<s> é 中" and back[20] == ""
    assert sentencepiece_codec.checked(frame({}), PATH).count() == 0


def test_query(spark, documents):
    rows = queries.op9_sentencepiece(spark, SMALL).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert len(rows) == len(texts)
    assert all(r["round_trip"] and r["parity"] in (True, None) for r in rows)
    assert all(r["n_ids"] == len(LIBRARY.encode(texts[r["doc_id"]] or "")) for r in rows)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=40) | st.text(" abéé▁\n\t1.", max_size=60), max_size=4))
def test_ids_by_word_are_those_of_whole_texts(texts):
    words = sentencepiece_codec.words_of(PATH)
    assert words.by_word
    codec = sentencepiece_codec.codec(PATH)
    for t, (ids, back, same) in zip(texts, words.checked(texts), strict=True):
        whole = codec.encode(t, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == whole
        assert back == (codec.decode(whole, skip_special_tokens=False) == t)
        assert same == (LIBRARY.encode(t) == whole)


def test_parity_of_every_row(spark, frame):
    assert all(r["parity"] is True for r in queries.op9_sentencepiece(spark, SMALL).collect())
    df = frame([(7, "a b"), (None, "a  b "), (3, None), (11, "▁a")])
    # Texts that the codec and the library take apart in different ways are told.
    marked = sentencepiece_codec.codec(PATH).encode("▁a", add_special_tokens=False).ids == LIBRARY.encode("▁a")
    got = {r["doc_id"]: r["parity"] for r in sentencepiece_codec.checked(df, PATH).collect()}
    assert got == {7: True, None: True, 3: True, 11: marked}
