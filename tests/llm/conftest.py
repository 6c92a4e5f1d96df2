"""Frames of hand-made texts and the driver's smallest tables."""

from __future__ import annotations

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def frame(spark):
    """frame({doc_id: text}) or frame([(doc_id, text), ...]) as a documents table."""

    def build(texts):
        rows = texts.items() if isinstance(texts, dict) else texts
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA)

    return build


@pytest.fixture
def documents(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")
