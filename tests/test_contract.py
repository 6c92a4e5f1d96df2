"""The registered queries against their SQL on the smallest driver tables."""

from __future__ import annotations

import os
import re
import sys
from pathlib import Path

import duckdb
import pytest

FOLDER = "/root/testdata/sf0.001"
sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as contract  # noqa: E402
from tools import compare  # noqa: E402

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables not present")

CHECKED = """
    s3_glob_csv t6_delete_rows t7_history t9_zorder p1_silver f6_trimmed_equality j1_gold_join j1_salted_join
    j1_unmatched a1_delay_by_route a4_delay_by_named_route_from a9_missing_counts o4_top_delays u1_multipart_csv
    d1_sql_functions m4_feature_table m8_roc_points m8_roc_area j1_hot_carriers t6_compact t9_file_skipping
    a9_missing_while_written m5_train_sample m7_model_metrics c1_refinement_chain
""".split()


@pytest.fixture(scope="module")
def connection():
    connection = duckdb.connect()
    for file in Path(FOLDER).glob("*.parquet"):
        connection.sql(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


@pytest.mark.parametrize("name", CHECKED)
def test_query_equals_sql(spark, connection, name):
    good, note = compare.check(spark, connection, FOLDER, name)
    assert good, note


def test_every_query_has_sql():
    own = {q for q in contract.queries() if q != "pipeline" and not re.match(r"op\d", q)}
    assert own <= set(contract.oracle_sql())
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    result = contract.entry(spark)
    assert result.columns == ["year", "origin", "name", "total_delay"] and result.count() > 0
