import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gatehold.functions import columns as C
from gatehold.functions.sql import register_functions

_SETTINGS = settings(max_examples=8, deadline=None)


def values(spark, column, data, kind="string"):
    """The values of a column expression over `x`, in the order of `data`."""
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, x {kind}")
    return [r[1] for r in df.select("i", column.alias("v")).orderBy("i").collect()]


def plain_hour(text):
    if text is None or not 1 <= len(text) <= 4:
        return None
    hour, minute = int(text.zfill(4)[:2]), int(text.zfill(4)[2:])
    return hour + minute / 60 if hour < 24 and minute < 60 else None


def test_hour_base10_examples(spark):
    got = values(spark, C.hour_base10(F.col("x")), ["741", "0741", "5", "2359", "2400", "1260", "", "12345", "ab", None])
    assert got == [7 + 41 / 60, 7 + 41 / 60, 5 / 60, 23 + 59 / 60, None, None, None, None, None, None]


@given(st.lists(st.one_of(st.none(), st.integers(0, 99999).map(str)), min_size=1, max_size=40))
@_SETTINGS
def test_hour_base10_property(spark, data):
    assert values(spark, C.hour_base10(F.col("x")), data) == [plain_hour(v) for v in data]


@pytest.mark.parametrize("bad", ["2400", "0060", "123456", None])
def test_hour_base10_strict_raises(spark, bad):
    with pytest.raises(PySparkException, match="HHMM"):
        values(spark, C.hour_base10(F.col("x"), strict=True), [bad])


_parts = st.tuples(st.integers(0, 12000), st.integers(0, 130), st.integers(0, 130))


@given(st.lists(_parts, min_size=1, max_size=40))
@_SETTINGS
def test_date_string_property(spark, data):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(data)], "i int, y int, m int, d int")
    text = C.date_string(F.col("y"), F.col("m"), F.col("d"))
    got = [r[1] for r in df.select("i", text.alias("v")).orderBy("i").collect()]
    assert got == [f"{y:04d}{m:02d}{d:02d}" for y, m, d in data]


def test_date_string_null_and_text(spark):
    df = spark.createDataFrame([("2007", "3", "4"), (None, "3", "4"), ("x", "3", "4")], "y string, m string, d string")
    text = C.date_string(F.col("y"), F.col("m"), F.col("d"))
    assert [r[0] for r in df.select(text).collect()] == ["20070304", None, None]
    with pytest.raises(PySparkException, match="whole numbers"):
        df.select(C.date_string(F.col("y"), F.col("m"), F.col("d"), strict=True)).collect()


@given(st.lists(st.one_of(st.none(), st.integers(-500, 500)), min_size=1, max_size=40))
@_SETTINGS
def test_delay_label_property(spark, data):
    assert values(spark, C.delay_label(F.col("x")), data, "int") == [int(v is not None and v > 15) for v in data]


def test_delay_label_of_text(spark):
    assert values(spark, C.delay_label(F.col("x")), ["16", "15", "x", None]) == [1, 0, 0, 0]


def test_casts(spark):
    text = ["1", "1.2", "-1.9", "T", None, "99999999999"]
    assert values(spark, C.as_int(F.col("x")), text) == [1, 1, -1, None, None, None]
    assert values(spark, C.as_double(F.col("x")), text) == [1.0, 1.2, -1.9, None, None, 99999999999.0]


def test_trace_amounts(spark):
    assert values(spark, C.amount(F.col("x")), ["T", "0.3", "0.05s", None]) == [0.0, 0.3, None, None]
    assert values(spark, C.whole_amount(F.col("x")), ["T", "1.2", "5", None]) == [0, 1, 5, None]


def test_text_helpers(spark):
    assert values(spark, C.trimmed_equals(F.col("x"), "SOD"), ["SOD  ", " SOD", "FM-15", None]) == [
        True, True, False, None,
    ]
    assert values(spark, C.part_of(F.col("x"), "-", 1), ["US-WA", "US", None]) == ["WA", None, None]
    assert values(spark, C.joined(F.col("x"), F.lit("!")), ["a", None]) == ["a!", None]
    assert values(spark, C.or_default(F.col("x"), "N/A"), ["a", None]) == ["a", "N/A"]


def test_date_parts(spark):
    df = spark.sql("SELECT timestamp'2008-02-29 23:59:00' AS x")
    parts = [C.year_of(F.col("x")), C.month_of(F.col("x")), C.day_of(F.col("x")), C.day_key(F.col("x"))]
    assert tuple(df.select(*parts).first()) == (2008, 2, 29, "20080229")


def test_scaled_int_cuts_in_binary_arithmetic(spark):
    data = [0.29, 0.3, 7.683333333333334, -0.299, None]
    expected = [None if v is None else math.trunc(v * 100) for v in data]
    assert values(spark, C.scaled_int(F.col("x")), data, "double") == expected
    assert expected[0] == 28


def test_following_years():
    assert C.following_years("2007") == [2007, 2008, 2009]


def test_sql_functions_agree_with_the_columns(spark):
    register_functions(spark)
    df = spark.createDataFrame(
        [("2007", "3", "4", "741", "16"), ("12007", "3", "4", "2400", "15"), (None, "3", "4", None, None)],
        "y string, m string, d string, t string, delay string",
    )
    df.createOrReplaceTempView("function_rows")
    by_sql = spark.sql("SELECT toDateString(y, m, d), get_hour_base10(t), delay_label(delay) FROM function_rows")
    by_column = df.select(
        C.date_string(F.col("y"), F.col("m"), F.col("d")), C.hour_base10(F.col("t")), C.delay_label(F.col("delay"))
    )
    assert [tuple(r) for r in by_sql.collect()] == [tuple(r) for r in by_column.collect()]


def test_part_of_takes_the_separator_literally(spark):
    assert values(spark, C.part_of(F.col("x"), "|", 1), ["US|WA", "US.WA"]) == ["WA", None]
    assert values(spark, C.part_of(F.col("x"), ".", 1), ["US|WA", "US.WA"]) == [None, "WA"]
