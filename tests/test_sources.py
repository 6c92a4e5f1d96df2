import pytest
from pyspark.errors import PySparkException

from gatehold import schemas, session
from gatehold.sources import files, tables

from .conftest import rows_of


def test_headed_csv_infers_types_and_reads_the_null_token(spark, flight_files):
    df = files.headed_csv(spark, f"{flight_files}/part-00000")
    assert dict(df.dtypes)["Year"] == "int" and dict(df.dtypes)["Origin"] == "string"
    assert rows_of(df, "FlightNum", "TailNum") == [(100, "N1"), (101, None)]


def test_headed_csv_with_other_delimiter(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x;y\n1;-\n2;b\n")
    df = files.headed_csv(spark, str(tmp_path), delimiter=";", null_token="-")
    assert rows_of(df) == [(1, None), (2, "b")]


def test_headerless_csv_takes_the_schema_of_another_frame(spark, flight_files):
    head = files.headed_csv(spark, f"{flight_files}/part-00000")
    df = files.headerless_csv(spark, f"{flight_files}/part-00501", head.schema)
    assert df.schema == head.schema
    assert df.count() == 6
    assert df.filter("DepDelay IS NULL").count() == 1


def test_unreadable_number_becomes_null(spark, flight_files):
    df = files.headerless_csv(spark, f"{flight_files}/part-00777", schemas.FLIGHTS_RAW)
    assert rows_of(df, "Year", "FlightNum", "Origin") == [(2006, None, "LAX")]


def test_glob_with_character_classes(spark, flight_files):
    df = files.headerless_csv(spark, f"{flight_files}/part-00[5-6][0-9][0-9]", schemas.FLIGHTS_RAW)
    assert df.count() == 6


def test_multipart_csv_is_the_bag_of_all_parts(spark, flight_files):
    df = files.multipart_csv(spark, f"{flight_files}/part-00000", f"{flight_files}/part-00[5-9][0-9][0-9]")
    assert df.count() == 9
    assert df.union(df).count() == 18


def test_json_with_and_without_schema(spark, airport_file):
    declared = files.json_lines(spark, airport_file, schemas.AIRPORT_CODES)
    inferred = files.json_lines(spark, airport_file)
    assert rows_of(declared, "iata_code", "name") == rows_of(inferred, "iata_code", "name")
    assert declared.count() == 5


def test_text_csv_has_only_strings(spark, flight_files):
    df = files.text_csv(spark, f"{flight_files}/part-00000")
    assert {t for _, t in df.dtypes} == {"string"}
    assert rows_of(df, "TailNum") == [("N1",), ("NA",)]


def test_views_and_tables(spark, raw, database):
    view = tables.register_view(raw, "flights_raw_test")
    assert view.count() == 9
    named = tables.sql_view(spark, "late_test", "SELECT * FROM flights_raw_test WHERE DepDelay > 15")
    assert tables.table(spark, "late_test").count() == named.count() == 3
    raw.write.mode("overwrite").saveAsTable(f"{database}.scan_me")
    assert tables.table(spark, f"{database}.scan_me").count() == 9


def test_local_rows(spark):
    import pandas as pd

    df = tables.local_rows(spark, pd.DataFrame({"a": [1, 2], "b": ["x", None]}), "a int, b string")
    assert rows_of(df) == [(1, "x"), (2, None)]


def test_scratch_folder_needs_a_shared_setting_on_a_cluster(spark):
    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"
        applicationId = "x"

        def getConf(self):
            return Conf()

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(PySparkException, match="spark.checkpoint.dir"):
        session.scratch_root(Session())


def test_staged_rows_are_the_same_rows(raw):
    assert rows_of(session.staged(raw, "raw")) == rows_of(raw)
