import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from gatehold.operators import quality
from gatehold.plans import airports, flights, gold, weather

from .conftest import rows_of


def test_bronze_keeps_the_named_origins(raw):
    assert rows_of(flights.bronze(raw, ["ORD", "SEA"]).groupBy("Origin").count()) == [("ORD", 6), ("SEA", 1)]
    assert flights.bronze(raw).count() == 9


def test_silver(silver):
    columns = ["FlightNum", "DateString", "decimal_DepTime", "TailNum", "delay", "label"]
    assert rows_of(silver, *columns) == sorted(
        [
            (100, "20070304", 7 + 41 / 60, "N1", 16, 1),
            (101, "20070304", 5 / 60, "N/A", 15, 0),
            (7, "20071231", 23 + 59 / 60, "N2", 0, 0),
            (8, "20080101", 12.0, "N3", -4, 0),
            (9, "20080101", None, "N3", 1, 0),
            (10, "20080229", None, "N4", 30, 1),
            (12, "19871015", 6.5, "N/A", 20, 1),
        ],
        key=repr,
    )
    assert [t for _, t in silver.dtypes] == ["int"] * 4 + ["string", "double", "string", "int"] + ["string"] * 3 + ["int"] * 3


def test_silver_from_text_columns(raw, silver):
    as_text = raw.select([F.col(c).cast("string").alias(c) for c in raw.columns])
    assert rows_of(flights.silver(flights.bronze(as_text, ["ORD", "SEA"]))) == rows_of(silver)


def test_strict_silver_raises(raw):
    with pytest.raises(PySparkException, match="HHMM"):
        flights.silver(raw, strict=True).collect()


def test_filter_on_silver_reaches_the_scan(spark, raw, tmp_path):
    raw.write.parquet(str(tmp_path / "bronze"))
    stored = flights.silver(spark.read.parquet(str(tmp_path / "bronze"))).filter("Year = 2007").select("delay")
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(Year,2007)" in plan and "ReadSchema: struct<Year:int,DepDelay:int>" in plan


def test_daily_weather(daily):
    columns = ["Airport", "DateString", "PREP", "SNOW", "SNWD", "TMIN", "TMAX"]
    assert rows_of(daily, *columns) == sorted(
        [
            ("ORD", "20070304", 0.0, 0.3, 0, 20, 33),
            ("SEA", "20070304", 0.29, 0.0, 1, 38, 50),
            ("ORD", "20071231", None, 1.2, 5, 10, 25),
            ("ORD", "20080101", None, 0.0, 0, 12, 28),
        ],
        key=repr,
    )
    assert rows_of(daily, "YEAR", "MONTH", "DAY")[0] == (2007, 12, 31)


def test_stations_as_a_frame_or_one_by_one(spark, weather_raw, daily):
    stations = spark.createDataFrame([("STN1", "ORD"), ("STN2", "SEA")], "STATION string, Airport string")
    assert rows_of(weather.daily_weather(weather_raw, stations)) == rows_of(daily)
    parts = [weather.station_weather(weather_raw, "STN1", "ORD"), weather.station_weather(weather_raw, "STN2", "SEA")]
    assert rows_of(weather.stacked(parts)) == rows_of(daily)


def test_airport_region(airport_codes):
    assert rows_of(airport_codes, "iata_code", "region") == [
        ("EWR", "NJ"), ("LGA", "NY"), ("ORD", "IL"), ("SEA", "WA"), ("XXX", None),
    ]


def test_airport_join(silver, airport_codes):
    joined = airports.with_airport(silver, airport_codes)
    assert rows_of(joined.groupBy("Dest", "name").count())[0] == ("EWR", "Newark", 1)
    assert joined.count() == 7


def test_gold_pairs_each_flight_with_the_weather_of_its_origin(silver, daily):
    joined = gold.gold(silver, daily)
    assert joined.columns == [*silver.columns, "STATION", "DATE", "PREP", "SNOW", "SNWD", "TMIN", "TMAX"]
    assert rows_of(joined, "FlightNum", "STATION", "TMAX") == sorted(
        [(100, "STN1", 33), (101, "STN2", 50), (7, "STN1", 25), (8, "STN1", 28), (9, "STN1", 28)], key=repr
    )
    assert gold.unmatched_count(silver, daily).first()["unmatched"] == 2


def test_repeated_weather_multiplies_and_is_reported(silver, daily):
    twice = daily.union(daily.filter("Airport = 'SEA'"))
    assert rows_of(gold.repeated_weather(twice)) == [("20070304", "SEA", 2)]
    assert gold.gold(silver, twice).filter("Origin = 'SEA'").count() == 2
    assert gold.repeated_weather(daily).count() == 0


def test_gold_is_the_same_without_broadcast(silver, daily):
    assert rows_of(gold.gold(silver, daily, broadcast_bytes=-1)) == rows_of(gold.gold(silver, daily))


def test_line(silver):
    assert ("ORDSEA",) in rows_of(gold.with_line(silver), "line")


def test_missing_counts_tell_nulls_from_nans(spark):
    df = spark.createDataFrame([(1.0, "a"), (float("nan"), None), (None, None)], "x double, t string")
    assert quality.missing_counts(df).first().asDict() == {"x_nulls": 1, "t_nulls": 2, "x_nans": 1}
    assert rows_of(quality.missing_report(df)) == [("t", 2, None), ("x", 1, 1)]
