"""Daily weather per airport from raw station observations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehold.functions import columns as C
from gatehold.operators.joins import lookup_join

DAILY_SUMMARY = "SOD"  # report type of a daily summary row


def _daily_columns(airport: Column) -> list[Column]:
    date = F.col("DATE")
    return [
        F.col("STATION"),
        airport.alias("Airport"),
        date,
        C.year_of(date).alias("YEAR"),
        C.month_of(date).alias("MONTH"),
        C.day_of(date).alias("DAY"),
        C.day_key(date).alias("DateString"),
        C.amount(F.col("DailyPrecipitation")).alias("PREP"),
        C.amount(F.col("DailySnowfall")).alias("SNOW"),
        C.whole_amount(F.col("DailySnowDepth")).alias("SNWD"),
        F.col("DailyMinimumDryBulbTemperature").alias("TMIN"),
        F.col("DailyMaximumDryBulbTemperature").alias("TMAX"),
    ]


def daily_summaries(raw: DataFrame) -> DataFrame:
    return raw.filter(C.trimmed_equals(F.col("REPORT_TYPE2"), DAILY_SUMMARY))


def daily_weather(raw: DataFrame, stations: DataFrame | dict[str, str]) -> DataFrame:
    """Daily weather of every mapped station, in one pass over `raw`.

    `stations` maps STATION to Airport, as a dict or as a frame of two columns.
    """
    if isinstance(stations, dict):
        stations = raw.sparkSession.createDataFrame(list(stations.items()), "STATION string, Airport string")
    days = lookup_join(daily_summaries(raw), stations.select("STATION", "Airport"), ["STATION"])
    return days.select(*_daily_columns(F.col("Airport")))


def station_weather(raw: DataFrame, station: str, airport: str) -> DataFrame:
    """Daily weather of one station under a constant airport code."""
    return daily_summaries(raw).filter(F.col("STATION") == station).select(*_daily_columns(F.lit(airport)))


def stacked(parts: list[DataFrame]) -> DataFrame:
    """Bag union of frames with the same columns."""
    return reduce(DataFrame.unionByName, parts)
