"""Flights with the weather at their origin on their day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.functions import columns as C
from gatehold.operators.joins import BROADCAST_BYTES, duplicate_keys, lookup_join

KEYS = ["DateString", "Origin"]
WEATHER_COLUMNS = ["STATION", "DATE", "PREP", "SNOW", "SNWD", "TMIN", "TMAX"]


def _by_origin(weather: DataFrame) -> DataFrame:
    return weather.select("DateString", F.col("Airport").alias("Origin"), *WEATHER_COLUMNS)


def gold(flights: DataFrame, weather: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """All flight columns plus the weather columns; flights without weather are left out.

    `weather` is read twice (measured, then joined): pass a stored table.
    """
    return lookup_join(flights, _by_origin(weather), KEYS, broadcast_bytes=broadcast_bytes)


def unmatched_count(flights: DataFrame, weather: DataFrame) -> DataFrame:
    """How many flights `gold` leaves out.

    Flights are counted per (day, origin) first, so the join sees one row per pair.
    """
    pairs = flights.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n"))
    days = _by_origin(weather).select(*KEYS).distinct()
    return pairs.join(days, KEYS, "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("unmatched"))


def repeated_weather(weather: DataFrame) -> DataFrame:
    """(day, airport) pairs with more than one weather row; each multiplies its flights in `gold`."""
    return duplicate_keys(weather, ["DateString", "Airport"])


def with_line(flights: DataFrame) -> DataFrame:
    """Add `line`, origin and destination as one route code."""
    return flights.withColumn("line", C.joined(F.col("Origin"), F.col("Dest")))
