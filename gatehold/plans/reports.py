"""Delay reports over the cleaned flights.

All are grouped sums: Spark adds up inside each task before the shuffle, so a
hot route or year costs one partial row per task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gatehold.functions import columns as C

REPORT_FLOOR = 100_000  # total delay a route must exceed to be listed


def _selected(flights: DataFrame, years: list[int] | int, origin: str | None) -> DataFrame:
    years = [years] if isinstance(years, int) else list(years)
    picked = flights.filter(F.col("Year").isin(*years) if len(years) > 1 else F.col("Year") == years[0])
    return picked if origin is None else picked.filter(F.col("Origin") == origin)


def _by_route(flights: DataFrame) -> DataFrame:
    return flights.groupBy(
        F.col("Year").alias("year"), F.col("Origin").alias("origin"), F.col("Dest").alias("dest")
    ).agg(F.sum("delay").alias("total_delay"))


def delay_by_route(
    flights: DataFrame, years: list[int] | int, origin: str | None = None, floor: int = REPORT_FLOOR
) -> DataFrame:
    """Total delay per year, origin and destination above `floor`, by year and total."""
    totals = _by_route(_selected(flights, years, origin))
    return totals.filter(F.col("total_delay") > floor).orderBy("year", "total_delay")


def delay_by_named_route(
    flights: DataFrame,
    airports: DataFrame,
    years: list[int] | int,
    origin: str | None = None,
    floor: int = REPORT_FLOOR,
) -> DataFrame:
    """The same with destinations labelled 'code - airport name'.

    Delays are summed per route before the airports are joined, so the join sees
    routes, not flights. Several airports under one code count as in a plain join.
    """
    routes = _by_route(_selected(flights, years, origin))
    known = airports.filter(F.col("iata_code").isNotNull()).select("iata_code", F.col("name").alias("airport"))
    totals = (
        routes.join(known, routes["dest"] == known["iata_code"], "inner")
        .groupBy("year", "origin", "airport", "dest")
        .agg(F.sum("total_delay").alias("total_delay"))
        .filter(F.col("total_delay") > floor)
    )
    name = C.joined(F.col("dest"), F.lit(" - "), F.col("airport"))
    return totals.select("year", "origin", name.alias("name"), "total_delay").orderBy("year", "total_delay")


def delay_by_named_route_from(
    flights: DataFrame,
    airports: DataFrame,
    year: int,
    years: int = 3,
    origin: str | None = None,
    floor: int = REPORT_FLOOR,
) -> DataFrame:
    """`delay_by_named_route` for `year` and the years that follow."""
    return delay_by_named_route(flights, airports, C.following_years(year, years), origin, floor)


def delay_by_destination(flights: DataFrame, destinations: list[str]) -> DataFrame:
    return (
        flights.filter(F.col("Dest").isin(*destinations))
        .groupBy(F.col("Year").alias("year"), F.col("Dest").alias("dest"))
        .agg(F.sum("delay").alias("total_delay"))
        .orderBy("year")
    )


def yearly_delays(flights: DataFrame) -> DataFrame:
    """Per year: how many flights were delayed at all, and by how much together."""
    return (
        flights.filter(F.col("delay") > 0)
        .groupBy(F.col("Year").alias("year"))
        .agg(F.count(F.lit(1)).alias("delayed"), F.sum("delay").alias("total_delay"))
        .orderBy("year")
    )


def matching_count(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.filter(condition).agg(F.count(F.lit(1)).alias("n"))


def years_present(flights: DataFrame) -> DataFrame:
    return flights.select(F.col("Year").alias("year")).distinct().orderBy("year")


def run_report(spark: SparkSession, query: str, **parameters) -> DataFrame:
    """A report written as SQL with named parameters, such as `WHERE year = :year`."""
    return spark.sql(query, args=parameters)
