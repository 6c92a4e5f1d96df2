"""Airport reference data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.functions import columns as C


def with_region(codes: DataFrame) -> DataFrame:
    """Add `region`, the second part of `iso_region`; null when there is none."""
    return codes.withColumn("region", C.part_of(F.col("iso_region"), "-", 1))


def with_airport(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights with the columns of their destination airport.

    No hint: Spark broadcasts the airports while their size is under its
    threshold, and otherwise shuffles, splitting skewed destinations.
    """
    known = airports.filter(F.col("iata_code").isNotNull())
    return flights.join(known, flights["Dest"] == known["iata_code"], "inner")
