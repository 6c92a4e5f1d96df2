"""Flights: raw rows, cleaned and labelled rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gatehold.functions import columns as C


def bronze(raw: DataFrame, origins: list[str] | None = None) -> DataFrame:
    """Raw rows that leave from one of `origins`; all rows when None."""
    return raw if origins is None else raw.filter(F.col("Origin").isin(*origins))


def silver(raw: DataFrame, strict: bool = False) -> DataFrame:
    """Typed, renamed and labelled flights.

    An unknown delay counts as 0 and so as on time. With `strict`, a scheduled
    time or date that cannot be read fails the job; otherwise it becomes null.
    """
    typed = {name for name, kind in raw.dtypes if kind == "int"}

    def whole(name: str) -> Column:
        # Already whole numbers are passed through, so that filters on them reach the scan.
        return F.col(name) if name in typed else C.as_int(F.col(name))

    delay = whole("DepDelay")
    return raw.select(
        whole("Year").alias("Year"),
        whole("Month").alias("Month"),
        whole("DayofMonth").alias("Day"),
        whole("DayOfWeek").alias("DayOfWeek"),
        C.date_string(whole("Year"), whole("Month"), whole("DayofMonth"), strict).alias("DateString"),
        C.hour_base10(F.col("CRSDepTime").cast("string"), strict).alias("decimal_DepTime"),
        F.col("UniqueCarrier"),
        whole("FlightNum").alias("FlightNum"),
        C.or_default(F.col("TailNum"), "N/A").alias("TailNum"),
        F.col("Origin"),
        F.col("Dest"),
        whole("Distance").alias("Distance"),
        C.or_default(delay, 0).alias("delay"),
        C.delay_label(delay).alias("label"),
    )
