"""The inputs of the library, derived from order, line item, customer and supplier tables.

A shipment plays the flight: it leaves the supplier's nation on its ship date
for the customer's nation, and its delay is the days since the order. The orders
of a nation on a day play the weather there. Whole tables are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


# Declared, so that opening a table needs no job that reads a footer.
_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
}


def _read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(_SCHEMAS[name]).parquet(f"{folder}/{name}.parquet")


def flights_raw(spark: SparkSession, folder: str) -> DataFrame:
    """Customers are joined to the orders before the line items, so the largest table is shuffled for its order
    and, unless suppliers fit a broadcast, for its supplier, and not for its customer too.

    Line items and orders grow together, so that join is always a shuffle on the order, whose skewed keys
    Spark splits; the other sides it broadcasts while it knows them to be small.
    """
    lineitem = _read(spark, folder, "lineitem")
    orders = _read(spark, folder, "orders")
    customer = _read(spark, folder, "customer")
    supplier = _read(spark, folder, "supplier")
    nation = _read(spark, folder, "nation")
    sources = nation.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("Origin"))
    targets = nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("Dest"))
    ordered = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(targets, "c_nationkey")
    shipped = (
        lineitem.join(ordered.hint("merge"), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(sources, "s_nationkey")
    )
    day = F.col("l_shipdate")
    minute = (F.col("l_orderkey") * 37 + F.col("l_linenumber") * 11) % 1440
    clock = ((minute - minute % 60) / 60 * 100 + minute % 60).cast("int").cast("string")
    odd = F.col("l_orderkey") + F.col("l_linenumber")
    return shipped.select(
        F.year(day).alias("Year"),
        F.month(day).alias("Month"),
        F.dayofmonth(day).alias("DayofMonth"),
        (F.weekday(day) + 1).alias("DayOfWeek"),
        F.when(odd % 97 == 0, None).when(odd % 89 == 0, "2400").otherwise(clock).alias("CRSDepTime"),
        F.concat("l_returnflag", "l_linestatus").alias("UniqueCarrier"),
        F.col("l_linenumber").alias("FlightNum"),
        F.when(F.col("l_discount") != 0, F.concat(F.lit("N"), F.col("l_suppkey").cast("string"))).alias("TailNum"),
        "Origin",
        "Dest",
        F.col("l_quantity").cast("int").alias("Distance"),
        F.when(F.col("l_tax") != 0, F.datediff(day, F.col("o_orderdate"))).alias("DepDelay"),
    )


def weather_raw(spark: SparkSession, folder: str) -> DataFrame:
    days = (
        _read(spark, folder, "orders")
        .join(_read(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("o_orderdate", "c_nationkey")
        .agg(F.min("o_orderkey").alias("k"), F.min("o_totalprice").alias("low"), F.max("o_totalprice").alias("high"))
    )
    k = F.col("k")

    def text(n: Column) -> Column:
        return n.cast("string")

    return days.select(
        F.concat(F.lit("STN"), text(F.col("c_nationkey"))).alias("STATION"),
        F.col("o_orderdate").alias("DATE"),
        F.when(k % 10 == 0, "FM-15").when(k % 10 < 5, "SOD").otherwise("SOD  ").alias("REPORT_TYPE2"),
        F.when(k % 7 == 0, "T")
        .when(k % 11 == 0, None)
        .when(k % 13 == 0, "0.05s")
        .otherwise(F.concat(text(k % 3), F.lit("."), F.lpad(text(k % 100), 2, "0")))
        .alias("DailyPrecipitation"),
        F.when(k % 5 == 0, "T")
        .when(k % 17 == 0, None)
        .otherwise(F.concat(F.lit("0."), text(k % 10)))
        .alias("DailySnowfall"),
        F.when(k % 4 == 0, "T")
        .when(k % 6 == 1, F.concat(text(k % 8), F.lit("."), text(k % 10)))
        .otherwise(text(k % 20))
        .alias("DailySnowDepth"),
        (F.col("low") / 10000).cast("int").alias("DailyMinimumDryBulbTemperature"),
        (F.col("high") / 10000).cast("int").alias("DailyMaximumDryBulbTemperature"),
    )


def stations(spark: SparkSession, folder: str) -> DataFrame:
    nation = _read(spark, folder, "nation")
    return nation.select(
        F.concat(F.lit("STN"), F.col("n_nationkey").cast("string")).alias("STATION"), F.col("n_name").alias("Airport")
    )


def airport_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every tenth nation has a region code without a second part."""
    nation = _read(spark, folder, "nation")
    region = _read(spark, folder, "region")
    code = F.concat("r_name", F.lit("-"), "n_name")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("iata_code"),
        F.concat(F.lit("Airport "), F.col("n_nationkey").cast("string")).alias("name"),
        F.when(F.col("n_nationkey") % 10 == 0, F.col("r_name")).otherwise(code).alias("iso_region"),
    )


def customer_sites(spark: SparkSession, folder: str) -> DataFrame:
    """Airport codes with one row per customer, for the steps that read the reference data alone."""
    customer = _read(spark, folder, "customer")
    nation = _read(spark, folder, "nation")
    region = _read(spark, folder, "region")
    key = F.col("c_custkey")
    return (
        customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("c_name").alias("iata_code"),
            F.concat(F.lit("Site "), key.cast("string")).alias("name"),
            F.when(key % 10 == 0, F.col("r_name")).otherwise(F.concat("r_name", F.lit("-"), "n_name")).alias("iso_region"),
        )
    )
