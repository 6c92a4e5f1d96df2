"""Catalog tables and views as sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def sql_view(spark: SparkSession, name: str, query: str) -> DataFrame:
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS {query}")
    return spark.table(name)


def local_rows(spark: SparkSession, frame, schema=None) -> DataFrame:
    """Distribute a small pandas frame (sent as Arrow batches)."""
    return spark.createDataFrame(frame, schema=schema)
