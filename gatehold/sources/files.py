"""CSV and JSON scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def headed_csv(
    spark: SparkSession, path, schema: StructType | str | None = None, delimiter: str = ",", null_token: str | None = "NA"
) -> DataFrame:
    """CSV with a header line. Without a schema the types are inferred, which costs one more pass."""
    reader = spark.read.option("header", True).option("sep", delimiter)
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def headerless_csv(
    spark: SparkSession, path, schema: StructType | str, delimiter: str = ",", null_token: str | None = "NA"
) -> DataFrame:
    """CSV without a header under an imposed schema; fields that do not parse become null.

    `path` may be a glob with character classes, or a list of paths.
    """
    reader = spark.read.schema(schema).option("header", False).option("sep", delimiter).option("mode", "PERMISSIVE")
    if null_token is not None:
        reader = reader.option("nullValue", null_token)
    return reader.csv(path)


def multipart_csv(spark: SparkSession, first, rest, schema: StructType | str | None = None) -> DataFrame:
    """Parts of one dataset of which only the first has a header.

    The types of the first part (inferred from that one file, or `schema`) are
    imposed on all the others.
    """
    head = headed_csv(spark, first, schema)
    return head.union(headerless_csv(spark, rest, head.schema))


def json_lines(spark: SparkSession, path, schema: StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.json(path)


def text_csv(spark: SparkSession, path) -> DataFrame:
    """CSV with a header and no inference: every column is text."""
    return spark.read.option("header", True).csv(path)
