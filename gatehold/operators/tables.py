"""Catalog tables, exports and small results."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from gatehold.functions.names import quoted
from gatehold.operators.layout import zorder


def create_database(spark: SparkSession, name: str, location: str | None = None) -> None:
    where = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}{where}")


def use_database(spark: SparkSession, name: str) -> None:
    spark.catalog.setCurrentDatabase(name)


def _publish(spark: SparkSession, writer: DataFrameWriter, name: str, properties: dict[str, str] | None = None) -> DataFrame:
    """Write a new table and put it in the place of `name`.

    The rows are written under a new name; only then is the old table renamed away, the new one renamed in and the old one
    dropped. A job that fails before leaves the table as it was, and one that dies between the renames leaves both tables
    whole under names that begin with this one's. Where the catalog moves folders by copying, so do the renames.
    """
    new, old = (f"{name}__{kind}_{uuid.uuid4().hex[:12]}" for kind in ("new", "old"))
    try:
        writer.saveAsTable(new)
        for key, value in (properties or {}).items():
            literals = [x.replace("\\", "\\\\").replace("'", "\\'") for x in (key, value)]
            spark.sql(f"ALTER TABLE {new} SET TBLPROPERTIES ('{literals[0]}' = '{literals[1]}')")
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {new}")
        raise
    replaced = spark.catalog.tableExists(name)
    if replaced:
        _rename(spark, name, old)
    try:
        _rename(spark, new, name)
    except BaseException:
        if replaced:
            _rename(spark, old, name)
        raise
    if replaced:
        spark.sql(f"DROP TABLE {old}")
    return spark.table(name)


def _rename(spark: SparkSession, name: str, to: str) -> None:
    """Rename a table, and let its partitions follow: some catalogs still have them where they were, and would delete
    what lies there when the table is dropped."""
    spark.sql(f"ALTER TABLE {name} RENAME TO {to}")
    if any(c.isPartition for c in spark.catalog.listColumns(to)):
        spark.sql(f"MSCK REPAIR TABLE {to} SYNC PARTITIONS")


def overwrite_table(df: DataFrame, name: str) -> DataFrame:
    """Replace a table, or make it; it stays as it was if the job fails. `df` may read the table itself."""
    return _publish(df.sparkSession, df.write.format("parquet"), name)


def create_table(df: DataFrame, name: str) -> DataFrame:
    """Fails if the table exists."""
    df.write.mode("errorifexists").format("parquet").saveAsTable(name)
    return df.sparkSession.table(name)


def replace_table(
    df: DataFrame, name: str, partition_by: list[str] | None = None, order_by: list[str] | None = None
) -> DataFrame:
    """Replace a table by the rows of `df`, optionally partitioned, rows sorted inside each file.

    The table stays as it was if the job fails. `df` may read the table itself; the result reads the new one.

    The REBALANCE hint gathers each partition value and lets adaptive execution
    cut a large value into several files and merge small ones; unlike a global
    sort it does not evaluate the input twice to find range bounds.
    """
    partition_by, order_by = list(partition_by or []), list(order_by or [])
    laid_out = df.hint("rebalance", *map(quoted, partition_by)) if partition_by else df
    if partition_by or order_by:
        laid_out = laid_out.sortWithinPartitions(*map(quoted, [*partition_by, *order_by]))
    writer = laid_out.write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return _publish(df.sparkSession, writer, name)


def copy_table(spark: SparkSession, source: str, target: str, partition_by: list[str] | None = None) -> DataFrame:
    return replace_table(spark.table(source), target, partition_by)


def _description(spark: SparkSession, name: str) -> dict[str, str]:
    """What the catalog says of a table as a whole, a few rows."""
    rows = spark.sql(f"DESCRIBE EXTENDED {name}").collect()
    start = [r["col_name"] for r in rows].index("# Detailed Table Information")
    return {r["col_name"]: r["data_type"] for r in rows[start + 1 :]}


def optimize_table(
    spark: SparkSession, name: str, columns: list[str], files: int | None = None, path: str | None = None
) -> DataFrame:
    """Rewrite a table clustered by `columns`, keeping its partitioning, properties and comment.

    Without `files` there are as many as the bytes of its values ask for. A managed table stays managed unless `path` is
    given; a table with a folder of its own needs a new folder there. If the job dies, the table is as it was.
    """
    before = spark.table(name)
    if path is None and _description(spark, name).get("Type") == "EXTERNAL":
        raise ValueError(f"{name} has a folder of its own: give the path of a new one")
    partition_by = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
    stored = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    properties = {k: v for k, v in stored.items() if not k.startswith(("spark.sql.", "transient_"))}
    comment = spark.catalog.getTable(name).description
    writer = zorder(before, columns, files, partition_by).write.format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    return _publish(spark, writer, name, properties | ({"comment": comment} if comment else {}))


def export_csv(df: DataFrame, path: str, files: int) -> None:
    """CSV with a header line in exactly `files` files (round robin)."""
    df.repartition(files).write.mode("overwrite").csv(path, header=True)


def analyze_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR ALL COLUMNS")


def column_statistics(spark: SparkSession, name: str, columns: list[str]) -> DataFrame:
    """Stored statistics (column, min, max, num_nulls) after `analyze_table`; one small row per column."""
    rows = []
    for c in columns:
        stats = {r["info_name"]: r["info_value"] for r in spark.sql(f"DESCRIBE EXTENDED {name} {c}").collect()}
        rows.append((c, stats["min"], stats["max"], int(stats["num_nulls"])))
    return spark.createDataFrame(rows, "column string, min string, max string, num_nulls long")


@contextmanager
def cached(df: DataFrame) -> Iterator[DataFrame]:
    """Keep `df` for the jobs inside the block that read it more than once."""
    df.cache()
    try:
        yield df
    finally:
        df.unpersist()


def to_local(df: DataFrame, max_rows: int) -> pd.DataFrame:
    """A small result as a pandas frame; refuses to bring a large one to the driver."""
    frame = df.limit(max_rows + 1).toPandas()
    if len(frame) > max_rows:
        raise ValueError(f"result has more than {max_rows} rows; aggregate it first or write it to a table")
    return frame


def preview(df: DataFrame, rows: int = 100, order_by: list[str] | None = None) -> DataFrame:
    return (df.orderBy(*order_by) if order_by else df).limit(rows)


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.lit(len(df.columns)).alias("columns"))


def column_names(df: DataFrame) -> DataFrame:
    """One row per column: position, name and how many values it holds."""
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    entries = [
        F.struct(F.lit(i).alias("position"), F.lit(c).alias("name"), F.col(c).alias("values"))
        for i, c in enumerate(df.columns)
    ]
    return counts.select(F.inline(F.array(*entries)))
