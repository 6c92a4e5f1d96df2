"""Data quality: missing values per column, in one pass or none of its own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _missing(df: DataFrame) -> list[Column]:
    nulls = [F.count(F.when(F.col(c).isNull(), 1)).alias(f"{c}_nulls") for c in df.columns]
    nans = [F.count(F.when(F.isnan(c), 1)).alias(f"{c}_nans") for c, t in df.dtypes if t in ("double", "float")]
    return [*nulls, *nans]


def missing_counts(df: DataFrame) -> DataFrame:
    """One row with `<column>_nulls` per column and `<column>_nans` per floating-point column."""
    return df.agg(*_missing(df))


def watched(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The same rows, and what counts their missing values while some job writes them: no pass of its own.

    Write the frame once, whole; then `watched_counts` has the counts.
    """
    seen = Observation()
    return df.observe(seen, *_missing(df)), seen


def watched_counts(df: DataFrame, seen: Observation) -> DataFrame:
    """The row of `missing_counts` from what was seen while `df` was written."""
    names = [f"{c}_nulls" for c in df.columns] + [f"{c}_nans" for c, t in df.dtypes if t in ("double", "float")]
    found = seen.get
    return df.sparkSession.createDataFrame([tuple(found[n] for n in names)], ", ".join(f"`{n}` long" for n in names))


def missing_report(df: DataFrame) -> DataFrame:
    """The same counts as rows (column, nulls, nans); nans is null where the type has none."""
    counts = missing_counts(df)
    entries = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"{c}_nulls").alias("nulls"),
            (F.col(f"{c}_nans") if f"{c}_nans" in counts.columns else F.lit(None).cast("long")).alias("nans"),
        )
        for c in df.columns
    ]
    return counts.select(F.inline(F.array(*entries)))
