"""Features for predicting whether a flight leaves late."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gatehold.functions import columns as C
from gatehold.operators.encode import apply_codes, fit_codes
from gatehold.operators.sampling import bootstrap
from gatehold.plans.gold import with_line

ENCODED = ["TailNum", "Origin", "Dest", "line", "UniqueCarrier"]
SCALED = ["decimal_DepTime", "PREP", "SNOW"]
# The delay defines the label, so it is never a feature.
NOT_FEATURES = ["DateString", "DATE", "STATION", "SNWD", "delay"]


def feature_rows(gold: DataFrame, years: list[int]) -> DataFrame:
    """Rows of `years` with the route column, without keys and the delay, and with whole-number amounts.

    All features come from one projection; training and scoring share it.
    """
    rows = with_line(gold.filter(F.col("Year").isin(*years))).drop(*NOT_FEATURES)
    return rows.withColumns({c: C.scaled_int(F.col(c)) for c in SCALED})


def encoded_rows(rows: DataFrame, codes: DataFrame | None = None) -> DataFrame:
    """Text features replaced by ordinal codes, fitted on `rows` unless `codes` are given."""
    codes = fit_codes(rows, ENCODED) if codes is None else codes
    return apply_codes(rows, codes, ENCODED)


def training_rows(rows: DataFrame, year: int, fraction: float = 0.3, seed: int = 1) -> DataFrame:
    """A bootstrap sample of one year: rows drawn with replacement, exactly round(fraction * their number) of them."""
    return bootstrap(rows.filter(F.col("Year") == year), fraction, seed)


def test_rows(rows: DataFrame, year: int) -> DataFrame:
    return rows.filter(F.col("Year") == year)


def label_column(rows: DataFrame) -> DataFrame:
    return rows.select("label")


def feature_columns(rows: DataFrame) -> list[str]:
    return [c for c in rows.columns if c != "label"]
