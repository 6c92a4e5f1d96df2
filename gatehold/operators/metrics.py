"""Quality of binary predictions, computed as aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from gatehold.operators.ordered import BUCKET_ROWS, running_totals
from gatehold.session import staged


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("double")).alias("accuracy"))


def confusion(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: tuple[int, ...] = (0, 1)
) -> DataFrame:
    """One row per (label, prediction) pair with its share; empty pairs have share 0.

    Rows with a null or another label or prediction are in no pair, and shares are of the rows that are in one.
    """
    cells = [(a, p) for a in classes for p in classes]
    counts = df.agg(
        F.count_if(F.col(label).isin(*classes) & F.col(prediction).isin(*classes)).alias("total"),
        *[F.count_if((F.col(label) == a) & (F.col(prediction) == p)).alias(f"n_{a}_{p}") for a, p in cells],
    )
    entries = [
        F.struct(
            F.lit(a).alias("label"),
            F.lit(p).alias("prediction"),
            F.col(f"n_{a}_{p}").alias("n"),
            F.coalesce(F.try_divide(f"n_{a}_{p}", "total"), F.lit(0.0)).alias("share"),
        )
        for a, p in cells
    ]
    return counts.select(F.inline(F.array(*entries)))


def _score_totals(df: DataFrame, label: str, score: str, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """One row per distinct score, highest first, with rows, running rows and all rows of either label.

    A null or NaN score ranks nowhere: such rows are left out.

    Aggregating to distinct scores first handles ties exactly and leaves the
    ordered step one row per score.
    """
    ranked = df.filter(F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double")))
    per_score = ranked.groupBy((-F.col(score)).alias("falling")).agg(
        F.count_if(F.col(label) == 1).alias("late"), F.count_if(F.col(label) == 0).alias("on_time")
    )
    seen = Observation()
    stored = staged(per_score.observe(seen, F.count(F.lit(1)).alias("rows")), "scores")
    so_far = {"late_so_far": F.col("late"), "on_time_so_far": F.col("on_time")}
    overall = {"late_so_far": "all_late", "on_time_so_far": "all_on_time"}
    return running_totals(stored, "falling", so_far, overall, bucket_rows, seen.get["rows"])


def roc_points(df: DataFrame, label: str = "label", score: str = "score", bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score, and the start (null, 0, 0)."""
    points = _score_totals(df, label, score, bucket_rows).select(
        (-F.col("falling")).alias("threshold"),
        F.try_divide("on_time_so_far", "all_on_time").alias("fpr"),
        F.try_divide("late_so_far", "all_late").alias("tpr"),
    )
    start = df.sparkSession.createDataFrame([(None, 0.0, 0.0)], points.schema)
    return start.union(points)


def roc_area(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Area under the curve: the share of (late, on-time) pairs ranked right, ties counted half."""
    totals = _score_totals(df, label, score)
    ranked_right = F.col("on_time").cast("double") * (
        F.col("late_so_far") - F.col("late") + F.col("late").cast("double") / 2
    )
    return totals.agg(
        F.try_divide(F.sum(ranked_right), F.sum("late").cast("double") * F.sum("on_time").cast("double")).alias("auc")
    )


def mean_fold_accuracy(
    df: DataFrame, fold: str = "fold", label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Mean over the folds of the accuracy in each."""
    right = (F.col(label) == F.col(prediction)).cast("double")
    per_fold = df.groupBy(fold).agg(F.avg(right).alias("accuracy"))
    return per_fold.agg(F.avg("accuracy").alias("mean_accuracy"))
