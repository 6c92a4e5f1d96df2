import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from gatehold.operators import metrics

from .conftest import rows_of


@pytest.fixture(scope="module")
def small(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1)]
    return spark.createDataFrame(rows, "label int, score double").withColumn("prediction", (F.col("score") >= 0.5).cast("int"))


def test_accuracy(small):
    assert metrics.accuracy(small).first()["accuracy"] == 0.75


def test_confusion_has_every_cell(small):
    assert rows_of(metrics.confusion(small), "label", "prediction", "share") == [
        (0, 0, 0.25), (0, 1, 0.25), (1, 0, 0.0), (1, 1, 0.5),
    ]


def test_roc_points_join_ties(small):
    assert rows_of(metrics.roc_points(small)) == [
        (0.1, 1.0, 1.0), (0.8, 0.5, 1.0), (0.9, 0.0, 0.5), (None, 0.0, 0.0),
    ]


def test_roc_area_counts_ties_half(small):
    assert metrics.roc_area(small).first()["auc"] == 0.875


def test_roc_area_equals_the_evaluator(spark):
    random.seed(5)
    rows = [(random.randint(0, 1), round(random.random(), 2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "label int, score double")
    expected = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert metrics.roc_area(df).first()["auc"] == pytest.approx(expected, abs=1e-12)


def test_one_class_has_no_area(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.4)], "label int, score double")
    assert metrics.roc_area(df).first()["auc"] is None


def test_mean_fold_accuracy(spark):
    df = spark.createDataFrame([(0, 1, 1), (0, 0, 1), (1, 1, 1)], "fold int, label int, prediction int")
    assert metrics.mean_fold_accuracy(df).first()["mean_accuracy"] == 0.75


def test_rows_outside_the_classes_and_scores_that_rank_nowhere(spark):
    df = spark.createDataFrame(
        [(1, 1, 0.9), (0, 0, 0.1), (None, 1, 0.5), (2, 0, 0.4), (1, 1, None), (0, 0, float("nan"))],
        "label int, prediction int, score double",
    )
    assert sum(r["share"] for r in metrics.confusion(df).collect()) == 1
    assert metrics.roc_area(df).first()["auc"] == 1
    assert max(r["threshold"] or 0 for r in metrics.roc_points(df).collect()) == 0.9
