"""Calibration of predictions against their outcomes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerspark.functions.columns import bucket, iso_week
from ledgerspark.operators.gitlog import last_per_key

EDGES = ([0.5, 0.7, 0.9], ["<0.5", "0.5-0.7", "0.7-0.9", "0.9+"])
FIFTHS = ([0.2, 0.4, 0.6, 0.8], ["0-0.2", "0.2-0.4", "0.4-0.6", "0.6-0.8", "0.8-1"])


def outcome_value(outcome: Column) -> Column:
    """TRUE is 1, partial is one half, anything else is 0; NULL is pending."""
    o = F.lower(outcome)
    return F.when(outcome.isNotNull(), F.when(o == "true", 1.0).when(o == "partial", 0.5).otherwise(0.0))


def settled(predictions: DataFrame, order: list[str]) -> DataFrame:
    """The last record of each prediction that has an outcome, with its value and Brier score."""
    last = last_per_key(predictions, ["prediction_id"], order).withColumn("y", outcome_value(F.col("outcome")))
    return last.where(F.col("y").isNotNull() & F.col("p").isNotNull()).withColumn("brier", (F.col("p") - F.col("y")) * (F.col("p") - F.col("y")))


def _scores() -> list[Column]:
    return [F.count(F.lit(1)).alias("n"), F.round(F.avg("p"), 10).alias("mean_p"), F.round(F.avg("y"), 10).alias("accuracy"), F.round(F.avg("brier"), 10).alias("brier")]


def calibration(predictions: DataFrame, order: list[str]) -> DataFrame:
    """Scores by left-closed bucket of the predicted probability."""
    return settled(predictions, order).groupBy(bucket("p", *EDGES).alias("bucket")).agg(*_scores())


def reliability(predictions: DataFrame, order: list[str]) -> DataFrame:
    """Scores by fifths of the predicted probability, right-closed."""
    return settled(predictions, order).groupBy(bucket("p", *FIFTHS, right=True).alias("bucket")).agg(*_scores())


def brier_over_time(predictions: DataFrame, order: list[str], grain: str) -> DataFrame:
    label = {"day": F.to_date("recorded_at").cast("string"), "week": iso_week("recorded_at"), "month": F.date_format("recorded_at", "yyyy-MM")}[grain]
    return settled(predictions, order).groupBy(label.alias("period")).agg(*_scores())


def accuracy_by(predictions: DataFrame, order: list[str], key: str) -> DataFrame:
    return settled(predictions, order).groupBy(key).agg(*_scores())
