"""Result files of a training run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.functions.scalar import safe_key
from barloom.operators.metrics import summary_table
from barloom.plans.training import Run
from barloom.sources.writers import write_csv


def prediction_rows(predictions: DataFrame, digits: int = 4) -> DataFrame:
    """Actual, predicted and band prices per code and date, rounded for export."""
    prices = {
        "actual_price": "Actual_Price", "predicted_price": "Predicted_Price",
        "lower_price": "Lower_CI_Price", "upper_price": "Upper_CI_Price"}
    return predictions.select(
        safe_key("code").alias("safe_code"), F.col("date").alias("Date"), F.col("code").alias("Ticker"),
        *[F.round(c, digits).alias(name) for c, name in prices.items()])


def write_results(run: Run, path: str) -> None:
    """Predictions in one folder per code and the numbered summaries."""
    rows = prediction_rows(run.predictions)
    rows.write.mode("overwrite").option("header", True).partitionBy("safe_code").csv(f"{path}/by_ticker")
    for name, table in (
        ("all_regression_metrics", run.regression), ("all_classification_metrics", run.classification),
        ("all_strategy_performance", run.strategy), ("all_baseline_metrics", run.baseline),
        ("all_model_comparison", run.comparison),
    ):
        write_csv(summary_table(table), f"{path}/{name}")


def write_prediction(next_day: DataFrame, path: str) -> None:
    """Next-day predictions of all codes with dates as text."""
    write_csv(next_day.withColumns({
        c: F.date_format(c, "yyyy-MM-dd") for c in ("last_date", "prediction_date")}), path)
