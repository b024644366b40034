"""Next-day prediction for every code in one query."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.functions.scalar import next_day
from barloom.operators.features import standardise
from barloom.operators.forecast import model_rows, score, trend_name
from barloom.operators.indicators import add_indicators
from barloom.operators.series import DAILY, Series, plain
from barloom.operators.windows import change, tail
from barloom.session import stage
from barloom.settings import CHANGE_FEATURES, DEFAULT, FEATURES, Settings


def last_windows(
    bars: DataFrame, scaler: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT, history: int | None = None,
) -> DataFrame:
    """One row per key: the scaled last window, last date and close, and the prediction date.

    Means are seeded from full history; ``history=65`` cuts it to the last rows for parity with
    the published predictions. Only the ``window + 1`` newest rows per key leave the indicator
    table, so the rest is a small per-key window.
    """
    recent = tail(bars, history, s) if history else bars
    known = stage(add_indicators(recent, s).select(s.key, s.time, *FEATURES_INPUT), "recent")
    rows = tail(known, cfg.window + 1, s)
    w = Window.partitionBy(s.key).orderBy(s.time)
    rows = rows.withColumns({f"{c}_pct_change": change(c, F.lag(c).over(w)) for c in CHANGE_FEATURES})
    rows = tail(rows, cfg.window, s).dropna(subset=FEATURES)
    scaled = rows.join(scaler, s.key).select(
        s.key, s.time, "close",
        F.col("mean_target_pct_change").alias("target_mean"), F.col("std_target_pct_change").alias("target_std"),
        *[standardise(c).alias(c) for c in FEATURES])
    item = F.struct(s.time, *FEATURES)
    out = scaled.groupBy(s.key).agg(
        F.sort_array(F.collect_list(item)).alias("window"),
        F.max(s.time).alias("last_date"), F.max_by("close", s.time).alias("last_close_price"),
        F.max("target_mean").alias("target_mean"), F.max("target_std").alias("target_std"))
    return plain(out).filter(F.size("window") == cfg.window).withColumn(
        "prediction_date", next_day("last_date"))


FEATURES_INPUT = [*CHANGE_FEATURES, *[c for c in FEATURES if not c.endswith("_pct_change")]]


def predict_next(windows: DataFrame, regressor: PipelineModel, classifier: PipelineModel) -> DataFrame:
    """Predicted price and trend name per key."""
    scored = score(model_rows(windows), regressor, classifier)
    pct = F.col("prediction") * F.col("target_std") + F.col("target_mean")
    return scored.select(
        "code", "last_date", "prediction_date", "last_close_price",
        (F.col("last_close_price") * (1 + pct)).alias("predicted_price"),
        trend_name(F.col("predicted_trend")).alias("predicted_trend"))
