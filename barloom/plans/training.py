"""The training and evaluation run over all codes: windows, fit, bands, metrics, strategy."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import forecast, joint, metrics
from barloom.operators.features import windows_and_scaler
from barloom.operators.series import DAILY, Series
from barloom.operators.strategy import strategy_summary
from barloom.session import stage
from barloom.settings import DEFAULT, Settings


@dataclass
class Run:
    regressor: PipelineModel
    classifier: PipelineModel
    losses: list[float]
    predictions: DataFrame
    regression: DataFrame
    classification: DataFrame
    strategy: DataFrame
    baseline: DataFrame
    comparison: DataFrame
    scaler: DataFrame
    joint: joint.Fit | None = None


def evaluate(scored: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> dict[str, DataFrame]:
    """Bands from validation residuals, then the per-code result tables on the test rows: the model's,
    those of the baseline that predicts the last close, and the comparison of both."""
    spread = forecast.residual_spread(
        scored.filter(F.col("split") == "val"), "target_scaled", "prediction", s.key)
    test = forecast.price_band(scored.filter(F.col("split") == "test"), spread, s, cfg=cfg)
    signals = test.select(
        s.key, s.time, F.col("close").alias("price"), F.col("actual_price").alias("next_price"),
        F.col("predicted_trend").alias("signal"))
    regression = metrics.regression_metrics(test, "actual_price", "predicted_price", s.key)
    baseline = metrics.regression_metrics(test, "actual_price", "close", s.key)
    return {
        "predictions": test, "regression": regression, "baseline": baseline,
        "comparison": metrics.compare_models(regression, baseline, s.key),
        "classification": metrics.classification_metrics(test, "target_trend", "predicted_trend", s.key),
        "strategy": strategy_summary(signals, s, cfg),
    }


def train(
    bars: DataFrame, grid: Iterable[forecast.Candidate] = (forecast.Candidate(),), s: Series = DAILY,
    cfg: Settings = DEFAULT, rank: int = 0, steps: int = 60, patience: int = 8,
) -> Run:
    """Fit, tune and evaluate over every code at once; nothing is collected but losses and weights.

    With ``rank`` the best pair of separate models (linear ones) is the start of one joint model with that many shared factors,
    fitted until its validation loss has not improved for ``patience`` steps; the evaluation is then that of the joint model.
    """
    windows, scaler = windows_and_scaler(bars, s, cfg)
    rows = forecast.weighted_rows(stage(forecast.model_rows(windows), "model-rows"), s)
    _, regressor, classifier, losses = forecast.tune(rows, grid, cfg)
    fit = None
    if rank:
        fit = joint.fit_joint(joint.joint_rows(rows), joint.from_separate(regressor, classifier, rank), cfg, steps, patience)
    found = joint.score_joint(rows, fit.weights) if fit else forecast.score(rows, regressor, classifier)
    scored = stage(found.drop("flat"), "scored")
    return Run(regressor, classifier, losses, **evaluate(scored, s, cfg), scaler=scaler, joint=fit)
