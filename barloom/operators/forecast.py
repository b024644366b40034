"""Forecasters over all keys at once: persistence and AR(1) baselines, Spark ML models, bands."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.features import class_weights
from barloom.operators.metrics import total_loss
from barloom.operators.series import DAILY, Series, attach, measured
from barloom.settings import DEFAULT, FEATURES, TREND_NAMES, Settings


def ar1_parameters(
    df: DataFrame, x: str = "close_pct_change", y: str = "target_pct_change", key: str = "code",
) -> DataFrame:
    """Least-squares slope and intercept of the next change on the current one."""
    return df.groupBy(key).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"))


def ar1_forecast(
    df: DataFrame, params: DataFrame, s: Series = DAILY, x: str = "close_pct_change",
) -> DataFrame:
    return attach(df, s, params).withColumn(
        "predicted_change", F.col("intercept") + F.col("slope") * F.col(x)).drop("slope", "intercept")


def price_from_change(close: str | Column, pct: str | Column) -> Column:
    """Price implied by a relative change."""
    close = F.col(close) if isinstance(close, str) else close
    pct = F.col(pct) if isinstance(pct, str) else pct
    return close * (1 + pct)


def residual_spread(df: DataFrame, actual: str, predicted: str, key: str = "code") -> DataFrame:
    """Sample std of validation residuals per key."""
    return df.groupBy(key).agg(F.stddev_samp(F.col(actual) - F.col(predicted)).alias("error_std"))


def price_band(
    df: DataFrame, spread: DataFrame, s: Series = DAILY, predicted: str = "prediction",
    actual: str = "target_scaled", cfg: Settings = DEFAULT,
) -> DataFrame:
    """Prices of truth, prediction and the 95% band from scaled changes."""
    mean, std = F.col("target_mean"), F.col("target_std")

    def price(z: Column) -> Column:
        return price_from_change("close", z * std + mean)

    half = cfg.band * F.col("error_std")
    return attach(df, s, spread).withColumns({
        "actual_price": price(F.col(actual)),
        "predicted_price": price(F.col(predicted)),
        "lower_price": price(F.col(predicted) - half),
        "upper_price": price(F.col(predicted) + half),
    }).drop("error_std")


def argmax_label(scores: Column) -> Column:
    """Index of the highest score, the first on ties."""
    return (F.array_position(scores, F.array_max(scores)) - 1).cast("int")


def trend_name(label: Column) -> Column:
    pairs = [F.lit(v) for kv in TREND_NAMES.items() for v in kv]
    return F.element_at(F.create_map(*pairs), label.cast("int"))


def model_rows(windows: DataFrame) -> DataFrame:
    """Flattened window as a vector. Targets are scaled per code, so the code itself is no feature."""
    flat = F.flatten(F.transform("window", lambda r: F.array(*[r[c] for c in FEATURES])))
    return windows.withColumn("flat", array_to_vector(flat)).drop("window")


@dataclass(frozen=True)
class Candidate:
    """One point of the tuning grid, with the solvers' limits."""

    regularisation: float = 0.01
    trees: int = 0  # 0: linear regression, else gradient-boosted trees
    depth: int = 4
    regressor_steps: int = 50
    classifier_steps: int = 30


def fit_regressor(rows: DataFrame, candidate: Candidate = Candidate()) -> PipelineModel:
    """One distributed fit over all keys of the scaled next change (F1)."""
    if candidate.trees:
        model = GBTRegressor(
            featuresCol="flat", labelCol="target_scaled", maxIter=candidate.trees, maxDepth=candidate.depth, seed=42)
    else:
        model = LinearRegression(
            featuresCol="flat", labelCol="target_scaled", regParam=candidate.regularisation,
            elasticNetParam=0.0, solver="l-bfgs", maxIter=candidate.regressor_steps)
    return Pipeline(stages=[model]).fit(rows)


def fit_classifier(rows: DataFrame, candidate: Candidate = Candidate()) -> PipelineModel:
    """Three-class trend model, rows weighted by balanced class weight (F2)."""
    model = LogisticRegression(
        featuresCol="flat", labelCol="target_trend", weightCol="class_weight",
        regParam=candidate.regularisation, maxIter=candidate.classifier_steps, family="multinomial",
        predictionCol="predicted_trend", probabilityCol="class_probability", rawPredictionCol="class_score")
    return Pipeline(stages=[model]).fit(rows)


def weighted_rows(rows: DataFrame, s: Series = DAILY) -> DataFrame:
    """Add each row's balanced class weight; weights come from the training windows only.

    Three rows a key: broadcast where their measured size allows, else joined on (key, block,
    label), so that no hot key meets in one task. Only key, split and label are read for them.
    """
    weights = class_weights(rows.filter(F.col("split") == "train").select(s.key, "target_trend"), key=s.key)
    weights, small = measured(weights.select(s.key, "target_trend", "class_weight"))
    if small:
        return rows.join(F.broadcast(weights), [s.key, "target_trend"], "left").fillna(1.0, ["class_weight"])
    spread = rows.select(*s.block_keys).distinct().join(weights, s.key)
    return rows.join(spread, [*s.block_keys, "target_trend"], "left").fillna(1.0, ["class_weight"])


def score(rows: DataFrame, regressor: PipelineModel, classifier: PipelineModel) -> DataFrame:
    out = classifier.transform(regressor.transform(rows))
    return out.withColumn("probability", vector_to_array("class_probability")).withColumn(
        "predicted_trend", argmax_label(F.col("probability"))).drop("class_probability", "class_score")


def tune(
    rows: DataFrame, grid: Iterable[Candidate], cfg: Settings = DEFAULT,
) -> tuple[Candidate, PipelineModel, PipelineModel, list[float]]:
    """Fit each candidate on train rows and keep the lowest total loss on validation rows."""
    train, val = rows.filter(F.col("split") == "train"), rows.filter(F.col("split") == "val")
    best, losses = None, []
    for candidate in grid:
        models = fit_regressor(train, candidate), fit_classifier(train, candidate)
        loss = total_loss(score(val, *models), cfg=cfg).first()["total_loss"]
        losses.append(loss)
        if best is None or loss < best[0]:
            best = (loss, candidate, *models)
    return best[1], best[2], best[3], losses


def save_models(path: str, regressor: PipelineModel, classifier: PipelineModel, scaler: DataFrame) -> None:
    """Write both pipelines and the per-key parameter table (F8)."""
    regressor.write().overwrite().save(f"{path}/regressor")
    classifier.write().overwrite().save(f"{path}/classifier")
    scaler.write.mode("overwrite").parquet(f"{path}/scaler")


def load_models(spark, path: str) -> tuple[PipelineModel, PipelineModel, DataFrame]:
    return (
        PipelineModel.load(f"{path}/regressor"), PipelineModel.load(f"{path}/classifier"),
        spark.read.parquet(f"{path}/scaler"))


def mean_by_position(df: DataFrame, arrays: str, keys: Sequence[str] = ()) -> DataFrame:
    """Element-wise mean of an array column, largest first."""
    each = df.select(*keys, F.posexplode(arrays).alias("pos", "value"))
    return each.groupBy(*keys, "pos").agg(F.avg("value").alias("weight")).orderBy(F.desc("weight"), "pos")


def mean_by_element(df: DataFrame, matrices: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean of a ``[step][element]`` array per element, over rows and steps, largest first."""
    steps = df.select(*keys, F.explode(matrices).alias("_step"))
    return mean_by_position(steps, "_step", keys)
