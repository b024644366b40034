"""Regression, classification and band metrics per key, each one grouped aggregate."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.windows import ordinal
from barloom.settings import DEFAULT, TREND_NAMES, Settings


def _ratio(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def regression_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", key: str = "code",
) -> DataFrame:
    """RMSE, MAE and R2 = 1 - SSE/SST (M1)."""
    err = F.col(actual) - F.col(predicted)
    both = df.filter(F.col(actual).isNotNull() & F.col(predicted).isNotNull())
    sums = both.groupBy(key).agg(
        F.avg(err * err).alias("_mse"), F.avg(F.abs(err)).alias("mae"), F.var_pop(actual).alias("_var"))
    return sums.select(
        key, F.sqrt("_mse").alias("rmse"), "mae",
        (1 - F.try_divide(F.col("_mse"), F.col("_var"))).alias("r2"))


def confusion_matrix(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", key: str = "code",
) -> DataFrame:
    """Counts of true class by predicted class (M2); the classes are fixed, so no value scan."""
    classes = list(TREND_NAMES)
    return (
        df.groupBy(key, F.col(actual).alias("actual")).pivot(predicted, classes)
        .agg(F.count(F.lit(1))).fillna(0, [str(c) for c in classes])
        .withColumnsRenamed({str(c): f"pred_{TREND_NAMES[c].lower()}" for c in classes}))


def classification_metrics(
    df: DataFrame, actual: str = "actual", predicted: str = "predicted", key: str = "code",
) -> DataFrame:
    """Accuracy, MCC and per-class precision, recall, F1 (M3-M5); undefined ratios are 0."""
    y, p = F.col(actual), F.col(predicted)
    aggs = {"_s": F.count(F.lit(1)), "_c": F.count_if(y == p)}
    for k in TREND_NAMES:
        aggs[f"_t{k}"] = F.count_if(y == k)
        aggs[f"_p{k}"] = F.count_if(p == k)
        aggs[f"_tp{k}"] = F.count_if((y == k) & (p == k))
    g = df.groupBy(key).agg(*[c.alias(n) for n, c in aggs.items()])
    d = {n: F.col(n).cast("double") for n in aggs}
    cols = {"accuracy": d["_c"] / d["_s"]}
    for k, label in TREND_NAMES.items():
        precision, recall = _ratio(d[f"_tp{k}"], d[f"_p{k}"]), _ratio(d[f"_tp{k}"], d[f"_t{k}"])
        cols[f"precision_{label.lower()}"] = precision
        cols[f"recall_{label.lower()}"] = recall
        cols[f"f1_{label.lower()}"] = _ratio(2 * precision * recall, precision + recall)
    both = sum((d[f"_t{k}"] * d[f"_p{k}"] for k in TREND_NAMES), F.lit(0.0))
    free_p = d["_s"] * d["_s"] - sum((d[f"_p{k}"] * d[f"_p{k}"] for k in TREND_NAMES), F.lit(0.0))
    free_t = d["_s"] * d["_s"] - sum((d[f"_t{k}"] * d[f"_t{k}"] for k in TREND_NAMES), F.lit(0.0))
    cols["mcc"] = _ratio(d["_c"] * d["_s"] - both, F.sqrt(free_p * free_t))
    return g.select(key, *[c.alias(n) for n, c in cols.items()])


def total_loss(
    df: DataFrame, probabilities: str = "probability", label: str = "target_trend",
    weight: str = "class_weight", actual: str = "target_scaled", predicted: str = "prediction",
    cfg: Settings = DEFAULT,
) -> DataFrame:
    """1 * MSE + 5 * class-weighted cross entropy as a one-row table (M6).

    A class that the model never saw has probability 0, which counts as the floor 1e-300 (a loss of
    691 for the row), so the loss stays a number.
    """
    p = F.coalesce(F.try_element_at(F.col(probabilities), (F.col(label) + 1).cast("int")), F.lit(0.0))
    ce = -F.log(F.greatest(p, F.lit(1e-300)))
    sq = (F.col(actual) - F.col(predicted)) * (F.col(actual) - F.col(predicted))
    return df.agg(
        F.avg(sq).alias("mse"),
        (F.sum(ce * F.col(weight)) / F.sum(weight)).alias("cross_entropy"),
    ).withColumn("total_loss", cfg.regression_weight * F.col("mse") + cfg.class_weight * F.col("cross_entropy"))


def band_coverage(
    df: DataFrame, actual: str = "actual", lower: str = "lower", upper: str = "upper", key: str = "code",
) -> DataFrame:
    """Share of actual values inside the band (M7)."""
    inside = F.col(actual).between(F.col(lower), F.col(upper))
    return df.groupBy(key).agg(F.avg(inside.cast("double")).alias("coverage"))


def compare_models(model: DataFrame, baseline: DataFrame, key: str = "code") -> DataFrame:
    """Per-key RMSE of two models on the same rows and the reduction."""
    return model.select(key, "rmse").join(
        baseline.select(key, F.col("rmse").alias("rmse_base")), key
    ).withColumn("reduction", 1 - F.try_divide(F.col("rmse"), F.col("rmse_base")))


def summary_table(df: DataFrame, key: str = "code", digits: int = 4) -> DataFrame:
    """Numbered report with doubles rounded for export."""
    numbered = ordinal(df, [key])
    kinds: Mapping[str, str] = dict(numbered.dtypes)
    return numbered.select(
        *[F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in numbered.columns])
