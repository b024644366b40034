"""One model for the next change and its trend (F1, F2, M6): two heads over shared factors, fitted to their joint loss.

A window's features x give ``h = x V`` with few columns; the change is ``h a + b``, the class probabilities are
``softmax(h U + c)``. The loss is that of :func:`barloom.operators.metrics.total_loss`, a weighted sum of the mean squared error
and the class-weighted cross entropy, and a small ridge. Every step is one pass over the stored rows: tasks add up loss and gradient
of their rows, Spark adds up the tasks position by position, and the driver, which only ever holds as many numbers as
the model has, takes an L-BFGS step with backtracking.

The validation loss comes out of the same pass. Fitting stops once it has not improved for ``patience`` steps, and the
weights of the best step are kept (F9).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.forecast import argmax_label
from barloom.session import stage
from barloom.settings import DEFAULT, TREND_NAMES, Settings

CLASSES = len(TREND_NAMES)
#: loss parts of a pass, for train and validation rows: squared errors, rows, weighted cross entropy, weights
PARTS = 4


@dataclass(frozen=True)
class Weights:
    factors: np.ndarray  # features x rank
    change: np.ndarray  # rank + 1, the intercept last
    classes: np.ndarray  # (rank + 1) x classes

    def flat(self) -> np.ndarray:
        return np.concatenate([self.factors.ravel(), self.change, self.classes.ravel()])

    def like(self, flat: np.ndarray) -> Weights:
        n, k = self.factors.size, self.change.size
        return Weights(flat[:n].reshape(self.factors.shape), flat[n:n + k], flat[n + k:].reshape(self.classes.shape))

    def outputs(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Factors, change and class probabilities of rows."""
        h = np.column_stack([x @ self.factors, np.ones(len(x))])
        logits = h @ self.classes
        odds = np.exp(logits - logits.max(axis=1, keepdims=True))
        return h, h @ self.change, odds / odds.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Step:
    number: int
    train_loss: float
    validation_loss: float


@dataclass(frozen=True)
class Fit:
    weights: Weights
    steps: list[Step]
    best: int  # number of the step whose weights these are
    stopped: bool  # whether patience ran out before the last step


def start_weights(features: int, rank: int, seed: int = 0) -> Weights:
    rng = np.random.default_rng(seed)
    return Weights(rng.normal(0, features ** -0.5, (features, rank)), np.zeros(rank + 1), rng.normal(0, 0.01, (rank + 1, CLASSES)))


def from_separate(regressor: PipelineModel, classifier: PipelineModel, rank: int = CLASSES) -> Weights:
    """Weights that give what two separate linear models give, as far as ``rank`` factors allow (3 do)."""
    line, logistic = regressor.stages[-1], classifier.stages[-1]
    classes = logistic.coefficientMatrix.toArray().T  # features x classes; a common shift of all classes changes nothing
    both = np.column_stack([line.coefficients.toArray(), classes - classes.mean(axis=1, keepdims=True)])
    u, size, v = np.linalg.svd(both, full_matrices=False)
    heads = (np.sqrt(size)[:, None] * v)[:rank]
    intercepts = logistic.interceptVector.toArray()
    return Weights((u * np.sqrt(size))[:, :rank], np.append(heads[:, 0], line.intercept),
                   np.vstack([heads[:, 1:], intercepts - intercepts.mean()]))


def joint_rows(rows: DataFrame) -> DataFrame:
    """What a fit reads of rows from :func:`barloom.operators.forecast.weighted_rows`, stored: plain arrays, targets, weight, split."""
    train, val = F.col("split") == "train", F.col("split") == "val"
    return stage(rows.filter(train | val).select(
        vector_to_array("flat").alias("x"), F.col("target_scaled").cast("double").alias("y"), F.col("target_trend").cast("int").alias("label"),
        F.col("class_weight").cast("double").alias("w"), val.alias("val")).dropna(), "joint-rows")


def _matrix(column: pa.Array, rows: int) -> np.ndarray:
    return np.asarray(column.flatten(), np.float64).reshape(rows, -1)


def loss_parts(rows: DataFrame, weights: Weights) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One pass: loss parts of train and validation rows (2 x ``PARTS``), and the gradients of squared error and cross entropy
    summed over the train rows."""
    size = weights.flat().size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(2 * PARTS + 2 * size)
        for batch in batches:
            x = _matrix(batch.column(0), batch.num_rows)
            y, label, w = (batch.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            val = batch.column(4).to_numpy(zero_copy_only=False).astype(bool)
            h, change, p = weights.outputs(x)
            error, at = change - y, np.arange(len(x))
            entropy = -np.log(np.maximum(p[at, label], 1e-300))
            for k, mine in enumerate((~val, val)):
                sums[k * PARTS:(k + 1) * PARTS] += (error[mine] ** 2).sum(), mine.sum(), (entropy * w)[mine].sum(), w[mine].sum()
            d_change = np.where(val, 0.0, 2 * error)
            d_logits = p.copy()
            d_logits[at, label] -= 1
            d_logits *= np.where(val, 0.0, w)[:, None]
            squares = Weights(x.T @ np.outer(d_change, weights.change[:-1]), h.T @ d_change, np.zeros_like(weights.classes))
            crosses = Weights(x.T @ (d_logits @ weights.classes[:-1].T), np.zeros_like(weights.change), h.T @ d_logits)
            sums[2 * PARTS:2 * PARTS + size] += squares.flat()
            sums[2 * PARTS + size:] += crosses.flat()
        yield pa.RecordBatch.from_arrays([pa.array([sums.tolist()], pa.list_(pa.float64()))], ["sums"])

    parts = rows.select("x", "y", "label", "w", "val").mapInArrow(run, "sums array<double>").select(F.posexplode("sums").alias("at", "v"))
    found = np.zeros(2 * PARTS + 2 * size)
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).toLocalIterator():  # as many numbers as the model has, twice
        found[r["at"]] = r["v"]
    return found[:2 * PARTS].reshape(2, PARTS), found[2 * PARTS:2 * PARTS + size], found[2 * PARTS + size:]


def _losses(parts: np.ndarray, cfg: Settings) -> tuple[float, float]:
    """Train and validation loss; without validation rows the second is that of the train rows."""
    each = [float(cfg.regression_weight * sse / n + cfg.class_weight * ce / w) if n else None for sse, n, ce, w in parts]
    if each[0] is None:
        raise ValueError("no train rows")
    return each[0], each[0] if each[1] is None else each[1]


def fit_joint(
    rows: DataFrame, start: Weights, cfg: Settings = DEFAULT, steps: int = 60, patience: int = 8, ridge: float = 1e-3, memory: int = 8,
    tolerance: float = 1e-5,
) -> Fit:
    """Fit to ``rows`` of :func:`joint_rows`. Step 0 is the start itself. ``tolerance`` is how much an improvement has to be."""
    def look(flat: np.ndarray) -> tuple[float, float, np.ndarray]:
        parts, squares, crosses = loss_parts(rows, start.like(flat))
        train, val = _losses(parts, cfg)
        gradient = cfg.regression_weight * squares / parts[0, 1] + cfg.class_weight * crosses / parts[0, 3] + ridge * flat
        return train, val, gradient

    at = start.flat()
    train, val, gradient = look(at)
    history, best, kept, pairs, stopped = [Step(0, train, val)], 0, at, [], False
    for number in range(1, steps + 1):
        direction = -_two_loop(gradient, pairs)
        if direction @ gradient >= 0:
            direction, pairs = -gradient, []
        length, goal = (1.0 if pairs else 1.0 / max(1.0, float(np.linalg.norm(gradient)))), train + ridge / 2 * at @ at
        for _ in range(12):
            new = at + length * direction
            new_train, new_val, new_gradient = look(new)
            if new_train + ridge / 2 * new @ new <= goal + 1e-4 * length * float(direction @ gradient):
                break
            length /= 2
        else:
            break  # no descent left
        moved, bent = new - at, new_gradient - gradient
        if moved @ bent > 1e-12:
            pairs = [*pairs, (moved, bent)][-memory:]
        at, train, gradient = new, new_train, new_gradient
        history.append(Step(number, new_train, new_val))
        if new_val < history[best].validation_loss - tolerance:
            best, kept = number, at
        elif number - best >= patience:
            stopped = True
            break
    return Fit(start.like(kept), history, best, stopped)


def _two_loop(gradient: np.ndarray, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The gradient times the inverse curvature that the last moves tell."""
    out, used = gradient.copy(), []
    for moved, bent in reversed(pairs):
        share = (moved @ out) / (moved @ bent)
        used.append(share)
        out -= share * bent
    if pairs:
        moved, bent = pairs[-1]
        out *= (moved @ bent) / (bent @ bent)
    for (moved, bent), share in zip(pairs, reversed(used)):
        out += moved * (share - (bent @ out) / (moved @ bent))
    return out


def score_joint(rows: DataFrame, weights: Weights) -> DataFrame:
    """Rows with the columns that :func:`barloom.operators.forecast.score` adds."""
    @F.pandas_udf("prediction double, probability array<double>")
    def outputs(x: pd.Series) -> pd.DataFrame:
        _, change, p = weights.outputs(np.stack(x.to_numpy()) if len(x) else np.empty((0, len(weights.factors))))
        return pd.DataFrame({"prediction": change, "probability": list(p)})

    out = rows.withColumn("_out", outputs(vector_to_array("flat")))
    return out.withColumns({"prediction": F.col("_out.prediction"), "probability": F.col("_out.probability")}).withColumn(
        "predicted_trend", argmax_label(F.col("probability"))).drop("_out")


def learning_curve(spark: SparkSession, fit: Fit) -> DataFrame:
    """``step, train_loss, validation_loss, kept``, a row per step."""
    return spark.createDataFrame([(s.number, s.train_loss, s.validation_loss, s.number == fit.best) for s in fit.steps],
                                 "step int, train_loss double, validation_loss double, kept boolean")


def save_joint(spark: SparkSession, path: str, weights: Weights) -> None:
    rows = [(name, list(map(int, np.shape(v))), np.ravel(v).tolist()) for name, v in vars(weights).items()]
    spark.createDataFrame(rows, "name string, shape array<int>, numbers array<double>").coalesce(1).write.mode("overwrite").parquet(path)


def load_joint(spark: SparkSession, path: str) -> Weights:
    return Weights(**{r["name"]: np.array(r["numbers"]).reshape(r["shape"]) for r in spark.read.parquet(path).collect()})
