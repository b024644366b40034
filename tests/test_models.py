"""The joint model and the pooled regressions against plain numpy."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from barloom.operators import forecast, joint, metrics, pooled
from barloom.plans import training
from barloom.session import stage
from barloom.settings import DEFAULT
from tests.series_data import bars, frame

WIDTH = 6


def window_rows(spark, n=900, seed=3):
    """Targets that share one direction of the features: the trend is the sign of the change, as for real windows."""
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, WIDTH))
    y = x @ np.array([1.0, -2, 0.5, 0, 0, 0]) * 0.5 + rng.normal(0, 0.5, n)
    label = np.digitize(y, [-0.6, 0.6])
    split = np.where(np.arange(n) < n * 0.7, "train", np.where(np.arange(n) < n * 0.85, "val", "test"))
    rows = [(["A", "B"][i % 2], x[i].tolist(), float(y[i]), int(label[i]), [1.0, 0.5, 1.5][label[i]], str(split[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "code string, x array<double>, target_scaled double, target_trend int, class_weight double, split string")
    return stage(df.repartition(5).withColumn("flat", array_to_vector("x")).drop("x"), "rows"), x, y, label, split


@pytest.fixture(scope="module")
def data(spark):
    return window_rows(spark)


def plain_loss(w, x, y, label, weight):
    _, change, p = w.outputs(x)
    return ((change - y) ** 2).mean() + 5 * (-np.log(p[np.arange(len(y)), label]) * weight).sum() / weight.sum()


def test_loss_and_gradient_are_those_of_plain_code(spark, data):
    rows, x, y, label, split = data
    weight, w = np.array([1.0, 0.5, 1.5])[label], joint.start_weights(WIDTH, 2, 5)
    w = w.like(w.flat() + np.random.default_rng(0).normal(0, 0.3, w.flat().size))
    parts, squares, crosses = joint.loss_parts(joint.joint_rows(rows), w)
    for k, name in enumerate(("train", "val")):
        mine = split == name
        assert joint._losses(parts, DEFAULT)[k] == pytest.approx(plain_loss(w, x[mine], y[mine], label[mine], weight[mine]))
    gradient = squares / parts[0, 1] + 5 * crosses / parts[0, 3]
    mine, flat = split == "train", w.flat()
    for i in range(flat.size):
        step = np.eye(flat.size)[i] * 1e-5
        slope = (plain_loss(w.like(flat + step), x[mine], y[mine], label[mine], weight[mine])
                 - plain_loss(w.like(flat - step), x[mine], y[mine], label[mine], weight[mine])) / 2e-5
        assert gradient[i] == pytest.approx(slope, rel=1e-4, abs=1e-6)


def test_joint_fit_is_not_above_the_separate_models(data):
    rows = data[0]
    train = rows.filter("split = 'train'")
    models = forecast.fit_regressor(train), forecast.fit_classifier(train)
    separate = metrics.total_loss(forecast.score(rows.filter("split = 'val'"), *models)).first()["total_loss"]
    start = joint.from_separate(*models)
    fit = joint.fit_joint(joint.joint_rows(rows), start, steps=15)
    assert fit.steps[0].validation_loss == pytest.approx(separate, rel=1e-6)  # three factors lose nothing
    assert fit.steps[fit.best].validation_loss <= separate + 1e-9
    scored = joint.score_joint(rows.filter("split = 'val'"), fit.weights)
    assert metrics.total_loss(scored).first()["total_loss"] == pytest.approx(fit.steps[fit.best].validation_loss)
    accuracy = scored.agg(F.avg((F.col("target_trend") == F.col("predicted_trend")).cast("double"))).first()[0]
    assert accuracy > 0.6
    losses = [s.train_loss for s in fit.steps]
    assert losses[-1] < losses[0] and all(b <= a + 1e-3 for a, b in zip(losses, losses[1:]))


def test_one_shared_factor_learns_both_targets_from_scratch(data):
    fit = joint.fit_joint(joint.joint_rows(data[0]), joint.start_weights(WIDTH, 1), steps=40)
    direction = fit.weights.factors[:, 0] / np.linalg.norm(fit.weights.factors)
    assert abs(direction @ np.array([1.0, -2, 0.5, 0, 0, 0]) / np.sqrt(5.25)) > 0.97
    assert fit.steps[fit.best].validation_loss < 0.8 * fit.steps[0].validation_loss


def test_fitting_stops_and_keeps_the_best_step(spark):
    """Few train rows, many features: the validation loss rises after a while."""
    rng = np.random.default_rng(1)
    rows = [("A", rng.normal(size=30).tolist(), float(rng.normal()), int(rng.integers(3)), 1.0, "train" if i < 40 else "val") for i in range(240)]
    df = spark.createDataFrame(rows, "code string, x array<double>, target_scaled double, target_trend int, class_weight double, split string")
    df = joint.joint_rows(df.withColumn("flat", array_to_vector("x")))
    fit = joint.fit_joint(df, joint.start_weights(30, 3, 2), steps=60, patience=5, ridge=0.0)
    losses = [s.validation_loss for s in fit.steps]
    assert fit.stopped and len(losses) < 61 and len(losses) - 1 - fit.best == 5
    assert losses[fit.best] == pytest.approx(min(losses), abs=1e-4) and losses[-1] > losses[fit.best]
    assert joint._losses(joint.loss_parts(df, fit.weights)[0], DEFAULT)[1] == pytest.approx(losses[fit.best])
    curve = joint.learning_curve(spark, fit)
    assert curve.count() == len(losses) and [r.step for r in curve.filter("kept").collect()] == [fit.best]


def test_saved_weights_and_no_validation_rows(spark, data, tmp_path):
    w = joint.start_weights(WIDTH, 2)
    joint.save_joint(spark, str(tmp_path), w)
    loaded = joint.load_joint(spark, str(tmp_path))
    assert all(np.array_equal(a, b) for a, b in zip(vars(w).values(), vars(loaded).values()))
    fit = joint.fit_joint(joint.joint_rows(data[0].filter("split = 'train'")), w, steps=2)
    assert all(s.train_loss == s.validation_loss for s in fit.steps)
    with pytest.raises(ValueError, match="no train rows"):
        joint.fit_joint(joint.joint_rows(data[0].limit(0)), w)


def test_training_run_with_a_joint_model(spark):
    pdf = bars(21, holes=False, sizes=(("AAA.VN", 200), ("^BBB", 180)))
    pdf["volume"] += 10
    run = training.train(stage(frame(spark, pdf), "bars"), (forecast.Candidate(1.0),), rank=3, steps=4)
    assert run.joint.steps[run.joint.best].validation_loss <= run.losses[0] + 1e-9
    assert {r.code for r in run.regression.collect()} == {"AAA.VN", "^BBB"} == {r.code for r in run.strategy.collect()}


def pooled_rows(spark, sizes=(("HOT", 400), ("MID", 30), ("ONE", 1))):
    rng = np.random.default_rng(8)
    out = []
    for k, (code, n) in enumerate(sizes):
        x = rng.normal(size=(n, 3))
        y = x @ [1.0, k, -1] + k + rng.normal(0, 0.1, n)
        out += [(code, int(i), *map(float, x[i]), float(y[i])) for i in range(n)]
    out += [("MID", 99, None, 1.0, 1.0, 1.0), ("MID", 98, 1.0, 1.0, 1.0, None), ("NULLS", 1, None, None, None, None)]
    return pd.DataFrame(out, columns=["code", "i", "a", "b", "c", "y"]), spark.createDataFrame(out, "code string, i int, a double, b double, c double, y double")


def by_hand(pdf, ridge, pooling):
    def parts(g):
        x = np.column_stack([np.ones(len(g)), g[["a", "b", "c"]]])
        return x.T @ x, x.T @ g.y.to_numpy()

    whole = pdf.dropna()
    left, right = parts(whole)
    common = np.linalg.solve(left + ridge * np.eye(4), right)
    out = {}
    for code, g in whole.groupby("code"):
        left, right = parts(g)
        out[code] = np.linalg.solve(left + (ridge + pooling) * np.eye(4), right + pooling * common)
    return out, common


@pytest.mark.parametrize("pooling", [0.0, 7.0, 1e9])
def test_pooled_regressions_equal_the_closed_form(spark, pooling, monkeypatch):
    pdf, df = pooled_rows(spark)
    monkeypatch.setattr(pooled, "HELD", 30)  # sums of a few codes at a time, so parts of a code meet in the second shuffle
    got = {r.code: r for r in pooled.fit_pooled(df.repartition(6), ["a", "b", "c"], "y", ridge=0.5, pooling=pooling).collect()}
    want, common = by_hand(pdf, 0.5, pooling)
    assert set(got) == set(want) and {c: r.n for c, r in got.items()} == {"HOT": 400, "MID": 30, "ONE": 1}
    for code, b in want.items():
        assert got[code].coefficients == pytest.approx(b.tolist(), rel=1e-9, abs=1e-9)
    if pooling > 1e6:
        assert got["ONE"].coefficients == pytest.approx(common.tolist(), rel=1e-4)


def test_pooled_prediction_and_bad_arguments(spark):
    pdf, df = pooled_rows(spark)
    with pytest.raises(ValueError):
        pooled.fit_pooled(df, ["a"], "y", ridge=0.0)
    rows = df.withColumn("date", F.date_add(F.lit("2020-01-01").cast("date"), F.col("i")))
    found = pooled.fit_pooled(rows, ["a", "b", "c"], "y", ridge=0.5)
    got = {(r.code, r.i): r.prediction for r in pooled.predict_pooled(rows, found, ["a", "b", "c"]).collect()}
    want, _ = by_hand(pdf, 0.5, 0.0)
    assert got["NULLS", 1] is None and got["MID", 99] is None
    r = pdf[(pdf.code == "HOT") & (pdf.i == 7)].iloc[0]
    assert got["HOT", 7] == pytest.approx(want["HOT"] @ [1, r.a, r.b, r.c])
