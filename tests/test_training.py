import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import features, forecast, metrics
from barloom.plans import inference, reports, training
from barloom.session import stage
from barloom.settings import FEATURES
from tests.series_data import bars, frame, ordered


@pytest.fixture(scope="module")
def day_bars(spark):
    pdf = bars(21, holes=False, sizes=(("AAA.VN", 260), ("^BBB", 220)))
    pdf["volume"] += 10
    return stage(frame(spark, pdf), "bars")


@pytest.fixture(scope="module")
def run(day_bars):
    return training.train(day_bars, (forecast.Candidate(0.1), forecast.Candidate(10.0)))


def test_result_tables_agree_with_the_scored_rows(run):
    test = run.predictions.toPandas()
    assert set(test.split) == {"test"} and len(run.losses) == 2
    for r in run.regression.collect():
        g = test[test.code == r.code]
        err = g.actual_price - g.predicted_price
        assert r.rmse == pytest.approx(np.sqrt((err ** 2).mean())) and r.mae == pytest.approx(err.abs().mean())
        assert ((g.lower_price <= g.predicted_price) & (g.predicted_price <= g.upper_price)).all()
    for r in run.classification.collect():
        g = test[test.code == r.code]
        assert r.accuracy == pytest.approx((g.target_trend == g.predicted_trend).mean())
    assert {r.code for r in run.strategy.collect()} == {"AAA.VN", "^BBB"}


def test_true_price_is_the_next_close(run, day_bars):
    closes = ordered(day_bars.toPandas())
    following = dict(zip(zip(closes.code, closes.date), closes.groupby("code").close.shift(-1)))
    for r in run.predictions.select("code", "date", "actual_price").collect():
        assert r.actual_price == pytest.approx(following[r.code, r.date])


def test_result_files(spark, run, tmp_path):
    reports.write_results(run, str(tmp_path))
    table = spark.read.option("header", True).csv(f"{tmp_path}/all_regression_metrics")
    assert [(r.STT, r.code) for r in table.orderBy("STT").collect()] == [("1", "AAA.VN"), ("2", "^BBB")]
    rows = spark.read.option("header", True).csv(f"{tmp_path}/by_ticker")
    assert {r.safe_code for r in rows.select("safe_code").distinct().collect()} == {"AAA_VN", "BBB"}
    assert rows.count() == run.predictions.count()


def test_saved_models_predict_the_same(spark, run, day_bars, tmp_path):
    scaler = run.scaler
    forecast.save_models(str(tmp_path), run.regressor, run.classifier, scaler)
    loaded = forecast.load_models(spark, str(tmp_path))
    now = inference.predict_next(inference.last_windows(day_bars, scaler), run.regressor, run.classifier)
    later = inference.predict_next(inference.last_windows(day_bars, loaded[2]), *loaded[:2])
    assert sorted(now.collect()) == sorted(later.collect())
    last = {r.code: r for r in day_bars.groupBy("code").agg(
        F.max("date").alias("date"), F.max_by("close", "date").alias("close")).collect()}
    for r in now.collect():
        assert r.last_date == last[r.code].date and r.last_close_price == last[r.code].close
        assert r.prediction_date == r.last_date + dt.timedelta(days=1)
        assert r.predicted_trend in ("Down", "Neutral", "Up")
    reports.write_prediction(now, f"{tmp_path}/latest")
    assert spark.read.option("header", True).csv(f"{tmp_path}/latest").count() == 2


def test_last_window_follows_the_training_windows(spark, day_bars):
    """With the final window kept in, training and inference see the same last row but one."""
    labelled = stage(features.labelled_features(day_bars), "labelled")
    _, scaler = features.scaled_features(labelled)
    shorter = day_bars.join(
        day_bars.groupBy("code").agg(F.max("date").alias("_last")), "code").filter("date < _last").drop("_last")
    got = {r.code: r.window for r in inference.last_windows(stage(shorter, "shorter"), scaler).collect()}
    rows = features.training_windows(day_bars, exclude_last=False)
    newest = rows.groupBy("code").agg(F.max_by("window", "date").alias("window")).collect()
    assert len(newest) == 2
    for r in newest:
        a = np.array([[w[c] for c in FEATURES] for w in r.window])
        b = np.array([[w[c] for c in FEATURES] for w in got[r.code]])
        np.testing.assert_allclose(a, b, rtol=1e-6, atol=1e-7)


def test_class_weights_come_from_training_rows_only(spark, day_bars):
    windows = stage(features.training_windows(day_bars), "windows")
    rows = forecast.weighted_rows(windows).select("code", "split", "target_trend", "class_weight").toPandas()
    train = rows[rows.split == "train"]
    for (code, label), g in rows.groupby(["code", "target_trend"]):
        mine = train[train.code == code]
        n = (mine.target_trend == label).sum()
        assert (g.class_weight == len(mine) / (mine.target_trend.nunique() * n)).all()
    assert len(rows) == windows.count()


def test_ar1_parameters_and_model_comparison(spark):
    df = spark.createDataFrame([("A", 1.0 * i, 2.0 * i + 3) for i in range(10)], "code string, x double, y double")
    p = forecast.ar1_parameters(df, "x", "y").first()
    assert (p.slope, p.intercept) == (pytest.approx(2.0), pytest.approx(3.0))
    same = metrics.compare_models(
        spark.createDataFrame([("A", 1.0)], "code string, rmse double"),
        spark.createDataFrame([("A", 4.0)], "code string, rmse double")).first()
    assert same.reduction == pytest.approx(0.75)


def test_the_chosen_candidate_has_the_lowest_validation_loss(spark, day_bars):
    rows = forecast.weighted_rows(stage(forecast.model_rows(features.training_windows(day_bars)), "rows"))
    grid = [forecast.Candidate(0.1), forecast.Candidate(1000.0), forecast.Candidate(0.01, classifier_steps=1)]
    best, _, _, losses = forecast.tune(rows, grid)
    assert best == grid[int(np.argmin(losses))] and len(losses) == 3


def test_run_has_the_scaler_and_a_baseline_on_the_same_rows(run, day_bars):
    _, scaler = features.scaled_features(stage(features.labelled_features(day_bars), "labelled"))
    want = {r.code: r.asDict() for r in scaler.collect()}
    got = {r.code: r.asDict() for r in run.scaler.collect()}
    assert set(got) == set(want)
    assert all(got[c][k] == pytest.approx(want[c][k]) for c in got for k in want[c] if k != "code")
    test = run.predictions.toPandas()
    both = {r.code: r for r in run.comparison.collect()}
    for code, g in test.groupby("code"):
        assert both[code].rmse_base == pytest.approx(np.sqrt(((g.actual_price - g.close) ** 2).mean()))


def test_loss_of_a_class_the_model_never_saw(spark):
    rows = spark.createDataFrame([(2, 1.0, 0.0, 0.0, [0.5, 0.5]), (0, 1.0, 0.0, 0.0, [0.5, 0.5])],
                                 "target_trend int, class_weight double, target_scaled double, prediction double, probability array<double>")
    loss = metrics.total_loss(rows).first()
    assert loss.cross_entropy == pytest.approx((-np.log(1e-300) - np.log(0.5)) / 2) and np.isfinite(loss.total_loss)


def test_parameters_join_alike_on_both_sides_of_the_threshold(spark, day_bars):
    from barloom.operators import clean
    from barloom.operators.series import DAILY, attach

    codes = spark.createDataFrame([("AAA.VN", "a"), ("ZZZ", "z")], "code string, type string")
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        got = {}
        for value in (limit, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
            got[value] = sorted(map(tuple, clean.enrich(day_bars, codes).collect()), key=str)
        assert got[limit] == got["-1"] and len(got[limit]) == day_bars.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    plan = attach(day_bars, DAILY, codes, "left")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 2 and "hashpartitioning" not in plan  # the bars once, the codes once
