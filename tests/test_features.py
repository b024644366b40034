import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from barloom.operators import features
from barloom.operators.quantiles import exact_quantiles, located
from barloom.operators.series import DAILY
from barloom.settings import CHANGE_FEATURES, FEATURES, LEVEL_FEATURES, Settings
from tests.series_data import bars, collected, frame, ordered, same
from tests.test_indicators import expected

SIZES = (("A", 330), ("B", 150), ("SHORT", 99))


def clean_bars(seed=11):
    pdf = bars(seed, holes=False, sizes=SIZES)
    pdf["volume"] += 10
    return pdf


def by_hand(g, window=15):
    """One code's training set built step by step in pandas."""
    g = g.reset_index(drop=True)
    ind = pd.concat([g, expected(g)], axis=1)
    ind["target"] = ind.close.shift(-1) / ind.close - 1
    ind = ind.dropna(subset=["target"]).reset_index(drop=True)
    lead = ind.target.iloc[:int(len(ind) * 0.7)]
    low, high = lead.quantile(0.33), lead.quantile(0.67)
    ind["trend"] = np.where(ind.target > high, 2, np.where(ind.target < low, 0, 1))
    x = pd.DataFrame({f"{c}_pct_change": ind[c].pct_change() for c in CHANGE_FEATURES})
    x[LEVEL_FEATURES] = ind[LEVEL_FEATURES]
    rows = pd.concat([ind[["date", "target", "trend", "close"]], x], axis=1).dropna().reset_index(drop=True)
    lead = rows.iloc[:int(len(rows) * 0.7)]
    cols = FEATURES + ["target"]
    z = (rows[cols] - lead[cols].mean()) / lead[cols].std(ddof=0).replace(0, 1)
    n = len(rows) - window
    out = []
    for i in range(n):
        last = i + window - 1
        part = "train" if i < int(n * 0.7) else "val" if i < int(n * (0.7 + 0.15)) else "test"
        out.append((rows.date[last], z[FEATURES].iloc[i:i + window].to_numpy(), z.target[last], rows.trend[last],
                    rows.close[last], part))
    return out


def test_training_windows_equal_a_step_by_step_build(spark):
    pdf = clean_bars()
    got = features.training_windows(frame(spark, pdf), DAILY.with_block_rows(64)).orderBy("code", "date").collect()
    want = [(c, *r) for c, g in ordered(pdf).groupby("code") if len(g) >= 100 for r in by_hand(g)]
    assert len(got) == len(want)
    for row, (code, date, x, target, trend, close, part) in zip(got, want):
        assert (row.code, row.date, row.target_trend, row.split) == (code, date, trend, part)
        assert row.close == close and abs(row.target_scaled - target) < 1e-8
        np.testing.assert_allclose(np.array([list(w) for w in row.window]), x, rtol=1e-6, atol=1e-7)


def test_test_rows_leak_nothing_into_training(spark):
    pdf = ordered(clean_bars())
    changed = pdf.copy()
    last = changed.groupby("code").cumcount(ascending=False) < 20
    for c in ("open", "high", "low", "close"):
        changed.loc[last, c] *= 1.5
    changed.loc[last, "volume"] += 70

    def train(p):
        rows = features.training_windows(frame(spark, p)).filter(F.col("split") == "train")
        return rows.orderBy("code", "date").select("code", "date", "window", "target_scaled", "target_trend").collect()

    before, after = train(pdf), train(changed)
    assert len(before) == len(after)
    for a, b in zip(before, after):
        assert a[:2] == b[:2] and a.target_trend == b.target_trend
        np.testing.assert_allclose(np.array(a.window), np.array(b.window), rtol=1e-9, atol=1e-9)


def test_baseline_windows(spark):
    pdf = ordered(clean_bars())
    pdf.loc[pdf.index % 9 == 0, "volume"] = 0.0
    rows = features.baseline_windows(frame(spark, pdf), DAILY.with_block_rows(16)).orderBy("code", "date").collect()
    want = 0
    for code, g in pdf.groupby("code"):
        if len(g) < 80:
            continue
        x = g[["open", "high", "low", "close", "volume"]].copy()
        x["volume"] = x.volume.replace(0, 1)
        cut = int(np.ceil(len(x) * 0.8))
        lead = x.iloc[:cut]
        z = ((x - lead.min()) / (lead.max() - lead.min())).to_numpy()
        mine = [r for r in rows if r.code == code]
        assert len(mine) == len(g) - 30
        for i, r in enumerate(mine, start=30):
            assert r.split == ("train" if i < cut else "test")
            np.testing.assert_allclose(np.array([list(w) for w in r.window]), z[i - 30:i], atol=1e-9)
            assert abs(r.target_scaled - z[i, 3]) < 1e-9
        want += len(mine)
    assert len(rows) == want


@pytest.mark.parametrize("probs", [{"a": 0.33, "b": 0.67}, {"lo": 0.0, "mid": 0.5, "hi": 1.0}])
def test_exact_quantiles(spark, probs):
    rng = np.random.default_rng(5)
    groups = {
        "normal": rng.normal(0, 0.02, 501), "ties": rng.choice([-1.5, 0.0, 2.0, 2.0], 400),
        "one": np.array([3.25]), "two": np.array([-4.0, 9.0]), "wide": np.exp(rng.normal(0, 30, 300)) * rng.choice([-1, 1], 300),
        "zeros": np.array([0.0, -0.0, 0.0]), "close": 1 + rng.random(200) * 1e-7,
    }
    rows = [(k, float(v)) for k, xs in groups.items() for v in xs] + [("normal", None)]
    out = exact_quantiles(spark.createDataFrame(rows, "code string, x double"), "code", "x", probs)
    got = {r.code: r.asDict() for r in out.collect()}
    assert set(got) == set(groups)
    for k, xs in groups.items():
        for name, q in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(xs, q), rel=1e-9, abs=1e-12)


def test_bins_with_many_values_are_split_until_few_are_ranked(spark):
    rng = np.random.default_rng(6)
    groups = {
        "dense": 1 + np.arange(3000) * 1e-9, "ties": np.repeat(1 + np.arange(200) * 1e-9, 9), "one": np.full(500, 1.5),
        "lopsided": 1 + 1e-5 * 0.5 ** rng.uniform(0, 30, 1500), "negative": -1 - rng.random(800) * 1e-6, "wide": rng.normal(0, 1, 300)}
    df = spark.createDataFrame([(k, float(v)) for k, xs in groups.items() for v in xs], "code string, x double").repartition(5)
    probs = {"lo": 0.0, "a": 0.33, "mid": 0.5, "hi": 1.0}
    held = located(df, "code", "x", probs, ranked=40)
    assert held.groupBy("code", "_bin").count().agg({"count": "max"}).first()[0] <= 40
    got = {r.code: r for r in exact_quantiles(df, "code", "x", probs, ranked=40).collect()}
    for k, xs in groups.items():
        for name, q in probs.items():
            assert got[k][name] == pytest.approx(np.quantile(xs, q), rel=1e-15, abs=1e-15), (k, name)


def test_scalers_guard_constant_columns(spark):
    df = spark.createDataFrame([("A", 1.0, 5.0), ("A", 3.0, 5.0)], "code string, x double, y double")
    s = features.standard_scaler(df, ["x", "y"]).first()
    assert (s.mean_x, s.std_x, s.mean_y, s.std_y) == (2.0, 1.0, 5.0, 1.0)
    m = features.min_max_scaler(df, ["x", "y"]).first()
    assert (m.min_x, m.range_x, m.min_y, m.range_y) == (1.0, 2.0, 5.0, 1.0)


def test_short_histories_are_left_out(spark):
    cfg = Settings(min_rows=140)
    codes = {r.code for r in features.labelled_features(frame(spark, clean_bars()), cfg=cfg).select("code").distinct().collect()}
    assert codes == {"A", "B"}


def test_next_change_drops_the_last_row(spark):
    pdf = clean_bars()
    out = collected(features.next_change(frame(spark, pdf), DAILY.with_block_rows(5)))
    want = ordered(pdf)
    want["t"] = want.groupby("code").close.shift(-1) / want.close - 1
    same(out.target_pct_change, want.t.dropna())
