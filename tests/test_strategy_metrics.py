import math

import numpy as np
import pandas as pd
import pytest

from barloom.operators import metrics
from barloom.operators.series import DAILY
from barloom.operators.strategy import equity_curves, strategy_summary
from tests.series_data import collected

CAPITAL, FEE = 100_000_000.0, 0.001


def outcome_rows(seed, sizes=(("A", 300), ("FLAT", 40), ("ONE", 1), ("TWO", 2), ("UP", 30))):
    rng = np.random.default_rng(seed)
    out = []
    for code, n in sizes:
        price = 100 * np.exp(np.cumsum(rng.normal(0, 0.03, n + 1)))
        signal = rng.choice([0, 1, 2], n, p=[0.2, 0.6, 0.2])
        if code == "FLAT":
            signal[:] = 1
        if code == "UP":
            signal[:] = 2
        day = pd.Timestamp("2020-01-01")
        out += [(code, (day + pd.Timedelta(int(i) * 2, "D")).date(), float(price[i]), float(price[i + 1]), int(signal[i]))
                for i in range(n)]
    return out


# Worked by hand, in units of the capital and with the fee rate f = 0.001, k = 1 - f. Each case: prices, last
# next price, signals; the strategy's value after each row, its end, its trades; buy and hold after each row.
K = 1 - FEE
HAND = {
    "ROUND": ([100, 110, 99, 120], 132, [2, 1, 0, 1],
              [K, 1.1 * K, 0.99 * K * K, 0.99 * K * K], 0.99 * K * K, 2, [K, 1.1 * K, 0.99 * K, 1.2 * K]),
    "OPEN": ([50, 40, 80], 100, [1, 2, 2],  # bought at 40, carried past the last signal, closed at 100
             [1, K, 2.5 * K * K], 2.5 * K * K, 2, [K, 0.8 * K, 1.6 * K]),
    "NEVER": ([10, 20], 5, [0, 2], [1, 1], 1, 0, [K, 2 * K]),  # the last signal is not acted on
    "TWICE": ([10, 20, 10, 30], 30, [2, 0, 2, 1],
              [K, 2 * K * K, 2 * K**3, 6 * K**4], 6 * K**4, 4, [K, 2 * K, K, 3 * K]),
}


def hand_rows():
    day = pd.Timestamp("2020-01-01")
    return [(code, (day + pd.Timedelta(3 * i, "D")).date(), float(p), float(n), g)
            for code, (prices, last, signals, *_) in HAND.items()
            for i, (p, n, g) in enumerate(zip(prices, [*prices[1:], last], signals))]


def drawdown(values):
    v = np.array(values)
    peak = np.maximum.accumulate(v)
    return 100 * ((peak - v) / peak).max()


def sharpe(values):
    r = pd.Series(values).pct_change().dropna()
    return 0.0 if r.std() == 0 else r.mean() / r.std() * math.sqrt(252)


OUTCOME = "code string, date date, price double, next_price double, signal int"


@pytest.mark.parametrize("rows", [1, 2, 512])
def test_hand_worked_cases(spark, rows):
    df = spark.createDataFrame(hand_rows(), OUTCOME).repartition(3)
    s = DAILY.with_block_rows(rows)
    got = {r.code: r for r in strategy_summary(df, s).collect()}
    curves = collected(equity_curves(df, s))
    near = lambda x: pytest.approx(x, rel=1e-12, abs=1e-9)
    for code, (prices, last, _, model, end, trades, hold) in HAND.items():
        r, mine = got[code], curves[curves.code == code]
        hold_end = K * last / prices[0] * K
        assert r.model_num_trades == trades
        assert (r.model_final_value, r.hold_final_value) == (near(CAPITAL * end), near(CAPITAL * hold_end))
        assert (r.model_return_pct, r.hold_return_pct) == (near((end - 1) * 100), near((hold_end - 1) * 100))
        assert (r.model_max_drawdown, r.hold_max_drawdown) == (near(drawdown([1, *model])), near(drawdown([1, *hold])))
        assert (r.model_sharpe_ratio, r.hold_sharpe_ratio) == (near(sharpe([1, *model])), near(sharpe([1, *hold])))
        np.testing.assert_allclose(mine.model_equity, CAPITAL * np.array(model), rtol=1e-12)
        np.testing.assert_allclose(mine.hold_equity, CAPITAL * np.array(hold), rtol=1e-12)
        np.testing.assert_allclose(mine.model_peak, CAPITAL * np.maximum.accumulate([1, *model])[1:], rtol=1e-12)


@pytest.mark.parametrize("seed", [1, 2])
def test_blocks_of_any_size_give_the_same(spark, seed):
    df = spark.createDataFrame(outcome_rows(seed), OUTCOME).repartition(3)
    tables = []
    for rows in (1, 7, 512):
        s = DAILY.with_block_rows(rows)
        curves = collected(equity_curves(df, s))
        assert (curves.model_equity > 0).all() and (curves.model_peak >= curves.model_equity - 1e-6).all()
        summary = strategy_summary(df, s).toPandas().sort_values("code").reset_index(drop=True)
        assert set(summary.code) == {"A", "FLAT", "TWO", "UP"}  # one row cannot be traded
        tables.append((curves[["model_equity", "hold_equity", "model_peak", "hold_peak"]], summary.drop(columns="code")))
    for curves, summary in tables[1:]:
        np.testing.assert_allclose(curves, tables[0][0], rtol=1e-9)
        np.testing.assert_allclose(summary.astype(float), tables[0][1].astype(float), rtol=1e-9, atol=1e-7)


def test_regression_and_classification(spark):
    rng = np.random.default_rng(9)
    data = [("A", float(a), float(a + e), int(y), int(p)) for a, e, y, p in zip(
        rng.normal(50, 9, 200), rng.normal(0, 2, 200), rng.integers(0, 3, 200), rng.integers(0, 3, 200))]
    data += [("B", 1.0, 1.0, 1, 1), ("B", 2.0, 2.5, 1, 1)]
    df = spark.createDataFrame(data, "code string, a double, f double, y int, p int")
    reg = {r.code: r for r in metrics.regression_metrics(df, "a", "f").collect()}
    a = np.array([r[1] for r in data if r[0] == "A"])
    f = np.array([r[2] for r in data if r[0] == "A"])
    assert reg["A"].rmse == pytest.approx(np.sqrt(((a - f) ** 2).mean()))
    assert reg["A"].mae == pytest.approx(np.abs(a - f).mean())
    assert reg["A"].r2 == pytest.approx(1 - ((a - f) ** 2).sum() / ((a - a.mean()) ** 2).sum())

    got = {r.code: r for r in metrics.classification_metrics(df, "y", "p").collect()}
    y = np.array([r[3] for r in data if r[0] == "A"])
    p = np.array([r[4] for r in data if r[0] == "A"])
    assert got["A"].accuracy == pytest.approx((y == p).mean())
    for k, n in enumerate(("down", "neutral", "up")):
        tp = ((y == k) & (p == k)).sum()
        assert got["A"][f"precision_{n}"] == pytest.approx(tp / (p == k).sum())
        assert got["A"][f"recall_{n}"] == pytest.approx(tp / (y == k).sum())
        assert got["A"][f"f1_{n}"] == pytest.approx(2 * tp / ((p == k).sum() + (y == k).sum()))
    one_hot = lambda v: np.eye(3)[v] - np.eye(3)[v].mean(0)
    cov = lambda u, v: (u * v).sum()
    u, v = one_hot(y), one_hot(p)
    assert got["A"].mcc == pytest.approx(cov(u, v) / math.sqrt(cov(u, u) * cov(v, v)))
    assert (got["B"].mcc, got["B"].precision_up, got["B"].f1_neutral) == (0.0, 0.0, 1.0)

    matrix = {(r.code, r.actual): (r.pred_down, r.pred_neutral, r.pred_up)
              for r in metrics.confusion_matrix(df, "y", "p").collect()}
    assert matrix["B", 1] == (0, 2, 0)
    assert matrix["A", 2] == tuple(((y == 2) & (p == k)).sum() for k in range(3))


def test_loss_weights_classes(spark):
    df = spark.createDataFrame(
        [([0.7, 0.2, 0.1], 0, 1.0, 0.5, 0.0), ([0.1, 0.1, 0.8], 2, 3.0, 1.0, 1.0)],
        "probability array<double>, target_trend int, class_weight double, target_scaled double, prediction double")
    r = metrics.total_loss(df).first()
    ce = -(1 * math.log(0.7) + 3 * math.log(0.8)) / 4
    assert r.mse == pytest.approx(0.125) and r.cross_entropy == pytest.approx(ce)
    assert r.total_loss == pytest.approx(0.125 + 5 * ce)


def test_summary_is_numbered(spark):
    df = spark.createDataFrame([("B", 1.23456), ("A", 2.0)], "code string, rmse double")
    assert [tuple(r) for r in metrics.summary_table(df).orderBy("STT").collect()] == [(1, "A", 2.0), (2, "B", 1.2346)]
