import numpy as np
import pandas as pd
import pytest

from barloom.operators.indicators import INDICATORS, add_indicators
from barloom.operators.series import DAILY, INTRADAY
from barloom.session import stage
from tests.series_data import bars, collected, frame, ordered, same


def expected(g):
    """The indicator definitions written as plain pandas formulas."""
    c, h, lo = g.close, g.high, g.low
    mean = lambda x, k: x.ewm(span=k, adjust=False).mean()
    step = c.diff().fillna(0)
    up, down = step.clip(lower=0).rolling(14).mean(), (-step).clip(lower=0).rolling(14).mean()
    tr = pd.concat([h - lo, (h - c.shift()).abs(), (lo - c.shift()).abs()], axis=1).max(axis=1)
    atr = mean(tr, 14)
    plus = 100 * mean(h.diff().mask(lambda x: x < 0, 0.0), 14) / (atr + 1e-9)
    minus = 100 * mean(lo.diff().mask(lambda x: x > 0, 0.0), 14).abs() / (atr + 1e-9)
    low14, high14 = lo.rolling(14).min(), h.rolling(14).max()
    k = 100 * (c - low14) / (high14 - low14 + 1e-9)
    mid, dev = c.rolling(20).mean(), c.rolling(20).std()
    return pd.DataFrame({
        "SMA_10": c.rolling(10).mean(), "EMA_10": mean(c, 10), "RSI_14": 100 - 100 / (1 + up / (down + 1e-9)),
        "MACD": mean(c, 12) - mean(c, 26), "BB_upper": mid + 2 * dev, "BB_lower": mid - 2 * dev, "ATR_14": atr,
        "ADX_14": mean(100 * (plus - minus).abs() / (plus + minus + 1e-9), 14),
        "STOCHk_14_3_3": k.rolling(3).mean()})


@pytest.mark.parametrize("rows", [7, 100_000])
@pytest.mark.parametrize("holes", [False, True])
def test_indicators_equal_formulas(spark, rows, holes):
    pdf = bars(3, holes=holes)
    out = collected(add_indicators(frame(spark, pdf), DAILY.with_block_rows(rows), gaps=holes))
    want = pd.concat([expected(g.reset_index(drop=True)) for _, g in ordered(pdf).groupby("code")]).reset_index(drop=True)
    assert len(out) == len(pdf)
    for name in INDICATORS:
        same(out[name], want[name], 1e-8)
    bounded = out[["RSI_14", "STOCHk_14_3_3"]].dropna()
    assert ((bounded > -1e-6) & (bounded < 100 + 1e-6)).all().all()


def test_minute_bars_fit_a_denser_series(spark):
    rng = np.random.default_rng(3)
    close = 100 + np.cumsum(rng.normal(0, 0.1, 4000))
    start = pd.Timestamp("2024-01-01")
    rows = [("A", (start + pd.Timedelta(i, "min")).to_pydatetime(), float(x), float(x) + 1, float(x) - 1, float(x), 1.0) for i, x in enumerate(close)]
    df = stage(spark.createDataFrame(rows, "code string, timestamp timestamp, open double, high double, low double, close double, volume double"), "minutes")
    s = INTRADAY.dense(df)
    assert s.step < INTRADAY.step and s.dense(df) == s and INTRADAY.dense(df.limit(5)) == INTRADAY
    got = add_indicators(df, s).orderBy("timestamp").toPandas()
    np.testing.assert_allclose(got.EMA_10, pd.Series(close).ewm(span=10, adjust=False).mean(), rtol=1e-10)
    np.testing.assert_allclose(got.SMA_10[9:], pd.Series(close).rolling(10).mean()[9:], rtol=1e-10)


def exchanges(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning(code")


def test_second_pass_does_not_shuffle_the_pieces_again(spark):
    """The stored pieces are bucketed by (code, block); without that Spark would have to move them for the second mean."""
    df = stage(frame(spark, bars(3, holes=False)), "bars")
    bucketed = add_indicators(df)
    plan = bucketed._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan
    spark.conf.set("spark.sql.sources.bucketing.enabled", "false")
    try:
        plain = add_indicators(df)
        shuffled = exchanges(plain)
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.enabled")
    assert exchanges(bucketed) < shuffled


def test_stored_pieces_are_no_wider_than_needed(spark):
    """One file a bucket at most, first values only where a block ends, no dictionaries for measurements."""
    from pyspark.sql import functions as F

    df = stage(frame(spark, bars(3, holes=False)), "bars")
    add_indicators(df)
    name = [t.name for t in spark.catalog.listTables() if t.name.startswith("barloom_")]
    stored = [t for t in map(spark.read.table, name) if "_first_close" in t.columns and "_S_EMA_10" in t.columns]
    assert stored
    fresh = [t for t in stored if not {"_tr", "_pdm", "_mdm"} & set(t.columns)]
    assert fresh
    for t in fresh:
        assert t.filter(~F.col("_end") & F.col("_first_close").isNotNull()).isEmpty()
        assert t.filter(F.col("_end") & F.col("_first_close").isNull() & (F.col("_count_close") > 0)).isEmpty() if "_count_close" in t.columns else True
        assert len(t.inputFiles()) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
