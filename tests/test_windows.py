import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barloom.operators import windows
from barloom.operators.ema import ema, ema_local
from barloom.operators.series import DAILY, attach, halo
from tests.series_data import bars, collected, frame, ordered, per_code, same

BLOCKS = [3, 64, 2048]


@pytest.mark.parametrize("rows", BLOCKS)
def test_rolling_waits_for_a_full_frame(spark, rows):
    pdf = bars()
    out = collected(windows.rolling(
        frame(spark, pdf), {"m": ("mean", "close", 5), "s": ("std", "close", 7), "x": ("max", "high", 9)},
        DAILY.with_block_rows(rows)))
    assert len(out) == len(pdf)
    same(out.m, per_code(pdf, lambda g: g.close.rolling(5).mean()))
    same(out.s, per_code(pdf, lambda g: g.close.rolling(7).std()))
    same(out.x, per_code(pdf, lambda g: g.high.rolling(9).max()))


@pytest.mark.parametrize("rows", BLOCKS)
def test_fills_lags_and_changes(spark, rows):
    pdf, s = bars(), DAILY.with_block_rows(rows)
    df = frame(spark, pdf)
    same(collected(windows.forward_fill(df, ["close"], s)).close, per_code(pdf, lambda g: g.close.ffill()))
    same(collected(windows.lag_fill(df, ["close"], s)).close, per_code(pdf, lambda g: g.close.fillna(g.close.shift())))
    same(collected(windows.lag(df, {"p": "close"}, s, 3)).p, per_code(pdf, lambda g: g.close.shift(3)))
    same(collected(windows.lead(df, {"p": "close"}, s)).p, per_code(pdf, lambda g: g.close.shift(-1)))
    same(collected(windows.difference(df, {"p": "close"}, s)).p, per_code(pdf, lambda g: g.close.diff()))
    same(collected(windows.pct_change(df, {"p": "close"}, s)).p,
         per_code(pdf, lambda g: g.close.ffill() / g.close.ffill().shift() - 1))


def test_zero_divisor_is_null(spark):
    out = collected(windows.pct_change(frame(spark, bars()), {"p": "volume"}))
    want = per_code(bars(), lambda g: g.volume.pct_change().replace([np.inf, -np.inf], np.nan))
    same(out.p, want)


@pytest.mark.parametrize("rows", BLOCKS)
def test_positions_and_split(spark, rows):
    pdf, s = bars(), DAILY.with_block_rows(rows)
    p = collected(windows.position(frame(spark, pdf), s))
    same(p.pos, per_code(pdf, lambda g: pd.Series(np.arange(1, len(g) + 1))))
    split = collected(windows.split_by_position(frame(spark, pdf), s))
    counts = split.groupby(["code", "split"]).size().to_dict()
    for code, n in (("HOT", 400), ("MID", 130)):
        assert counts[code, "train"] == int(n * 0.7)
        assert counts[code, "train"] + counts[code, "val"] == int(n * (0.7 + 0.15))
    assert counts["ONE", "test"] == 1


def test_split_bound_uses_doubles(spark):
    pdf = bars(holes=False, sizes=(("N90", 90),))
    counts = collected(windows.split_by_position(frame(spark, pdf))).split.value_counts()
    assert counts["train"] == int(90 * 0.7) == 62


@pytest.mark.parametrize("rows", BLOCKS)
def test_running_state(spark, rows):
    pdf, s = bars(), DAILY.with_block_rows(rows)
    df = frame(spark, pdf).withColumn("g", 1 + F.col("volume") / 1000)
    out = collected(windows.running(df, {
        "mx": ("max", "high"), "sm": ("sum", "volume"), "pr": ("product", "g"), "la": ("last", "close")}, s))
    same(out.mx, per_code(pdf, lambda g: g.high.cummax()))
    same(out.sm, per_code(pdf, lambda g: g.volume.cumsum()))
    same(out.pr, per_code(pdf, lambda g: (1 + g.volume / 1000).cumprod()))
    same(out.la, per_code(pdf, lambda g: g.close.ffill()))


@pytest.mark.parametrize("rows", [3, 512])
def test_sequences_keep_nulls_in_place(spark, rows):
    pdf = bars()
    seq = windows.sequences(frame(spark, pdf), ["date", "close"], 5, DAILY.with_block_rows(rows))
    got = {(r.code, r.date): [x.close for x in r.window] for r in seq.collect()}
    want = {}
    for code, g in ordered(pdf).groupby("code"):
        close = [None if np.isnan(x) else x for x in g.close]
        want |= {(code, d): close[i - 4:i + 1] for i, d in enumerate(g.date) if i >= 4}
    assert got == want


def test_ordinal_tail_latest_and_history(spark):
    pdf = ordered(bars())
    df = frame(spark, pdf)
    numbered = windows.ordinal(df, ["code", "date"]).toPandas().sort_values("STT")
    assert list(numbered.STT) == list(range(1, len(pdf) + 1))
    assert list(numbered.date) == list(pdf.date)
    assert collected(windows.tail(df, 4)).groupby("code").size().to_dict() == {"HOT": 4, "MID": 4, "ONE": 1}
    assert collected(windows.latest(df, ["high"])).high.tolist() == pdf.groupby("code").high.last().tolist()
    assert set(collected(windows.enough_history(df, 130)).code) == {"HOT", "MID"}


@pytest.mark.parametrize("rows", BLOCKS)
@pytest.mark.parametrize("span", [2, 10, 26])
def test_mean_with_gaps_equals_pandas(spark, rows, span):
    pdf = bars()
    out = collected(ema(frame(spark, pdf), {"y": ("close", span)}, DAILY.with_block_rows(rows)))
    same(out.y, per_code(pdf, lambda g: g.close.ewm(span=span, adjust=False).mean()))


@pytest.mark.parametrize("span_blocks", [1, 3, 50])
def test_mean_over_many_spans_of_blocks(spark, monkeypatch, span_blocks):
    monkeypatch.setattr("barloom.operators.ema.SPAN_BLOCKS", span_blocks)
    pdf = bars()
    out = collected(ema(
        frame(spark, pdf), {"y": ("close", 10), "z": ("close", 26), "h": ("high", 12)}, DAILY.with_block_rows(4)))
    for name, c, k in (("y", "close", 10), ("z", "close", 26), ("h", "high", 12)):
        same(out[name], per_code(pdf, lambda g: g[c].ewm(span=k, adjust=False).mean()))


def test_mean_without_gaps_equals_pandas(spark):
    pdf = bars(holes=False)
    for rows in BLOCKS:
        out = collected(ema(frame(spark, pdf), {"y": ("close", 12)}, DAILY.with_block_rows(rows), gaps=False))
        same(out.y, per_code(pdf, lambda g: g.close.ewm(span=12, adjust=False).mean()))


def test_mean_refuses_blocks_beyond_the_double_range(spark):
    pdf = bars(holes=False, sizes=(("LONG", 900),))
    with pytest.raises(Exception, match="block too long"):
        ema_local(frame(spark, pdf), {"y": ("close", 2)}, DAILY.with_block_rows(5000), gaps=False).collect()
    out = collected(ema(frame(spark, pdf), {"y": ("close", 2)}, DAILY.with_block_rows(5000), gaps=False))
    same(out.y, per_code(pdf, lambda g: g.close.ewm(span=2, adjust=False).mean()))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.integers(1, 200), seed=st.integers(0, 1000))
def test_any_block_size_gives_the_same_fill_and_mean(spark, rows, seed):
    pdf, s = bars(seed, sizes=(("A", 90), ("B", 40))), DAILY.with_block_rows(rows)
    filled = windows.forward_fill(frame(spark, pdf), ["close"], s)
    twice = windows.forward_fill(filled, ["close"], s)
    same(collected(twice).close, per_code(pdf, lambda g: g.close.ffill()))
    same(collected(ema(frame(spark, pdf), {"y": ("close", 10)}, s)).y,
         per_code(pdf, lambda g: g.close.ewm(span=10, adjust=False).mean()))


def test_hot_key_is_split(spark):
    """No shuffle of bars is partitioned by the code alone, and no bars pass through one task."""
    pdf = bars(sizes=(("HOT", 3000), ("ONE", 1)))
    wide = halo(frame(spark, pdf), DAILY.with_block_rows(64), ["close"], before=5)
    blocks = wide.groupBy("code", "_block").count().agg({"count": "max"}).first()[0]
    assert blocks <= 64 + 5
    params = spark.createDataFrame([("HOT", 1.0)], "code string, p double")
    joined = attach(frame(spark, pdf), DAILY, params)
    assert joined.count() == 3000


def test_fitted_blocks(spark):
    df = frame(spark, bars(sizes=(("LONG", 2000), ("ONE", 1))))
    days = df.filter("code = 'LONG'").agg(F.date_diff(F.max("date"), F.min("date"))).first()[0]
    assert DAILY.with_block_rows(8).fitted(df).block_rows == int(days ** 0.5) + 1
    assert DAILY.fitted(df).block_rows == DAILY.block_rows
