"""Scans in several levels give what one window over the key gives, and no task holds more than a span of a key."""

from dataclasses import replace

import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from barloom.operators import windows
from barloom.operators.ema import ema
from barloom.operators.series import BLOCK, DAILY, Fold, halo, scanned, without_halo
from tests.series_data import bars, collected, frame, per_code, same

#: 3 rows a block, 4 blocks a span: 5 levels cover 3 * 4 ** 5 = 3072 days
SMALL = replace(DAILY.with_block_rows(3), span_blocks=4, levels=5)


def summaries(spark, n=150):
    rows = [("A", b, b % 7 if b % 3 else None, [b * 10 + j for j in range(b % 2 + 1)], float(b % 5 + 1) / 3) for b in range(-20, n) if b % 4 != 1]
    rows += [("B", 5, 1, [1], 2.0)]
    return spark.createDataFrame(rows, f"code string, {BLOCK} long, x long, rows array<long>, g double")


@pytest.mark.parametrize("levels", [1, 2, 3, 5])
def test_folds_equal_a_window_over_the_key(spark, levels):
    s = replace(SMALL, levels=levels)
    state = {
        "sum": Fold("sum", "x"), "max": Fold("max", "x"), "min": Fold("min", "x"), "last": Fold("last", "x"), "prod": Fold("product", "g"),
        "all": Fold("sum", "x", whole=True), "top": Fold("max", "x", whole=True), "tail": Fold("tail", "rows", 5), "head": Fold("head", "rows", 5)}
    got = scanned(summaries(spark), s, state)
    assert got.columns == [*summaries(spark).columns, *state]
    for code, mine in got.toPandas().sort_values(BLOCK).groupby("code"):
        x = mine.x.astype(float)
        before = x.shift()
        near = lambda got_, want: pd.testing.assert_series_equal(got_.astype(float), want, check_names=False)
        near(mine["sum"], before.expanding().sum().where(before.expanding().count() > 0))
        near(mine["max"], before.expanding().max())
        near(mine["min"], before.expanding().min())
        near(mine["last"], before.ffill())
        near(mine["prod"], mine.g.cumprod().shift())
        assert set(mine["all"]) == {x.sum()} and set(mine["top"]) == {x.max()}
        arrays = [list(r) for r in mine["rows"]]
        for i, (tail, head) in enumerate(zip(mine["tail"], mine["head"])):
            assert list(tail) == sum(arrays[:i], [])[-5:]
            assert list(head) == sum(arrays[i + 1:], [])[:5]


def test_operators_equal_pandas_with_many_levels(spark):
    pdf = bars(sizes=(("LONG", 400), ("MID", 40), ("ONE", 1)))
    df = frame(spark, pdf)
    same(collected(windows.forward_fill(df, ["close"], SMALL)).close, per_code(pdf, lambda g: g.close.ffill()))
    out = collected(windows.rolling(df, {"m": ("mean", "volume", 20)}, SMALL))
    same(out.m, per_code(pdf, lambda g: g.volume.rolling(20).mean()))
    out = collected(windows.lead(df, {"n": "volume"}, SMALL, 7))
    same(out.n, per_code(pdf, lambda g: g.volume.shift(-7)))
    out = collected(windows.running(df, {"t": ("sum", "volume"), "h": ("max", "volume")}, SMALL))
    same(out.t, per_code(pdf, lambda g: g.volume.cumsum()))
    same(out.h, per_code(pdf, lambda g: g.volume.cummax()))
    out = collected(windows.position(df, SMALL))
    same(out.pos, per_code(pdf, lambda g: pd.Series(range(1, len(g) + 1), index=g.index)))
    same(out.n_rows, per_code(pdf, lambda g: pd.Series(len(g), index=g.index)))
    same(collected(ema(df, {"y": ("close", 10)}, SMALL)).y, per_code(pdf, lambda g: g.close.ewm(span=10, adjust=False).mean()))
    wide = without_halo(halo(df, SMALL, ["close"], before=3, after=2))
    assert wide.count() == len(pdf)


def test_no_window_holds_more_than_a_span_of_a_key(spark, monkeypatch):
    """Every window that a scan makes is counted where it is made: rows of its partitions, over the table it is put on."""
    seen, real = [], Window.partitionBy

    def counted(*keys):
        seen.append(keys)
        return real(*keys)

    s = replace(SMALL, levels=5)
    monkeypatch.setattr(Window, "partitionBy", staticmethod(counted))
    out = scanned(summaries(spark), s, {"sum": Fold("sum", "x"), "near": Fold("tail", "rows", 2)})
    by_key = [k for k in seen if k == ("code",)]
    assert len(by_key) == 1 and [k for k in seen if k[-1] == "_span"]
    monkeypatch.undo()
    blocks = out.select("code", BLOCK)
    for level in range(1, 5):  # spans of a level within one of the next, and what is left at the last
        width = s.span_blocks ** level
        inside = blocks.withColumn("a", F.floor(F.col(BLOCK) / (width // s.span_blocks))).withColumn("b", F.floor(F.col(BLOCK) / width))
        assert inside.groupBy("code", "b").agg(F.count_distinct("a").alias("n")).agg(F.max("n")).first()[0] <= s.span_blocks
    last = blocks.withColumn("b", F.floor(F.col(BLOCK) / s.span_blocks ** 4)).groupBy("code").agg(F.count_distinct("b").alias("n"))
    assert last.agg(F.max("n")).first()[0] <= s.span_blocks


def test_levels_follow_the_longest_key(spark):
    df = frame(spark, bars(sizes=(("LONG", 300), ("ONE", 1))))
    s = replace(DAILY.with_block_rows(3), span_blocks=4)
    days = df.filter("code = 'LONG'").agg(F.date_diff(F.max("date"), F.min("date"))).first()[0]
    levels = s.spanned(df).levels
    assert 3 * 4 ** (levels - 1) <= days + 6 and days <= 3 * 4 ** levels + 6
    assert DAILY.spanned(df) == DAILY and s.spanned(df.limit(0)).levels == 1
