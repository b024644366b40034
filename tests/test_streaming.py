import datetime as dt
import os
import shutil

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from barloom.plans.medallion import Layout
from barloom.session import stage_root
from barloom.sources.ticks import bars_from_ticks
from barloom.streaming import live

TICKS = "code string, ts timestamp, price double"
T0 = dt.datetime(2024, 1, 1)


def write(spark, path, rows, schema=TICKS):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_stream_of_ticks_equals_batch_with_late_and_replayed_files(spark, tmp_path):
    source = f"{tmp_path}/ticks"
    batches = [
        [("A", at(1), 5.0), ("A", at(14), 7.0), ("B", at(3), 1.0)],
        [("A", at(31), 9.0), ("B", at(50), 2.0)],
        [("A", at(7), 8.0)],  # late for its bar, within the watermark
        [("A", at(75), 4.0)],
    ]
    for rows in batches:
        write(spark, source, rows)
    schema = spark.read.parquet(source).schema
    layout = Layout(f"{tmp_path}/live", "intraday")
    stream = live.live_bars(live.file_stream(spark, source, schema, files_per_batch=1), "code", "ts", "price", "2 hours")
    live.publish_stream(stream, layout, f"{tmp_path}/cp", mode="update")
    ticks = spark.read.parquet(source)
    want = bars_from_ticks(ticks, "code", "ts", "price", F.lit(1).cast("double"))
    key = lambda df: sorted(map(tuple, df.select("code", "timestamp", "open", "high", "low", "close", "volume").collect()))
    assert key(spark.read.parquet(layout.bars)) == key(want)
    # a replay from the start (a lost checkpoint) upserts the same rows
    live.publish_stream(stream, layout, f"{tmp_path}/cp2", mode="update")
    assert key(spark.read.parquet(layout.bars)) == key(want)
    report = {r.code: r.nb for r in spark.read.parquet(layout.report).collect()}
    assert report == {"A": 3, "B": 2}


def test_dedupe_within_watermark(spark, tmp_path):
    source, out = f"{tmp_path}/bars", f"{tmp_path}/out"
    schema = "code string, timestamp timestamp, close double"
    for _ in range(2):
        write(spark, source, [("A", at(0), 1.0), ("A", at(15), 2.0), ("B", at(0), 3.0)], schema)
    stream = live.live_dedupe(live.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1))
    live.run_available(stream.writeStream.format("parquet"), f"{tmp_path}/cp", path=out)
    assert spark.read.parquet(out).count() == 3


def test_fill_and_mean_carry_state_over_batches(spark, tmp_path):
    source, out = f"{tmp_path}/bars", f"{tmp_path}/out"
    schema = "code string, timestamp timestamp, close double"
    closes = {"A": [None, 4.0, None, 6.0, 8.0, None, 5.0], "B": [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0]}
    rows = [(c, at(15 * i), x) for c, xs in closes.items() for i, x in enumerate(xs)]
    for lo, hi in ((0, 2), (2, 5), (5, 7)):
        mine = [r for r in rows if at(15 * lo) <= r[1] < at(15 * hi)]
        write(spark, source, mine[::-1], schema)
    write(spark, source, [("A", at(15), 1000.0)], schema)  # too late: reported, changes nothing
    stream = live.live_fill_and_mean(
        live.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1), 4)
    live.run_available(stream.writeStream.format("parquet"), f"{tmp_path}/cp", path=out)
    got = spark.read.parquet(out).orderBy("code", "timestamp").toPandas()
    assert got.late.sum() == 1
    got = got[~got.late]
    for code, xs in closes.items():
        want = pd.Series(xs, dtype=float).ffill()
        mine = got[got.code == code].reset_index(drop=True)
        pd.testing.assert_series_equal(mine.close.astype(float), want, check_names=False)
        pd.testing.assert_series_equal(
            mine.ema.astype(float), want.ewm(span=4, adjust=False).mean(), check_names=False)


def test_block_form_of_fill_and_mean_equals_the_stateful_form(spark, tmp_path):
    source, out = f"{tmp_path}/bars", f"{tmp_path}/out"
    schema = "code string, timestamp timestamp, close double"
    closes = {"A": [None, 4.0, None, 6.0, 8.0, None, 5.0], "B": [1.0, 2.0, 3.0, None, 5.0, 6.0, 7.0], "C": [None] * 3}
    rows = [(c, at(15 * i), x) for c, xs in closes.items() for i, x in enumerate(xs)]
    for lo, hi in ((0, 2), (2, 5), (5, 7)):
        write(spark, source, [r for r in rows if at(15 * lo) <= r[1] < at(15 * hi)][::-1], schema)
    write(spark, source, [("A", at(15), 1000.0), ("A", at(20), 7.0), ("B", at(90), 7.0)], schema)  # late or replayed: set aside
    stream = live.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1)
    live.publish_filled(stream, out, f"{tmp_path}/cp", span=4)
    late = live.late_rows(spark, out)
    assert sorted((r.code, r.timestamp, r.close, r.batch) for r in late.collect()) == [
        ("A", at(15), 1000.0, "3"), ("A", at(20), 7.0, "3"), ("B", at(90), 7.0, "3")]
    state = f"{tmp_path}/state"
    live.run_available(live.live_fill_and_mean(stream, 4).writeStream.format("parquet"), f"{tmp_path}/cp2", path=state)
    both = [sorted((r.code, r.timestamp, r.close) for r in rows.collect()) for rows in (
        late, spark.read.parquet(state).filter("late"))]
    assert both[0] == both[1]
    assert sorted(os.listdir(f"{out}_state")) == ["2", "3"]
    got = spark.read.parquet(f"{out}/bars").orderBy("code", "timestamp").toPandas()
    for code, xs in closes.items():
        want = pd.Series(xs, dtype=float).ffill()
        mine = got[got.code == code].reset_index(drop=True)
        pd.testing.assert_series_equal(mine.close.astype(float), want, check_names=False)
        pd.testing.assert_series_equal(
            mine.ema.astype(float), want.ewm(span=4, adjust=False).mean(), check_names=False)


def test_a_missing_state_fails_instead_of_starting_anew(spark, tmp_path):
    source, out = f"{tmp_path}/bars", f"{tmp_path}/out"
    schema = "code string, timestamp timestamp, close double"
    write(spark, source, [("A", at(0), 1.0)], schema)
    kind = spark.read.parquet(source).schema
    live.publish_filled(live.file_stream(spark, source, kind), out, f"{tmp_path}/cp", span=4)
    shutil.rmtree(f"{out}_state/0")
    write(spark, source, [("A", at(15), None)], schema)
    with pytest.raises(StreamingQueryException, match="needs the state"):
        live.publish_filled(live.file_stream(spark, source, kind), out, f"{tmp_path}/cp", span=4)
    assert spark.read.parquet(f"{out}/bars").count() == 1


def test_finished_batches_leave_no_stages(spark, tmp_path):
    source, layout = f"{tmp_path}/ticks", Layout(f"{tmp_path}/live", "intraday")
    write(spark, source, [("A", at(1), 5.0)])
    before = set(os.listdir(stage_root(spark))) if os.path.isdir(stage_root(spark)) else set()
    stream = live.live_bars(live.file_stream(spark, source, spark.read.parquet(source).schema), "code", "ts", "price")
    live.publish_stream(stream, layout, f"{tmp_path}/cp", mode="update")
    assert set(os.listdir(stage_root(spark)) if os.path.isdir(stage_root(spark)) else ()) == before


@pytest.fixture
def watch(spark):
    listener = live.StreamWatch()
    spark.streams.addListener(listener)
    yield listener
    spark.streams.removeListener(listener)


def test_every_tick_behind_the_watermark_is_counted(spark, tmp_path, watch):
    """Over more batches than a query remembers, each with late ticks of one bar and of several."""
    source, layout = f"{tmp_path}/ticks", Layout(f"{tmp_path}/live", "intraday")
    write(spark, source, [("A", at(6000), 5.0)])
    kind, late = spark.read.parquet(source).schema, 0
    frames = []
    for n in range(150):
        rows = [("A", at(6000 + n), 5.0)] + [("A", at(m), 6.0) for m in (1, 2, 40)[:n % 4]] * (n > 1)
        late += len(rows) - 1
        frames.append(pd.DataFrame(rows, columns=["code", "ts", "price"]))
    for n, frame in enumerate(frames):  # one file a batch, without a Spark job for each
        frame.assign(ts=frame.ts.astype("datetime64[us, UTC]")).to_parquet(f"{source}/more-{n:03}.parquet", index=False)
        os.utime(f"{source}/more-{n:03}.parquet", (2_000_000_000 + n, 2_000_000_000 + n))
    newest, partitions = {}, spark.conf.get("spark.sql.shuffle.partitions")
    query = (live.live_bars(live.file_stream(spark, source, kind, files_per_batch=1), "code", "ts", "price", "1 hour", count=True)
             .writeStream.outputMode("update").foreachBatch(lambda df, n: newest.update({(r.code, r.timestamp): r.ticks for r in df.collect()})))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        started = live.run_available(query, f"{tmp_path}/cp")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    watch.settle(started)
    assert watch.batches(started) >= 151 > len(started.recentProgress)
    arrived = watch.total(started, "arrived.ticks")
    assert arrived == 1 + sum(map(len, frames)) == watch.total(started, "input")
    write(spark, layout.bars, [(*key, n) for key, n in newest.items()], "code string, timestamp timestamp, ticks long")
    assert live.late_ticks(spark, layout, arrived) == late > watch.total(started)  # the state operator counts groups


def test_running_stream_publishes_on_its_clock(spark, tmp_path, watch):
    source, layout = f"{tmp_path}/ticks", Layout(f"{tmp_path}/live", "intraday")
    write(spark, source, [("A", at(1), 5.0), ("A", at(2), 4.0)])
    stream = live.live_bars(live.file_stream(spark, source, spark.read.parquet(source).schema), "code", "ts", "price", count=True)
    query = live.publish_stream(stream, layout, f"{tmp_path}/cp", mode="update", every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive and spark.read.parquet(layout.bars).first().ticks == 2
        write(spark, source, [("A", at(600), 9.0)])
        query.processAllAvailable()
        write(spark, source, [("A", at(3), 7.0), ("A", at(4), 7.0), ("A", at(601), 1.0)])  # two are late
    finally:
        live.drain(query)
    assert not query.isActive
    arrived = watch.settle(query).total(query, "arrived.ticks")
    assert arrived == 6 and live.late_ticks(spark, layout, arrived) == 2
    assert sorted((r.open, r.close, r.ticks) for r in spark.read.parquet(layout.bars).collect()) == [(5.0, 4.0, 2), (9.0, 1.0, 2)]


def in_order(rows, span):
    out = {}
    for code in sorted({c for c, _, _ in rows}):
        mine = pd.DataFrame(sorted((t, x) for c, t, x in rows if c == code), columns=["t", "x"])
        mine["x"] = mine.x.astype(float).ffill()
        mine["y"] = mine.x.ewm(span=span, adjust=False).mean()
        out |= {(code, t.to_pydatetime()): (x, y) for t, x, y in mine.itertuples(index=False)}
    return out


@pytest.mark.parametrize("seed", [0, 1])
def test_rows_out_of_order_within_the_lateness_are_put_in_order(spark, tmp_path, watch, seed):
    rng = np.random.default_rng(seed)
    source, out = f"{tmp_path}/bars", f"{tmp_path}/out"
    schema = "code string, timestamp timestamp, close double"
    rows = [(c, at(15 * i), None if rng.random() < 0.3 else float(rng.integers(1, 90))) for c in "AB" for i in range(40)]
    arrival = sorted(rows, key=lambda r: r[1] + dt.timedelta(minutes=int(rng.integers(0, 100))))  # at most 100 minutes late
    for lo in range(0, 80, 16):
        write(spark, source, arrival[lo:lo + 16] + arrival[lo:lo + 2], schema)  # and some twice
    end = [(c, at(10_000), 1.0) for c in "AB"]
    write(spark, source, end, schema)
    write(spark, source, [("A", at(15 * 7), 1000.0), ("A", at(15 * 8), 1000.0)], schema)  # behind the watermark
    stream = live.live_fill_and_mean_in_order(
        live.file_stream(spark, source, spark.read.parquet(source).schema, files_per_batch=1), "2 hours", 4)
    query = live.run_available(stream.writeStream.format("parquet"), f"{tmp_path}/cp", path=out)
    got = {(r.code, r.timestamp): (r.close, r.ema) for r in spark.read.parquet(out).collect()}
    want = in_order(rows, 4)
    assert set(got) == set(want) and not any(r.late for r in spark.read.parquet(out).collect())
    for key, (x, y) in want.items():
        assert got[key] == ((None, None) if pd.isna(x) else (x, pytest.approx(y)))
    assert watch.settle(query).total(query) == 2
    # a second run goes on from what still waits: the closing bars, and what comes after them
    write(spark, source, [("A", at(10_030), None), ("A", at(10_015), 3.0), ("A", at(20_000), 1.0)], schema)
    live.run_available(stream.writeStream.format("parquet"), f"{tmp_path}/cp", path=out)
    later = {(r.code, r.timestamp): r.close for r in spark.read.parquet(out).collect()}
    assert {k: v for k, v in later.items() if k not in got} == {
        ("A", at(10_000)): 1.0, ("B", at(10_000)): 1.0, ("A", at(10_015)): 3.0, ("A", at(10_030)): 3.0}


def test_order_does_not_depend_on_the_session_zone(spark, tmp_path):
    source, out, zone = f"{tmp_path}/bars", f"{tmp_path}/out", spark.conf.get("spark.sql.session.timeZone")
    schema = "code string, timestamp timestamp, close double"
    for rows in ([("A", at(30), None), ("A", at(0), 2.0)], [("A", at(15), 4.0), ("A", at(9_000), 1.0)]):
        write(spark, source, rows, schema)
    kind = spark.read.parquet(source).schema
    spark.conf.set("spark.sql.session.timeZone", "Asia/Ho_Chi_Minh")
    try:
        stream = live.live_fill_and_mean_in_order(live.file_stream(spark, source, kind, files_per_batch=1), "1 hour", 4)
        live.run_available(stream.writeStream.format("parquet"), f"{tmp_path}/cp", path=out)
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert sorted((r.timestamp, r.close) for r in spark.read.parquet(out).collect()) == [(at(0), 2.0), (at(15), 4.0), (at(30), 4.0)]
