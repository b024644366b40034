import datetime as dt
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.operators import clean
from barloom.plans import medallion
from barloom.plans.medallion import Layout
from barloom.sources import readers, writers
from barloom.session import stage
from tests.series_data import SCHEMA, bars, collected, frame, per_code, same


def report(spark, when):
    return spark.createDataFrame(
        [("A", 1, dt.date(2020, 1, 1), dt.date(2020, 1, 2), when)],
        "code string, nb int, min_date date, max_date date, updated timestamp")


EMPTY = "code string, nb int, min_date date, max_date date, updated timestamp"
T0, T1 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)


def test_gate(spark):
    old, new, none = report(spark, T0), report(spark, T1), spark.createDataFrame([], EMPTY)
    assert medallion.is_open(medallion.gate(new, old))
    assert not medallion.is_open(medallion.gate(old, old))
    assert medallion.is_open(medallion.gate(old, none))
    assert not medallion.is_open(medallion.gate(none, old))
    assert not medallion.is_open(medallion.gate(report(spark, None), old))
    mixed = old.unionByName(new)
    assert medallion.is_open(medallion.gate(mixed, old))
    assert not medallion.is_open(medallion.gate(mixed, old, mode="min"))


def test_empty_control_table_lets_rows_pass(spark):
    new = report(spark, T1)
    assert medallion.keep_newer(new, spark.createDataFrame([], EMPTY)).count() == 1
    assert medallion.keep_newer(new, report(spark, T0)).count() == 1
    assert medallion.keep_newer(new, new).count() == 0


def test_profile_and_dedupe(spark):
    df = spark.createDataFrame([
        ("A", dt.date(2020, 1, 1), 1.0, None, None, 1.0, 5.0), ("A", dt.date(2020, 1, 1), 1.0, None, None, 1.0, 5.0),
        ("A", dt.date(2020, 1, 1), None, None, None, 2.0, 5.0), ("B", dt.date(2020, 1, 1), 3.0, 1.0, 1.0, 1.0, 5.0),
    ], SCHEMA)
    assert clean.duplicate_count(df).first()[0] == 1
    assert clean.null_profile(df).first().high == 3 == clean.null_profile_sum(df).first().high
    none = df.limit(0)
    assert clean.null_profile(none).first().high == 0 and clean.null_profile_sum(none).first().high is None
    kept = {r.code: r for r in clean.dedupe(df).collect()}
    assert len(kept) == 2 and kept["A"].open == 1.0


def test_dedupe_keeps_the_latest_revision_whole(spark):
    day, at = dt.date(2020, 1, 1), dt.datetime(2024, 1, 1)
    rows = [("A", day, 9.0, 1.0, 1, at), ("A", day, 5.0, None, 2, at + dt.timedelta(microseconds=1)), ("B", day, 1.0, 2.0, None, None),
            ("B", day, 7.0, None, -5, at - dt.timedelta(days=30_000)), ("C", day, 1.0, None, 3, at), ("C", day, None, 2.0, 3, at),
            ("C", day, 1.0, None, 3, at)]
    df = spark.createDataFrame(rows * 50, "code string, date date, open double, close double, revision int, loaded timestamp").repartition(7)
    for revision in ("revision", "loaded"):
        out = clean.dedupe(df, revision=revision)
        got = {r.code: (r.open, r.close) for r in out.collect()}
        assert got["A"] == (5.0, None) and got["B"] == (7.0, None)  # a row without a revision is older than any other
        assert got["C"] in ((1.0, None), (None, 2.0)) and out.count() == 3  # of one revision, but from one row
        plan = out._jdf.queryExecution().toString()
        assert "SortAggregate" not in plan and "HashAggregate" in plan


def test_refresh_takes_the_later_file(spark, tmp_path):
    layout, day = Layout(f"{tmp_path}/t", "day"), dt.date(2020, 1, 1)
    row = lambda c, n: spark.createDataFrame([("A", day, c, c, c, c, 1.0, n)], f"{SCHEMA}, revision int")
    medallion.initial_load(row(9.0, 1).unionByName(row(5.0, 2)), None, report(spark, T0), layout, revision="revision")
    assert spark.read.parquet(layout.bars).first().close == 5.0
    medallion.refresh(row(3.0, 4).unionByName(row(8.0, 3)), None, report(spark, T1), layout, revision="revision")
    stored = spark.read.parquet(layout.bars)
    assert stored.first().close == 3.0 and "revision" not in stored.columns
    files = f"{tmp_path}/files"
    for n, c in enumerate((9.0, 5.0)):
        row(c, n).drop("revision").coalesce(1).write.parquet(f"{files}/{n}")
        for f in os.listdir(f"{files}/{n}"):
            os.utime(f"{files}/{n}/{f}", (1_700_000_000 + n, 1_700_000_000 + n))
    arrived = readers.with_arrival(spark.read.option("recursiveFileLookup", True).parquet(files))
    assert medallion.clean_bars(arrived, revision="arrived").first().close == 5.0


def test_enrich_keeps_unlisted_and_does_not_multiply(spark):
    df = frame(spark, bars())
    codes = spark.createDataFrame([("HOT", "x"), ("HOT", "a"), ("MID", "m")], "code string, type string")
    out = clean.enrich(df, codes)
    assert out.count() == df.count()
    assert {(r.code, r.type) for r in out.select("code", "type").distinct().collect()} == {
        ("HOT", "a"), ("MID", "m"), ("ONE", None)}


def rows_of(spark, layout):
    return sorted(map(tuple, spark.read.parquet(layout.bars).drop("part").collect()), key=str)


@pytest.mark.parametrize("cut", ["2015-06-01", "2016-03-01"])
def test_refresh_equals_full_load_and_replay_changes_nothing(spark, tmp_path, cut):
    pdf = bars()
    df = stage(frame(spark, pdf), "test")
    codes = spark.createDataFrame([("HOT", "h"), ("MID", "m")], "code string, type string")
    whole, parts = Layout(f"{tmp_path}/whole", "day"), Layout(f"{tmp_path}/parts", "day")
    medallion.initial_load(df, codes, report(spark, T0), whole)
    edge = F.lit(cut).cast("date")
    medallion.initial_load(df.filter(F.col("date") < edge), codes, report(spark, T0), parts)
    batch = df.filter(F.col("date") >= edge)
    assert medallion.refresh(batch, codes, report(spark, T1), parts)
    once = rows_of(spark, parts)
    assert once == rows_of(spark, whole)
    assert not medallion.refresh(batch, codes, report(spark, T1), parts)
    assert medallion.refresh(batch, codes, report(spark, T1 + dt.timedelta(days=1)), parts)
    assert rows_of(spark, parts) == once


def test_refresh_survives_lost_side_tables(spark, tmp_path):
    df = stage(frame(spark, bars()), "test")
    codes = spark.createDataFrame([("HOT", "h")], "code string, type string")
    whole, parts = Layout(f"{tmp_path}/whole", "day"), Layout(f"{tmp_path}/parts", "day")
    medallion.initial_load(df, codes, report(spark, T0), whole)
    edge = F.lit("2016-01-01").cast("date")
    medallion.initial_load(df.filter(F.col("date") < edge), codes, report(spark, T0), parts)
    shutil.rmtree(parts.report)
    for f in os.listdir(parts.tail):
        os.remove(f"{parts.tail}/{f}")
    assert medallion.refresh(df.filter(F.col("date") >= edge), codes, report(spark, T0), parts)
    assert rows_of(spark, parts) == rows_of(spark, whole)


def test_late_batch_is_seeded_from_before_it(spark):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    make = lambda rows: spark.createDataFrame([("A", day(n), c, c, c, c, 1.0) for n, c in rows], SCHEMA)
    silver = make([(0, 10.0), (1, 11.0), (9, 99.0)])
    out = medallion.clean_batch(make([(5, None), (6, 3.0)]), silver)
    assert [r.close for r in out.orderBy("date").collect()] == [11.0, 3.0]
    out = medallion.clean_batch(make([(12, None), (13, None)]), silver)
    assert [r.close for r in out.orderBy("date").collect()] == [99.0, 99.0]


def test_correction_is_filled_forward(spark, tmp_path):
    day = lambda n: dt.date(2020, 1, 1) + dt.timedelta(days=n)
    make = lambda rows: spark.createDataFrame([("A", day(n), c, c, c, c, 1.0) for n, c in rows], SCHEMA)
    layout = Layout(f"{tmp_path}/t", "day")
    medallion.initial_load(make([(1, 1.0), (2, None), (3, None), (4, 4.0)]), None, report(spark, T0), layout)
    assert medallion.refresh(make([(2, 9.0)]), None, report(spark, T1), layout)
    stored = spark.read.parquet(layout.bars).orderBy("date").collect()
    assert [r.close for r in stored] == [1.0, 9.0, 9.0, 4.0]
    assert [r.filled for r in stored] == [0, 0, 15, 0]
    assert medallion.refresh(make([(4, None)]), None, report(spark, T1 + dt.timedelta(days=1)), layout)
    assert [r.close for r in spark.read.parquet(layout.bars).orderBy("date").collect()] == [1.0, 9.0, 9.0, 9.0]
    assert spark.read.parquet(layout.tail).first().close == 9.0


@pytest.mark.parametrize("seed, fill", [(0, "forward"), (1, "forward"), (2, "forward"), (3, "lag"), (4, "lag")])
def test_any_order_of_batches_gives_the_full_load(spark, tmp_path, seed, fill):
    rng = np.random.default_rng(seed)
    pdf = bars(seed, sizes=(("HOT", 60), ("MID", 25), ("ONE", 1)))
    pdf.loc[rng.random(len(pdf)) < 0.3, ["open", "high", "low", "close"]] = np.nan
    whole, parts = Layout(f"{tmp_path}/whole", "day"), Layout(f"{tmp_path}/parts", "day")
    codes = spark.createDataFrame([("HOT", "h")], "code string, type string")
    medallion.initial_load(frame(spark, pdf), codes, report(spark, T0), whole, fill=fill)
    groups = rng.integers(0, 3, len(pdf))
    for n in range(3):
        part = frame(spark, pdf[groups == n])
        when = report(spark, T0 + dt.timedelta(days=n))
        if n:
            assert medallion.refresh(part, codes, when, parts, fill=fill)
        else:
            medallion.initial_load(part, codes, when, parts, fill=fill)
    assert rows_of(spark, parts) == rows_of(spark, whole)
    assert sorted(map(tuple, spark.read.parquet(parts.tail).collect()), key=str) == sorted(
        map(tuple, spark.read.parquet(whole.tail).select(*spark.read.parquet(parts.tail).columns).collect()), key=str)


def test_rows_without_a_key_are_set_aside(spark, tmp_path):
    layout = Layout(f"{tmp_path}/t", "day")
    rows = [("A", dt.date(2020, 1, 1), 1.0, 1.0, 1.0, 1.0, 1.0), (None, dt.date(2020, 1, 1), 2.0, 2.0, 2.0, 2.0, 2.0), ("A", None, 3.0, 3.0, 3.0, 3.0, 3.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    medallion.initial_load(df, None, report(spark, T0), layout)
    for _ in range(2):
        medallion.refresh(df, None, report(spark, T1), layout)
    kept = spark.read.parquet(layout.rejected)
    assert kept.groupBy("batch").count().count() == 2 and kept.count() == 4
    assert spark.read.parquet(layout.bars).count() == 1


def test_publish_writes_only_touched_partitions(spark, tmp_path):
    make = lambda rows: spark.createDataFrame([("A", dt.date(y, 1, n), c, c, c, c, 1.0) for y, n, c in rows], SCHEMA)
    layout, gold = Layout(f"{tmp_path}/silver", "day"), f"{tmp_path}/gold"
    database = f"gold_test_{os.getpid()}"
    codes = spark.createDataFrame([("A", "a")], "code string, type string")
    files = lambda: {f for d, _, names in os.walk(f"{gold}/day") for f in (f"{d}/{n}" for n in names) if "part=2019" in f}
    try:
        medallion.initial_load(make([(2019, 1, 1.0), (2020, 1, 2.0)]), codes, report(spark, T0), layout)
        assert medallion.publish(spark, layout, database, gold, codes)
        before = files()
        assert not medallion.publish(spark, layout, database, gold, codes)
        medallion.refresh(make([(2020, 2, 5.0), (2021, 1, 6.0)]), codes, report(spark, T1), layout)
        assert medallion.publish(spark, layout, database, gold, codes)
        assert files() == before and before
        got = sorted((r.date.year, r.close) for r in spark.read.table(f"{database}.day").collect())
        assert got == [(2019, 1.0), (2020, 2.0), (2020, 5.0), (2021, 6.0)]
        assert spark.read.table(f"{database}.report_day").first().updated == T1
        assert spark.read.table(f"{database}.codes").count() == 1
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def test_upsert_touches_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    make = lambda rows: spark.createDataFrame(rows, "code string, date date, close double, part int")
    d = dt.date
    writers.upsert(make([("A", d(2019, 1, 1), 1.0, 2019), ("A", d(2020, 1, 1), 2.0, 2020)]), path)

    def files_2019():
        rows = readers.rows_per_file(spark.read.parquet(path).filter("part = 2019"))
        return {r.file for r in rows.collect()}

    files = files_2019()
    for _ in range(2):
        writers.upsert(make([("A", d(2020, 1, 1), 5.0, 2020), ("B", d(2020, 1, 1), 7.0, 2020)]), path)
    assert files_2019() == files
    got = sorted((r.code, r.date.year, r.close) for r in spark.read.parquet(path).collect())
    assert got == [("A", 2019, 1.0), ("A", 2020, 5.0), ("B", 2020, 7.0)]


def test_lag_fill_and_forward_fill_transforms(spark):
    pdf = bars()
    out = collected(medallion.clean_bars(frame(spark, pdf)))
    same(out.close, per_code(pdf, lambda g: g.close.ffill()))
    out = collected(medallion.clean_bars(frame(spark, pdf), fill="lag"))
    same(out.close, per_code(pdf, lambda g: g.close.fillna(g.close.shift())))


def test_symbol_file_is_normalised(spark, tmp_path):
    path = f"{tmp_path}/s.csv"
    with open(path, "w") as f:
        f.write("Date,Symbol,Open,High,Low,Close,Volume,Dividends,Stock Splits\n"
                "2023-07-31 00:00:00+07:00,GAS.VN,1,2,0.5,1.5,10,0,0\n"
                "not a date,GAS.VN,1,2,0.5,1.5,10,0,0\n"
                "2023-08-01 00:00:00+00:00,BTC-USD,1,x,0.5,1.1,10,0,0\n")
    utc = readers.read_symbols(spark, path)
    assert utc.columns == ["date", "code", "open", "high", "low", "close", "volume"]
    got = {r.code: r for r in utc.collect()}
    assert len(got) == 2
    assert got["GAS.VN"].date == dt.date(2023, 7, 30)
    assert got["BTC-USD"].high is None and got["BTC-USD"].close == 1.1
    local = {r.code: r.date for r in readers.read_symbols(spark, path, "Asia/Ho_Chi_Minh").collect()}
    assert local["GAS.VN"] == dt.date(2023, 7, 31)


def test_drop_table_keeps_external_files_unless_asked(spark, tmp_path):
    df = spark.createDataFrame([(1,)], "a int")
    for delete in (False, True):
        path = f"{tmp_path}/t{delete}"
        writers.save_table(df, f"drop_me_{delete}", path)
        writers.drop_table(spark, f"drop_me_{delete}", delete_data=delete)
        assert not spark.catalog.tableExists(f"drop_me_{delete}")
        assert writers.path_exists(spark, path) is not delete
    writers.drop_table(spark, "never_there", delete_data=True)
