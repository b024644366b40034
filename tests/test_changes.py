"""Refresh and publication under faults: the gold tables end up as after a full load, wherever a run stops."""

import datetime as dt
import os
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from barloom.plans import medallion
from barloom.plans.changes import ChangeLog
from barloom.plans.medallion import Layout
from barloom.sources import writers
from tests.series_data import SCHEMA

WRITES = ("write_parquet", "overwrite_partitions", "save_table", "create_empty")
#: days around three turns of the year, so that a fill crosses partitions
DAYS = [dt.date(y, m, d) for y, m, ds in ((2018, 12, (29, 30, 31)), (2019, 1, (1, 2, 3)), (2019, 12, (30, 31)), (2020, 1, (1, 2)), (2021, 1, (1, 2)))
        for d in ds]


class Crash(Exception):
    pass


class Faults:
    """Stops a run instead of its nth write, or in the middle of it."""

    def __init__(self, monkeypatch, root):
        self.left, self.half, self.seen = None, False, []
        for name in WRITES:
            monkeypatch.setattr(writers, name, self._counted(name, getattr(writers, name), str(root)))

    def _counted(self, name, write, root):
        def run(*args, **named):
            path = next((a for a in args if isinstance(a, str) and a.startswith(root)), None)
            if path and self.left is not None:
                self.seen.append(name)
                self.left -= 1
                if self.left == 0:
                    if self.half:  # a partition that is being replaced is gone, its new files are not there yet
                        parts = {f"part={r.part}" for r in args[0].select("part").distinct().collect()}
                        shutil.rmtree(f"{path}/{min(parts & set(os.listdir(path)))}")
                    raise Crash(name)
            return write(*args, **named)
        return run

    def run(self, after, half, work):
        """Whether the run reached its ``after``-th write and stopped there."""
        self.left, self.half, self.seen = after, half, []
        try:
            work()
            return False
        except Crash:
            return True
        finally:
            self.left = None


def report(spark, when):
    return spark.createDataFrame([("A", 1, DAYS[0], DAYS[-1], when)], "code string, nb int, min_date date, max_date date, updated timestamp")


def filled(raw):
    out, last = [], None
    for day in sorted(raw):
        last = last if raw[day] is None else raw[day]
        out.append((day, last))
    return out


@pytest.mark.parametrize("half, stops", [(False, range(1, 99)), (True, [3, 8])])
def test_gold_equals_a_full_load_after_a_crash_at_every_write(spark, tmp_path, monkeypatch, half, stops):
    """Instead of every write, and in the middle of the replacement of silver (3) and gold (8) partitions."""
    rng = np.random.default_rng(half)
    make = lambda rows: spark.createDataFrame([("A", d, c, c, c, c, 1.0) for d, c in rows.items()], SCHEMA)
    layout, gold, database = Layout(f"{tmp_path}/silver", "day"), f"{tmp_path}/gold", f"crash_test_{os.getpid()}_{int(half)}"
    codes = spark.createDataFrame([("A", "a")], "code string, type string")
    raw = {d: float(i) if i % 3 == 0 else None for i, d in enumerate(DAYS[:-2])}
    log, when, writes = medallion.change_log(spark, layout), dt.datetime(2024, 1, 1), []
    faults = Faults(monkeypatch, tmp_path)
    try:
        medallion.initial_load(make(raw), codes, report(spark, when), layout)
        medallion.publish(spark, layout, database, gold, codes)
        for after in stops:
            when += dt.timedelta(days=1)
            days = [DAYS[i] for i in rng.choice(len(DAYS), 2, replace=False)]
            batch = {d: float(100 * after + i) if rng.random() < 0.7 else None for i, d in enumerate(days)}
            raw |= batch

            def work():
                medallion.refresh(make(batch), codes, report(spark, when), layout)
                medallion.publish(spark, layout, database, gold, codes)

            stopped = faults.run(after, half, work)
            writes = faults.seen if len(faults.seen) > len(writes) else writes
            if stopped:
                if after % 2:  # a publication that comes before the repeat
                    medallion.publish(spark, layout, database, gold, codes)
                work()
            stored = sorted((r.date, r.close) for r in spark.read.table(f"{database}.day").collect())
            assert stored == filled(raw), f"stopped at write {after}: {faults.seen}"
            assert sorted((r.date, r.close) for r in spark.read.parquet(layout.bars).collect()) == filled(raw)
            assert spark.read.parquet(layout.tail).first().close == filled(raw)[-1][1]
            assert not log.open_batches()
            if not stopped:
                break
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")
    assert half or after - 1 == len(writes) == 9


def test_open_batch_is_finished_by_another_batch(spark, tmp_path, monkeypatch):
    make = lambda rows: spark.createDataFrame([("A", d, c, c, c, c, 1.0) for d, c in rows.items()], SCHEMA)
    layout = Layout(f"{tmp_path}/silver", "day")
    when = dt.datetime(2024, 1, 1)
    medallion.initial_load(make({DAYS[0]: 1.0}), None, report(spark, when), layout)
    faults = Faults(monkeypatch, tmp_path)
    first = make({DAYS[3]: 5.0})
    assert faults.run(4, False, lambda: medallion.refresh(first, None, report(spark, when + dt.timedelta(days=1)), layout))
    # the batch that was lost is never repeated; the next one starts after it and is filled from it
    assert medallion.refresh(make({DAYS[4]: None}), None, report(spark, when + dt.timedelta(days=2)), layout)
    assert sorted((r.date, r.close) for r in spark.read.parquet(layout.bars).collect()) == [(DAYS[0], 1.0), (DAYS[3], 5.0), (DAYS[4], 5.0)]
    parts = medallion.change_log(spark, layout).entries().where(F.col("updated") > F.lit(when + dt.timedelta(days=1)))
    assert {r.part for r in parts.collect()} == {2019}


def test_older_batch_does_not_pass_because_a_newer_one_is_open(spark, tmp_path, monkeypatch):
    make = lambda c: spark.createDataFrame([("A", DAYS[0], c, c, c, c, 1.0)], SCHEMA)
    layout, when = Layout(f"{tmp_path}/silver", "day"), dt.datetime(2024, 1, 5)
    medallion.initial_load(make(1.0), None, report(spark, when), layout)
    faults = Faults(monkeypatch, tmp_path)
    assert faults.run(7, False, lambda: medallion.refresh(make(2.0), None, report(spark, when + dt.timedelta(days=1)), layout))
    assert not medallion.refresh(make(3.0), None, report(spark, when - dt.timedelta(days=1)), layout)
    assert spark.read.parquet(layout.bars).first().close == 2.0
    assert medallion.refresh(make(2.0), None, report(spark, when + dt.timedelta(days=1)), layout)


def test_log_without_entries(spark, tmp_path):
    log = ChangeLog(spark, f"{tmp_path}/log", medallion.T.StructField("part", medallion.T.IntegerType()))
    assert log.open_batches() == [] and log.entries().count() == 0 and log.pending_since() is None
    assert not log.recover(f"{tmp_path}/table")
