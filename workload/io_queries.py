"""Registered queries for sources, sinks, refresh, streaming and model training."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom import schemas
from barloom.functions.scalar import iso_date, safe_key
from barloom.operators import clean, features, forecast, joint
from barloom.operators.series import INTRADAY
from barloom.plans import inference, medallion, reports, training
from barloom.session import scratch_path, stage
from barloom.sources import readers, writers
from barloom.streaming import live
from workload.oracles import CTES, KEYS, P4, rnd, sig
from workload.queries import OHLCV, REPORT_SQL, query
from workload.tables import (
    PRICES, bars_day, bars_intraday, code_list, dirty_day, outcomes, staged_day, staged_intraday, table,
)

DAY_COLUMNS = ["code", "date", *PRICES, "volume"]


def _day_file(spark: SparkSession, d: str) -> DataFrame:
    return bars_day(spark, d).withColumn("adj_close", F.col("close")).select(schemas.BARS_DAY.names)


# --- sources ----------------------------------------------------------------------------------


@query("csv_declared_schema", f"""
    SELECT {KEYS}, {P4}, CASE WHEN day % 13 <> 0 THEN volume END AS volume FROM numbered_day""")
def _(spark, d):
    path = scratch_path(spark, "csv")
    broken = F.when(F.unix_date("date") % 13 == 0, "n/a").otherwise(F.col("volume").cast("string"))
    writers.write_csv(_day_file(spark, d).withColumn("volume", broken), path)
    return readers.read_csv(spark, path, schemas.BARS_DAY).drop("adj_close")


@query("csv_all_text", "SELECT code, type FROM code_list")
def _(spark, d):
    path = scratch_path(spark, "codes")
    writers.write_csv(code_list(spark, d), path)
    return readers.read_csv_text(spark, path)


@query("csv_inferred_schema", f"SELECT {KEYS}, {OHLCV} FROM bars_day")
def _(spark, d):
    path = scratch_path(spark, "csv")
    writers.write_csv(bars_day(spark, d), path)
    return readers.read_csv_inferred(spark, path)


def _reports(spark, d):
    day = clean.refresh_report(bars_day(spark, d), F.col("date").cast("timestamp"))
    intraday = clean.refresh_report(bars_intraday(spark, d), F.col("timestamp").cast("timestamp"), "timestamp")
    return day, intraday


DAY_REPORT = REPORT_SQL.format(t="date", u="CAST(CAST(max(date) AS TIMESTAMP) AS VARCHAR)")
INTRADAY_REPORT = REPORT_SQL.format(t="timestamp", u="CAST(max(timestamp) AS VARCHAR)")


@query("reports_from_files", DAY_REPORT + ", 'day' AS kind FROM bars_day GROUP BY code UNION ALL "
       + INTRADAY_REPORT + ", 'intraday' AS kind FROM bars_intraday GROUP BY code")
def _(spark, d):
    paths = [scratch_path(spark, "report") for _ in range(2)]
    for report, path in zip(_reports(spark, d), paths):
        writers.write_csv(report, path)
    return readers.read_reports(spark, *paths)


@query("csv_directory", f"SELECT {KEYS}, {OHLCV} FROM bars_day")
def _(spark, d):
    path = scratch_path(spark, "parts")
    writers.write_csv(_day_file(spark, d).repartition(5, "code", "date"), path)
    return readers.read_csv(spark, path, schemas.BARS_DAY).drop("adj_close")


@query("table_by_path", f"SELECT {KEYS}, {OHLCV} FROM bars_day")
def _(spark, d):
    path = scratch_path(spark, "table")
    writers.write_parquet(bars_day(spark, d), path)
    return readers.read_table(spark, path)


@query("symbols_file", f"SELECT {KEYS}, {OHLCV} FROM numbered_day WHERE day % 19 <> 0")
def _(spark, d):
    path = scratch_path(spark, "symbols")
    stamp = F.concat(F.date_format("date", "yyyy-MM-dd"), F.lit(" 00:00:00+00:00"))
    raw = bars_day(spark, d).select(
        F.when(F.unix_date("date") % 19 == 0, "bad date").otherwise(stamp).alias("Date"),
        *[F.col(c).alias(c.title()) for c in [*PRICES, "volume"]], F.lit(0.0).alias("Dividends"),
        F.lit(0.0).alias("Stock Splits"), F.col("code").alias("Symbol"))
    writers.write_csv(raw, path)
    return readers.read_symbols(spark, path).select(DAY_COLUMNS)


@query("rows_per_input_file", "SELECT count(*) AS files, CAST(sum(n) AS BIGINT) AS n_rows FROM (SELECT code, count(*) AS n FROM bars_day GROUP BY code)")
def _(spark, d):
    path = scratch_path(spark, "byfile")
    writers.write_parquet(bars_day(spark, d).repartition("code"), path, ["code"])
    return readers.rows_per_file(spark.read.parquet(path)).agg(
        F.count(F.lit(1)).alias("files"), F.sum("n_rows").alias("n_rows"))


# --- sinks and catalog -------------------------------------------------------------------------


@query("csv_single_file", "SELECT code, type, CAST(1 AS BIGINT) AS files FROM code_list")
def _(spark, d):
    path = scratch_path(spark, "export")
    writers.write_csv(code_list(spark, d), path, single_file=True)
    out = readers.read_csv(spark, path, schemas.CODE_LIST)
    return out.withColumn("files", F.lit(len(readers.input_listing(out))))


@query("csv_overwrite", f"SELECT {KEYS}, {OHLCV} FROM bars_day")
def _(spark, d):
    path = scratch_path(spark, "twice")
    writers.write_csv(_day_file(spark, d).withColumn("volume", F.lit(0.0)), path)
    writers.write_csv(_day_file(spark, d), path)
    return readers.read_csv(spark, path, schemas.BARS_DAY).drop("adj_close")


def _database(spark: SparkSession) -> str:
    """A fresh database in the scratch folder, so runs never meet each other's tables."""
    name = f"gold_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}` LOCATION '{scratch_path(spark, name)}'")
    writers.create_database(spark, name)
    return name


@query("table_overwrite", f"SELECT {KEYS}, {OHLCV} FROM bars_day")
def _(spark, d):
    name = f"{_database(spark)}.day"
    writers.save_table(dirty_day(spark, d), name, scratch_path(spark, "day"))
    writers.drop_table(spark, name, delete_data=True)
    writers.save_table(bars_day(spark, d), name, scratch_path(spark, "day"))
    return readers.read_table(spark, name)


@query("table_append", f"SELECT {KEYS}, close FROM bars_day UNION ALL SELECT {KEYS}, close FROM bars_day")
def _(spark, d):
    name, bars = f"{_database(spark)}.day", staged_day(spark, d)
    writers.save_table(bars, name)
    writers.save_table(bars, name, mode="append")
    return readers.read_table(spark, name).select("code", "date", "close")


CTES["event_report"] = """
    SELECT event_type AS code, count(*) AS nb, CAST(min(ts) AS DATE)::VARCHAR AS min_date,
      CAST(max(ts) AS DATE)::VARCHAR AS max_date, max(ts) AS newest FROM events GROUP BY 1"""
NEWER = """SELECT code, nb, min_date, max_date, strftime(newest, '%Y-%m-%d %H:%M:%S') AS updated FROM event_report
    WHERE newest > (SELECT min(newest) FROM event_report)"""


def _event_report(spark, d):
    """Control table over the raw events, whose newest times differ by code."""
    ticks = table(spark, d, "events").select(F.col("event_type").alias("code"), F.col("ts").alias("timestamp"))
    return clean.refresh_report(ticks, F.col("timestamp"), "timestamp")


@query("control_table_replace", NEWER)
def _(spark, d):
    report = stage(_event_report(spark, d), "report")
    published = report.filter(F.col("updated") == report.agg(F.min("updated")).scalar())
    name = f"{_database(spark)}.report_intraday"
    writers.save_table(published, name)
    newer = stage(medallion.keep_newer(report, readers.read_table(spark, name)), "newer")
    writers.save_table(newer, name)
    return readers.read_table(spark, name)


@query("result_file", f"""
    SELECT {KEYS}, replace(code, '^', '') AS safe, {rnd('next_price', 'actual', 4)}, {rnd('price', 'predicted', 4)} FROM outcomes""", 4)
def _(spark, d):
    rows = outcomes(staged_day(spark, d)).select(
        "code", iso_date("date").alias("date"), safe_key("code").alias("safe"),
        (F.col("next_price") * (1.0 + 1e-11)).alias("actual"), (F.col("price") * (1.0 + 1e-11)).alias("predicted"))
    path = scratch_path(spark, "results")
    writers.write_report(rows, path)
    schema = "code string, date string, safe string, actual double, predicted double"
    return spark.read.schema(schema).option("header", True).csv(path)


# --- refresh ----------------------------------------------------------------------------------


@query("silver_gate", """
    SELECT (SELECT max(date) FROM bars_day) > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders) AS run""")
def _(spark, d):
    bronze = clean.refresh_report(bars_day(spark, d), F.col("date"))
    silver = table(spark, d, "orders").select(F.to_date("o_orderdate").alias("updated"))
    return medallion.gate(bronze, silver)


@query("gold_gate", NEWER)
def _(spark, d):
    report = _event_report(spark, d)
    return medallion.keep_newer(report, medallion.newest(report, "min"))



def _halves(spark, d):
    """An old part and a later batch that overlaps it by a month."""
    rows = stage(clean.dedupe(dirty_day(spark, d)), "clean")
    old = rows.filter(F.col("date") < F.lit("1999-06-15").cast("date"))
    new = rows.filter(F.col("date") >= F.lit("1999-05-15").cast("date"))
    return old, new


@query("keyed_upsert", f"SELECT {KEYS}, {OHLCV} FROM clean_day")
def _(spark, d):
    old, new = _halves(spark, d)
    path = scratch_path(spark, "upsert")
    for batch in (old, new, new):
        writers.upsert(stage(batch.withColumn("part", F.year("date")), "batch"), path)
    return spark.read.parquet(path).drop("part")


@query("batch_clean_with_history", f"SELECT {KEYS}, {OHLCV} FROM filled_day WHERE date >= DATE '1999-05-15'")
def _(spark, d):
    old, new = _halves(spark, d)
    return medallion.clean_batch(new, medallion.clean_bars(old)).select(DAY_COLUMNS)


@query("initial_load", f"""
    SELECT f.code, CAST(f.date AS VARCHAR) AS date, {OHLCV}, type, CAST(year(f.date) AS BIGINT) AS part
    FROM filled_day f LEFT JOIN code_type USING (code)""")
def _(spark, d):
    layout = medallion.Layout(scratch_path(spark, "silver"), "day")
    bars = stage(dirty_day(spark, d), "bronze")
    medallion.initial_load(
        bars, code_list(spark, d), clean.refresh_report(bars, F.col("date").cast("timestamp")), layout)
    return spark.read.parquet(layout.bars).drop(medallion.FILLED)


SILVER_DAY = f"SELECT f.code, CAST(f.date AS VARCHAR) AS date, {OHLCV}, type FROM filled_day f LEFT JOIN code_type USING (code)"


def _report(bars: DataFrame, later: int = 0) -> DataFrame:
    """Control table of a daily batch that was refreshed ``later`` days after its newest bar."""
    return clean.refresh_report(bars, F.date_add("date", later).cast("timestamp"))


@query("incremental_refresh", SILVER_DAY)
def _(spark, d):
    old, new = _halves(spark, d)
    codes = stage(code_list(spark, d), "codes")
    layout = medallion.Layout(scratch_path(spark, "silver"), "day")
    medallion.initial_load(old, codes, _report(old), layout)
    for _ in range(2):  # the second call finds the gate shut
        medallion.refresh(new, codes, _report(new), layout)
    database = _database(spark)
    medallion.publish(spark, layout, database, scratch_path(spark, "gold"))
    return readers.read_table(spark, f"{database}.day").drop("part")


@query("refresh_with_correction", SILVER_DAY)
def _(spark, d):
    """Old days arrive without prices first; the batch that corrects them reaches back before filled runs."""
    rows = stage(clean.dedupe(dirty_day(spark, d)), "clean")
    codes = stage(code_list(spark, d), "codes")
    missing = F.unix_date("date") % 5 == 0
    first = rows.withColumns({c: F.when(~missing, F.col(c)) for c in PRICES})
    layout = medallion.Layout(scratch_path(spark, "silver"), "day")
    medallion.initial_load(first, codes, _report(first), layout)
    medallion.refresh(rows.filter(missing), codes, _report(rows, 1), layout)
    return spark.read.parquet(layout.bars).drop("part", medallion.FILLED)


@query("gold_incremental", SILVER_DAY)
def _(spark, d):
    """Three publishes: all, only what a batch touched, and one that finds the gate shut."""
    old, new = _halves(spark, d)
    codes = stage(code_list(spark, d), "codes")
    layout, database, path = medallion.Layout(scratch_path(spark, "silver"), "day"), _database(spark), scratch_path(spark, "gold")
    medallion.initial_load(old, codes, _report(old), layout)
    medallion.publish(spark, layout, database, path, codes)
    medallion.refresh(new, codes, _report(new), layout)
    for _ in range(2):
        medallion.publish(spark, layout, database, path, codes)
    return readers.read_table(spark, f"{database}.day").drop("part")


class Crash(Exception):
    """Stands for a lost driver."""


@contextmanager
def crash_instead_of(module, name: str) -> Iterator[None]:
    """Stop at the first call of a function, as if the driver were lost there."""
    original = getattr(module, name)

    def lost(*_args, **_named):
        raise Crash(name)

    setattr(module, name, lost)
    try:
        yield
    except Crash:
        pass
    finally:
        setattr(module, name, original)


@query("gold_after_crash", SILVER_DAY)
def _(spark, d):
    """A correction that refills later years is lost between the bars and the control table, then repeated."""
    rows = stage(clean.dedupe(dirty_day(spark, d)), "clean")
    codes = stage(code_list(spark, d), "codes")
    missing = F.unix_date("date") % 5 == 0
    first = rows.withColumns({c: F.when(~missing, F.col(c)) for c in PRICES})
    layout, database, path = medallion.Layout(scratch_path(spark, "silver"), "day"), _database(spark), scratch_path(spark, "gold")
    medallion.initial_load(first, codes, _report(first), layout)
    medallion.publish(spark, layout, database, path, codes)
    batch, report = rows.filter(missing), stage(_report(rows, 1), "report")
    with crash_instead_of(medallion, "_set_aside"):
        medallion.refresh(batch, codes, report, layout)
    medallion.refresh(batch, codes, report, layout)
    with crash_instead_of(writers, "save_table"):
        medallion.publish(spark, layout, database, path, codes)
    medallion.publish(spark, layout, database, path, codes)
    return readers.read_table(spark, f"{database}.day").drop("part")


CTES["dirty_intraday"] = """
    SELECT code, timestamp, CASE WHEN minute(timestamp) <> 30 THEN open END AS open,
      CASE WHEN minute(timestamp) <> 30 THEN high END AS high, CASE WHEN minute(timestamp) <> 30 THEN low END AS low,
      CASE WHEN minute(timestamp) NOT IN (15, 30) THEN close END AS close, volume FROM bars_intraday"""
CTES["filled_intraday"] = f"""
    SELECT code, timestamp, {', '.join(f'last_value({c} IGNORE NULLS) OVER w AS {c}' for c in PRICES)}, volume
    FROM dirty_intraday WINDOW w AS (PARTITION BY code ORDER BY timestamp)"""
SILVER_INTRADAY = f"SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, {OHLCV} FROM filled_intraday"


def _dirty_intraday(spark: SparkSession, d: str) -> DataFrame:
    minute = F.minute("timestamp")
    bars = staged_intraday(spark, d).withColumns({c: F.when(minute != 30, F.col(c)) for c in PRICES})
    return stage(bars.withColumn("close", F.when(minute != 15, F.col("close"))), "dirty-intraday")


def _intraday_report(bars: DataFrame, later: int = 0) -> DataFrame:
    return clean.refresh_report(bars, F.col("timestamp") + F.make_dt_interval(F.lit(later)), "timestamp")


@query("initial_load_intraday", SILVER_INTRADAY)
def _(spark, d):
    bars = _dirty_intraday(spark, d)
    codes = bars.select("code").distinct().withColumn("type", F.lit("event"))
    layout = medallion.Layout(scratch_path(spark, "silver"), "intraday")
    medallion.initial_load(bars, codes, _intraday_report(bars), layout, INTRADAY)
    return spark.read.parquet(layout.bars).drop("part", "type", medallion.FILLED)


@query("incremental_refresh_intraday", SILVER_INTRADAY)
def _(spark, d):
    """Every third day arrives late, in two batches, the older days last."""
    bars = _dirty_intraday(spark, d)
    codes = stage(bars.select("code").distinct().withColumn("type", F.lit("event")), "codes")
    late, half = F.dayofmonth("timestamp") % 3 == 0, F.dayofmonth("timestamp") > 15
    layout = medallion.Layout(scratch_path(spark, "silver"), "intraday")
    medallion.initial_load(bars.filter(~late), codes, _intraday_report(bars), layout, INTRADAY)
    for n, part in enumerate((late & half, late & ~half)):
        medallion.refresh(bars.filter(part), codes, _intraday_report(bars, n + 1), layout, INTRADAY)
    return spark.read.parquet(layout.bars).drop("part", "type", medallion.FILLED)


# --- streaming --------------------------------------------------------------------------------


@query("streaming_bars", f"SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, {OHLCV} FROM bars_intraday")
def _(spark, d):
    source, root = scratch_path(spark, "ticks"), scratch_path(spark, "live")
    ticks = table(spark, d, "events")
    ticks.repartitionByRange(3, "ts").write.parquet(source)
    stream = live.file_stream(spark, source, ticks.schema, files_per_batch=1)
    layout = medallion.Layout(root, "intraday")
    live.publish_stream(
        live.live_bars(stream, "event_type", "ts", "value", "60 days"), layout, f"{root}/checkpoint", mode="update")
    return spark.read.parquet(layout.bars).drop("part")


@query("streaming_dedupe", f"SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, {OHLCV} FROM bars_intraday")
def _(spark, d):
    source, out = scratch_path(spark, "bars"), scratch_path(spark, "once")
    bars = staged_intraday(spark, d)
    for _ in range(2):
        bars.write.mode("append").parquet(source)
    stream = live.live_dedupe(live.file_stream(spark, source, bars.schema), "60 days")
    live.run_available(stream.writeStream.format("parquet"), f"{out}-checkpoint", path=out)
    return spark.read.parquet(out)


CTES["holed_bars"] = """
    SELECT code, timestamp, row_number() OVER (PARTITION BY code ORDER BY timestamp) AS rn,
      CASE WHEN minute(timestamp) <> 30 THEN close END AS raw FROM bars_intraday"""
CTES["closed_bars"] = """
    SELECT *, last_value(raw IGNORE NULLS) OVER (PARTITION BY code ORDER BY timestamp) AS close FROM holed_bars"""
CTES["live_mean"] = """
    WITH RECURSIVE e AS (SELECT code, rn, close AS y FROM closed_bars WHERE rn = 1 UNION ALL
      SELECT r.code, r.rn, CASE WHEN e.y IS NULL THEN r.close
        ELSE r.close * (2.0::DOUBLE / 11) + e.y * (1.0::DOUBLE - 2.0::DOUBLE / 11) END
      FROM e JOIN closed_bars r ON r.code = e.code AND r.rn = e.rn + 1) SELECT * FROM e"""


def _with_rocksdb(spark: SparkSession, run) -> None:
    """Run a stream whose operator needs the RocksDB state store."""
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider, None)
    spark.conf.set(provider, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        run()
    finally:
        spark.conf.set(provider, before) if before else spark.conf.unset(provider)


def _stateful(spark: SparkSession, source: str, schema, out: str) -> None:
    stream = live.live_fill_and_mean(live.file_stream(spark, source, schema), 10)
    _with_rocksdb(spark, lambda: live.run_available(stream.writeStream.format("parquet"), f"{out}-checkpoint", path=out))


def _blockwise(spark: SparkSession, source: str, schema, out: str) -> None:
    live.publish_filled(live.file_stream(spark, source, schema), out, f"{out}-checkpoint")


def _arrive(parts, source: str, *steps) -> None:
    """Write the parts one after the other, each followed by a run of every stream."""
    for part in parts:
        part.write.mode("append").parquet(source)
        for step in steps:
            step()


def _holed(spark: SparkSession, d: str) -> DataFrame:
    return staged_intraday(spark, d).withColumn("close", F.when(F.minute("timestamp") != 30, F.col("close")))


@query("streaming_fill_and_mean", f"""
    SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, close, {sig('y', 'ema')}, false AS late
    FROM closed_bars JOIN live_mean USING (code, rn)""", sigs=("ema",))
def _(spark, d):
    source, out, bars = scratch_path(spark, "bars"), scratch_path(spark, "filled"), _holed(spark, d)
    day = F.dayofmonth("timestamp")
    first, second = day < 11, (day >= 11) & (day < 21)  # three arrivals, in time order within the month of the events
    _arrive((bars.filter(first), bars.filter(second), bars.filter(~first & ~second)), source,
            lambda: _stateful(spark, source, bars.schema, out))
    return spark.read.parquet(out)


@query("streaming_fill_and_mean_blocks", f"""
    SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, close, {sig('y', 'ema')}
    FROM closed_bars JOIN live_mean USING (code, rn)""", sigs=("ema",))
def _(spark, d):
    source, out, bars = scratch_path(spark, "bars"), scratch_path(spark, "filled"), _holed(spark, d)
    first = F.dayofmonth("timestamp") < 16
    _arrive((bars.filter(first), bars.filter(~first)), source, lambda: _blockwise(spark, source, bars.schema, out))
    return spark.read.parquet(f"{out}/bars").drop("part")


@query("streaming_out_of_order", f"""
    SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, close, {sig('y', 'ema')}, false AS late
    FROM closed_bars JOIN live_mean USING (code, rn)""", sigs=("ema",))
def _(spark, d):
    """Every bar arrives up to two days late, in four arrivals; the result is that of the bars in order of time. A last row of
    another code moves the watermark past them all."""
    source, out, bars = scratch_path(spark, "bars"), scratch_path(spark, "ordered"), _holed(spark, d)
    arrival = F.dayofyear("timestamp") + F.pmod(F.xxhash64("code", "timestamp"), F.lit(3))
    first, last = stage(bars.agg(F.min(F.dayofyear("timestamp")), F.max(F.dayofyear("timestamp"))), "days").first()
    edges = [first + (last + 3 - first) * i // 4 for i in range(5)]
    end = bars.agg(F.max("timestamp").alias("timestamp")).select(*[
        F.lit("end").alias(c) if c == "code" else (F.col(c) + F.expr("INTERVAL 10 DAYS")).alias(c) if c == "timestamp"
        else F.lit(None).cast(bars.schema[c].dataType).alias(c) for c in bars.columns])
    parts = [bars.filter((arrival >= lo) & (arrival < hi)).orderBy(F.rand(5)) for lo, hi in zip(edges, edges[1:])]
    parts[0].write.mode("append").parquet(source)  # the stream needs its folder to start
    stream = live.live_fill_and_mean_in_order(live.file_stream(spark, source, bars.schema), "3 days", 10)
    run = lambda: _with_rocksdb(spark, lambda: live.run_available(stream.writeStream.format("parquet"), f"{out}-checkpoint", path=out))
    run()
    _arrive((*parts[1:], end), source, run)
    return spark.read.parquet(out)


CTES["timely_bars"] = """
    SELECT code, timestamp, raw, row_number() OVER (PARTITION BY code ORDER BY timestamp) AS rn FROM holed_bars
    WHERE NOT (day(timestamp) < 16 AND minute(timestamp) = 45)"""
CTES["timely_closed"] = """
    SELECT *, last_value(raw IGNORE NULLS) OVER (PARTITION BY code ORDER BY timestamp) AS close FROM timely_bars"""
CTES["timely_mean"] = """
    WITH RECURSIVE e AS (SELECT code, rn, close AS y FROM timely_closed WHERE rn = 1 UNION ALL
      SELECT r.code, r.rn, CASE WHEN e.y IS NULL THEN r.close
        ELSE r.close * (2.0::DOUBLE / 11) + e.y * (1.0::DOUBLE - 2.0::DOUBLE / 11) END
      FROM e JOIN timely_closed r ON r.code = e.code AND r.rn = e.rn + 1) SELECT * FROM e"""


@query("streaming_late_rows", f"""
    SELECT form, code, CAST(timestamp AS VARCHAR) AS timestamp, close, ema, late FROM (
      SELECT code, timestamp, close, {sig('y', 'ema')}, false AS late FROM timely_closed JOIN timely_mean USING (code, rn)
      UNION ALL SELECT code, timestamp, raw, NULL, true FROM holed_bars
        WHERE day(timestamp) < 16 AND minute(timestamp) IN (0, 45)), (SELECT unnest(['blocks', 'state']) AS form)""", sigs=("ema",))
def _(spark, d):
    """The last arrival holds bars that belong before the second and a replay of bars of the first."""
    source, bars = scratch_path(spark, "bars"), _holed(spark, d)
    state, blocks = scratch_path(spark, "state"), scratch_path(spark, "blocks")
    first, minute = F.dayofmonth("timestamp") < 16, F.minute("timestamp")
    _arrive((bars.filter(first & (minute != 45)), bars.filter(~first), bars.filter(first & minute.isin(0, 45))), source,
            lambda: _stateful(spark, source, bars.schema, state), lambda: _blockwise(spark, source, bars.schema, blocks))
    columns = ["code", "timestamp", "close", "ema", "late"]
    on_time = spark.read.parquet(f"{blocks}/bars").withColumn("late", F.lit(False)).select(columns)
    late = live.late_rows(spark, blocks).withColumns({"ema": F.lit(None).cast("double"), "late": F.lit(True)}).select(columns)
    by_state = spark.read.parquet(state).withColumn("timestamp", F.col("timestamp").cast(bars.schema["timestamp"].dataType)).select(columns)
    return on_time.unionByName(late).withColumn("form", F.lit("blocks")).unionByName(by_state.withColumn("form", F.lit("state")))


# --- models -----------------------------------------------------------------------------------


def _run(spark, d):
    return training.train(staged_day(spark, d), (forecast.Candidate(0.01), forecast.Candidate(1.0)))


@query("model_training", f"""
    SELECT code, count(*) AS n_test, {sig('avg(close * (1 + target_pct_change))', 'mean_actual')}, {sig('sqrt(avg(power(close * target_pct_change, 2)))', 'rmse_base')},
      true AS in_band, true AS scores_valid
    FROM windows WHERE split = 'test' GROUP BY code""", sigs=("mean_actual", "rmse_base"))
def _(spark, d):
    """What of the result files does not depend on the solver: rows, truth, baseline, and that scores are sound."""
    run = _run(spark, d)
    path = scratch_path(spark, "results")
    reports.write_results(run, path)
    names = ["all_regression_metrics", "all_classification_metrics", "all_strategy_performance", "all_model_comparison"]
    scores = None
    for n in names:
        table_ = readers.read_csv_inferred(spark, f"{path}/{n}").drop("STT")
        table_ = table_.drop("rmse") if n == "all_model_comparison" else table_
        scores = table_ if scores is None else scores.join(table_, "code")
    rows = run.predictions.groupBy("code").agg(
        F.count(F.lit(1)).alias("n_test"), F.avg("actual_price").alias("mean_actual"),
        F.sqrt(F.avg(F.pow(F.col("actual_price") - F.col("close"), 2))).alias("rmse_base"),
        F.bool_and(F.col("predicted_price").between(F.col("lower_price"), F.col("upper_price"))).alias("in_band"))
    sound = ((F.col("rmse") > 0) & (F.col("mae") <= F.col("rmse")) & F.col("accuracy").between(0, 1) & F.col("mcc").between(-1, 1)
             & (F.col("model_num_trades") >= 0) & (F.abs(F.col("s.rmse_base") - F.col("r.rmse_base")) < 0.01))
    return rows.alias("r").join(scores.alias("s"), "code").select(
        "code", "n_test", "mean_actual", F.col("r.rmse_base").alias("rmse_base"), "in_band", sound.alias("scores_valid"))


@query("joint_training", """
    SELECT code, count(*) AS n_test, true AS falls, true AS not_above_separate, true AS best_kept, true AS scores_valid
    FROM windows WHERE split = 'test' GROUP BY code""")
def _(spark, d):
    """One model of change and trend: its train loss falls at every step, the step of the lowest validation loss is kept, and
    that loss is not above the separate models' it started from."""
    run = training.train(staged_day(spark, d), (forecast.Candidate(0.01), forecast.Candidate(1.0)), rank=3, steps=12, patience=4)
    curve = joint.learning_curve(spark, run.joint).toPandas()
    falls = bool((curve.train_loss.diff().dropna() <= 1e-3).all()) and len(curve) > 2
    kept = curve.loc[curve.kept, "validation_loss"].item()
    sound = run.classification.select("code", (F.col("accuracy").between(0, 1) & F.col("mcc").between(-1, 1)).alias("scores_valid"))
    return run.predictions.groupBy("code").agg(F.count(F.lit(1)).alias("n_test")).join(sound, "code").select(
        "code", "n_test", F.lit(falls).alias("falls"), F.lit(bool(kept <= min(run.losses) + 1e-9)).alias("not_above_separate"),
        F.lit(bool(kept <= curve.validation_loss.min() + 1e-4)).alias("best_kept"), "scores_valid")


@query("boosted_regressor", f"""
    SELECT {KEYS}, {rnd('z_target_pct_change', 'target_scaled')}, true AS predicted FROM windows WHERE split = 'test'""", 6)
def _(spark, d):
    rows = stage(forecast.model_rows(features.training_windows(staged_day(spark, d))), "rows")
    model = forecast.fit_regressor(rows.filter(F.col("split") == "train"), forecast.Candidate(trees=5))
    finite = F.col("prediction").isNotNull() & ~F.isnan("prediction") & (F.abs("prediction") < 1e6)
    return model.transform(rows.filter(F.col("split") == "test")).select("code", "date", "target_scaled", finite.alias("predicted"))


CTES["last_rows"] = """
    SELECT code, max(date) AS last_date, arg_max(close, date) AS last_close_price FROM bars_day GROUP BY code"""


@query("next_day_inputs", f"""
    SELECT code, CAST(last_date AS VARCHAR) AS last_date, CAST(last_date + 1 AS VARCHAR) AS prediction_date,
      last_close_price, CAST(15 AS BIGINT) AS steps FROM last_rows""")
def _(spark, d):
    bars = staged_day(spark, d)
    labelled = stage(features.labelled_features(bars), "labelled")
    _rows, scaler = features.scaled_features(labelled)
    rows = inference.last_windows(bars, scaler)
    return rows.select("code", "last_date", "prediction_date", "last_close_price", F.size("window").alias("steps"))


@query("next_day_prediction", """
    SELECT code, CAST(last_date AS VARCHAR) AS last_date, CAST(last_date + 1 AS VARCHAR) AS prediction_date, last_close_price,
      true AS named, true AS priced, true AS same_after_loading FROM last_rows""")
def _(spark, d):
    bars = staged_day(spark, d)
    run = training.train(bars)
    path = scratch_path(spark, "models")
    forecast.save_models(path, run.regressor, run.classifier, run.scaler)
    regressor, classifier, scaler = forecast.load_models(spark, path)
    now = inference.predict_next(inference.last_windows(bars, run.scaler), run.regressor, run.classifier)
    later = inference.predict_next(inference.last_windows(bars, scaler), regressor, classifier)
    same = F.col("predicted_price").eqNullSafe(F.col("price_now")) & F.col("predicted_trend").eqNullSafe(F.col("trend_now"))
    return later.join(now.select("code", F.col("predicted_price").alias("price_now"), F.col("predicted_trend").alias("trend_now")), "code").select(
        "code", "last_date", "prediction_date", "last_close_price", F.col("predicted_trend").isin("Down", "Neutral", "Up").alias("named"),
        (F.col("predicted_price").isNotNull() & ~F.isnan("predicted_price")).alias("priced"), same.alias("same_after_loading"))


@query("feature_weights", f"""
    SELECT element AS pos, {rnd('avg(v)', 'weight')} FROM (
      SELECT unnest(range(len(embedding))) % 16 AS element, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings)
    GROUP BY element""", 6)
def _(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("embedding").cast("array<double>").alias("e"))
    steps = F.sequence(F.lit(0), F.floor((F.size("e") - 1) / 16))
    matrix = F.transform(steps, lambda i: F.slice("e", (i * 16 + 1).cast("int"), 16))
    return forecast.mean_by_element(rows.where(F.size("e") > 0).select(matrix.alias("m")), "m")


