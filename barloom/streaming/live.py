"""Structured Streaming form of the refresh: ingest, bars, dedupe, fill and mean state, publish."""

from __future__ import annotations

import threading
from collections import Counter
from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from barloom.operators.clean import dedupe
from barloom.operators.ema import ema
from barloom.operators.series import INTRADAY, Series, attach, plain
from barloom.operators.windows import forward_fill, latest
from barloom.plans.medallion import Layout, partition_of
from barloom.session import delete_path, discarding_stages, stage
from barloom.sources import writers
from barloom.sources.ticks import bars_from_ticks


def file_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None,
) -> DataFrame:
    """New files of a folder as a stream (ST6)."""
    reader = spark.readStream.format(fmt).schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def _event_time(df: DataFrame, column: str, lateness: str) -> DataFrame:
    """Watermarks need an instant, so zone-less times are read in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp")).withWatermark(column, lateness)


#: name of a bar's number of ticks, and of the observation that counts arriving ones
TICKS, ARRIVED = "ticks", "arrived"


def live_bars(
    ticks: DataFrame, code: str, time: str, price: str, lateness: str = "1 hour", every: str = "15 minutes", count: bool = False,
) -> DataFrame:
    """Bars from a tick stream; a bar is final once the watermark passes it (ST8). Ticks that come later
    than that are left out. With ``count`` a bar says how many ticks it has, and the stream reports how many have
    arrived (``ARRIVED``, see :class:`StreamWatch`), from which :func:`late_ticks` follows."""
    if count:
        ticks = ticks.observe(ARRIVED, F.count(F.lit(1)).alias("ticks"))
    return bars_from_ticks(
        _event_time(ticks, time, lateness), code, time, price, F.lit(1).cast("double"), every, count=TICKS if count else None)


def live_dedupe(
    bars: DataFrame, lateness: str = "1 hour", key: tuple[str, ...] = ("code", "timestamp"),
) -> DataFrame:
    """Drop repeats of a key that arrive within the lateness (ST7)."""
    return _event_time(bars, key[-1], lateness).dropDuplicatesWithinWatermark(list(key))


FILL_STATE = T.StructType([
    T.StructField("timestamp", T.TimestampType()), T.StructField("close", T.DoubleType()),
    T.StructField("mean", T.DoubleType())])
FILL_OUTPUT = T.StructType([
    T.StructField("code", T.StringType()), T.StructField("timestamp", T.TimestampType()),
    T.StructField("close", T.DoubleType()), T.StructField("ema", T.DoubleType()),
    T.StructField("late", T.BooleanType())])


def carried_on(rows: pd.DataFrame, close: float | None, mean: float | None, alpha: float) -> tuple[pd.Series, pd.Series]:
    """Filled closes and their exponential means for rows in time order that follow a state."""
    filled = pd.concat([pd.Series([close], dtype=float), rows["close"].astype(float)]).ffill().iloc[1:]
    # the old mean stands in front; where there is none the first known close is the first mean
    means = pd.concat([pd.Series([mean], dtype=float), filled]).ewm(alpha=alpha, adjust=False).mean().iloc[1:]
    return filled, means.where(filled.notna())


def filled_rows(code: str, rows: pd.DataFrame, state: tuple | None, alpha: float) -> tuple[pd.DataFrame, tuple]:
    """Output rows for ``rows`` in time order, none of them late, and last close and mean after them."""
    closes, means = carried_on(rows, *(state or (None, None)), alpha)
    out = pd.DataFrame({"code": code, rows.columns[0]: rows.iloc[:, 0].to_numpy(), "close": closes.to_numpy(), "ema": means.to_numpy(), "late": False})
    return out, tuple(None if pd.isna(x) else float(x) for x in (closes.iloc[-1], means.iloc[-1]))


def mean_of_filled(span: float):
    """State per code: last time, last close, current mean. Rows are filled, then averaged.

    A row at or before the state's time is late: it is passed on marked, and changes nothing.
    """
    alpha = 2.0 / (span + 1.0)

    class FilledMean(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.state = handle.getValueState("last", FILL_STATE)

        def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows))[["timestamp", "close"]].sort_values("timestamp", kind="stable")
            last, *state = self.state.get() if self.state.exists() else (None, None, None)
            late = batch["timestamp"].duplicated()
            if last is not None:
                late |= batch["timestamp"] <= pd.Timestamp(last)
            if late.any():
                yield batch[late].assign(code=key[0], ema=None, late=True)[FILL_OUTPUT.names]
            fresh = batch[~late]
            if len(fresh):
                out, state = filled_rows(key[0], fresh, state, alpha)
                self.state.update((fresh["timestamp"].iloc[-1].to_pydatetime(), *state))
                yield out

        def close(self) -> None:
            pass

    return FilledMean()


def live_fill_and_mean(bars: DataFrame, span: float = 10) -> DataFrame:
    """Forward fill and exponential mean across micro-batches (ST9). Needs the RocksDB state store.

    For short triggers: a code's rows of one micro-batch are handled together in one task. For
    backfills, or where one code dominates, use :func:`publish_filled`, which splits codes. Rows have to arrive in
    time order per code; :func:`live_fill_and_mean_in_order` puts them into order.
    """
    slim = bars.select("code", F.col("timestamp").cast("timestamp").alias("timestamp"), "close")
    return slim.groupBy("code").transformWithStateInPandas(
        statefulProcessor=mean_of_filled(span), outputStructType=FILL_OUTPUT,
        outputMode="Append", timeMode="None")


WAITING = T.StructType([T.StructField("micros", T.LongType()), T.StructField("close", T.DoubleType())])
MEAN_STATE = T.StructType([T.StructField("close", T.DoubleType()), T.StructField("mean", T.DoubleType())])
TIMER = T.StructType([T.StructField("millis", T.LongType())])
ORDERED_OUTPUT = T.StructType([T.StructField("micros", T.LongType()) if f.name == "timestamp" else f for f in FILL_OUTPUT])


def mean_in_event_order(span: float):
    """Rows wait in a list until the watermark has passed them, then go through fill and mean in time order.

    State per code: the waiting rows, the time of the one timer that is set (that of the earliest waiting row),
    last close and mean. Whatever Spark lets through is later than the watermark of the batch before, and so later
    than every row that has been released. Times are microseconds, which no session zone can shift.
    """
    alpha = 2.0 / (span + 1.0)

    class OrderedMean(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            self.handle = handle
            self.state = handle.getValueState("last", MEAN_STATE)
            self.waiting = handle.getListState("waiting", WAITING)
            self.timer = handle.getValueState("timer", TIMER)

        def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
            batch = pd.concat(list(rows))
            self.waiting.appendList(_listed(batch))
            self._wake(batch)
            return iter(())

        def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
            held = pd.DataFrame(list(self.waiting.get()), columns=WAITING.names)
            ready = _millis(held["micros"]) <= timerValues.getCurrentWatermarkInMs()
            self.timer.clear()
            rest = held[~ready]
            if len(rest):
                self.waiting.put(_listed(rest))
                self._wake(rest)
            else:
                self.waiting.clear()
            # of the copies of a time the largest close counts, so the order of arrival does not matter
            rows = held[ready].sort_values(["micros", "close"], na_position="first").drop_duplicates("micros", keep="last")
            if not len(rows):
                return iter(())
            out, state = filled_rows(key[0], rows, self.state.get() if self.state.exists() else None, alpha)
            self.state.update(state)
            return iter((out,))

        def _wake(self, rows: pd.DataFrame) -> None:
            """Have the timer set to the earliest of ``rows``, unless it is set earlier."""
            millis = int(_millis(rows["micros"]).min())
            now = self.timer.get()[0] if self.timer.exists() else None
            if now is not None and now <= millis:
                return
            if now is not None:
                self.handle.deleteTimer(now)
            self.handle.registerTimer(millis)
            self.timer.update((millis,))

        def close(self) -> None:
            pass

    return OrderedMean()


def _listed(rows: pd.DataFrame) -> list[tuple]:
    return [(int(t), None if pd.isna(c) else float(c)) for t, c in zip(rows["micros"], rows["close"])]


def _millis(micros: pd.Series) -> pd.Series:
    """The first whole millisecond that is not before the time: watermarks and timers are whole milliseconds."""
    return -(-micros // 1000)


def live_fill_and_mean_in_order(bars: DataFrame, lateness: str = "1 hour", span: float = 10) -> DataFrame:
    """Forward fill and exponential mean of bars that arrive in any order within ``lateness`` (ST9).

    A row waits until the watermark, the newest time seen less ``lateness``, has passed it. The result is that of the rows in time
    order, whatever their order of arrival. Rows behind the watermark are left out by Spark and counted
    (:class:`StreamWatch`). A code's waiting rows are those of one ``lateness``, its other state is three numbers.
    What still waits when a stream stops stays in the checkpoint and comes out when newer rows arrive. Needs
    the RocksDB state store.
    """
    slim = _event_time(bars.select("code", "timestamp", "close"), "timestamp", lateness)
    rows = slim.withColumn("micros", F.unix_micros("timestamp")).groupBy("code").transformWithStateInPandas(
        statefulProcessor=mean_in_event_order(span), outputStructType=ORDERED_OUTPUT,
        outputMode="Append", timeMode="EventTime")
    return rows.select("code", F.timestamp_micros("micros").alias("timestamp"), "close", "ema", "late")


def split_late(batch: DataFrame, last: DataFrame, s: Series = INTRADAY) -> tuple[DataFrame, DataFrame]:
    """Rows newer than the code's row in ``last`` (or of a code without one), and the others."""
    known = last.select(s.key, F.col(s.time).alias("_known"))
    rows = plain(attach(batch, s, known, "left"))
    on_time = F.col("_known").isNull() | (F.col(s.time) > F.col("_known"))
    return rows.filter(on_time).drop("_known"), rows.filter(~on_time).drop("_known")


def fill_and_mean_batch(
    rows: DataFrame, last: DataFrame | None, span: float, s: Series = INTRADAY,
) -> DataFrame:
    """Rows of one micro-batch, none of them late, filled and averaged by the block operators.

    ``last`` holds each code's newest time, close and mean. Its close seeds the fill and its mean
    seeds the average, as one extra row per code that is dropped again.
    """
    rows = rows.select(s.key, s.time, "close").withColumn("seed", F.lit(False))
    if last is not None:
        rows = rows.unionByName(last.select(s.key, s.time, "close", F.lit(True).alias("seed")))
    rows = stage(forward_fill(rows, ["close"], s), "filled")
    if last is None:
        start = rows.withColumn("_x", F.col("close"))
    else:
        means = last.select(s.key, F.col("mean").alias("_mean"))
        start = plain(attach(rows, s, means, "left")).withColumn(
            "_x", F.when(F.col("seed"), F.col("_mean")).otherwise(F.col("close"))).drop("_mean")
    out = ema(start, {"ema": ("_x", span)}, s, gaps=False)
    return out.filter(~F.col("seed")).select(s.key, s.time, "close", "ema")


def publish_filled(
    bars: DataFrame, path: str, checkpoint: str, span: float = 10, s: Series = INTRADAY,
) -> StreamingQuery:
    """Forward fill and exponential mean of a bar stream, written as an upserted table (ST9).

    The state is a small table of each code's last row. It is versioned by micro-batch number, so
    a replayed batch starts from the state it first saw and writes the same rows; a batch whose
    state is missing fails. Only the last two states are kept. Rows at or before their code's state
    are late, as in :func:`mean_of_filled`: they change nothing and are kept by batch, see
    :func:`late_rows`. Copies of a key inside a batch count once.
    """
    def apply(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        before = f"{path}_state/{number - 1}"
        if number and not writers.path_exists(spark, before):
            raise FileNotFoundError(f"batch {number} needs the state in {before}")
        with discarding_stages(spark):
            fresh = stage(dedupe(stage(batch, "arrived"), [s.key, s.time]), "fresh")
            last = spark.read.parquet(before) if number else None
            if last is not None:
                fresh, late = split_late(fresh, last, s)
                writers.write_parquet(late.select(s.key, s.time, "close"), f"{path}_late/{number}")
            rows = stage(fill_and_mean_batch(fresh, last, span, s).withColumn("part", partition_of(s)), "filled")
            writers.upsert(rows, f"{path}/bars", [s.key, s.time])
            ends = latest(rows.withColumnRenamed("ema", "mean"), ["close", "mean"], s)
            if last is not None:
                ends = latest(ends.unionByName(last.select(ends.columns)), ["close", "mean"], s)
            writers.write_parquet(ends, f"{path}_state/{number}")
        delete_path(spark, f"{path}_state/{number - 2}")  # batch number - 1 is committed and never runs again

    return run_available(bars.writeStream.outputMode("append").foreachBatch(apply), checkpoint)


def late_rows(spark: SparkSession, path: str, s: Series = INTRADAY) -> DataFrame:
    """Rows that came too late for :func:`publish_filled`, with the number of their batch."""
    if not writers.path_exists(spark, f"{path}_late"):
        return spark.createDataFrame([], FILL_OUTPUT).select(s.key, s.time, "close", F.lit("").alias("batch"))
    rows = spark.read.option("recursiveFileLookup", True).parquet(f"{path}_late")
    return rows.withColumn("batch", F.regexp_extract(F.input_file_name(), r"_late/(\d+)/", 1))


class StreamWatch(StreamingQueryListener):
    """Adds up what the micro-batches of streams report, however many there are (a query itself remembers only its
    last few). Register it with ``spark.streams.addListener`` before the streams start."""

    def __init__(self) -> None:
        self._lock = threading.Condition()
        self._batches: dict[str, int] = {}
        self._newest: dict[str, int] = {}
        self._ended: set[str] = set()
        self._sums: dict[str, Counter[str]] = {}

    def onQueryStarted(self, event: Any) -> None:
        pass

    def onQueryProgress(self, event: Any) -> None:
        progress = event.progress
        run = str(progress.runId)
        with self._lock:
            sums = self._sums.setdefault(run, Counter())
            sums["input"] += progress.numInputRows
            sums["dropped"] += sum(op.numRowsDroppedByWatermark for op in progress.stateOperators)
            for name, row in (progress.observedMetrics or {}).items():
                for metric, value in row.asDict().items():
                    sums[f"{name}.{metric}"] += value or 0
            self._batches[run] = self._batches.get(run, 0) + 1
            self._newest[run] = max(progress.batchId, self._newest.get(run, -1))
            self._lock.notify_all()

    def onQueryIdle(self, event: Any) -> None:
        pass

    def onQueryTerminated(self, event: Any) -> None:
        with self._lock:
            self._ended.add(str(event.runId))
            self._lock.notify_all()

    def settle(self, query: StreamingQuery, timeout: float = 60.0) -> StreamWatch:
        """Wait until all that the query has done is added up: events arrive a little after the fact."""
        run, last = str(query.runId), query.lastProgress
        with self._lock:
            arrived = lambda: run in self._ended if not query.isActive else last is None or self._newest.get(run, -1) >= last.batchId
            if not self._lock.wait_for(arrived, timeout):
                raise TimeoutError(f"no events of the stream {run} within {timeout} s")
        return self

    def total(self, query: StreamingQuery, name: str = "dropped") -> int:
        """``input`` rows, rows ``dropped`` behind a watermark (groups of them, if an aggregate comes first), or an observed metric."""
        with self._lock:
            return self._sums.get(str(query.runId), Counter())[name]

    def batches(self, query: StreamingQuery) -> int:
        with self._lock:
            return self._batches.get(str(query.runId), 0)


def late_ticks(spark: SparkSession, layout: Layout, arrived: int) -> int:
    """How many of the ``arrived`` ticks are in no bar, because they came behind the watermark: a count of ticks, not of
    the groups that a state operator drops. For bars that :func:`live_bars` made with ``ticks`` and that were published in mode
    ``update``."""
    return arrived - (spark.read.parquet(layout.bars).agg(F.sum(TICKS)).first()[0] or 0)


def run_available(query, checkpoint: str, **options: str) -> StreamingQuery:
    """Start a writer over everything available now and wait for it (ST6)."""
    for name, value in options.items():
        query = query.option(name, value)
    started = query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    started.awaitTermination()
    return started


def run_every(query, checkpoint: str, every: str = "15 minutes", **options: str) -> StreamingQuery:
    """Start a writer that looks for new rows ``every`` so often, and return it running (ST6)."""
    for name, value in options.items():
        query = query.option(name, value)
    return query.option("checkpointLocation", checkpoint).trigger(processingTime=every).start()


def drain(query: StreamingQuery) -> StreamingQuery:
    """Let a running stream finish what has arrived, then stop it."""
    query.processAllAvailable()
    query.stop()
    return query


def publish_stream(
    bars: DataFrame, layout: Layout, checkpoint: str, s: Series = INTRADAY, mode: str = "append", every: str | None = None,
) -> StreamingQuery:
    """Upsert each micro-batch into the table, then refresh the control table (ST10).

    The upsert is by key, so a batch that is replayed after a crash changes nothing, and
    ``mode='update'`` publishes bars early and corrects them as late ticks arrive. Everything that is there now is
    published, or, with ``every``, what is there at each tick of that clock, until the returned stream is stopped.
    """

    def apply(batch: DataFrame, _id: int) -> None:
        with discarding_stages(batch.sparkSession):
            rows = stage(batch.withColumn("part", partition_of(s)), "batch")
            if rows.isEmpty():
                return
            writers.upsert(rows, layout.bars, [s.key, s.time])
            refresh_counts(rows, layout, s)

    writer = bars.writeStream.outputMode(mode).foreachBatch(apply)
    return run_every(writer, checkpoint, every) if every else run_available(writer, checkpoint)


def refresh_counts(rows: DataFrame, layout: Layout, s: Series = INTRADAY) -> None:
    """Bring the control table up to date after an upsert of ``rows``.

    Counts are kept per (code, partition); only partitions the batch touched are counted again,
    and the control table is the fold of that small table.
    """
    spark, parts = rows.sparkSession, f"{layout.report}_parts"
    touched = writers.touched_partitions(spark, layout.bars, rows)
    counted = stage(touched.groupBy("code", "part").agg(
        F.count(F.lit(1)).alias("nb"), F.min(s.time).alias("first"), F.max(s.time).alias("last")), "counts")
    writers.overwrite_partitions(counted, parts)
    report = spark.read.parquet(parts).groupBy("code").agg(
        F.sum("nb").cast("int").alias("nb"), F.to_date(F.min("first")).alias("min_date"),
        F.to_date(F.max("last")).alias("max_date"), F.max("last").alias("updated"))
    writers.write_parquet(report, layout.report)
