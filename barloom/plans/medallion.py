"""Bronze to silver to gold: initial load, incremental refresh, gates (ST1-ST5).

Silver and gold are Parquet tables partitioned by calendar year (daily) or date (intraday),
so a refresh reads and rewrites only what a batch touches.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators import clean
from barloom.operators.series import DAILY, Series, attach, last_value, plain
from barloom.operators.windows import forward_fill, lag_fill, latest
from barloom.plans.changes import ChangeLog
from barloom.schemas import FILLED_DAY, FILLED_INTRADAY, REPORT
from barloom.session import stage
from barloom.sources import writers


@dataclass(frozen=True)
class Layout:
    """Where the tables of one stream live."""

    root: str
    kind: str  # "day" or "intraday"

    @property
    def bars(self) -> str:
        return f"{self.root}/{self.kind}"

    @property
    def report(self) -> str:
        return f"{self.root}/report_{self.kind}"

    @property
    def tail(self) -> str:
        return f"{self.root}/last_{self.kind}"

    @property
    def rejected(self) -> str:
        return f"{self.root}/rejected_{self.kind}"

    @property
    def changes(self) -> str:
        return f"{self.root}/changes_{self.kind}"


def partition_of(s: Series) -> Column:
    """Partition value of a row: the year of a daily bar, the date of an intraday bar."""
    return F.year(s.time) if s.step >= 86_400 else F.to_date(s.time)


def price_columns(s: Series) -> list[str]:
    return FILLED_DAY if s.step >= 86_400 else FILLED_INTRADAY


FILLED = "filled"


def rejected_rows(bars: DataFrame, s: Series = DAILY) -> DataFrame:
    """Rows that have no place in a series: without code or time."""
    return bars.filter(F.col(s.key).isNull() | F.col(s.time).isNull())


def observed(bars: DataFrame, s: Series = DAILY) -> DataFrame:
    """Bars as they were observed: filled prices, as marked in ``FILLED``, are NULL again."""
    if FILLED not in bars.columns:
        return bars
    names = [c for c in price_columns(s) if c in bars.columns]
    raw = {c: F.when(F.col(FILLED).bitwiseAND(F.lit(1 << i)) == 0, F.col(c)) for i, c in enumerate(names)}
    return bars.withColumns(raw).drop(FILLED)


def filled_bars(bars: DataFrame, s: Series = DAILY, fill: str = "forward") -> DataFrame:
    """Prices filled, and a number whose bits say which of them were (``FILLED``)."""
    cols = [c for c in price_columns(s) if c in bars.columns]
    kept = bars.withColumns({f"_raw_{c}": F.col(c) for c in cols})
    out = lag_fill(kept, cols, s) if fill == "lag" else forward_fill(kept, cols, s)
    bits = sum((F.when(F.col(f"_raw_{c}").isNull() & F.col(c).isNotNull(), F.lit(1 << i)).otherwise(0)
                for i, c in enumerate(cols)), F.lit(0))
    return out.select(*bars.columns, bits.alias(FILLED))


def clean_bars(
    bars: DataFrame, codes: DataFrame | None = None, s: Series = DAILY, fill: str = "forward", mark: bool = False,
    revision: str | None = None,
) -> DataFrame:
    """Dedupe on key, fill prices, add the type (the silver transform).

    ``fill='lag'`` bridges single gaps only, ``'forward'`` all of them. ``mark`` adds ``FILLED``.
    Rows without code or time are left out; :func:`rejected_rows` are those. ``revision`` names a column that
    says which row of a key is the latest; it is not kept.
    """
    once = _once(bars, s, revision)  # the fill reads it twice
    out = filled_bars(once, s, fill)
    out = clean.enrich(out, codes, s) if codes is not None else out
    return out if mark else out.drop(FILLED)


def _once(bars: DataFrame, s: Series, revision: str | None) -> DataFrame:
    """One row per key and time, stored, without the revision."""
    kept = clean.dedupe(bars.dropna(subset=[s.key, s.time]), [s.key, s.time], revision)
    return stage(kept.drop(revision) if revision else kept, "deduped")


def last_rows(bars: DataFrame, s: Series = DAILY) -> DataFrame:
    """Newest time and last known prices of each code: one partial + final aggregate."""
    cols = [c for c in price_columns(s) if c in bars.columns]
    return bars.groupBy(s.key).agg(
        F.max(s.time).alias(s.time), *[last_value(c, s.time).alias(c) for c in cols])


def rows_before(bars: DataFrame, s: Series = DAILY, fill: str = "forward") -> DataFrame:
    """What a fill goes on from after these bars: the last known prices, or for ``'lag'`` the last row as it was observed."""
    if fill != "lag":
        return last_rows(bars, s)
    return latest(observed(bars, s), [c for c in price_columns(s) if c in bars.columns], s)


def clean_batch(
    batch: DataFrame, silver: DataFrame, codes: DataFrame | None = None, s: Series = DAILY,
    tail: DataFrame | None = None, mark: bool = False, revision: str | None = None, fill: str = "forward",
) -> DataFrame:
    """Clean one batch so that silver plus the result equals a full load (ST5) with the same ``fill``.

    A code whose batch starts after its last row is filled from that row, which ``tail`` (the small
    table of last rows) holds. Of a code whose batch reaches back, later silver rows may have been
    filled from prices that the batch corrects: they are taken back to what was observed and filled
    again with the batch, and those that come out different are part of the result. Only such codes
    are looked up in ``silver``, joined per block. ``fill='lag'`` takes what was observed in the row before, so its
    seeds are those rows (read from ``silver``, ``tail`` is not used).
    """
    batch = _once(batch, s, revision)
    if fill == "lag":
        tail = rows_before(silver, s, fill)
    tail = last_rows(silver, s) if tail is None else tail
    starts = batch.groupBy(s.key).agg(F.min(s.time).alias("_start"))
    known = tail.join(starts, s.key)
    seed = known.filter(F.col(s.time) < F.col("_start")).drop("_start")
    late = stage(known.filter(F.col(s.time) >= F.col("_start")).select(s.key, "_start"), "late-codes")
    rows, again = batch.withColumns({"_seed": F.lit(False), "_new": F.lit(True)}), None
    if not late.isEmpty():  # spares the usual refresh a scan of history
        history = plain(attach(silver, s, late))
        before = rows_before(history.filter(F.col(s.time) < F.col("_start")).drop("_start"), s, fill)
        seed = seed.unionByName(before.select(*seed.columns))
        again = stage(history.filter(F.col(s.time) >= F.col("_start")).drop("_start"), "reopened")
        older = observed(again, s).select(*batch.columns).join(batch.select(s.key, s.time), [s.key, s.time], "left_anti")
        rows = rows.unionByName(older.withColumns({"_seed": F.lit(False), "_new": F.lit(False)}))
    rows = rows.unionByName(seed.withColumns({"_seed": F.lit(True), "_new": F.lit(False)}), allowMissingColumns=True)
    out = filled_bars(rows, s, fill).filter(~F.col("_seed")).drop("_seed")
    if again is not None:  # rows that were only reopened and came out as they were stay where they are
        marks = again if FILLED in again.columns else again.withColumn(FILLED, F.lit(0))
        same = [c for c in [*price_columns(s), FILLED] if c in marks.columns]
        stored = marks.select(s.key, s.time, *[F.col(c).alias(f"_was_{c}") for c in same], F.lit(True).alias("_stored"))
        out = out.join(stored, [s.key, s.time], "left")
        changed = ~F.coalesce("_stored", F.lit(False))
        for c in same:
            changed = changed | ~F.col(c).eqNullSafe(F.col(f"_was_{c}"))
        out = out.filter(F.col("_new") | changed)
    out = out.select(*batch.columns, FILLED)
    out = clean.enrich(out, codes, s) if codes is not None else out
    return out if mark else out.drop(FILLED)


def later_rows(tail: DataFrame, rows: DataFrame, s: Series = DAILY) -> DataFrame:
    """Tail table after a batch: the newest row of each code, prices carried where NULL; a row of the
    batch goes before an older one of the same time."""
    cols = [c for c in price_columns(s) if c in tail.columns]
    both = tail.select(*tail.columns, F.lit(0).alias("_new")).unionByName(
        last_rows(rows, s).select(*tail.columns, F.lit(1).alias("_new")))
    order = F.struct(s.time, "_new")
    return both.groupBy(s.key).agg(
        F.max(s.time).alias(s.time),
        *[F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c) for c in cols]).select(*tail.columns)


def newest(report: DataFrame, mode: str = "max") -> DataFrame:
    """One-row table with the report's newest (or, for parity, oldest) refresh time."""
    f = F.max if mode == "max" else F.min
    return report.agg(f("updated").alias("updated"))


def gate(bronze: DataFrame, silver: DataFrame, mode: str = "max") -> DataFrame:
    """One row, one column ``run``: is the bronze report newer than the silver one (J3, ST2)?

    An empty silver report opens the gate; an empty bronze report keeps it shut.
    """
    known = newest(silver, mode).scalar()
    run = F.col("updated").isNotNull() & (known.isNull() | (F.col("updated") > known))
    return newest(bronze, mode).select(run.alias("run"))


def is_open(gate_row: DataFrame) -> bool:
    return bool(gate_row.first()["run"])


def keep_newer(report: DataFrame, published: DataFrame) -> DataFrame:
    """Report rows newer than everything published (P6, ST3)."""
    return clean.newer_than(report, clean.high_water_mark(published))


def _set_aside(bars: DataFrame, report: DataFrame, layout: Layout, s: Series) -> None:
    """Keep rows that cannot be placed, by the refresh time of their batch; a repeat replaces them."""
    when = report.agg(F.coalesce(F.max("updated").cast("string"), F.lit("none"))).scalar()
    writers.overwrite_partitions(rejected_rows(bars, s).withColumn("batch", when), layout.rejected, "batch")


def change_log(spark: SparkSession, layout: Layout) -> ChangeLog:
    """Which partitions of the bars each batch touched, for recovery and for the gold tables."""
    kind = T.IntegerType() if layout.kind == "day" else T.DateType()
    return ChangeLog(spark, layout.changes, T.StructField("part", kind))


def initial_load(
    bars: DataFrame, codes: DataFrame, report: DataFrame, layout: Layout, s: Series = DAILY, revision: str | None = None,
    fill: str = "forward",
) -> None:
    """Clean everything and overwrite the tables, control table last (ST1). After a crash it has to be repeated."""
    silver = clean_bars(bars, codes, s, fill, mark=True, revision=revision).withColumn("part", partition_of(s))
    writers.write_parquet(silver, layout.bars, ["part"])
    spark = bars.sparkSession
    stored_bars = spark.read.parquet(layout.bars)
    log = change_log(spark, layout)
    number = log.begin(stored_bars, newest_time(report))
    _set_aside(bars, report, layout, s)
    writers.write_parquet(last_rows(stored_bars, s), layout.tail)
    writers.write_parquet(report, layout.report)
    log.close(number)


def newest_time(report: DataFrame) -> datetime | None:
    return newest(report).first()["updated"]


def stored(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A small side table, empty if a crash left none behind; both can be rebuilt from the bars."""
    if writers.path_exists(spark, path):
        return spark.read.schema(schema).parquet(path)
    return spark.createDataFrame([], schema)


def refresh(
    batch: DataFrame, codes: DataFrame, report: DataFrame, layout: Layout, s: Series = DAILY, revision: str | None = None,
    fill: str = "forward",
) -> bool:
    """Apply one batch if its report is newer than the published one (ST2-ST5).

    A write-ahead log makes a crash at any point harmless (:mod:`barloom.plans.changes`). The new content of the
    partitions that the batch touches and the list of them are on disk before the first of them is replaced;
    the batch is closed after its last write. The next refresh or publication first finishes what an open batch
    began. A batch at least as new as an open one passes the gate, so that a crash between the
    control table and the closing cannot shut it, and its partitions include those of the open one: a
    repeat that finds its rows in place already still tells the gold tables of them. The table of last rows is
    only trusted while no batch is open. Returns whether anything was written.
    """
    spark = batch.sparkSession
    log, when = change_log(spark, layout), newest_time(report)
    open_ = log.recover(layout.bars)
    published = stored(spark, layout.report, REPORT)
    if not is_open(gate(report, published)) and not (open_ and when and when >= (log.pending_since() or when)):
        return False
    silver = spark.read.parquet(layout.bars)
    known = last_rows(silver, s)
    tail = stored(spark, layout.tail, known.schema)
    tail = known if open_ or tail.isEmpty() else tail
    rows = stage(clean_batch(batch, silver, codes, s, tail, mark=True, revision=revision, fill=fill).withColumn("part", partition_of(s)), "batch")
    tail = stage(later_rows(tail, rows, s), "tail")  # before the bars change, of which it may be made
    number = log.begin(rows, when, writers.merged_partitions(rows, layout.bars, [s.key, s.time]))
    log.apply(number, layout.bars)
    _set_aside(batch, report, layout, s)
    writers.write_parquet(tail, layout.tail)
    writers.write_parquet(stage(report, "report"), layout.report)
    log.close(number)
    return True


def publish(spark: SparkSession, layout: Layout, database: str, path: str, codes: DataFrame | None = None) -> bool:
    """Bring the gold tables of one stream up to date (S10-S12, S14, ST3); whether anything was written.

    The first call writes everything. Later ones are gated by the newest refresh time in the gold
    control table and write only the partitions that batches since then touched, taken from the
    log of changes; other files stay as they are. Bars go first and the control table last,
    so a crash in between repeats harmless work. What a crashed refresh left half done is finished first.
    """
    log = change_log(spark, layout)
    log.recover(layout.bars)
    writers.create_database(spark, database)
    bars, report, listed = f"{database}.{layout.kind}", f"{database}.report_{layout.kind}", f"{database}.codes"
    silver = spark.read.parquet(layout.bars).drop(FILLED)
    control = spark.read.schema(REPORT).parquet(layout.report)
    if codes is not None and not spark.catalog.tableExists(listed):
        writers.save_table(codes, listed, f"{path}/codes")
    if not (spark.catalog.tableExists(bars) and spark.catalog.tableExists(report)):
        writers.save_table(silver, bars, f"{path}/{layout.kind}", partition_by=["part"])
        writers.save_table(control, report, f"{path}/report_{layout.kind}")
        return True
    published = spark.read.table(report)
    if keep_newer(control, published).isEmpty():
        return False
    newer = keep_newer(log.entries(), published)
    touched = [r[0] for r in newer.select("part").distinct().collect()]  # calendar years or days
    writers.overwrite_partitions(silver.filter(F.col("part").isin(touched)), f"{path}/{layout.kind}")
    spark.catalog.recoverPartitions(bars)
    spark.catalog.refreshTable(bars)
    writers.save_table(stage(control, "control"), report, f"{path}/report_{layout.kind}")
    return True
