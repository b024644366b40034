"""Time blocks: the unit of parallelism for ordered work on a bar series.

A window over a whole code puts every bar of that code into one task. Here a
series is cut into fixed time blocks that hold at most ``block_rows`` bars, all
ordered work runs per (code, block), and what crosses a block border travels
as a small per-block summary:

* bounded look-back (lags, rolling windows, sequences): ``halo`` copies the last
  rows of earlier blocks into a block;
* unbounded look-back (fill, running aggregates, positions): ``carry`` scans the
  block summaries and joins the state before each block back on (code, block).

No step shuffles bars on the code alone, so a code holding a third of all rows
spreads over as many tasks as it has blocks. Nor do the block summaries of a very long
code have to meet in one task: ``span_blocks`` of them make a span, spans make wider spans
(``levels``), and a task folds the rows of one span (:func:`scanned`).
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import stage, stage_measured

BLOCK = "_block"
HALO = "_halo"


@dataclass(frozen=True)
class Series:
    """How a bar table is keyed. ``time`` is unique per ``key`` and lies on a grid of ``step`` seconds,
    so a block holds at most ``block_rows`` bars and a key at most (its time span / step / block_rows)
    blocks. With one level the block summaries of a key, one for ``block_rows`` bars, meet in one task. With more levels at
    most ``span_blocks`` of them do, up to ``block_rows * span_blocks ** levels`` bars a key; :meth:`spanned` chooses."""

    key: str = "code"
    time: str = "date"
    step: int = 86_400
    block_rows: int = 2048
    span_blocks: int = 1024
    levels: int = 1

    def with_block_rows(self, rows: int) -> Series:
        return replace(self, block_rows=rows)

    def fitted(self, df: DataFrame) -> Series:
        """Block size for very long series: the square root of the longest key's grid length, so
        that blocks and block summaries of that key are about equally many rows. One small
        aggregate; only a number comes back."""
        index = self.with_block_rows(1).block_id(df)
        spans = df.groupBy(self.key).agg((F.max(index) - F.min(index)).alias("_span"))
        longest = spans.agg(F.max("_span")).first()[0] or 0
        return self.with_block_rows(max(self.block_rows, math.isqrt(longest) + 1))

    def spanned(self, df: DataFrame) -> Series:
        """The series with as many levels as its longest key needs, so that no task folds more than a span of block
        summaries. One small aggregate; only a number comes back."""
        blocks = self.blocked(df).groupBy(self.key).agg((F.max(BLOCK) - F.min(BLOCK) + 1).alias("_blocks"))
        longest, levels = blocks.agg(F.max("_blocks")).first()[0] or 0, 1
        while longest > self.span_blocks ** levels:
            levels += 1
        return replace(self, levels=levels)

    def dense(self, df: DataFrame) -> Series:
        """The series with a step fine enough for ``df``: bars denser than the grid, such as minute
        bars in a 15-minute series, would overfill blocks. Small aggregates; only numbers come back."""
        fitting = self
        while True:
            counts = plain(df).withColumn(BLOCK, fitting.block_id(df)).groupBy(*self.block_keys).count()
            most = counts.agg(F.max("count")).first()[0] or 0
            if most <= self.block_rows or fitting.step == 1:
                return fitting
            fitting = replace(fitting, step=max(1, fitting.step * self.block_rows // most))

    def block_id(self, df: DataFrame) -> Column:
        t = F.col(self.time)
        kind = df.schema[self.time].dataType
        days = F.unix_date(F.to_date(t)).cast("long") * 86_400
        if isinstance(kind, T.DateType):
            seconds = days
        elif isinstance(kind, T.TimestampType):
            seconds = F.unix_seconds(t)
        else:
            seconds = days + F.hour(t) * 3600 + F.minute(t) * 60 + F.second(t)
        return F.floor(seconds / F.lit(self.step * self.block_rows)).cast("long")

    def blocked(self, df: DataFrame) -> DataFrame:
        return df if BLOCK in df.columns else df.withColumn(BLOCK, self.block_id(df))

    @property
    def block_keys(self) -> list[str]:
        return [self.key, BLOCK]

    @property
    def local(self) -> WindowSpec:
        """Rows of one block in time order."""
        return Window.partitionBy(*self.block_keys).orderBy(self.time)


DAILY = Series()
INTRADAY = Series(time="timestamp", step=900)


def last_value(x: str | Column, time: str) -> Column:
    """Aggregate: the latest non-null value. Partial aggregation keeps one row per group."""
    x = F.col(x) if isinstance(x, str) else x
    return F.max_by(x, F.when(x.isNotNull(), F.col(time)))


def first_value(x: str | Column, time: str) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.min_by(x, F.when(x.isNotNull(), F.col(time)))


_FOLDS = {
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "product": (F.product, lambda a, b: F.coalesce(a * b, a, b)),
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
}


@dataclass(frozen=True)
class Fold:
    """What the blocks of a key say together in one column.

    ``kind`` is sum, product, max, min, last (not NULL), or for array columns tail or head: their last or first ``k``
    elements. Before a block stand all earlier blocks of the key, for ``head`` all later ones; with ``whole`` (sum, max, min)
    all of its blocks count.
    """

    kind: str
    column: str
    k: int = 0
    whole: bool = False

    @property
    def backwards(self) -> bool:
        return self.kind == "head"

    def before(self, w: WindowSpec) -> Column:
        """The fold of the rows before this one in the window."""
        near = w.rowsBetween(Window.unboundedPreceding, -1)
        if self.kind == "last":
            return F.last(self.column, ignorenulls=True).over(near)
        if self.k:  # k blocks hold k elements at least
            return self._joined(F.collect_list(self.column).over(w.rowsBetween(-self.k, -1)))
        return _FOLDS[self.kind][0](F.col(self.column)).over(near)

    def total(self, order: str, rank: str) -> Column:
        """The fold of a group of rows, as an aggregate; ``rank`` counts them from the end."""
        if self.kind == "last":
            return last_value(self.column, order)
        if self.k:
            nearest = F.sort_array(F.collect_list(F.when(F.col(rank) <= self.k, F.struct(order, self.column))))
            return self._joined(F.transform(nearest, lambda r: r[self.column]))
        return _FOLDS[self.kind][0](F.col(self.column))

    def merged(self, outer: Column, here: Column) -> Column:
        """Both parts of what stands before a block: earlier spans, and earlier blocks of its own."""
        if self.kind == "last":
            return F.coalesce(here, outer)
        if self.k:
            # in a scan that runs backwards the outer rows come after those that are here
            return self._cut(F.when(outer.isNull(), here).otherwise(F.concat(here, outer) if self.backwards else F.concat(outer, here)))
        return _FOLDS[self.kind][1](outer, here)

    def _joined(self, arrays: Column) -> Column:
        """The elements of arrays in scan order, in the order of time."""
        return self._cut(F.flatten(F.reverse(arrays) if self.backwards else arrays))

    def _cut(self, rows: Column) -> Column:
        if self.backwards:
            return F.slice(rows, 1, self.k)
        return F.when(F.size(rows) > self.k, F.slice(rows, -self.k, self.k)).otherwise(rows)


def scanned(blocks: DataFrame, s: Series, state: Mapping[str, Fold]) -> DataFrame:
    """Add folds to a table of one row per (key, block).

    Blocks are folded within spans of ``s.span_blocks``, spans within wider spans, and so on for ``s.levels`` levels; what
    stands before a span is joined back to its rows. No window is over a key, unless the key is one span at the last level.
    With several levels the table is stored first, as each level reads it twice.
    """
    blocks = stage(blocks, "blocks") if s.levels > 1 else blocks
    for backwards in (False, True):
        mine = {n: f for n, f in state.items() if f.backwards == backwards}
        if mine:
            order = F.col(BLOCK) * (-1 if backwards else 1)
            blocks = _scanned(blocks.withColumn("_order", order), [s.key], mine, s.span_blocks, s.levels).drop("_order")
    return blocks


def _scanned(rows: DataFrame, key: list[str], state: Mapping[str, Fold], size: int, levels: int) -> DataFrame:
    """``rows`` are ordered by ``_order`` within ``key``."""
    if levels <= 1:
        w = Window.partitionBy(*key).orderBy("_order")
        return rows.withColumns({n: _FOLDS[f.kind][0](F.col(f.column)).over(Window.partitionBy(*key)) if f.whole else f.before(w)
                                 for n, f in state.items()})
    span, columns = [*key, "_span"], list(dict.fromkeys(f.column for f in state.values()))
    rows = rows.withColumn("_span", F.floor(F.col("_order") / size))
    w = Window.partitionBy(*span).orderBy("_order")
    here = rows.withColumns({f"_here_{n}": f.before(w) for n, f in state.items() if not f.whole})
    ends = rows.select(*span, "_order", *columns)
    if any(f.k for f in state.values()):
        ends = ends.withColumn("_rank", F.row_number().over(Window.partitionBy(*span).orderBy(F.desc("_order"))))
    totals = {f"_total_{n}": f.total("_order", "_rank") for n, f in state.items()}
    spans = ends.groupBy(*span).agg(*[c.alias(n) for n, c in totals.items()]).withColumn("_order", F.col("_span"))
    wider = {f"_outer_{n}": replace(f, column=f"_total_{n}") for n, f in state.items()}
    outer = _scanned(spans.withColumnRenamed("_span", "_of"), key, wider, size, levels - 1).withColumnRenamed("_of", "_span")
    out = here.join(outer.select(*span, *wider), span, "left")
    out = out.withColumns({n: F.col(f"_outer_{n}") if f.whole else f.merged(F.col(f"_outer_{n}"), F.col(f"_here_{n}")) for n, f in state.items()})
    return out.drop("_span", *wider, *[f"_here_{n}" for n in state])


def carry(
    df: DataFrame, s: Series, block: Mapping[str, Column], state: Mapping[str, Fold],
) -> DataFrame:
    """Add per-block state columns to every row of ``df`` (which has a block column).

    ``block`` are aggregates per (key, block); ``state`` are folds of those over the blocks before.
    """
    summary = df.groupBy(*s.block_keys).agg(*[c.alias(n) for n, c in block.items()])
    return df.join(scanned(summary, s, state).select(*s.block_keys, *state), s.block_keys, "left")


# Stored parameters are taken to grow at most this much in memory.
UNPACKED = 10


def measured(params: DataFrame) -> tuple[DataFrame, bool]:
    """``params`` stored, and whether their measured size allows a broadcast in this session."""
    table, size = stage_measured(params, "parameters")
    return table, size * UNPACKED <= params.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def attach(df: DataFrame, s: Series, params: DataFrame, how: str = "inner") -> DataFrame:
    """Join one-row-per-key parameters onto ``df`` without shuffling rows on the key.

    The parameters are stored and measured. Below the session's broadcast threshold they are
    broadcast and ``df`` is read once and not moved. Above it they are spread over the blocks that
    exist, so the join key is (key, block) and a hot key stays split.
    """
    df = s.blocked(df)
    params, small = measured(params)
    if small:
        return df.join(F.broadcast(params), s.key, how)
    spread = df.select(*s.block_keys).distinct().join(params, s.key, how)
    return df.join(spread, s.block_keys, how)


def halo(
    df: DataFrame, s: Series, cols: Sequence[str], before: int = 0, after: int = 0,
) -> DataFrame:
    """Add to each block copies of the neighbouring ``before``/``after`` rows, marked ``HALO``.

    Only ``cols`` are copied. Sparse blocks are handled: the copies come from as many
    neighbouring blocks as it takes, since every block summary holds at least one row.
    """
    df = s.blocked(df)
    row = F.struct(s.time, *[c for c in cols if c != s.time])
    parts = [df.withColumn(HALO, F.lit(False))]
    for rows, order, kind in ((before, F.col(s.time).desc(), "tail"), (after, F.col(s.time).asc(), "head")):
        if not rows:
            continue
        edge = Window.partitionBy(*s.block_keys).orderBy(order)
        kept = F.sort_array(F.collect_list(row))
        edges = (
            df.select(*s.block_keys, s.time, *[c for c in cols if c != s.time])
            .withColumn("_n", F.row_number().over(edge)).filter(F.col("_n") <= rows)
            .groupBy(*s.block_keys).agg(kept.alias("_rows"))
        )
        copies = (
            scanned(edges, s, {"_near": Fold(kind, "_rows", rows)}).filter(F.size("_near") > 0)
            .select(*s.block_keys, F.explode("_near").alias("_r"))
            .select(*s.block_keys, "_r.*", F.lit(True).alias(HALO))
        )
        parts.append(copies)
    out = parts[0]
    for extra in parts[1:]:
        out = out.unionByName(extra, allowMissingColumns=True)
    return out


def without_halo(df: DataFrame) -> DataFrame:
    return df.filter(~F.col(HALO)).drop(HALO)


def looking_back(
    df: DataFrame, s: Series, rows: int, cols: Sequence[str], exprs: Mapping[str, Column],
) -> DataFrame:
    """Add window columns that look back at most ``rows`` rows; ``exprs`` use ``s.local``."""
    wide = halo(df, s, cols, before=rows)
    return without_halo(wide.withColumns(dict(exprs))) if rows else wide.withColumns(dict(exprs)).drop(HALO)


def plain(df: DataFrame) -> DataFrame:
    """Drop the helper columns of this module."""
    return df.drop(BLOCK, HALO)
