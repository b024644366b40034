"""Profiling, deduplication, enrichment and gating of bar tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.series import DAILY, Series, attach, plain


def null_profile(df: DataFrame) -> DataFrame:
    """Nulls per column in one pass; 0 on an empty table (A2)."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def null_profile_sum(df: DataFrame) -> DataFrame:
    """Nulls per column as a sum; NULL on an empty table."""
    return df.agg(*[F.sum(F.col(c).isNull().cast("int")).alias(c) for c in df.columns])


def row_count(df: DataFrame, name: str = "row_count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def duplicate_count(df: DataFrame, name: str = "duplicates") -> DataFrame:
    """Rows beyond the first of each identical group (A5); copies fold before the shuffle."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias(name))


def dedupe(df: DataFrame, key: Sequence[str] = ("code", "date"), revision: str | None = None) -> DataFrame:
    """One row per key (A6); a group of copies shrinks to one row per input task.

    With ``revision`` (a number or a time, such as when a row arrived) the row of the latest one survives, whole, also
    where it holds NULLs; rows without one count as the oldest. Without it the survivor is the largest by the other columns
    in order, NULLs lowest, so reruns agree.
    """
    rest = [c for c in df.columns if c not in key]
    if not rest:
        return df.dropDuplicates()
    if revision is None:
        kept = df.groupBy(*key).agg(F.max(F.struct(*rest)).alias("_row"))
        return kept.select(*key, "_row.*").select(*df.columns)
    ranked = df.withColumn("_rank", _revision_rank(df, revision, rest))
    return ranked.groupBy(*key).agg(*[F.max_by(c, "_rank").alias(c) for c in rest]).select(*df.columns)


def _revision_rank(df: DataFrame, revision: str, rest: Sequence[str]) -> Column:
    """Revision and row hash in one number of fixed width, which keeps the aggregation hashed, and in which rows of one
    revision differ, so that all columns of a key come from the same row."""
    column = F.col(revision)
    if df.schema[revision].dataType.typeName() in ("timestamp", "timestamp_ntz", "date"):
        column = F.unix_micros(column.cast("timestamp"))
    half = F.lit(1 << 62).cast("decimal(20,0)")
    number = F.coalesce(column.cast("long"), F.lit(-(1 << 62))).cast("decimal(20,0)")
    return number * half + F.shiftrightunsigned(F.xxhash64(*rest), 2).cast("decimal(20,0)")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct."""
    return df.dropDuplicates()


def replace_value(df: DataFrame, column: str, old: float, new: float) -> DataFrame:
    """Swap one value for another."""
    return df.withColumn(column, F.when(F.col(column) == old, F.lit(new)).otherwise(F.col(column)))


def enrich(bars: DataFrame, codes: DataFrame, s: Series = DAILY) -> DataFrame:
    """Left join of the code list (J1). Bars without a listed code keep a NULL type and a
    code listed twice does not multiply bars."""
    dim = codes.groupBy("code").agg(F.min("type").alias("type"))
    return plain(attach(bars, s, dim, "left")).select(*bars.columns, "type")


def refresh_report(bars: DataFrame, updated: Column, time: str = "date") -> DataFrame:
    """Control table: rows, date span and refresh time per code."""
    day = F.to_date(time)
    return bars.groupBy("code").agg(
        F.count(F.lit(1)).cast("int").alias("nb"), F.min(day).alias("min_date"),
        F.max(day).alias("max_date"), F.max(updated).alias("updated"))


def high_water_mark(df: DataFrame, column: str = "updated", name: str = "max_updated") -> DataFrame:
    """Newest value of a column (A1)."""
    return df.agg(F.max(column).alias(name))


def newer_than(df: DataFrame, mark: DataFrame, column: str = "updated") -> DataFrame:
    """Rows newer than the one-row, one-column ``mark`` (P6); an empty mark lets everything pass."""
    limit = mark.select(F.max(mark.columns[0])).scalar()
    return df.filter(limit.isNull() | (F.col(column) > limit))


def at_latest(df: DataFrame, column: str = "date") -> DataFrame:
    """Rows at the newest date (P7), as a scalar subquery the scan can prune by."""
    return df.filter(F.col(column) == df.agg(F.max(column)).scalar())


def only_codes(df: DataFrame, codes: Sequence[str]) -> DataFrame:
    """Key filter (P5); pushed down to the scan."""
    return df.filter(F.col("code").isin(list(codes)))


def per_column(df: DataFrame, columns: Sequence[str], make) -> DataFrame:
    """Generated projection, one expression per column."""
    return df.select(*[make(c).alias(c) for c in columns])


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))
