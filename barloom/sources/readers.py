"""Readers for bar files, code lists, control tables and the raw training file."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import schemas


def read_csv(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """CSV with header and declared types; a malformed cell becomes NULL."""
    return spark.read.schema(schema).option("header", True).csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with every column as string."""
    return spark.read.option("header", True).csv(path)


def read_csv_inferred(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with inferred types, which costs an extra pass (S3); for first contact with a file only."""
    return spark.read.option("header", header).option("inferSchema", True).csv(path)


def read_reports(spark: SparkSession, day: str, intraday: str) -> DataFrame:
    """Both control tables in one frame, told apart by ``kind``."""
    return union_reports(
        read_csv(spark, day, schemas.REPORT), read_csv(spark, intraday, schemas.REPORT))


def union_reports(day: DataFrame, intraday: DataFrame) -> DataFrame:
    return day.withColumn("kind", F.lit("day")).unionByName(intraday.withColumn("kind", F.lit("intraday")))


def read_table(spark: SparkSession, name_or_path: str, fmt: str = "parquet") -> DataFrame:
    """Stored table by path or by catalog name."""
    if "/" in name_or_path:
        return spark.read.format(fmt).load(name_or_path)
    return spark.table(name_or_path)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Lower-case names, ``symbol`` to ``code``, optional corporate-action columns dropped."""
    out = df.toDF(*[c.lower() for c in df.columns])
    return out.withColumnsRenamed({"symbol": "code"}).drop("dividends", "stock splits")


def read_symbols(spark: SparkSession, path: str, zone: str | None = None) -> DataFrame:
    """The raw daily file with normalised headers and typed columns.

    Columns are matched by header, so their order in the file does not matter.
    """
    raw = normalise_headers(read_csv_text(spark, path))
    kinds = {f.name: f.dataType for f in schemas.SYMBOLS_DAILY}
    typed = raw.select(*[
        F.col(c).try_cast(kinds[c]).alias(c) if c in kinds else F.col(c) for c in raw.columns])
    return normalise_dates(typed, zone)


def normalise_dates(df: DataFrame, zone: str | None = None, column: str = "date") -> DataFrame:
    """Text with offset to a date; unparsable rows are dropped.

    ``zone=None`` takes the UTC date. With a zone the date is the exchange-local one, which
    keeps local midnights on their own day.
    """
    moment = F.try_to_timestamp(F.col(column))
    here = F.lit(zone or "UTC")
    local = F.convert_timezone(F.current_timezone(), here, moment.cast("timestamp_ntz"))
    return df.withColumn(column, F.to_date(local)).dropna(subset=[column])


def input_listing(df: DataFrame) -> list[str]:
    """Files behind a frame."""
    return df.inputFiles()


def rows_per_file(df: DataFrame) -> DataFrame:
    """Row count of each input file."""
    return df.groupBy(F.input_file_name().alias("file")).agg(F.count(F.lit(1)).alias("n_rows"))


def with_arrival(df: DataFrame, name: str = "arrived") -> DataFrame:
    """Rows with the time their file was written, a revision for :func:`barloom.operators.clean.dedupe`. For tables
    read from files, before anything else is done to them."""
    return df.withColumn(name, F.col("_metadata.file_modification_time"))
