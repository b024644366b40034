"""Sinks: CSV exports, catalog tables, idempotent upsert, report files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.session import delete_path, stage


# Partition values that a batch may bring to the driver: 270 years of days.
MAX_PARTITIONS = 100_000


def write_csv(df: DataFrame, path: str, mode: str = "overwrite", single_file: bool = False) -> None:
    """CSV with header (S8, S9). ``single_file`` is for small exports: one task writes everything."""
    (df.coalesce(1) if single_file else df).write.mode(mode).option("header", True).csv(path)


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition value before a partitioned write, so that the number of
    files does not grow with tasks times partitions. Adaptive execution splits large partitions
    over several tasks and merges small ones."""
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def write_parquet(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite",
) -> None:
    writer = gathered(df, partition_by).write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition: str = "part") -> None:
    """Replace only the partitions that occur in ``df``."""
    (gathered(df, [partition]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition).parquet(path))


def create_database(spark: SparkSession, name: str) -> None:
    """S14."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{name}`")


def save_table(
    df: DataFrame, name: str, path: str | None = None, mode: str = "overwrite",
    partition_by: Sequence[str] = (), fmt: str = "parquet",
) -> None:
    """Catalog table, at an external path if given."""
    writer = gathered(df, partition_by).write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def drop_table(spark: SparkSession, name: str, delete_data: bool = False) -> None:
    """Drop a table (S15). Files of an external table stay unless ``delete_data`` is asked for."""
    location = None
    if delete_data and spark.catalog.tableExists(name):
        rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").filter(F.col("col_name") == "Location")
        found = rows.first()
        location = found["data_type"] if found else None
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if location:
        delete_path(spark, location)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if there is no such folder."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [f.getPath().getName() for f in files.listStatus(target)] if files.exists(target) else []


def create_empty(spark: SparkSession, path: str) -> None:
    """An empty file as a mark; one that is there already stays."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).createNewFile(target)


def merge_rows(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """New rows plus the old rows whose key is not among them (ST4)."""
    return new.unionByName(old.join(new.select(*keys), list(keys), "left_anti"))


def touched_partitions(spark: SparkSession, path: str, rows: DataFrame, partition: str = "part") -> DataFrame:
    """The stored rows of the partitions that ``rows`` fall into.

    Only the distinct partition values (calendar days or years) come to the driver, where they
    become a literal filter, so the scan lists and reads those directories alone.
    """
    values = [r[0] for r in rows.select(partition).distinct().limit(MAX_PARTITIONS + 1).collect()]
    if len(values) > MAX_PARTITIONS:
        raise ValueError(f"a batch may touch {MAX_PARTITIONS} partitions; choose a coarser {partition!r}")
    return spark.read.parquet(path).filter(F.col(partition).isin(values))


def merged_partitions(
    new: DataFrame, path: str, keys: Sequence[str] = ("code", "date"), partition: str = "part",
) -> DataFrame:
    """What the partitions that ``new`` falls into hold after an upsert of it."""
    old = touched_partitions(new.sparkSession, path, new, partition)
    return merge_rows(old.select(*new.columns), new, keys)


def upsert(
    new: DataFrame, path: str, keys: Sequence[str] = ("code", "date"), partition: str = "part",
) -> None:
    """Replace rows by key in a partitioned Parquet table; applying a batch twice changes nothing (ST4).

    Only partitions the batch touches are read and rewritten. The merged rows are staged in the
    shared folder first, because the job reads the partitions it overwrites. ``new`` must hold
    one row per key, be cheap to read twice, and the partition column must be a function of the key.
    """
    spark = new.sparkSession
    if not path_exists(spark, path):
        write_parquet(new, path, [partition])
        return
    overwrite_partitions(stage(merged_partitions(new, path, keys, partition), "merged"), path, partition)


def write_report(df: DataFrame, path: str, digits: int = 4) -> None:
    """Result table with doubles rounded for export."""
    kinds = dict(df.dtypes)
    write_csv(df.select(*[
        F.round(c, digits).alias(c) if kinds[c] == "double" else F.col(c) for c in df.columns]), path)
