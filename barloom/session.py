"""Session settings and the shared folder that staged tables are written to."""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_DIR = "spark.checkpoint.dir"
_open = threading.local()
#: folders of sessions on one machine that name none, by application (the setting itself cannot be changed later)
_own_dirs: dict[str, str] = {}
#: names of bucketed tables, by application
_tables: dict[str, list[str]] = {}


def local_session(cores: str = "8", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("barloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    A machine-local folder is used only in local mode and only where the
    setting is missing.
    """
    path = spark.conf.get(CHECKPOINT_DIR, None)
    if not path:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_DIR} to a folder shared by the cluster")
        application = spark.sparkContext.applicationId
        path = _own_dirs.get(application) or _own_dirs.setdefault(application, tempfile.mkdtemp(prefix="barloom-"))
    return path.rstrip("/")


def stage_root(spark: SparkSession) -> str:
    """This application's own folder below the shared one."""
    return f"{shared_dir(spark)}/barloom-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path for intermediate files, never used twice."""
    return f"{stage_root(spark)}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once to the shared folder and read it back as Parquet.

    Used where two branches of a plan need the same costly input. The lineage
    ends at files that outlive any executor, and later readers prune columns.
    Staged tables stay until :func:`clear_stages`, or the end of the :func:`discarding_stages`
    they were made in.
    """
    return _staged(df, label)[0]


def stage_measured(df: DataFrame, label: str = "stage") -> tuple[DataFrame, int]:
    """:func:`stage`, and the bytes that the stored table takes."""
    table, path = _staged(df, label)
    target = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(df.sparkSession._jsc.hadoopConfiguration())
    return table, files.getContentSummary(target).getLength()


def buckets(spark: SparkSession) -> int:
    """Buckets of a table that is staged now, or partitions of rows dealt out for one."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stage_bucketed(df: DataFrame, keys: list[str], order: list[str], label: str = "stage") -> DataFrame:
    """:func:`stage`, with rows of equal ``keys`` in one bucket, sorted by ``keys`` and ``order``.

    Later windows, aggregates and joins on the keys find the rows where they need them and do not shuffle them again. There
    are as many buckets as shuffle partitions; a table that comes out of a shuffle on the keys is written as one
    file a bucket. Bucketing is kept in the catalog, under a name that :func:`clear_stages` drops.
    """
    spark = df.sparkSession
    path, name = scratch_path(spark, label), f"barloom_{uuid.uuid4().hex}"
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    _tables.setdefault(spark.sparkContext.applicationId, []).append(name)
    # Measurements hardly repeat: looking each up in a dictionary that is dropped when full costs more than it saves.
    plain = {f"parquet.enable.dictionary#{f.name}": "false" for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    df.write.options(**plain).bucketBy(buckets(spark), *keys).sortBy(*keys, *order).option("path", path).saveAsTable(name)
    return spark.read.table(name)


def _staged(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if getattr(_open, "paths", None) is not None:
        _open.paths.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def delete_path(spark: SparkSession, path: str) -> None:
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@contextmanager
def discarding_stages(spark: SparkSession) -> Iterator[None]:
    """Delete what this thread stages inside, for work whose results are written by its end, such as
    a micro-batch of a stream that never stops."""
    outer, _open.paths = getattr(_open, "paths", None), []
    try:
        yield
    finally:
        for path in _open.paths:
            delete_path(spark, path)
        _open.paths = outer


def clear_stages(spark: SparkSession) -> None:
    """Delete what this application staged, once its results are written elsewhere."""
    for name in _tables.pop(spark.sparkContext.applicationId, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    delete_path(spark, stage_root(spark))
