"""Write-ahead log of the batches that a table of bars takes.

Before a batch changes the table, two things are on disk under the batch's number: its redo rows, which are the
complete new content of every partition it touches, and its entry, the list of those partitions. After its
last write the batch is closed. A crash in between leaves an open batch, and whoever comes next finishes it from its
redo rows first: replacing partitions by their complete content can be repeated any number of times, also after
a replacement that stopped between deleting a partition and moving its new files in. An open batch's
partitions are carried over into the next entry, so whatever is derived from changed partitions sees them too.

One writer at a time, as for the table itself. Numbers count up from 1; the entries are small (a row per calendar
partition) and stay, the redo rows go when the batch is closed.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import delete_path, stage
from barloom.sources import writers


class ChangeLog:
    """The log at ``path`` of a table partitioned by the column ``part``."""

    def __init__(self, spark: SparkSession, path: str, part: T.StructField):
        self.spark, self.path = spark, path
        self.schema = T.StructType([T.StructField("part", part.dataType), T.StructField("updated", T.TimestampType()),
                                    T.StructField("batch", T.IntegerType())])

    def _numbers(self, folder: str) -> list[int]:
        names = writers.list_names(self.spark, folder)
        return sorted(int(n.removeprefix("batch=")) for n in names if n.removeprefix("batch=").isdigit())

    def _redo(self, number: int) -> str:
        return f"{self.path}_redo/batch={number}"

    def open_batches(self) -> list[int]:
        """Batches that were begun and not closed; closing one closes all before it."""
        closed = max(self._numbers(f"{self.path}_closed"), default=0)
        return [n for n in self._numbers(self.path) if n > closed]

    def entries(self, batches: Sequence[int] | None = None) -> DataFrame:
        """``part, updated, batch``: the partitions of these batches, or of all."""
        if not writers.path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], self.schema)
        found = self.spark.read.schema(self.schema).parquet(self.path)
        return found if batches is None else found.where(F.col("batch").isin(list(batches)))

    def pending_since(self) -> datetime | None:
        """Refresh time of the newest open batch."""
        return self.entries(self.open_batches()).agg(F.max("updated")).first()[0]

    def begin(self, touched: DataFrame, updated: datetime | None, rows: DataFrame | None = None) -> int:
        """Open a batch that touches the partitions in ``touched``; ``rows`` are their complete new content."""
        open_ = self.open_batches()
        number = max(self._numbers(self.path), default=0) + 1
        if rows is not None:
            writers.write_parquet(rows, self._redo(number))
        parts = touched.select("part").unionByName(self.entries(open_).select("part")).distinct()
        entry = stage(parts.withColumn("updated", F.lit(updated).cast("timestamp")), "entry")
        writers.write_parquet(entry, f"{self.path}/batch={number}")
        return number

    def redo_rows(self, number: int) -> DataFrame | None:
        path = self._redo(number)
        return self.spark.read.parquet(path) if writers.path_exists(self.spark, f"{path}/_SUCCESS") else None

    def apply(self, number: int, table: str) -> None:
        """Replace the partitions of a batch in the table by its redo rows."""
        rows = self.redo_rows(number)
        if rows is not None:
            writers.overwrite_partitions(rows, table)

    def recover(self, table: str) -> bool:
        """Finish what open batches began in the table; whether there were any."""
        open_ = self.open_batches()
        for number in open_:
            self.apply(number, table)
        return bool(open_)

    def close(self, number: int) -> None:
        """All writes of the batch are done, and those of the batches before it."""
        writers.create_empty(self.spark, f"{self.path}_closed/{number}")
        for name in writers.list_names(self.spark, f"{self.path}_closed"):
            if name != str(number):
                delete_path(self.spark, f"{self.path}_closed/{name}")
        delete_path(self.spark, f"{self.path}_redo")
