"""Samples of a bounded size that a model on the driver is fitted to."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 1 << 31


def hashed_sample(df: DataFrame, columns: Sequence[str], size: int) -> DataFrame:
    """All rows if there are at most ``size``, else about ``size`` rows, chosen by a hash of ``columns``.

    A filter by the share of rows wanted, so tasks send only what is kept (a sort with a limit would
    send ``size`` rows from every task). The same rows come out on every run.
    """
    total = df.count()
    if total <= size:
        return df
    return df.where(F.pmod(F.xxhash64(*columns), F.lit(SLOTS)) < int(SLOTS * 0.97 * size / total))
