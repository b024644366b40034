"""Scalar helpers on columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_key(code: str | Column) -> Column:
    """Code as a file-safe key: ``.VN`` becomes ``_VN`` and ``^`` goes."""
    return F.replace(F.replace(F.col(code) if isinstance(code, str) else code, F.lit(".VN"), F.lit("_VN")),
                     F.lit("^"), F.lit(""))


def next_day(date: str | Column) -> Column:
    return F.date_add(date, 1)


def iso_date(date: str | Column) -> Column:
    return F.date_format(date, "yyyy-MM-dd")
