"""Ticks to bars (S18): one partial + final aggregate per (code, bucket)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def bars_from_ticks(
    ticks: DataFrame, code: str, time: str, price: Column | str, volume: Column,
    every: str = "15 minutes", rank: Column | None = None, count: str | None = None,
) -> DataFrame:
    """Open/high/low/close/volume bars.

    ``rank`` orders ticks within a bucket (default: ``time``) and must decide the price for open
    and close to be deterministic. A numeric or time rank keeps the aggregation hashed; a struct
    works too but makes Spark sort every input partition. ``every='1 day'`` yields a ``date``
    column, anything else a ``timestamp`` column. ``count`` names a column for the number of ticks. Works on
    streams as well.
    """
    rank = F.col(time) if rank is None else rank
    daily = every == "1 day"
    bucket = F.to_date(time).alias("date") if daily else F.window(time, every).alias("_w")
    price = F.col(price) if isinstance(price, str) else price
    slim = ticks.select(
        F.col(code).alias("code"), F.col(time), price.alias("_price"), volume.alias("_volume"),
        rank.alias("_rank"))
    bars = slim.groupBy("code", bucket).agg(
        F.min_by("_price", "_rank").alias("open"),
        F.max("_price").alias("high"),
        F.min("_price").alias("low"),
        F.max_by("_price", "_rank").alias("close"),
        F.sum("_volume").alias("volume"),
        *([F.count(F.lit(1)).alias(count)] if count else []),
    )
    when = F.col("date") if daily else F.col("_w.start").alias("timestamp")
    return bars.select("code", when, "open", "high", "low", "close", "volume", *([count] if count else []))
