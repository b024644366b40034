"""Exact quantiles per key that never sort a whole key in one task."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.session import stage

# Bins per factor of two of the absolute value, and the smallest magnitude told apart.
BINS_PER_OCTAVE = 4096
SMALLEST = 2.0 ** -60
# Distinct values of a bin that one task may rank, and into how many a larger bin is split.
RANKED = 1 << 16
SPLIT = 4096


def _bin(x: Column) -> Column:
    """Monotone bin number that needs no statistics of the data."""
    size = F.floor(F.log2(1 + F.abs(x) / F.lit(SMALLEST)) * BINS_PER_OCTAVE).cast("long")
    return F.when(x < 0, -size).otherwise(size)


def _wanted(probs: Mapping[str, float]) -> Column:
    """The ranks wanted of each key: floor and ceiling of q * (n - 1), zero-based."""
    return F.array(*[
        f(F.lit(float(q)) * (F.col("_total") - 1)).cast("long")
        for q in probs.values() for f in (F.floor, F.ceil)])


def _holds_a_rank(probs: Mapping[str, float]) -> Column:
    return F.exists(_wanted(probs), lambda r: (r >= F.col("_below")) & (r < F.col("_below") + F.col("_m")))


def located(df: DataFrame, key: str, value: str, probs: Mapping[str, float], ranked: int = RANKED) -> DataFrame:
    """The distinct values ``_x`` with counts ``_n`` of the bins that hold a wanted rank, with the rows ``_below`` the bin and
    the ``_total`` of the key; no bin has more than ``ranked`` of them. Stored.

    A bin with more is split evenly between its least and its greatest value, and only the parts that hold a wanted rank go
    on. A part is ``SPLIT`` times narrower, so after a few rounds doubles have no more values to offer.
    """
    x = F.col(value) + F.lit(0.0)  # folds -0.0 into 0.0
    # The key filters are those the join below adds to one side; with them on both sides the
    # shuffled counts are the same exchange and Spark runs it once.
    counts = (
        df.filter(F.col(value).isNotNull() & F.col(key).isNotNull()).select(key, x.alias("_x"))
        .withColumn("_bin", _bin(F.col("_x"))).filter(F.col("_bin").isNotNull())
        .groupBy(key, "_bin", "_x").agg(F.count(F.lit(1)).alias("_n")))
    along = Window.partitionBy(key).orderBy("_bin")
    bins = (
        counts.groupBy(key, "_bin").agg(F.sum("_n").alias("_m"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        .withColumns({
            "_below": F.coalesce(
                F.sum("_m").over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
            "_total": F.sum("_m").over(Window.partitionBy(key)),
        }))
    needed = bins.filter(_holds_a_rank(probs)).drop("_m")
    held = stage(counts.join(needed, [key, "_bin"]), "quantile-bins")
    while True:
        sizes = held.filter(F.col("_lo") < F.col("_hi")).groupBy(key, "_bin").agg(F.count(F.lit(1)).alias("_values"))
        large = sizes.filter(F.col("_values") > ranked).select(key, "_bin")
        if large.isEmpty():
            return held
        part = F.least(F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * SPLIT), F.lit(SPLIT - 1))
        rows = held.join(large, [key, "_bin"], "left_semi").withColumn("_part", part)
        within = Window.partitionBy(key, "_bin").orderBy("_part")  # SPLIT rows at most
        parts = rows.groupBy(key, "_bin", "_part", "_total", F.col("_below").alias("_start")).agg(
            F.sum("_n").alias("_m"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
        parts = parts.withColumn("_below", F.col("_start") + F.coalesce(
            F.sum("_m").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
        parts = parts.filter(_holds_a_rank(probs)).drop("_m", "_start")
        split = rows.select(key, "_bin", "_part", "_x", "_n").join(parts, [key, "_bin", "_part"]).withColumn("_bin", F.xxhash64("_bin", "_part"))
        held = stage(held.join(large, [key, "_bin"], "left_anti").unionByName(split.select(held.columns)), "quantile-bins")


def exact_quantiles(df: DataFrame, key: str, value: str, probs: Mapping[str, float], ranked: int = RANKED) -> DataFrame:
    """Linear-interpolation quantiles, one row per key, ``{output name: probability}``.

    Values are counted per (key, value) and per logarithmic bin. The bin counts of a key
    (bounded by the double range) locate the two ranks each quantile needs; only values of
    those bins are ranked, after bins with many distinct values were split (:func:`located`). NULLs are ignored.
    """
    held = located(df, key, value, probs, ranked)
    in_bin = Window.partitionBy(key, "_bin").orderBy("_x")
    ranked_rows = held.withColumn(
        "_first", F.col("_below") + F.coalesce(
            F.sum("_n").over(in_bin.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    picks = {}
    for i, (name, q) in enumerate(probs.items()):
        exact = F.lit(float(q)) * (F.col("_total") - 1)
        for side, f in (("lo", F.floor), ("hi", F.ceil)):
            rank = f(exact).cast("long")
            hit = (rank >= F.col("_first")) & (rank < F.col("_first") + F.col("_n"))
            picks[f"_{side}{i}"] = F.max(F.when(hit, F.col("_x")))
    found = ranked_rows.groupBy(key).agg(
        F.max("_total").alias("_total"), *[c.alias(n) for n, c in picks.items()])
    result = []
    for i, (name, q) in enumerate(probs.items()):
        exact = F.lit(float(q)) * (F.col("_total") - 1)
        share = exact - F.floor(exact)
        result.append((F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * share).alias(name))
    return found.select(key, *result)
