"""Bar tables derived from the given tables; the oracle SQL derives the same ones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.operators.series import DAILY, halo, plain, without_halo
from barloom.operators.windows import change
from barloom.session import stage
from barloom.sources.ticks import bars_from_ticks

PRICES = ["open", "high", "low", "close"]
def unit_price() -> Column:
    return F.col("l_extendedprice") / F.col("l_quantity")


def line_rank() -> Column:
    """Order of line items within a ship date: order key, line number, then unit price.

    One DECIMAL, so that bars are built by hash aggregation. The line key takes the leading
    digits and the price, in millionths, the last 13: prices are cents over a whole quantity of
    at most 50, so two different ones are at least four millionths apart.
    """
    line = (F.col("l_orderkey") * 16 + F.col("l_linenumber")).cast("decimal(20,0)")
    millionths = F.floor(unit_price() * 1e6).cast("decimal(13,0)")
    return line * F.lit(10**13).cast("decimal(15,0)") + millionths


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bars_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars of unit prices per return flag."""
    return bars_from_ticks(
        table(spark, sf_dir, "lineitem"), "l_returnflag", "l_shipdate", unit_price(), F.col("l_quantity"),
        "1 day", line_rank())


def bars_by_supplier(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Daily bars of unit prices per supplier: many codes with short, gappy histories. Stored, in full or with ``columns``."""
    lines = table(spark, sf_dir, "lineitem").withColumn("supplier", F.col("l_suppkey").cast("string"))
    bars = bars_from_ticks(lines, "supplier", "l_shipdate", unit_price(), F.col("l_quantity"), "1 day", line_rank())
    return stage(bars.select("code", "date", *columns) if columns else bars, "suppliers")


def bars_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    """15-minute bars of event values per event type."""
    return bars_from_ticks(
        table(spark, sf_dir, "events"), "event_type", "ts", "value", F.lit(1).cast("double"))


def staged_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily bars as a stored table, the way the cleaned layer holds them."""
    return stage(bars_day(spark, sf_dir), "day")


def staged_intraday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stage(bars_intraday(spark, sf_dir), "intraday")


def with_nulls(bars: DataFrame) -> DataFrame:
    """Dirt rule: all prices missing on two days in 17, the close also on one in 29."""
    day = F.unix_date("date")
    hole = (day % 17).isin(0, 1)
    out = bars.withColumns({c: F.when(~hole, F.col(c)) for c in PRICES})
    return out.withColumn("close", F.when(day % 29 != 3, F.col("close")))


def with_copies(bars: DataFrame) -> DataFrame:
    """Dirt rule: exact copies of one day in 7, and a second close on one day in 11."""
    day = F.unix_date("date")
    again = bars.filter(day % 7 == 0)
    other = bars.filter(day % 11 == 0).withColumn("close", F.col("close") + 1)
    return bars.unionByName(again).unionByName(other)


def dirty_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_copies(with_nulls(staged_day(spark, sf_dir)))


def code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code list with one code missing and one listed twice."""
    codes = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("code"), "l_linestatus")
    listed = codes.filter(F.col("code") != "R").filter((F.col("code") != "N") | (F.col("l_linestatus") == "O"))
    return listed.distinct().select("code", F.concat_ws("_", F.lit("type"), "l_linestatus").alias("type"))


def outcomes(bars: DataFrame) -> DataFrame:
    """Rows with current and next change, a true class and a signal from the volume."""
    wide = halo(bars, DAILY, ["close", "volume"], before=1, after=1)
    w = DAILY.local
    out = without_halo(wide.withColumns({
        "close_pct_change": change("close", F.lag("close").over(w)),
        "volume_change": F.col("volume") / F.lag("volume").over(w) - 1,
        "next_price": F.lead("close").over(w),
    })).withColumn("target_pct_change", F.try_divide("next_price", "close") - 1)
    out = plain(out).dropna(subset=["close_pct_change", "target_pct_change"])

    def three_way(x: str, edge: float):
        return F.when(F.col(x) > edge, 2).when(F.col(x) < -edge, 0).otherwise(1)

    return out.select(
        "code", "date", F.col("close").alias("price"), "next_price", "close_pct_change", "target_pct_change",
        three_way("target_pct_change", 0.1).alias("actual"),
        three_way("volume_change", 0.3).alias("signal"))


# Moves values off exact decimal ties, which the two engines round differently.
OFF_TIES = 1.0 + 1e-11


def sig(x: Column) -> Column:
    """Seven significant digits, for values whose size varies by orders of magnitude."""
    return F.format_string("%.6e", x * OFF_TIES).cast("double")


# Powers of ten that a double holds exactly.
TENS = [10.0 ** k for k in range(23)]
# More columns than this make a method too long to be compiled.
MOST = 9


def sig_all(df: DataFrame, names: list[str], digits: int | None = None, rounded: list[str] | None = None) -> DataFrame:
    """:func:`sig` of columns ``names``, and those ``rounded`` to ``digits`` places, with the same doubles as by text.

    A whole number of few digits over a power of ten that a double holds exactly is the double nearest to that decimal,
    so the digits need no text. Text decides what lies close to a tie or out of that range. Each step is a projection of
    its own: in one expression Spark would repeat the inner ones, and Java does not compile long methods.
    """
    rounded = rounded or []
    x, power, scaled, whole = ({n: f"_{k}_{n}" for n in [*names, *rounded]} for k in ("x", "power", "scaled", "whole"))
    tens = F.array(*map(F.lit, TENS))
    steps = df.withColumns({x[n]: F.col(f"`{n}`") * OFF_TIES for n in x})
    steps = steps.withColumns({power[n]: F.get(tens, (6 - F.floor(F.log10(F.abs(x[n])))).try_cast("int")) for n in names})
    steps = steps.withColumns({scaled[n]: F.col(x[n]) * (F.lit(10.0 ** digits) if n in rounded else F.col(power[n])) for n in x})
    steps = steps.withColumns({whole[n]: F.rint(scaled[n]) for n in x})
    off_tie = {n: F.abs(F.col(scaled[n]) - F.col(whole[n])) < 0.499999 for n in x}
    done = {n: F.when(off_tie[n], F.try_divide(whole[n], power[n])).otherwise(F.format_string("%.6e", x[n]).try_cast("double")) for n in names}
    for n in rounded:
        # a sum with zero has no negative zero
        done[n] = F.when(off_tie[n] & (F.abs(scaled[n]) < 1e9), F.col(whole[n]) / F.lit(10.0 ** digits) + 0.0).otherwise(F.round(x[n], digits))
    return steps.withColumns(done).select(*[f"`{c}`" for c in df.columns])


def shaped(df: DataFrame, digits: int | None = None, sigs: tuple[str, ...] = ()) -> DataFrame:
    """Plain comparable types: dates and times as text, integers as bigint, doubles rounded."""
    doubles = [f.name for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)]
    exact = [n for n in doubles if n in sigs or "*" in sigs]
    rounded = [n for n in doubles if n not in exact and digits is not None]
    few = 0 < len(exact) and len(exact) + len(rounded) <= MOST
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif isinstance(f.dataType, T.IntegerType):
            c = c.cast("long")
        elif f.name in doubles and not few:
            if f.name in exact:
                c = F.when(c.isNotNull(), sig(c))
            elif f.name in rounded:
                c = F.round(c * OFF_TIES, digits)
        cols.append(c.alias(f.name))
    return (sig_all(df, exact, digits, rounded) if few else df).select(*cols)
