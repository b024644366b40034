"""Technical indicators on a bar series, composed from the window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom.operators.ema import ema_local, ema_resolve, fitting
from barloom.operators.series import BLOCK, DAILY, Series, halo, plain, without_halo
from barloom.operators.windows import full_frame
from barloom.session import buckets, stage_bucketed

# Smoothing guard, and the indicator columns in output order.
GUARD = 1e-9
INDICATORS = [
    "SMA_10", "EMA_10", "RSI_14", "MACD", "BB_upper", "BB_lower", "ATR_14", "ADX_14", "STOCHk_14_3_3",
]
# The longest look-back of the rolling part is 20 rows.
ROLLING_REACH = 19


def _step(x: str, s: Series) -> Column:
    return F.col(x) - F.lag(x).over(s.local)


def true_range(s: Series = DAILY) -> Column:
    """Largest of the three ranges; NULL parts are skipped, so the first row is high - low."""
    before = F.lag("close").over(s.local)
    return F.greatest(
        F.col("high") - F.col("low"), F.abs(F.col("high") - before), F.abs(F.col("low") - before))


def _rolling_level(s: Series) -> list[dict[str, Column]]:
    """Column levels; each level only uses columns of earlier ones."""
    w = s.local
    close_step, high_step, low_step = (_step(c, s) for c in ("close", "high", "low"))
    first = {
        "SMA_10": full_frame("mean", "close", 10, w),
        "_sma20": full_frame("mean", "close", 20, w),
        "_std20": full_frame("std", "close", 20, w),
        "_gain": F.coalesce(F.greatest(close_step, F.lit(0.0)), F.lit(0.0)),
        "_loss": F.coalesce(F.greatest(-close_step, F.lit(0.0)), F.lit(0.0)),
        "_low14": full_frame("min", "low", 14, w),
        "_high14": full_frame("max", "high", 14, w),
        "_tr": true_range(s),
        "_dh": high_step,
        "_dl": low_step,
    }
    k = 100 * ((F.col("close") - F.col("_low14")) / (F.col("_high14") - F.col("_low14") + GUARD))
    second = {
        "BB_upper": F.col("_sma20") + F.col("_std20") * 2,
        "BB_lower": F.col("_sma20") - F.col("_std20") * 2,
        "RSI_14": 100 - 100 / (1 + full_frame("mean", "_gain", 14, w) / (full_frame("mean", "_loss", 14, w) + GUARD)),
        "STOCHk_14_3_3": full_frame("mean", k, 3, w),
        # A NULL step must stay NULL: a zero would start the mean one row early.
        "_pdm": F.when(F.col("_dh") < 0, 0.0).otherwise(F.col("_dh")),
        "_mdm": F.when(F.col("_dl") > 0, 0.0).otherwise(F.col("_dl")),
    }
    return [first, second]


PARTS = ["_sma20", "_std20", "_gain", "_loss", "_low14", "_high14", "_dh", "_dl"]
# Columns whose previous value the rolling pass can look up itself.
NEIGHBOURS = ["open", "high", "low", "close", "volume", "SMA_10", "BB_upper", "BB_lower"]


def _rolled(df: DataFrame, s: Series, neighbours: bool = False) -> DataFrame:
    """Rolling part of the indicators with the inputs of ATR and ADX, in one shuffle."""
    if neighbours:
        wide = halo(df, s, ["open", "high", "low", "close", "volume"], before=ROLLING_REACH + 1, after=1)
    else:
        wide = halo(df, s, ["high", "low", "close"], before=ROLLING_REACH)
    # As many tasks as buckets: rows get several times as wide below, so few large partitions would sort for long.
    wide = wide.repartition(buckets(df.sparkSession), *s.block_keys)
    levels = _rolling_level(s)
    if neighbours:
        levels.append({f"prev_{c}": F.lag(c).over(s.local) for c in NEIGHBOURS} | {"next_close": F.lead("close").over(s.local)})
    for level in levels:
        wide = wide.withColumns(level)
    return without_halo(wide).drop(*PARTS)


def rolling_indicators(df: DataFrame, s: Series = DAILY) -> DataFrame:
    """SMA, RSI, Bollinger bands and stochastic."""
    return plain(_rolled(df, s)).drop("_tr", "_pdm", "_mdm")


def add_indicators(
    bars: DataFrame, s: Series = DAILY, gaps: bool = False, neighbours: bool = False,
) -> DataFrame:
    """All nine indicator columns.

    ``gaps=False`` expects filled bars (see ``windows.forward_fill``); pass ``gaps=True`` for
    bars with NULL prices inside a series. Rolling parts and the in-block pieces of the first
    means are computed in one shuffle on (code, block) and written once, bucketed by (code, block); the ADX mean is
    resolved from that table, whose rows are not shuffled again. ``neighbours=True`` (filled bars only) adds ``prev_*`` of the price
    and trend columns and ``next_close`` in the same pass.
    """
    if gaps and neighbours:
        raise ValueError("neighbours need filled bars")
    means = {
        "EMA_10": ("close", 10), "_e12": ("close", 12), "_e26": ("close", 26),
        "ATR_14": ("_tr", 14), "_ep": ("_pdm", 14), "_em": ("_mdm", 14),
    }
    s, bars = fitting(s, means), plain(bars)
    before = {"EMA_10": "prev_EMA_10", "_e12": "_pe12", "_e26": "_pe26", "ATR_14": "prev_ATR_14"}
    pieces = ema_local(_rolled(s.blocked(bars), s, neighbours), means, s, gaps).drop("_pdm", "_mdm", *([] if neighbours else ["_tr"]))
    pieces = stage_bucketed(pieces, s.block_keys, [s.time], "indicators")
    known = ema_resolve(pieces, means, s, before if neighbours else None)
    plus = 100 * (F.col("_ep") / (F.col("ATR_14") + GUARD))
    minus = 100 * (F.abs("_em") / (F.col("ATR_14") + GUARD))
    known = known.withColumns({
        "MACD": F.col("_e12") - F.col("_e26"),
        "_dx": 100 * (F.abs(plus - minus) / (plus + minus + GUARD)),
        **({"prev_MACD": F.col("_pe12") - F.col("_pe26")} if neighbours else {}),
    })
    adx = {"ADX_14": ("_dx", 14)}
    out = ema_resolve(ema_local(known, adx, s, gaps), adx, s)
    extra = [f"prev_{c}" for c in [*NEIGHBOURS, "EMA_10", "MACD", "ATR_14"]] + ["next_close", BLOCK]
    return out.select(*bars.columns, *INDICATORS, *([c for c in extra if c not in bars.columns] if neighbours else []))
