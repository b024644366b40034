"""Evaluating trend signals as a long-or-flat strategy against buy and hold.

The position is the last non-neutral signal. Every equity curve is a running product of
per-row growth factors, and drawdown and Sharpe do not depend on its level, so the summary
is two levels of aggregation (blocks, then keys) without replaying the curve.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import DAILY, Fold, Series, carry, last_value, plain, scanned
from barloom.settings import DEFAULT, DOWN, UP, Settings


def growth(df: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> DataFrame:
    """Per-row growth factors and trades.

    Input: key, time, ``price`` (last known close), ``next_price`` (true next close) and
    ``signal`` (0 sell, 1 hold, 2 buy). The last row of a key ignores its signal and closes
    an open position at ``next_price``. Keys with one row are dropped: nothing can be traded.
    """
    keep = cfg.fee
    b = s.blocked(df).withColumn(
        "_wish", F.when(F.col("signal") == UP, 1).when(F.col("signal") == DOWN, 0))
    earlier = s.local.rowsBetween(Window.unboundedPreceding, -1)
    b = b.withColumns({
        "_lw": F.last("_wish", ignorenulls=True).over(earlier),
        "_lp": F.lag("price").over(s.local),
    })
    b = carry(
        b, s,
        {"_bw": last_value("_wish", s.time), "_bp": F.max_by(F.struct("price"), s.time), "_bn": F.count(F.lit(1)),
         "_at": F.max(s.time)},
        {
            "_iw": Fold("last", "_bw"),
            "_ip": Fold("last", "_bp"),  # a struct, so that a missing price is not skipped
            "_end": Fold("max", "_at", whole=True),
            "_n": Fold("sum", "_bn", whole=True),
        }).filter(F.col("_n") >= 2)
    b = b.withColumns({
        "held": F.coalesce("_lw", "_iw", F.lit(0)) == 1,
        "prev_price": F.coalesce("_lp", "_ip.price"),
        "is_last": F.col(s.time) == F.col("_end"),
    })
    state = F.when(F.coalesce(F.col("_wish"), F.col("held").cast("int")) == 1, True).otherwise(False)
    b = b.withColumn("trade", F.when(F.col("is_last"), F.col("held")).otherwise(state != F.col("held")))
    move = F.when(
        F.col("held"),
        F.when(F.col("is_last"), F.col("next_price")).otherwise(F.col("price")) / F.col("prev_price"),
    ).otherwise(1.0)
    cost = F.when(F.col("trade"), 1.0 - keep).otherwise(1.0)
    hold = F.when(F.col("prev_price").isNull(), 1.0 - keep).otherwise(F.col("price") / F.col("prev_price"))
    out = b.withColumns({"model_growth": move * cost, "hold_growth": hold})
    return out.drop("_wish", "_lw", "_lp", "_iw", "_ip", "_end", "_n")


def _levels(blocks: DataFrame, s: Series, top: str, sides: tuple[str, ...] = ("hold", "model")) -> DataFrame:
    """Equity before each block (``_in_``, 1 at the start) and its peak up to there (``_peak_``), where ``top`` names the
    highest equity within a block relative to its start."""
    blocks = blocks.withColumns({f"_in_{x}": F.coalesce(f"_in_{x}", F.lit(1.0)) for x in sides})
    blocks = blocks.withColumns({f"_high_{x}": F.col(f"_in_{x}") * F.col(f"{top}_{x}") for x in sides})
    blocks = scanned(blocks, s, {f"_peak_{x}": Fold("max", f"_high_{x}") for x in sides})
    return blocks.withColumns({f"_peak_{x}": F.greatest(F.lit(1.0), f"_peak_{x}") for x in sides})


def equity_curves(df: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> DataFrame:
    """Row-level equity of both strategies and their running peaks.

    Product and peak of a block travel in one summary and come back in one join.
    """
    upto, sides = s.local.rowsBetween(Window.unboundedPreceding, 0), ("hold", "model")
    rows = growth(df, s, cfg).withColumns({f"_c_{x}": F.product(F.col(f"{x}_growth")).over(upto) for x in sides})
    rows = rows.withColumns({f"_p_{x}": F.max(f"_c_{x}").over(upto) for x in sides})
    blocks = rows.groupBy(*s.block_keys).agg(
        *[F.product(F.col(f"{x}_growth")).alias(f"_end_{x}") for x in sides], *[F.max(f"_c_{x}").alias(f"_top_{x}") for x in sides])
    blocks = _levels(scanned(blocks, s, {f"_in_{x}": Fold("product", f"_end_{x}") for x in sides}), s, "_top")
    out = rows.join(blocks.select(*s.block_keys, *[f"_{k}_{x}" for x in sides for k in ("in", "peak")]), s.block_keys)
    out = out.withColumns({f"{x}_equity": cfg.capital * (F.col(f"_in_{x}") * F.col(f"_c_{x}")) for x in sides} | {
        f"{x}_peak": cfg.capital * F.greatest(F.lit(1.0), F.col(f"_peak_{x}"), F.col(f"_in_{x}") * F.col(f"_p_{x}")) for x in sides})
    return plain(out).drop(*[f"_{k}_{x}" for x in sides for k in ("c", "p", "in", "peak")])


def strategy_summary(df: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> DataFrame:
    """Return, final value, drawdown, Sharpe and trade count per key."""
    rows = growth(df, s, cfg)
    upto = s.local.rowsBetween(Window.unboundedPreceding, 0)
    sides = ("hold", "model")
    rows = rows.withColumns({f"_c_{x}": F.product(F.col(f"{x}_growth")).over(upto) for x in sides})
    rows = rows.withColumns({f"_p_{x}": F.max(f"_c_{x}").over(upto) for x in sides})
    aggs = {
        "_n": F.count(F.lit(1)),
        "_trades": F.sum(F.col("trade").cast("int")),
        "_exit": F.max(F.when(F.col("is_last"), F.col("next_price") / F.col("price"))),
    }
    for x in sides:
        c, p, g = F.col(f"_c_{x}"), F.col(f"_p_{x}"), F.col(f"{x}_growth")
        aggs |= {
            f"_prod_{x}": F.product(g), f"_max_{x}": F.max(c), f"_min_{x}": F.min(c),
            f"_dd_{x}": F.max((p - c) / p), f"_mean_{x}": F.avg(g - 1), f"_var_{x}": F.var_pop(g - 1),
        }
    blocks = rows.groupBy(*s.block_keys).agg(*[c.alias(n) for n, c in aggs.items()])
    blocks = blocks.withColumns({f"_sum_{x}": F.col(f"_mean_{x}") * F.col("_n") for x in sides})
    blocks = scanned(blocks, s, {
        **{f"_in_{x}": Fold("product", f"_prod_{x}") for x in sides},
        **{f"_all_{x}": Fold("sum", f"_sum_{x}", whole=True) for x in sides}, "_rows": Fold("sum", "_n", whole=True)})
    blocks = _levels(blocks, s, "_max").withColumns({f"_avg_{x}": F.col(f"_all_{x}") / F.col("_rows") for x in sides})
    final = {"_n": F.sum("_n"), "model_num_trades": F.sum("_trades"), "_exit": F.max("_exit")}
    for x in sides:
        trough = F.col(f"_in_{x}") * F.col(f"_min_{x}")
        final |= {
            f"_total_{x}": F.product(F.col(f"_prod_{x}")),
            f"{x}_max_drawdown": 100 * F.max(F.greatest(
                F.lit(0.0), F.col(f"_dd_{x}"), (F.col(f"_peak_{x}") - trough) / F.col(f"_peak_{x}"))),
            f"_avg_{x}": F.max(f"_avg_{x}"),
            f"_m2_{x}": F.sum(F.col("_n") * (
                F.col(f"_var_{x}") + F.pow(F.col(f"_mean_{x}") - F.col(f"_avg_{x}"), F.lit(2)))),
        }
    total = blocks.groupBy(s.key).agg(*[c.alias(n) for n, c in final.items()])
    end = {
        "hold": cfg.capital * F.col("_total_hold") * F.col("_exit") * (1 - cfg.fee),
        "model": cfg.capital * F.col("_total_model"),
    }
    out = {}
    for x in sides:
        std = F.sqrt(F.try_divide(F.col(f"_m2_{x}"), F.col("_n") - 1))
        out[f"{x}_return_pct"] = (end[x] / cfg.capital - 1) * 100
        out[f"{x}_final_value"] = end[x]
        out[f"{x}_max_drawdown"] = F.col(f"{x}_max_drawdown")
        out[f"{x}_sharpe_ratio"] = F.coalesce(
            F.try_divide(F.col(f"_avg_{x}"), std) * F.sqrt(F.lit(float(cfg.days_per_year))), F.lit(0.0))
    return total.select(s.key, *[c.alias(n) for n, c in out.items()], "model_num_trades")
