"""Exponential mean with ``adjust=False`` semantics as window sums over blocks.

Each valid row maps the previous mean y to ``A*y + B`` with ``A = d/(d+a)``,
``B = a*x/(d+a)``, ``d = (1-a)**gap``. Inside a block, with ``L`` the running sum of
``-ln A``, this unrolls to ``y = exp(-L) * (y_in + S)`` where ``S`` is the running sum of
``B * exp(L)``: two window sums, no recursion. ``y_in`` is the mean at the end of the
previous block and comes from a scan over one row per block.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.series import BLOCK, DAILY, Fold, Series, plain, scanned

# exp() leaves the double range beyond this exponent.
EXPONENT_RANGE = 700.0
# A gap this long (in log weight) leaves 4e-44 of the old mean; longer ones count as this.
FORGOTTEN = 100.0
# Blocks per span in the two-level scan over block ends.
SPAN_BLOCKS = 1024

Specs = Mapping[str, tuple[str, float]]


def _alpha(span: float) -> float:
    if span <= 1:
        raise ValueError("span must be above 1")
    return 2.0 / (span + 1.0)


def _checked(exponent: Column) -> Column:
    message = F.lit("block too long for this span: lower Series.block_rows or check the time grid")
    return F.when(exponent <= EXPONENT_RANGE, exponent).otherwise(F.raise_error(message).cast("double"))


def _gaps(df: DataFrame, s: Series, cols: list[str]) -> DataFrame:
    """Row distance from each valid row to the previous valid row (1 for the first)."""
    b = df.withColumn("_rn", F.row_number().over(s.local))
    valid = {c: F.when(F.col(c).isNotNull(), F.col("_rn")) for c in cols}
    summary = b.groupBy(*s.block_keys).agg(
        F.count(F.lit(1)).alias("_cnt"), *[F.max(valid[c]).alias(f"_lv_{c}") for c in cols])
    offset = scanned(summary, s, {"_off": Fold("sum", "_cnt")}).withColumn("_off", F.coalesce("_off", F.lit(0)))
    offset = offset.withColumns({f"_lv_{c}": F.col("_off") + F.col(f"_lv_{c}") for c in cols})
    states = scanned(offset, s, {f"_last_{c}": Fold("max", f"_lv_{c}") for c in cols}).select(
        *s.block_keys, "_off", *[F.col(f"_last_{c}").alias(f"_lv_{c}") for c in cols])
    b = b.withColumns({
        f"_pv_{c}": F.max(valid[c]).over(s.local.rowsBetween(Window.unboundedPreceding, -1))
        for c in cols})
    j = b.join(states, s.block_keys, "left")
    here = F.col("_off") + F.col("_rn")
    j = j.withColumns({
        f"_gap_{c}": F.when(F.col(c).isNotNull(), F.coalesce(
            here - F.coalesce(F.col("_off") + F.col(f"_pv_{c}"), F.col(f"_lv_{c}")), F.lit(1)))
        for c in cols})
    return j.drop("_rn", "_off", *[f"_lv_{c}" for c in cols], *[f"_pv_{c}" for c in cols])


def ema_local(df: DataFrame, specs: Specs, s: Series = DAILY, gaps: bool = True) -> DataFrame:
    """Add each mean's in-block pieces; needs no other block. ``gaps=False`` asserts that
    NULLs occur only before the first value (filled data) and saves the gap pass.

    The last row of a block carries the block's totals and is flagged ``_end``, so that the
    scan over blocks is a filter rather than another aggregation.
    """
    b = s.blocked(df)
    cols = sorted({c for c, _ in specs.values()})
    upto = s.local.rowsBetween(Window.unboundedPreceding, 0)
    helpers: list[str] = []
    end = F.lead(F.lit(1)).over(s.local).isNull()
    marks = {
        "_end": end,
        **{f"_first_{c}": F.when(end, F.first(c, ignorenulls=True).over(upto)) for c in cols},
    }
    if gaps:
        b = _gaps(b, s, cols)
        steps = {}
        for name, (c, span) in specs.items():
            a = _alpha(span)
            grow = F.least(F.col(f"_gap_{c}") * F.lit(-math.log(1 - a)), F.lit(FORGOTTEN))
            steps[f"_step_{name}"] = F.when(F.col(c).isNotNull(), F.log1p(F.lit(a) * F.exp(grow)))
        b = b.withColumns(steps).withColumns(marks | {
            f"_L_{name}": F.coalesce(F.sum(f"_step_{name}").over(upto), F.lit(0.0)) for name in specs})
        # B = (1 - A) * x for every gap, since a/(d+a) = 1 - d/(d+a).
        weight = {name: -F.expm1(-F.col(f"_step_{name}")) for name in specs}
        helpers = [*steps, *[f"_gap_{c}" for c in cols]]
    else:
        b = b.withColumns(marks | {f"_count_{c}": F.count(c).over(upto) for c in cols})
        weight = {name: F.lit(_alpha(span)) for name, (_, span) in specs.items()}
    grown = _exponents(b, specs)
    pieces = {}
    for name, (c, _) in specs.items():
        term = weight[name] * F.col(c) * F.exp(_checked(grown[name]))
        pieces[f"_S_{name}"] = F.coalesce(F.sum(term).over(upto), F.lit(0.0))
    return b.withColumns(pieces).drop(*helpers)


def _exponents(df: DataFrame, specs: Specs) -> dict[str, Column]:
    """Log weight since the block start: stored if gaps were counted, else count * -ln(1 - a)."""
    return {
        name: F.col(f"_L_{name}") if f"_L_{name}" in df.columns
        else F.col(f"_count_{c}") * F.lit(-math.log(1 - _alpha(span)))
        for name, (c, span) in specs.items()}


def _scan(rows: DataFrame, specs: Specs, part: list[str], order: str) -> DataFrame:
    """Within each partition: log weight so far (``_cl_``), first value (``_x0_``) and what the rows
    up to here contribute to the mean (``_share_``), older rows decayed."""
    upto = Window.partitionBy(*part).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    cols = sorted({c for c, _ in specs.values()})
    rows = rows.withColumns({
        **{f"_cl_{n}": F.sum(f"_bl_{n}").over(upto) for n in specs},
        **{f"_x0_{c}": F.first(f"_first_{c}", ignorenulls=True).over(upto) for c in cols},
    })
    history = {}
    for c in cols:
        mine = {n: span for n, (col, span) in specs.items() if col == c}
        # Rows further back weigh exp(-745) or less, which is zero in a double. The frame of the
        # slowest mean of a column covers those of its faster ones.
        slowest = max(mine, key=lambda n: mine[n])
        near = Window.partitionBy(*part).orderBy(f"_cl_{slowest}").rangeBetween(-745, 0)
        history[f"_hist_{c}"] = F.collect_list(
            F.struct(*[F.col(f"_{k}_{n}") for n in mine for k in ("cl", "bt")])).over(near)
    shares = {f"_share_{n}": _share(n, c) for n, (c, _) in specs.items()}
    return rows.withColumns(history).withColumns(shares).drop(*history)


def _share(n: str, c: str) -> Column:
    here = F.col(f"_cl_{n}")
    return F.aggregate(
        f"_hist_{c}", F.lit(0.0),
        lambda total, e: total + e[f"_bt_{n}"] * F.exp(e[f"_cl_{n}"] - here))


def ema_resolve(
    df: DataFrame, specs: Specs, s: Series = DAILY, previous: Mapping[str, str] | None = None,
) -> DataFrame:
    """Turn the pieces into means: scan the block ends in two levels, join the incoming mean back.

    ``previous`` asks for the mean of the row before as well, ``{mean: output}``. It follows
    from the recurrence, ``(y - a*x) / (1 - a)``, and so needs gap-free pieces.
    """
    cols = sorted({c for c, _ in specs.values()})
    grown = _exponents(df, specs)
    ends = df.filter("_end").select(
        *s.block_keys,
        *[grown[n].alias(f"_bl_{n}") for n in specs],
        *[(F.col(f"_S_{n}") * F.exp(-grown[n])).alias(f"_bt_{n}") for n in specs],
        *[f"_first_{c}" for c in cols])
    # Two levels: blocks within a span of blocks, then spans, so one key's blocks never all meet.
    ends = ends.withColumn("_span", F.floor(F.col(BLOCK) / SPAN_BLOCKS))
    inner = _scan(ends, specs, [s.key, "_span"], BLOCK)
    spans = inner.groupBy(s.key, "_span").agg(
        *[F.max(f"_cl_{n}").alias(f"_bl_{n}") for n in specs],
        *[F.max_by(f"_share_{n}", BLOCK).alias(f"_bt_{n}") for n in specs],
        *[F.max_by(f"_x0_{c}", BLOCK).alias(f"_first_{c}") for c in cols])
    in_order = Window.partitionBy(s.key).orderBy("_span")
    starts = _scan(spans, specs, [s.key], "_span").select(
        s.key, "_span",
        *[F.lag(F.col(f"_share_{n}") + F.col(f"_x0_{c}") * F.exp(-F.col(f"_cl_{n}"))).over(in_order)
          .alias(f"_start_{n}") for n, (c, _) in specs.items()])
    placed = inner.join(starts, [s.key, "_span"], "left").withColumns({
        f"_after_{n}": F.col(f"_share_{n}")
        + F.exp(-F.col(f"_cl_{n}")) * F.coalesce(f"_start_{n}", f"_x0_{c}")
        for n, (c, _) in specs.items()})
    in_span = Window.partitionBy(s.key, "_span").orderBy(BLOCK)
    states = placed.select(
        *s.block_keys,
        *[F.coalesce(F.lag(f"_after_{n}").over(in_span), F.col(f"_start_{n}")).alias(f"_in_{n}") for n in specs],
        *[f"_x0_{c}" for c in cols])
    out = df.join(states, s.block_keys, "left")
    results = {}
    for n, (c, _) in specs.items():
        started = F.col(f"_in_{n}").isNotNull() | (grown[n] > 0)
        results[n] = F.when(started, F.exp(-grown[n]) * (F.coalesce(f"_in_{n}", f"_x0_{c}") + F.col(f"_S_{n}")))
    out = out.withColumns(results)
    before = {}
    for n, name in (previous or {}).items():
        c, span = specs[n]
        has = F.col(f"_in_{n}").isNotNull() | (F.col(f"_count_{c}") > 1)
        before[name] = F.when(has, (F.col(n) - _alpha(span) * F.col(c)) / (1 - _alpha(span)))
    drop = [f"_{k}_{n}" for n in specs for k in ("in", "L", "S")]
    drop += [f"_{k}_{c}" for c in cols for k in ("x0", "first", "count")]
    return (out.withColumns(before) if before else out).drop("_end", *drop)


def fitting(s: Series, specs: Specs) -> Series:
    """The series with blocks short enough for the fastest mean to stay in the double range."""
    fastest = max(-math.log(1 - _alpha(span)) for _, span in specs.values())
    return s.with_block_rows(min(s.block_rows, int((EXPONENT_RANGE - FORGOTTEN) / fastest)))


def ema(df: DataFrame, specs: Specs, s: Series = DAILY, gaps: bool = True) -> DataFrame:
    """Exponential means ``{name: (column, span)}`` of any history length."""
    s = fitting(s, specs)
    return plain(ema_resolve(ema_local(plain(df), specs, s, gaps), specs, s))
