"""Ordered operators on a bar series: fills, lags, rolling statistics, positions, running state, sequences."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barloom.operators.series import (
    DAILY, Fold, Series, attach, carry, halo, last_value, looking_back, plain, without_halo,
)
from barloom.session import stage

ROLLING = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max, "sum": F.sum}


def full_frame(fn: str, x: str | Column, k: int, w: WindowSpec) -> Column:
    """Rolling aggregate that is NULL until the frame holds ``k`` non-null values."""
    frame = w.rowsBetween(-(k - 1), 0)
    return F.when(F.count(x).over(frame) == k, ROLLING[fn](x).over(frame))


def rolling(
    df: DataFrame, specs: Mapping[str, tuple[str, str, int]], s: Series = DAILY,
) -> DataFrame:
    """Rolling columns ``{name: (mean|std|min|max|sum, column, k)}``."""
    back = max(k for _, _, k in specs.values()) - 1
    cols = sorted({c for _, c, _ in specs.values()})
    exprs = {name: full_frame(fn, c, k, s.local) for name, (fn, c, k) in specs.items()}
    return plain(looking_back(df, s, back, cols, exprs))


def lag(df: DataFrame, specs: Mapping[str, str], s: Series = DAILY, n: int = 1) -> DataFrame:
    """Value ``n`` rows earlier, ``{name: column}``."""
    exprs = {name: F.lag(c, n).over(s.local) for name, c in specs.items()}
    return plain(looking_back(df, s, n, sorted(set(specs.values())), exprs))


def lead(df: DataFrame, specs: Mapping[str, str], s: Series = DAILY, n: int = 1) -> DataFrame:
    """Value ``n`` rows later."""
    wide = halo(df, s, sorted(set(specs.values())), after=n)
    return plain(without_halo(wide.withColumns(
        {name: F.lead(c, n).over(s.local) for name, c in specs.items()})))


def difference(df: DataFrame, specs: Mapping[str, str], s: Series = DAILY) -> DataFrame:
    """``x - lag(x)``."""
    exprs = {name: F.col(c) - F.lag(c).over(s.local) for name, c in specs.items()}
    return plain(looking_back(df, s, 1, sorted(set(specs.values())), exprs))


def change(x: str, previous: str | Column) -> Column:
    """Relative change; a zero divisor gives NULL, never infinity or an error."""
    return F.try_divide(F.col(x), F.col(previous) if isinstance(previous, str) else previous) - 1


def pct_change(
    df: DataFrame, specs: Mapping[str, str], s: Series = DAILY, filled: bool = False,
) -> DataFrame:
    """``x / lag(x) - 1`` (W9), gaps padded first unless the input is known to be ``filled``."""
    cols = sorted(set(specs.values()))
    out = s.blocked(df)
    padded = {c: f"_pad_{c}" for c in cols}
    if filled:
        out = out.withColumns({p: F.col(c) for c, p in padded.items()})
    else:
        out = forward_fill(out, cols, s, into=padded)
    exprs = {name: change(padded[c], F.lag(padded[c]).over(s.local)) for name, c in specs.items()}
    return plain(looking_back(out, s, 1, list(padded.values()), exprs)).drop(*padded.values())


def lag_fill(df: DataFrame, cols: Sequence[str], s: Series = DAILY) -> DataFrame:
    """``coalesce(x, lag(x))``: bridges single gaps only."""
    exprs = {c: F.coalesce(F.col(c), F.lag(c).over(s.local)) for c in cols}
    return plain(looking_back(df, s, 1, cols, exprs)).select(*df.columns)


def forward_fill(
    df: DataFrame, cols: Sequence[str], s: Series = DAILY, into: Mapping[str, str] | None = None,
) -> DataFrame:
    """Last known value (W2). ``into`` names the output columns, else they are replaced."""
    names = dict(into or {c: c for c in cols})
    b = s.blocked(df).withColumns(
        {f"_loc_{c}": F.last(c, ignorenulls=True).over(s.local) for c in cols})
    out = carry(
        b, s,
        {f"_end_{c}": last_value(c, s.time) for c in cols},
        {f"_in_{c}": Fold("last", f"_end_{c}") for c in cols},
    ).withColumns({names[c]: F.coalesce(f"_loc_{c}", f"_in_{c}") for c in cols})
    keep = df.columns + [n for n in names.values() if n not in df.columns]
    return out.select(*keep)


def position(df: DataFrame, s: Series = DAILY, pos: str = "pos", total: str = "n_rows") -> DataFrame:
    """1-based row position within the key and the key's row count; keeps the block column."""
    b = s.blocked(df).withColumn("_rn", F.row_number().over(s.local))
    out = carry(b, s, {"_cnt": F.count(F.lit(1))}, {"_off": Fold("sum", "_cnt"), total: Fold("sum", "_cnt", whole=True)})
    return out.withColumn(pos, F.col("_rn") + F.coalesce("_off", F.lit(0))).drop("_rn", "_off")


def split_by_position(
    df: DataFrame, s: Series = DAILY, train: float = 0.7, val: float = 0.15, name: str = "split",
) -> DataFrame:
    """Label rows train / val / test by position per key (W11); bounds truncate as ``int(n * ratio)``.
    Keeps the block column."""
    p = position(df, s, "_pos", "_tot")
    n = F.col("_tot")
    # Ratios stay doubles: a DECIMAL 0.7 would move the bound for some n.
    label = (
        F.when(F.col("_pos") <= F.floor(n * F.lit(float(train))), "train")
        .when(F.col("_pos") <= F.floor(n * F.lit(float(train + val))), "val")
        .otherwise("test")
    )
    return p.withColumn(name, label).drop("_pos", "_tot")


# Running aggregates: the same aggregate works on rows, on blocks and across blocks.
_RUNNING = {
    "max": (F.max, F.greatest),
    "min": (F.min, F.least),
    "sum": (F.sum, lambda a, b: F.coalesce(a + b, a, b)),
    "product": (F.product, lambda a, b: F.coalesce(a * b, a, b)),
}


def running(df: DataFrame, specs: Mapping[str, tuple[str, str]], s: Series = DAILY) -> DataFrame:
    """Running ``{name: (max|min|sum|product|last, column)}`` from the start of the key."""
    b = s.blocked(df)
    upto = s.local.rowsBetween(Window.unboundedPreceding, 0)
    local, block, state, final = {}, {}, {}, {}
    for name, (kind, c) in specs.items():
        loc, end, inn = f"_loc_{name}", f"_end_{name}", f"_in_{name}"
        if kind == "last":
            local[loc] = F.last(c, ignorenulls=True).over(upto)
            block[end] = last_value(c, s.time)
            state[inn] = Fold("last", end)
            final[name] = F.coalesce(loc, inn)
        else:
            agg, merge = _RUNNING[kind]
            local[loc] = agg(F.col(c)).over(upto)
            block[end] = agg(F.col(c))
            state[inn] = Fold(kind, end)
            final[name] = merge(F.col(inn), F.col(loc))
    out = carry(b.withColumns(local), s, block, state).withColumns(final)
    return out.drop(*local, *state)


def sequences(
    df: DataFrame, cols: Sequence[str], length: int, s: Series = DAILY, name: str = "window",
    only_full: bool = True,
) -> DataFrame:
    """Array of the last ``length`` rows as structs, oldest first (W12); keeps the block column."""
    back = length - 1
    item = F.collect_list(F.struct(*cols)).over(s.local.rowsBetween(-back, 0))
    out = looking_back(df, s, back, cols, {name: item})
    return out.filter(F.size(name) == length) if only_full else out


def tail(df: DataFrame, n: int, s: Series = DAILY) -> DataFrame:
    """The newest ``n`` rows of each key (W13); Spark trims to ``n`` per key before the shuffle."""
    newest = Window.partitionBy(s.key).orderBy(F.col(s.time).desc())
    return df.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= n).drop("_n")


def latest(df: DataFrame, cols: Sequence[str], s: Series = DAILY) -> DataFrame:
    """The newest row of each key (W18) as one partial + final aggregate."""
    return df.groupBy(s.key).agg(
        F.max(s.time).alias(s.time), *[F.max_by(c, s.time).alias(c) for c in cols])


def ordinal(df: DataFrame, order: Sequence[str], name: str = "STT") -> DataFrame:
    """Global 1..n numbering (W14) without a single-task window.

    Rows are range-sorted and numbered within their partition; the partition
    offsets (one row per partition) are added back.
    """
    ids = stage(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()), "ordinal")
    part, local = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    parts = ids.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_cnt"))
    offsets = parts.select(
        "_part",
        F.coalesce(F.sum("_cnt").over(
            Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    return (
        ids.withColumn("_part", part).join(F.broadcast(offsets), "_part")
        .select((local + F.col("_off") + 1).alias(name), *df.columns)
    )


def enough_history(df: DataFrame, n: int, s: Series = DAILY) -> DataFrame:
    """Rows of keys that have at least ``n`` rows."""
    counts = df.groupBy(s.key).agg(F.count(F.lit(1)).alias("_rows")).filter(F.col("_rows") >= n)
    return attach(df, s, counts).select(*df.columns)

