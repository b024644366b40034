"""Training sets: target, label, feature frame, scaling, sequences, splits, class weights."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barloom.operators.indicators import add_indicators
from barloom.operators.quantiles import exact_quantiles
from barloom.operators.series import BLOCK, DAILY, Fold, Series, attach, halo, plain, scanned, without_halo
from barloom.operators.windows import change, enough_history, position, sequences
from barloom.session import stage
from barloom.settings import (
    BASELINE_FEATURES, CHANGE_FEATURES, DEFAULT, DOWN, FEATURES, NEUTRAL, UP, Settings,
)


def first_share(pos: str, n: str, ratio: float) -> Column:
    """Row lies in the leading ``int(n * ratio)`` rows; the ratio is a double on purpose."""
    return F.col(pos) <= F.floor(F.col(n) * F.lit(float(ratio)))


def split_label(pos: Column, n: Column, train: float, val: float) -> Column:
    return (
        F.when(pos <= F.floor(n * F.lit(float(train))), "train")
        .when(pos <= F.floor(n * F.lit(float(train + val))), "val").otherwise("test"))


def next_change(df: DataFrame, s: Series = DAILY, price: str = "close") -> DataFrame:
    """Next row's relative change as ``target_pct_change``; rows without one are dropped (L2)."""
    wide = halo(df, s, [price], after=1)
    target = F.try_divide(F.lead(price).over(s.local), F.col(price)) - 1
    return plain(without_halo(wide.withColumn("target_pct_change", target))).dropna(
        subset=["target_pct_change"])


def trend_bounds(df: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> DataFrame:
    """Label bounds per key from the leading training share of the raw rows."""
    p = position(df, s, "_pos", "_n").filter(first_share("_pos", "_n", cfg.train_ratio))
    return exact_quantiles(
        p, s.key, "target_pct_change",
        {"lower_bound": cfg.lower_quantile, "upper_bound": cfg.upper_quantile})


def trend_label(
    df: DataFrame, bounds: DataFrame, s: Series = DAILY, name: str = "target_trend",
) -> DataFrame:
    """2 above the upper bound, 0 below the lower, else 1 (L3)."""
    labelled = attach(df, s, bounds).withColumn(name, _trend(F.col("target_pct_change")))
    return labelled.drop("lower_bound", "upper_bound")


def _trend(x: Column) -> Column:
    return F.when(x > F.col("upper_bound"), UP).when(x < F.col("lower_bound"), DOWN).otherwise(NEUTRAL)


def feature_frame(bars: DataFrame, s: Series = DAILY) -> DataFrame:
    """The 14 features, target and close of every bar (L2, L4).

    Relative changes need no pass of their own: the indicator pass hands over each row's
    neighbours. ``complete`` marks rows without NULLs; ``_bar``, ``_raw`` and ``_ok`` count bars,
    rows with a target and complete rows within the block.
    """
    ind = add_indicators(bars, s, neighbours=True)
    rows = ind.withColumns({
        **{f"{c}_pct_change": change(c, f"prev_{c}") for c in CHANGE_FEATURES},
        "target_pct_change": F.try_divide("next_close", "close") - 1,
    }).select(s.key, BLOCK, s.time, *FEATURES, "target_pct_change", "close")
    whole = F.lit(True)
    for c in [*FEATURES, "target_pct_change"]:
        whole = whole & F.col(c).isNotNull()
    upto = s.local.rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("complete", whole).withColumns({
        "_bar": F.count(F.lit(1)).over(upto),
        "_raw": F.count("target_pct_change").over(upto),
        "_ok": F.count_if("complete").over(upto),
    })


def block_positions(frame: DataFrame, s: Series = DAILY) -> DataFrame:
    """Per block: rows before it and in its key, for rows with a target and complete rows."""
    ends = frame.groupBy(*s.block_keys).agg(*[F.max(c).alias(c) for c in ("_bar", "_raw", "_ok")])
    found = scanned(ends, s, {
        "n_bars": Fold("sum", "_bar", whole=True), "raw_before": Fold("sum", "_raw"), "n_raw": Fold("sum", "_raw", whole=True),
        "ok_before": Fold("sum", "_ok"), "n_rows": Fold("sum", "_ok", whole=True)})
    return found.select(
        *s.block_keys, "n_bars", F.coalesce("raw_before", F.lit(0)).alias("raw_before"), "n_raw",
        F.coalesce("ok_before", F.lit(0)).alias("ok_before"), "n_rows")


def standard_scaler(
    df: DataFrame, cols: Sequence[str], s: Series = DAILY, train: Column | None = None,
) -> DataFrame:
    """Mean and population std per key over the training rows; zero std becomes 1."""
    rows = df if train is None else df.filter(train)
    std = {c: F.stddev_pop(c) for c in cols}
    return rows.groupBy(s.key).agg(
        *[F.avg(c).alias(f"mean_{c}") for c in cols],
        *[F.when(x == 0, 1.0).otherwise(x).alias(f"std_{c}") for c, x in std.items()])


def min_max_scaler(
    df: DataFrame, cols: Sequence[str], s: Series = DAILY, train: Column | None = None,
) -> DataFrame:
    """Minimum and range per key over the training rows; zero range becomes 1."""
    rows = df if train is None else df.filter(train)
    spread = {c: F.max(c) - F.min(c) for c in cols}
    return rows.groupBy(s.key).agg(
        *[F.min(c).alias(f"min_{c}") for c in cols],
        *[F.when(x == 0, 1.0).otherwise(x).alias(f"range_{c}") for c, x in spread.items()])


def standardise(c: str) -> Column:
    return (F.col(c) - F.col(f"mean_{c}")) / F.col(f"std_{c}")


def unstandardise(x: Column, c: str) -> Column:
    """Inverse of :func:`standardise`."""
    return x * F.col(f"std_{c}") + F.col(f"mean_{c}")


def to_unit(c: str) -> Column:
    return (F.col(c) - F.col(f"min_{c}")) / F.col(f"range_{c}")


def from_unit(x: Column, c: str) -> Column:
    """Inverse of :func:`to_unit`."""
    return x * F.col(f"range_{c}") + F.col(f"min_{c}")


def class_distribution(df: DataFrame, label: str = "target_trend", key: str = "code") -> DataFrame:
    """Share of each class per key."""
    counts = df.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(key)))


def class_weights(train: DataFrame, label: str = "target_trend", key: str = "code") -> DataFrame:
    """Balanced weights n / (k * n_c), k being the classes present (A10)."""
    per_key = Window.partitionBy(key)
    counts = train.groupBy(key, label).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn(
        "class_weight",
        F.sum("n").over(per_key) / (F.count(F.lit(1)).over(per_key) * F.col("n")))


def prepared_rows(
    bars: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT, scaled: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Filled bars to complete feature rows with label, position, row count and scaler (L2-L5);
    returns (rows, stored parameters with a row per block).

    The feature frame is written once. Everything a row needs from elsewhere (its position, its
    key's label bounds and scaler) is gathered in one small table with a row per block, so the
    frame is joined once, on (key, block).
    """
    frame = stage(feature_frame(bars, s), "features")
    blocks = stage(block_positions(frame, s), "positions")
    placed = frame.join(blocks, s.block_keys).withColumns({
        "pos_raw": F.col("raw_before") + F.col("_raw"), "pos": F.col("ok_before") + F.col("_ok")})
    early = placed.filter(
        F.col("target_pct_change").isNotNull() & first_share("pos_raw", "n_raw", cfg.train_ratio))
    params = blocks.join(exact_quantiles(
        early, s.key, "target_pct_change",
        {"lower_bound": cfg.lower_quantile, "upper_bound": cfg.upper_quantile}), s.key)
    if scaled:
        train = placed.filter(F.col("complete") & first_share("pos", "n_rows", cfg.train_ratio))
        params = params.join(standard_scaler(train, [*FEATURES, "target_pct_change"], s), s.key)
    params = stage(params.filter((F.col("n_bars") >= cfg.min_rows) & (F.col("n_rows") >= cfg.window)), "parameters")
    rows = (
        frame.filter("complete").join(params, s.block_keys)
        .withColumns({
            "pos": F.col("ok_before") + F.col("_ok"),
            "target_trend": _trend(F.col("target_pct_change")),
            **({f"z_{c}": standardise(c) for c in [*FEATURES, "target_pct_change"]} if scaled else {}),
        }).drop("complete", "_bar", "_raw", "_ok", "n_bars", "raw_before", "n_raw", "ok_before",
                "lower_bound", "upper_bound"))
    return rows, params


def labelled_features(bars: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> DataFrame:
    """Complete feature rows with label, position and row count per key (L2-L4)."""
    return prepared_rows(bars, s, cfg, scaled=False)[0]


def scaled_features(rows: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """Features and target of labelled rows scaled with training statistics (L5); returns (rows, scaler)."""
    cols = [*FEATURES, "target_pct_change"]
    scaler = standard_scaler(rows, cols, s, first_share("pos", "n_rows", cfg.train_ratio))
    out = attach(rows, s, scaler).withColumns({f"z_{c}": standardise(c) for c in cols})
    return out, scaler


def training_windows(
    bars: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT, exclude_last: bool = True,
) -> DataFrame:
    """Sequence set (L7): 15 scaled feature rows per window with the last row's target, label,
    close and date, and the split by window position (L9).

    ``exclude_last`` leaves out each key's final window, as the published results do.
    """
    return windows_and_scaler(bars, s, cfg, exclude_last)[0]


def windows_and_scaler(
    bars: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT, exclude_last: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """:func:`training_windows` and the scaler they were made with, a row per key."""
    rows, params = prepared_rows(bars, s, cfg)
    scaler = params.select(s.key, *[f"{k}_{c}" for c in [*FEATURES, "target_pct_change"] for k in ("mean", "std")]).distinct()
    slim = rows.select(
        s.key, BLOCK, s.time, "pos", "n_rows", "close", "target_pct_change", "target_trend",
        F.col("z_target_pct_change").alias("target_scaled"),
        F.col("mean_target_pct_change").alias("target_mean"),
        F.col("std_target_pct_change").alias("target_std"),
        *[F.col(f"z_{c}").alias(c) for c in FEATURES])
    seq = sequences(slim, FEATURES, cfg.window, s).drop(*FEATURES)
    return number_windows(seq, cfg, exclude_last), scaler


def number_windows(seq: DataFrame, cfg: Settings = DEFAULT, exclude_last: bool = True) -> DataFrame:
    """Window number, window count and split, derived from row positions without another pass."""
    n = F.col("n_rows") - cfg.window + (0 if exclude_last else 1)
    i = F.col("pos") - cfg.window + 1
    return seq.withColumns({"window_no": i, "n_windows": n}).filter(
        F.col("window_no") <= F.col("n_windows")).withColumn(
        "split", split_label(F.col("window_no"), F.col("n_windows"), cfg.train_ratio, cfg.val_ratio))


def baseline_windows(bars: DataFrame, s: Series = DAILY, cfg: Settings = DEFAULT) -> DataFrame:
    """Baseline sequence set (L6, L8): 30 min-max scaled rows predict the next scaled close.

    The target row decides the split, so the test pool reaches 30 rows back into training.
    """
    gated = s.blocked(enough_history(bars, cfg.baseline_min_rows, s)).withColumn(
        "volume", F.when(F.col("volume") == 0, F.lit(1.0)).otherwise(F.col("volume")))
    rows = stage(position(
        gated.select(s.key, BLOCK, s.time, *BASELINE_FEATURES), s, "pos", "n_rows"), "baseline")
    bound = F.ceil(F.col("n_rows") * F.lit(float(cfg.baseline_train_ratio)))
    scaler = min_max_scaler(rows, BASELINE_FEATURES, s, F.col("pos") <= bound)
    scaled = attach(rows, s, scaler).select(
        *s.block_keys, s.time, "pos", "n_rows", F.col("close").alias("target_close"),
        to_unit("close").alias("target_scaled"), "min_close", "range_close",
        *[to_unit(c).alias(c) for c in BASELINE_FEATURES])
    # The window ends one row before the target row: rows -30..-1.
    k = cfg.baseline_window
    wide = halo(scaled, s, BASELINE_FEATURES, before=k)
    item = F.collect_list(F.struct(*BASELINE_FEATURES)).over(s.local.rowsBetween(-k, -1))
    seq = without_halo(wide.withColumn("window", item)).filter(F.size("window") == k)
    return seq.drop(*BASELINE_FEATURES).withColumn(
        "split", F.when(F.col("pos") <= bound, "train").otherwise("test"))
