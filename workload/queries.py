"""Registered queries and their oracle SQL, one entry per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators import clean, features, forecast, metrics, pooled, strategy, windows
from barloom.operators.ema import ema
from barloom.operators.indicators import INDICATORS, add_indicators, rolling_indicators, true_range
from barloom.operators.series import DAILY, INTRADAY, Series, attach, looking_back, plain
from barloom.operators.quantiles import exact_quantiles
from barloom.plans import medallion
from barloom.session import stage
from barloom.settings import BASELINE_FEATURES, FEATURES
from barloom.sources.readers import normalise_dates, union_reports
from workload.oracles import CTES, KEYS, SCALE, W, full, rnd, sig, sql
from workload.tables import (
    PRICES, bars_by_supplier, bars_day, bars_intraday, code_list, dirty_day, outcomes, shaped, staged_day, staged_intraday,
    table, with_copies, with_nulls,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None, digits: int | None = None, sigs: tuple[str, ...] = ()):
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf_dir: shaped(fn(spark, sf_dir), digits, sigs)
        if oracle:
            ORACLES[name] = sql(oracle)
        return fn

    return register


OHLCV = "open, high, low, close, volume"

# --- bars, projections, filters ---------------------------------------------------------------


@query("bars_daily", f"SELECT {KEYS}, {OHLCV} FROM bars_day")
def _(spark, d):
    return bars_day(spark, d)


@query("bars_intraday", f"""
    SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, {OHLCV} FROM bars_intraday""")
def _(spark, d):
    return bars_intraday(spark, d)


@query("project", "SELECT DISTINCT code, type FROM code_list")
def _(spark, d):
    return code_list(spark, d).select("code", "type")


@query("derived_columns", f"""
    SELECT {KEYS}, high - low AS spread, (high + low + close) / 3 AS typical FROM bars_day""")
def _(spark, d):
    return bars_day(spark, d).withColumns({
        "spread": F.col("high") - F.col("low"),
        "typical": (F.col("high") + F.col("low") + F.col("close")) / 3,
    }).select("code", "date", "spread", "typical")


@query("renamed_columns", "SELECT code AS ticker, CAST(date AS VARCHAR) AS day, close AS last_price FROM bars_day")
def _(spark, d):
    return clean.rename(
        bars_day(spark, d).select("code", "date", "close"), {"code": "ticker", "date": "day", "close": "last_price"})


@query("generated_projection", f"SELECT {', '.join(f'count({c}) AS {c}' for c in PRICES)} FROM null_day")
def _(spark, d):
    counts = clean.per_column(with_nulls(bars_day(spark, d)), PRICES, lambda c: F.col(c).isNotNull().cast("int"))
    return counts.agg(*[F.sum(c).alias(c) for c in PRICES])


@query("code_filter", f"SELECT {KEYS}, close FROM bars_day WHERE code IN ('A', 'R')")
def _(spark, d):
    return clean.only_codes(bars_day(spark, d), ["A", "R"]).select("code", "date", "close")


@query("watermark_filter", f"""
    SELECT {KEYS}, close FROM bars_day
    WHERE date > (SELECT max(CAST(o_orderdate AS DATE)) FROM orders)""")
def _(spark, d):
    mark = table(spark, d, "orders").agg(F.max(F.to_date("o_orderdate")).alias("mark"))
    return clean.newer_than(bars_day(spark, d), mark, "date").select("code", "date", "close")


@query("latest_date_rows", f"SELECT {KEYS}, {OHLCV} FROM bars_day WHERE date = (SELECT max(date) FROM bars_day)")
def _(spark, d):
    return clean.at_latest(staged_day(spark, d))


@query("drop_optional_columns", "SELECT l_orderkey, l_returnflag FROM lineitem")
def _(spark, d):
    return table(spark, d, "lineitem").select("l_orderkey", "l_returnflag", "l_tax").drop("l_tax", "not_there")


@query("drop_null_close", f"SELECT {KEYS}, close FROM null_day WHERE close IS NOT NULL")
def _(spark, d):
    return with_nulls(bars_day(spark, d)).dropna(subset=["close"]).select("code", "date", "close")


@query("drop_any_null", f"""
    SELECT {KEYS}, {OHLCV} FROM null_day WHERE {' AND '.join(f'{c} IS NOT NULL' for c in PRICES)}""")
def _(spark, d):
    return with_nulls(bars_day(spark, d)).dropna("any")


@query("replace_value", f"""
    SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, CASE WHEN volume = 1 THEN 2 ELSE volume END AS volume
    FROM bars_intraday""")
def _(spark, d):
    return clean.replace_value(bars_intraday(spark, d), "volume", 1.0, 2.0).select("code", "timestamp", "volume")


@query("minimum_history", f"""
    SELECT user_id, count(*) AS n FROM (
      SELECT *, count(*) OVER (PARTITION BY user_id) AS c FROM (SELECT DISTINCT user_id, ts FROM events))
    WHERE c >= 60 GROUP BY 1""")
def _(spark, d):
    s = Series(key="user_id", time="ts", step=900)
    rows = table(spark, d, "events").select("user_id", "ts").distinct()
    return windows.enough_history(rows, 60, s).groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))


# --- profiling, dedupe, enrichment -------------------------------------------------------------


@query("null_profile", "SELECT " + ", ".join(
    f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in ["code", "date", *PRICES, "volume"]) + " FROM dirty_day")
def _(spark, d):
    return clean.null_profile(dirty_day(spark, d))


@query("null_profile_sum", "SELECT " + ", ".join(
    f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}"
    for c in ["code", "date", *PRICES, "volume"]) + " FROM dirty_day")
def _(spark, d):
    return clean.null_profile_sum(dirty_day(spark, d))


@query("row_count", "SELECT count(*) AS row_count FROM dirty_day")
def _(spark, d):
    return clean.row_count(dirty_day(spark, d))


@query("duplicate_count", """
    SELECT (SELECT count(*) FROM dirty_day) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty_day)) AS duplicates""")
def _(spark, d):
    return clean.duplicate_count(dirty_day(spark, d))


@query("dedupe_on_key", f"SELECT {KEYS}, {OHLCV} FROM clean_day")
def _(spark, d):
    return clean.dedupe(dirty_day(spark, d))


@query("dedupe_by_revision", """
    SELECT n.code, CAST(n.date AS VARCHAR) AS date, CASE WHEN n.day % 33 = 0 THEN n.open - 2 WHEN n.day % 11 = 0 THEN d.open ELSE n.open + 1 END AS open,
      CASE WHEN n.day % 33 = 0 THEN n.close - 2 WHEN n.day % 11 = 0 THEN d.close ELSE n.close + 1 END AS close, n.volume
    FROM numbered_day n JOIN null_day d USING (code, date)""")
def _(spark, d):
    """Later revisions lower prices or take them back; the last of each bar counts, however large it is."""
    day = staged_day(spark, d).select("code", "date", "open", "close", "volume")
    number = F.unix_date("date")
    moved = lambda by: day.withColumns({c: F.col(c) + by for c in ("open", "close")})
    first = moved(1).withColumn("revision", F.lit(1))
    holes = with_nulls(staged_day(spark, d)).select(day.columns).filter(number % 11 == 0).withColumn("revision", F.lit(2))
    last = moved(-2).filter(number % 33 == 0).withColumn("revision", F.lit(3))
    rows = last.unionByName(first).unionByName(holes).unionByName(holes).unionByName(last)
    return clean.dedupe(rows, revision="revision").drop("revision")


@query("distinct_rows", f"SELECT DISTINCT {KEYS}, {OHLCV} FROM dirty_day")
def _(spark, d):
    return clean.distinct_rows(dirty_day(spark, d))


@query("enrich_with_type", f"""
    SELECT b.code, CAST(b.date AS VARCHAR) AS date, close, type FROM bars_day b LEFT JOIN code_type USING (code)""")
def _(spark, d):
    return clean.enrich(staged_day(spark, d), code_list(spark, d)).select("code", "date", "close", "type")


@query("orders_with_segment", """
    SELECT o_orderkey, o_custkey, c_mktsegment AS type FROM orders LEFT JOIN customer ON o_custkey = c_custkey""")
def _(spark, d):
    dim = table(spark, d, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("type"))
    return table(spark, d, "orders").join(dim, "o_custkey", "left").select("o_orderkey", "o_custkey", "type")


REPORT_SQL = """
    SELECT code, count(*) AS nb, CAST(min({t}) AS DATE)::VARCHAR AS min_date,
      CAST(max({t}) AS DATE)::VARCHAR AS max_date, {u} AS updated"""


@query("refresh_report", REPORT_SQL.format(t="date", u="CAST(max(date) AS VARCHAR)") + " FROM bars_day GROUP BY code")
def _(spark, d):
    return clean.refresh_report(bars_day(spark, d), F.col("date"))


@query("combined_report",
       REPORT_SQL.format(t="date", u="CAST(CAST(max(date) AS TIMESTAMP) AS VARCHAR)")
       + ", 'day' AS kind FROM bars_day GROUP BY code UNION ALL "
       + REPORT_SQL.format(t="timestamp", u="CAST(max(timestamp) AS VARCHAR)")
       + ", 'intraday' AS kind FROM bars_intraday GROUP BY code")
def _(spark, d):
    day = clean.refresh_report(bars_day(spark, d), F.col("date").cast("timestamp_ntz"))
    intraday = clean.refresh_report(bars_intraday(spark, d), F.col("timestamp"), "timestamp")
    return union_reports(day, intraday)


@query("high_water_mark", "SELECT CAST(max(timestamp) AS VARCHAR) AS max_updated FROM bars_intraday")
def _(spark, d):
    return clean.high_water_mark(bars_intraday(spark, d), "timestamp")


@query("union_append", f"""
    SELECT {KEYS}, close FROM bars_day UNION ALL SELECT {KEYS}, close FROM clean_day""")
def _(spark, d):
    cols = ["code", "date", "close"]
    return bars_day(spark, d).select(cols).unionByName(clean.dedupe(dirty_day(spark, d)).select(cols))


@query("sorted_by_code_and_date", f"SELECT {KEYS}, close FROM bars_day")
def _(spark, d):
    return bars_day(spark, d).select("code", "date", "close").orderBy("code", "date")


@query("oldest_refresh", "SELECT CAST(min(date) AS VARCHAR) AS updated FROM (SELECT code, max(date) AS date FROM bars_day GROUP BY code)")
def _(spark, d):
    return medallion.newest(clean.refresh_report(bars_day(spark, d), F.col("date")), "min")


@query("first_rows", f"SELECT {KEYS}, close FROM bars_day ORDER BY code, date LIMIT 20")
def _(spark, d):
    return bars_day(spark, d).select("code", "date", "close").orderBy("code", "date").limit(20)


# --- windows ----------------------------------------------------------------------------------


@query("lag_fill", f"""
    SELECT {KEYS}, {', '.join(f'coalesce({c}, lag({c}) OVER w) AS {c}' for c in PRICES)}, volume FROM null_day {W}""")
def _(spark, d):
    return windows.lag_fill(with_nulls(staged_day(spark, d)), PRICES)


@query("forward_fill", f"SELECT {KEYS}, {OHLCV} FROM filled_day")
def _(spark, d):
    return windows.forward_fill(stage(clean.dedupe(dirty_day(spark, d)), "clean"), PRICES)


ROLL = {"mean5": ("mean", "close", 5), "std7": ("std", "close", 7), "min9": ("min", "low", 9), "max9": ("max", "high", 9)}
ROLL_FN = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


@query("rolling_statistics", f"""
    SELECT {KEYS}, {', '.join(f'{rnd(full(ROLL_FN[f], c, k), n)}' for n, (f, c, k) in ROLL.items())}
    FROM null_day {W}""", 6)
def _(spark, d):
    return windows.rolling(with_nulls(staged_day(spark, d)), ROLL).select("code", "date", *ROLL)


@query("rolling_intraday", f"""
    SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, {rnd(full('avg', 'close', 20), 'sma_20')}
    FROM bars_intraday WINDOW w AS (PARTITION BY code ORDER BY timestamp)""", 6)
def _(spark, d):
    return windows.rolling(staged_intraday(spark, d), {"sma_20": ("mean", "close", 20)}, INTRADAY).select(
        "code", "timestamp", "sma_20")


@query("difference", f"SELECT {KEYS}, close - lag(close) OVER w AS step FROM bars_day {W}")
def _(spark, d):
    return windows.difference(staged_day(spark, d), {"step": "close"}).select("code", "date", "step")


@query("previous_close", f"SELECT {KEYS}, lag(close) OVER w AS previous FROM bars_day {W}")
def _(spark, d):
    return windows.lag(staged_day(spark, d), {"previous": "close"}).select("code", "date", "previous")


@query("next_close", f"SELECT {KEYS}, lead(close) OVER w AS following FROM bars_day {W}")
def _(spark, d):
    return windows.lead(staged_day(spark, d), {"following": "close"}).select("code", "date", "following")


@query("pct_change", f"""
    SELECT {KEYS}, c / nullif(lag(c) OVER w, 0) - 1 AS change
    FROM (SELECT code, date, last_value(close IGNORE NULLS) OVER w AS c FROM null_day {W}) {W}""")
def _(spark, d):
    return windows.pct_change(with_nulls(staged_day(spark, d)), {"change": "close"}).select("code", "date", "change")


@query("pct_change_zero_divisor", """
    SELECT code, CAST(timestamp AS VARCHAR) AS timestamp, low / nullif(lag(low) OVER w, 0) - 1 AS change
    FROM bars_intraday WINDOW w AS (PARTITION BY code ORDER BY timestamp)""")
def _(spark, d):
    return windows.pct_change(staged_intraday(spark, d), {"change": "low"}, INTRADAY, filled=True).select(
        "code", "timestamp", "change")


@query("ordered_split", f"""
    SELECT {KEYS}, CASE WHEN row_number() OVER w <= floor(count(*) OVER (PARTITION BY code) * 0.7::DOUBLE) THEN 'train'
      WHEN row_number() OVER w <= floor(count(*) OVER (PARTITION BY code) * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val'
      ELSE 'test' END AS split FROM bars_day {W}""")
def _(spark, d):
    return windows.split_by_position(staged_day(spark, d)).select("code", "date", "split")


@query("row_positions", f"""
    SELECT {KEYS}, row_number() OVER w AS pos, count(*) OVER (PARTITION BY code) AS n_rows FROM bars_day {W}""")
def _(spark, d):
    return windows.position(staged_day(spark, d)).select("code", "date", "pos", "n_rows")


@query("sliding_sequences", f"""
    SELECT {KEYS}, volume_first, volume_sum FROM (
      SELECT *, count(*) OVER f AS n, first_value(volume) OVER f AS volume_first, sum(volume) OVER f AS volume_sum
      FROM bars_day WINDOW f AS (PARTITION BY code ORDER BY date ROWS BETWEEN 14 PRECEDING AND CURRENT ROW))
    WHERE n = 15""")
def _(spark, d):
    seq = windows.sequences(staged_day(spark, d), ["close", "volume"], 15)
    total = F.aggregate("window", F.lit(0.0), lambda a, r: a + r["volume"])
    return seq.select("code", "date", F.col("window")[0]["volume"].alias("volume_first"), total.alias("volume_sum"))


@query("tail_per_code", f"""
    SELECT {KEYS}, close FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY date DESC) AS r FROM bars_day)
    WHERE r <= 65""")
def _(spark, d):
    return windows.tail(bars_day(spark, d), 65).select("code", "date", "close")


@query("ordinal", f"""
    SELECT row_number() OVER (ORDER BY code, date) AS "STT", {KEYS}, close FROM bars_day""")
def _(spark, d):
    return windows.ordinal(staged_day(spark, d).select("code", "date", "close"), ["code", "date"])


@query("running_state", f"""
    SELECT {KEYS}, max(close) OVER w AS peak, min(close) OVER w AS trough, sum(volume) OVER w AS total,
      {sig('product(1 + volume / 1e6) OVER w', 'growth')},
      last_value(CASE WHEN volume > 100 THEN close END IGNORE NULLS) OVER w AS last_busy
    FROM bars_day WINDOW w AS (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING)""", sigs=("growth",))
def _(spark, d):
    rows = staged_day(spark, d).withColumns({
        "_g": 1 + F.col("volume") / 1e6, "_busy": F.when(F.col("volume") > 100, F.col("close"))})
    out = windows.running(rows, {
        "peak": ("max", "close"), "trough": ("min", "close"), "total": ("sum", "volume"),
        "growth": ("product", "_g"), "last_busy": ("last", "_busy")})
    return out.select("code", "date", "peak", "trough", "total", "growth", "last_busy")


@query("latest_per_code", "SELECT code, CAST(max(date) AS VARCHAR) AS date, arg_max(close, date) AS close FROM bars_day GROUP BY code")
def _(spark, d):
    return windows.latest(bars_day(spark, d), ["close"])


@query("ema_with_gaps", f"""
    SELECT {KEYS}, {sig('y', 'ema_10')} FROM gap_rows JOIN gap_mean USING (code, rn)""",
       sigs=("ema_10",))
def _(spark, d):
    return ema(with_nulls(staged_day(spark, d)), {"ema_10": ("close", 10)}).select("code", "date", "ema_10")


# --- indicators -------------------------------------------------------------------------------


def indicator(name: str, columns: list[str]):
    """Single indicators computed on their own, without the full set."""
    body = ", ".join(sig(c) for c in columns)
    source = "indicators" if {"MACD", "EMA_10", "ATR_14", "ADX_14"} & set(columns) else "rolling"
    return query(name, f"SELECT {KEYS}, {body} FROM {source}", sigs=("*",))


@indicator("sma_10", ["SMA_10"])
def _(spark, d):
    return windows.rolling(staged_day(spark, d), {"SMA_10": ("mean", "close", 10)}).select("code", "date", "SMA_10")


@query("ema_10", f"SELECT {KEYS}, {sig('EMA_10')} FROM rolling JOIN means USING (code, rn)", sigs=("*",))
def _(spark, d):
    return ema(staged_day(spark, d), {"EMA_10": ("close", 10)}, gaps=False).select("code", "date", "EMA_10")


@query("macd", f"SELECT {KEYS}, {rnd('e12 - e26', 'MACD')} FROM rolling JOIN means USING (code, rn)", 6)
def _(spark, d):
    out = ema(staged_day(spark, d), {"e12": ("close", 12), "e26": ("close", 26)}, gaps=False)
    return out.select("code", "date", (F.col("e12") - F.col("e26")).alias("MACD"))


@query("rsi_bollinger_stochastic", f"""
    SELECT {KEYS}, {sig('SMA_10')}, {sig('BB_upper')}, {rnd('BB_lower')}, {rnd('RSI_14')}, {rnd('STOCHk_14_3_3')}
    FROM rolling""", 6, sigs=("SMA_10", "BB_upper"))
def _(spark, d):
    return rolling_indicators(staged_day(spark, d)).select(
        "code", "date", "SMA_10", "BB_upper", "BB_lower", "RSI_14", "STOCHk_14_3_3")


@query("true_range", f"SELECT {KEYS}, tr AS true_range FROM moves")
def _(spark, d):
    return plain(looking_back(staged_day(spark, d), DAILY, 1, ["close"], {"true_range": true_range()})).select(
        "code", "date", "true_range")


@query("atr_14", f"SELECT {KEYS}, {sig('ATR_14')} FROM rolling JOIN means USING (code, rn)", sigs=("*",))
def _(spark, d):
    rows = looking_back(staged_day(spark, d), DAILY, 1, ["close"], {"_tr": true_range()})
    return ema(rows, {"ATR_14": ("_tr", 14)}, gaps=False).select("code", "date", "ATR_14")


@query("indicator_set", "SELECT " + KEYS + ", " + ", ".join(
    rnd(c) if c in ("MACD", "BB_lower") else sig(c) for c in INDICATORS) + " FROM indicators",
       6, sigs=tuple(c for c in INDICATORS if c not in ("MACD", "BB_lower")))
def _(spark, d):
    return add_indicators(staged_day(spark, d)).select("code", "date", *INDICATORS)


@query("indicator_set_intraday", "SELECT code, CAST(date AS VARCHAR) AS timestamp, " + ", ".join(
    rnd(c) for c in INDICATORS) + " FROM indicators_i", 6)
def _(spark, d):
    return add_indicators(staged_intraday(spark, d), INTRADAY).select("code", "timestamp", *INDICATORS)


# --- many codes -------------------------------------------------------------------------------


def by_supplier(name: str, oracle: str, digits: int | None = None, sigs: tuple[str, ...] = ()):
    """A query over supplier bars; its oracle is that for flags with another code."""
    def register(fn: Query) -> Query:
        query(name, oracle, digits, sigs)(fn)
        ORACLES[name] = ORACLES[name].replace("l_returnflag", "CAST(l_suppkey AS VARCHAR)")
        return fn

    return register


@by_supplier("forward_fill_by_supplier", f"SELECT {KEYS}, {OHLCV} FROM filled_day")
def _(spark, d):
    bars = with_copies(with_nulls(bars_by_supplier(spark, d)))
    return windows.forward_fill(stage(clean.dedupe(bars), "clean"), PRICES)


@by_supplier("rolling_statistics_by_supplier", f"""
    SELECT {KEYS}, {', '.join(f'{rnd(full(ROLL_FN[f], c, k), n)}' for n, (f, c, k) in ROLL.items())}
    FROM null_day {W}""", 6)
def _(spark, d):
    return windows.rolling(with_nulls(bars_by_supplier(spark, d)), ROLL).select("code", "date", *ROLL)


@by_supplier("indicator_set_by_supplier", "SELECT " + KEYS + ", " + ", ".join(
    rnd(c, digits=4) if c in ("MACD", "BB_lower") else sig(c) for c in INDICATORS) + " FROM indicators", 4, tuple(c for c in INDICATORS if c not in ("MACD", "BB_lower")))
def _(spark, d):
    return add_indicators(bars_by_supplier(spark, d, "high", "low", "close")).select("code", "date", *INDICATORS)


# --- training sets ----------------------------------------------------------------------------


@query("next_change", f"""
    SELECT {KEYS}, t AS target_pct_change
    FROM (SELECT *, lead(close) OVER w / nullif(close, 0) - 1 AS t FROM bars_day {W}) WHERE t IS NOT NULL""")
def _(spark, d):
    return features.next_change(staged_day(spark, d)).select("code", "date", "target_pct_change")


@query("quantile_bounds", f"SELECT code, {rnd('lower_bound')}, {rnd('upper_bound')} FROM bounds_simple", 6)
def _(spark, d):
    return features.trend_bounds(features.next_change(staged_day(spark, d)))


def _labelled(spark, d):
    rows = stage(features.next_change(staged_day(spark, d)), "next")
    return features.trend_label(rows, features.trend_bounds(rows))


@query("event_value_quantiles", f"""
    SELECT user_id, {rnd('quantile_cont(value, 0.1)', 'p10')}, {rnd('quantile_cont(value, 0.5)', 'p50')},
      {rnd('quantile_cont(value, 0.95)', 'p95')} FROM events GROUP BY user_id""", 6)
def _(spark, d):
    return exact_quantiles(table(spark, d, "events"), "user_id", "value", {"p10": 0.1, "p50": 0.5, "p95": 0.95})


@query("trend_labels", f"SELECT {KEYS}, target_trend FROM labels_simple")
def _(spark, d):
    return _labelled(spark, d).select("code", "date", "target_trend")


@query("class_distribution", """
    SELECT code, target_trend, count(*) AS n, count(*) / sum(count(*)) OVER (PARTITION BY code) AS share
    FROM labels_simple GROUP BY code, target_trend""")
def _(spark, d):
    return features.class_distribution(_labelled(spark, d))


@query("class_weights", """
    SELECT code, target_trend, count(*) AS n,
      sum(count(*)) OVER (PARTITION BY code) / (count(*) OVER (PARTITION BY code) * count(*)) AS class_weight
    FROM labels_simple WHERE pos <= floor(n * 0.7::DOUBLE) GROUP BY code, target_trend""")
def _(spark, d):
    rows = windows.split_by_position(_labelled(spark, d)).filter(F.col("split") == "train")
    return features.class_weights(rows)


FEATURE_SIGS = tuple(FEATURES)


def _feature_cols() -> str:
    return ", ".join(sig(c) for c in FEATURES)


@query("feature_frame", f"SELECT {KEYS}, {_feature_cols()}, target_trend, pos, n_rows FROM labelled", sigs=FEATURE_SIGS)
def _(spark, d):
    return features.labelled_features(staged_day(spark, d)).select(
        "code", "date", *FEATURES, "target_trend", "pos", "n_rows")


STEADY = [c for c in FEATURES if c != "MACD_pct_change"]


@query("scaled_features", f"""
    SELECT {KEYS}, {', '.join(rnd('z_' + c, c) for c in STEADY)} FROM scaled""", 6)
def _(spark, d):
    rows, _scaler = features.scaled_features(stage(features.labelled_features(staged_day(spark, d)), "labelled"))
    return rows.select("code", "date", *[F.col(f"z_{c}").alias(c) for c in STEADY])


@query("standard_scaler", "SELECT code, " + ", ".join(
    f"{sig(f'avg({c})', 'mean_' + c)}, {sig(f'stddev_pop({c})', 'std_' + c)}" for c in SCALE)
    + " FROM next_bars WHERE pos <= floor(n * 0.7::DOUBLE) GROUP BY code", sigs=("*",))
def _(spark, d):
    p = windows.position(staged_day(spark, d))
    return features.standard_scaler(p, SCALE, train=features.first_share("pos", "n_rows", 0.7))


@query("min_max_scaling", f"""
    SELECT {KEYS}, {', '.join(rnd(f'({c} - min_{c}) / range_{c}', c) for c in SCALE)}
    FROM next_bars JOIN unit_params USING (code)""", 6)
def _(spark, d):
    p = stage(windows.position(staged_day(spark, d)), "pos")
    params = features.min_max_scaler(
        p, SCALE, train=F.col("pos") <= F.ceil(F.col("n_rows") * F.lit(0.8)))
    return attach(p, DAILY, params).select("code", "date", *[features.to_unit(c).alias(c) for c in SCALE])


@query("inverse_scaling", f"SELECT {KEYS}, {sig('close')} FROM bars_day", sigs=("*",))
def _(spark, d):
    p = stage(windows.position(staged_day(spark, d)), "pos")
    params = features.standard_scaler(p, ["close"], train=features.first_share("pos", "n_rows", 0.7))
    rows = attach(p, DAILY, params).withColumn("z", features.standardise("close"))
    return rows.select("code", "date", features.unstandardise(F.col("z"), "close").alias("close"))


@query("training_windows", f"""
    SELECT {KEYS}, window_no, n_windows, split, target_trend, {rnd('close')}, {rnd('z_target_pct_change', 'target_scaled')},
      {', '.join(f"{rnd(f'first_{c}')}, {rnd(f'sum_{c}')}" for c in STEADY)} FROM windows""", 6)
def _(spark, d):
    rows = features.training_windows(staged_day(spark, d))
    first = [F.col("window")[0][c].alias(f"first_{c}") for c in STEADY]
    totals = [F.aggregate("window", F.lit(0.0), lambda a, r: a + r[c]).alias(f"sum_{c}") for c in STEADY]
    return rows.select(
        "code", "date", "window_no", "n_windows", "split", "target_trend", "close", "target_scaled", *first, *totals)


@query("split_sizes", "SELECT code, split, count(*) AS n FROM windows GROUP BY code, split")
def _(spark, d):
    return features.training_windows(staged_day(spark, d)).groupBy("code", "split").agg(F.count(F.lit(1)).alias("n"))


@query("baseline_windows", f"""
    SELECT {KEYS}, {rnd('u_close', 'target_scaled')}, {', '.join(f"{rnd(f'first_{c}')}, {rnd(f'sum_{c}')}" for c in BASELINE_FEATURES)},
      CASE WHEN pos <= ceil(n * 0.8::DOUBLE) THEN 'train' ELSE 'test' END AS split
    FROM base_rows WHERE k = 30""", 6)
def _(spark, d):
    rows = features.baseline_windows(staged_day(spark, d))
    first = [F.col("window")[0][c].alias(f"first_{c}") for c in BASELINE_FEATURES]
    totals = [F.aggregate("window", F.lit(0.0), lambda a, r: a + r[c]).alias(f"sum_{c}") for c in BASELINE_FEATURES]
    return rows.select("code", "date", "target_scaled", *first, *totals, "split")


@query("dates_utc", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) - 1 AS VARCHAR) AS date FROM lineitem")
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+07:00")).alias("date"))
    return normalise_dates(rows)


@query("dates_local", "SELECT l_orderkey, l_linenumber, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS date FROM lineitem")
def _(spark, d):
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.concat(F.date_format("l_shipdate", "yyyy-MM-dd HH:mm:ss"), F.lit("+07:00")).alias("date"))
    return normalise_dates(rows, "Asia/Ho_Chi_Minh")


# --- forecasting and metrics ------------------------------------------------------------------


def _split_outcomes(spark, d):
    return stage(windows.split_by_position(outcomes(staged_day(spark, d))), "outcomes")


def _forecasts(spark, d):
    rows = _split_outcomes(spark, d)
    params = forecast.ar1_parameters(rows.filter(F.col("split") == "train"))
    out = forecast.ar1_forecast(rows, params)
    return out.withColumn("predicted_price", forecast.price_from_change("price", "predicted_change"))


@query("ar1_parameters", f"SELECT code, {sig('slope')}, {sig('intercept')} FROM ar1", sigs=("*",))
def _(spark, d):
    return forecast.ar1_parameters(_split_outcomes(spark, d).filter(F.col("split") == "train"))


CTES["sums_of_products"] = """
    SELECT code, count(*) AS n, sum(x) AS sx, sum(x * x) AS sxx, sum(y) AS sy, sum(x * y) AS sxy
    FROM (SELECT code, close_pct_change AS x, target_pct_change AS y FROM out_rows WHERE split = 'train')
    WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY code"""
CTES["common_line"] = """
    SELECT (sy * (sxx + 0.5) - sx * sxy) / ((n + 0.5) * (sxx + 0.5) - sx * sx) AS b0,
      ((n + 0.5) * sxy - sx * sy) / ((n + 0.5) * (sxx + 0.5) - sx * sx) AS b1
    FROM (SELECT sum(n) AS n, sum(sx) AS sx, sum(sxx) AS sxx, sum(sy) AS sy, sum(sxy) AS sxy FROM sums_of_products)"""


@query("pooled_regression", f"""
    SELECT code, n, {sig('(ry * (sxx + 20.5) - sx * rx) / det', 'intercept')}, {sig('((n + 20.5) * rx - sx * ry) / det', 'slope')}
    FROM (SELECT *, sy + 20 * b0 AS ry, sxy + 20 * b1 AS rx, (n + 20.5) * (sxx + 20.5) - sx * sx AS det FROM sums_of_products, common_line)""",
       sigs=("intercept", "slope"))
def _(spark, d):
    """A ridge line per code, pooled towards the line of all codes."""
    rows = _split_outcomes(spark, d).filter(F.col("split") == "train")
    found = pooled.fit_pooled(rows, ["close_pct_change"], "target_pct_change", ridge=0.5, pooling=20.0)
    return found.select("code", "n", F.get("coefficients", F.lit(0)).alias("intercept"), F.get("coefficients", F.lit(1)).alias("slope"))


@query("ar1_forecast", f"SELECT {KEYS}, {rnd('predicted_change')}, {sig('predicted_price')} FROM forecasts",
       6, sigs=("predicted_price",))
def _(spark, d):
    return _forecasts(spark, d).select("code", "date", "predicted_change", "predicted_price")


@query("residual_spread", f"SELECT code, {sig('error_std')} FROM spread", sigs=("*",))
def _(spark, d):
    rows = _forecasts(spark, d).filter(F.col("split") == "val")
    return forecast.residual_spread(rows, "target_pct_change", "predicted_change")


def _banded(spark, d):
    rows = stage(_forecasts(spark, d), "forecasts")
    spread = forecast.residual_spread(rows.filter(F.col("split") == "val"), "target_pct_change", "predicted_change")
    test = rows.filter(F.col("split") == "test").withColumns({
        "target_mean": F.lit(0.0), "target_std": F.lit(1.0), "close": F.col("price")})
    return forecast.price_band(test, spread, DAILY, "predicted_change", "target_pct_change")


@query("price_band", f"""
    SELECT {KEYS}, {sig('next_price', 'actual_price')}, {sig('predicted_price')}, {rnd('lower_price')}, {sig('upper_price')}
    FROM banded""", 6, sigs=("actual_price", "predicted_price", "upper_price"))
def _(spark, d):
    return _banded(spark, d).select("code", "date", "actual_price", "predicted_price", "lower_price", "upper_price")


@query("band_coverage", f"""
    SELECT code, {rnd('avg(CASE WHEN next_price BETWEEN lower_price AND upper_price THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)', 'coverage')}
    FROM banded GROUP BY code""", 6)
def _(spark, d):
    return metrics.band_coverage(_banded(spark, d), "next_price", "lower_price", "upper_price")


@query("argmax_label", """
    SELECT vec_id, CAST(list_position(embedding, list_max(embedding)) - 1 AS BIGINT) AS label FROM embeddings""")
def _(spark, d):
    return table(spark, d, "embeddings").select("vec_id", forecast.argmax_label(F.col("embedding")).alias("label"))


@query("trend_names", f"""
    SELECT {KEYS}, CASE signal WHEN 0 THEN 'Down' WHEN 1 THEN 'Neutral' ELSE 'Up' END AS trend FROM outcomes""")
def _(spark, d):
    return outcomes(staged_day(spark, d)).select("code", "date", forecast.trend_name(F.col("signal")).alias("trend"))


@query("array_position_means", f"""
    SELECT pos, {rnd('avg(v)', 'weight')} FROM (
      SELECT unnest(range(len(embedding))) AS pos, CAST(unnest(embedding) AS DOUBLE) AS v FROM embeddings) GROUP BY pos""", 6)
def _(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("embedding").cast("array<double>").alias("e"))
    return forecast.mean_by_position(rows, "e")


def _test_rows(spark, d):
    return _forecasts(spark, d).filter(F.col("split") == "test")


@query("regression_metrics", f"SELECT code, {sig('rmse')}, {sig('mae')}, {rnd('r2')} FROM ar1_score", 6, ("rmse", "mae"))
def _(spark, d):
    return metrics.regression_metrics(_test_rows(spark, d), "next_price", "predicted_price")


@query("persistence_baseline", f"SELECT code, {sig('rmse')}, {sig('mae')}, {rnd('r2')} FROM hold_score", 6, ("rmse", "mae"))
def _(spark, d):
    return metrics.regression_metrics(_split_outcomes(spark, d).filter(F.col("split") == "test"), "next_price", "price")


@query("model_comparison", f"""
    SELECT code, {sig('m.rmse', 'rmse')}, {sig('b.rmse', 'rmse_base')}, {rnd('1 - m.rmse / b.rmse', 'reduction')}
    FROM ar1_score m JOIN hold_score b USING (code)""", 6, ("rmse", "rmse_base"))
def _(spark, d):
    test = stage(_test_rows(spark, d), "test")
    return metrics.compare_models(
        metrics.regression_metrics(test, "next_price", "predicted_price"),
        metrics.regression_metrics(test, "next_price", "price"))


@query("confusion_matrix", """
    SELECT code, actual, count(*) FILTER (WHERE signal = 0) AS pred_down, count(*) FILTER (WHERE signal = 1) AS pred_neutral,
      count(*) FILTER (WHERE signal = 2) AS pred_up FROM outcomes GROUP BY code, actual""")
def _(spark, d):
    return metrics.confusion_matrix(outcomes(staged_day(spark, d)), "actual", "signal")


@query("classification_metrics", f"SELECT code, {rnd('c / s', 'accuracy')}, " + ", ".join(
    f"{rnd('precision_' + n)}, {rnd('recall_' + n)}, "
    + rnd(f"coalesce(2 * precision_{n} * recall_{n} / nullif(precision_{n} + recall_{n}, 0), 0)", f"f1_{n}")
    for n in ("down", "neutral", "up"))
    + ", " + rnd("coalesce((c * s - (t0 * p0 + t1 * p1 + t2 * p2)) / nullif(sqrt((s * s - (p0 * p0 + p1 * p1 + p2 * p2))"
                 " * (s * s - (t0 * t0 + t1 * t1 + t2 * t2))), 0), 0)", "mcc") + " FROM ratios", 6)
def _(spark, d):
    return metrics.classification_metrics(outcomes(staged_day(spark, d)), "actual", "signal")


SQUARES = "avg(power(target_pct_change - close_pct_change, 2))"
ENTROPY = ("(sum(-ln(CASE WHEN actual = signal THEN 0.8::DOUBLE ELSE 0.1::DOUBLE END) * (1 + actual)) "
           "/ sum(1 + actual))")


@query("total_loss", f"""
    SELECT {rnd(SQUARES, 'mse')}, {rnd(ENTROPY, 'cross_entropy')}, {rnd(f'{SQUARES} + 5 * {ENTROPY}', 'total_loss')}
    FROM outcomes""", 6)
def _(spark, d):
    rows = outcomes(staged_day(spark, d)).withColumns({
        "probability": F.transform(F.array(*[F.lit(k) for k in range(3)]),
                                   lambda k: F.when(k == F.col("signal"), 0.8).otherwise(0.1)),
        "class_weight": 1 + F.col("actual")})
    return metrics.total_loss(rows, label="actual", actual="target_pct_change", predicted="close_pct_change")


@query("metrics_summary", f"""
    SELECT row_number() OVER (ORDER BY code) AS "STT", code, round(rmse, 4) AS rmse, round(mae, 4) AS mae, round(r2, 4) AS r2
    FROM ar1_score""")
def _(spark, d):
    return metrics.summary_table(metrics.regression_metrics(_test_rows(spark, d), "next_price", "predicted_price"))


# --- strategy ---------------------------------------------------------------------------------


@query("strategy_growth", f"""
    SELECT {KEYS}, held, trade, is_last, {rnd('model_growth')}, {rnd('hold_growth')} FROM growths""", 6)
def _(spark, d):
    return strategy.growth(outcomes(staged_day(spark, d))).select(
        "code", "date", "held", "trade", "is_last", "model_growth", "hold_growth")


EQUITY = ["model_equity", "hold_equity", "model_peak", "hold_peak"]


@query("equity_curves", f"SELECT {KEYS}, {', '.join(sig(c) for c in EQUITY)} FROM peaks", sigs=tuple(EQUITY))
def _(spark, d):
    return strategy.equity_curves(outcomes(staged_day(spark, d))).select("code", "date", *EQUITY)


def _side_sql(x: str) -> str:
    exits = "* arg_max(next_price / price, date) * (1.0::DOUBLE - 0.001::DOUBLE)" if x == "hold" else ""
    end = f"1e8::DOUBLE * product({x}_growth) {exits}"
    return (
        f"{sig(f'({end} / 1e8::DOUBLE - 1) * 100', x + '_return_pct')}, {sig(end, x + '_final_value')}, "
        f"{sig(f'100 * max(({x}_peak - {x}_equity) / {x}_peak)', x + '_max_drawdown')}, "
        f"{sig(f'coalesce(avg({x}_growth - 1) / nullif(stddev_samp({x}_growth - 1), 0) * sqrt(252.0::DOUBLE), 0)', x + '_sharpe_ratio')}")


@query("strategy_summary", f"""
    SELECT code, {_side_sql('hold')}, {_side_sql('model')}, CAST(sum(CASE WHEN trade THEN 1 ELSE 0 END) AS BIGINT) AS model_num_trades
    FROM peaks GROUP BY code""", sigs=("*",))
def _(spark, d):
    return strategy.strategy_summary(outcomes(staged_day(spark, d)))
