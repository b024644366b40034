"""Oracle SQL: shared table expressions and a helper that pulls in what a query needs."""

from __future__ import annotations

import re

P4 = "open, high, low, close"
KEYS = "code, CAST(date AS VARCHAR) AS date"


# Moves values off exact decimal ties, which the two engines round differently.
OFF_TIES = "(1.0::DOUBLE + 1e-11::DOUBLE)"


def sig(x: str, name: str | None = None) -> str:
    return f"CAST(printf('%.6e', ({x}) * {OFF_TIES}) AS DOUBLE) AS {name or x}"


def rnd(x: str, name: str | None = None, digits: int = 6) -> str:
    return f"round(({x}) * {OFF_TIES}, {digits}) AS {name or x}"


def _ema(rows: str, specs: dict[str, tuple[str, int]], extra: str = "") -> str:
    """Recursive mean over gap-free rows numbered 1..n; NULL only before the first value."""
    start = ", ".join(f"{c} AS {n}" for n, (c, _) in specs.items())
    step = ", ".join(
        f"CASE WHEN e.{n} IS NULL THEN r.{c} WHEN r.{c} IS NULL THEN e.{n} ELSE "
        f"r.{c} * (2.0::DOUBLE / {k + 1}) + e.{n} * (1.0::DOUBLE - 2.0::DOUBLE / {k + 1}) END AS {n}"
        for n, (c, k) in specs.items())
    return (
        f"SELECT code, rn, {start} FROM {rows} WHERE rn = 1 UNION ALL "
        f"SELECT r.code, r.rn, {step} FROM e JOIN {rows} r ON r.code = e.code AND r.rn = e.rn + 1")


def gap_ema(rows: str, c: str, k: int) -> str:
    """Recursive mean with decay over gaps; ``d`` is the weight left of the old mean."""
    a, q = f"(2.0::DOUBLE / {k + 1})", f"(1.0::DOUBLE - 2.0::DOUBLE / {k + 1})"
    return (
        f"SELECT code, rn, {c} AS y, CASE WHEN {c} IS NULL THEN NULL ELSE 1.0::DOUBLE END AS d "
        f"FROM {rows} WHERE rn = 1 UNION ALL "
        f"SELECT r.code, r.rn, CASE WHEN e.y IS NULL THEN r.{c} WHEN r.{c} IS NULL THEN e.y ELSE "
        f"(e.d * {q} * e.y + {a} * r.{c}) / (e.d * {q} + {a}) END, "
        f"CASE WHEN r.{c} IS NOT NULL THEN 1.0::DOUBLE WHEN e.d IS NULL THEN NULL ELSE e.d * {q} END "
        f"FROM e JOIN {rows} r ON r.code = e.code AND r.rn = e.rn + 1")


def full(fn: str, x: str, k: int, w: str = "w") -> str:
    frame = f"({w} ROWS BETWEEN {k - 1} PRECEDING AND CURRENT ROW)"
    return f"CASE WHEN count({x}) OVER {frame} = {k} THEN {fn}({x}) OVER {frame} END"


W = "WINDOW w AS (PARTITION BY code ORDER BY date)"

EMA_SPECS = {
    "EMA_10": ("close", 10), "e12": ("close", 12), "e26": ("close", 26),
    "ATR_14": ("tr", 14), "ep": ("pdm", 14), "em": ("mdm", 14),
}
CHANGES = ["open", "high", "low", "close", "volume", "SMA_10", "EMA_10", "MACD", "BB_upper", "BB_lower", "ATR_14"]
LEVELS = ["RSI_14", "ADX_14", "STOCHk_14_3_3"]
FEATURES = [f"{c}_pct_change" for c in CHANGES] + LEVELS
SCALED = FEATURES + ["target_pct_change"]

CTES = {
    "bars_day": """
        SELECT l_returnflag AS code, CAST(l_shipdate AS DATE) AS date,
          first(p ORDER BY l_orderkey, l_linenumber, p) AS open,
          max(p) AS high, min(p) AS low,
          last(p ORDER BY l_orderkey, l_linenumber, p) AS close,
          sum(l_quantity) AS volume
        FROM (SELECT *, l_extendedprice / l_quantity AS p FROM lineitem) GROUP BY 1, 2""",
    "bars_intraday": """
        SELECT event_type AS code, time_bucket(INTERVAL '15 minutes', ts) AS timestamp,
          arg_min(value, ts) AS open, max(value) AS high, min(value) AS low, arg_max(value, ts) AS close,
          CAST(count(*) AS DOUBLE) AS volume
        FROM events GROUP BY 1, 2""",
    "numbered_day": "SELECT *, date - DATE '1970-01-01' AS day FROM bars_day",
    "null_day": """
        SELECT code, date, day, CASE WHEN day % 17 NOT IN (0, 1) THEN open END AS open,
          CASE WHEN day % 17 NOT IN (0, 1) THEN high END AS high,
          CASE WHEN day % 17 NOT IN (0, 1) THEN low END AS low,
          CASE WHEN day % 17 NOT IN (0, 1) AND day % 29 <> 3 THEN close END AS close, volume
        FROM numbered_day""",
    "dirty_day": """
        SELECT code, date, open, high, low, close, volume FROM null_day
        UNION ALL SELECT code, date, open, high, low, close, volume FROM null_day WHERE day % 7 = 0
        UNION ALL SELECT code, date, open, high, low, close + 1, volume FROM null_day WHERE day % 11 = 0""",
    "clean_day": """
        SELECT code, date, open, high, low, close, volume FROM (
          SELECT *, row_number() OVER (PARTITION BY code, date ORDER BY open DESC NULLS LAST,
            high DESC NULLS LAST, low DESC NULLS LAST, close DESC NULLS LAST, volume DESC NULLS LAST) AS r
          FROM dirty_day) WHERE r = 1""",
    "code_list": """
        SELECT DISTINCT l_returnflag AS code, 'type_' || l_linestatus AS type FROM lineitem
        WHERE l_returnflag <> 'R' AND (l_returnflag <> 'N' OR l_linestatus = 'O')""",
    "code_type": "SELECT code, min(type) AS type FROM code_list GROUP BY code",
    "filled_day": f"""
        SELECT code, date, {', '.join(f'last_value({c} IGNORE NULLS) OVER w AS {c}' for c in P4.split(', '))}, volume
        FROM clean_day {W}""",
    "stepped": f"""
        SELECT *, row_number() OVER w AS rn, lag(close) OVER w AS pc, high - lag(high) OVER w AS dh,
          low - lag(low) OVER w AS dl, close - lag(close) OVER w AS dc FROM bars_day {W}""",
    "moves": """
        SELECT *, coalesce(greatest(dc, 0), 0) AS gain, coalesce(greatest(-dc, 0), 0) AS loss,
          greatest(high - low, coalesce(abs(high - pc), high - low), coalesce(abs(low - pc), high - low)) AS tr,
          CASE WHEN dh < 0 THEN 0 ELSE dh END AS pdm, CASE WHEN dl > 0 THEN 0 ELSE dl END AS mdm FROM stepped""",
    "rolled": f"""
        SELECT *, {full('avg', 'close', 10)} AS SMA_10, {full('avg', 'close', 20)} AS sma20,
          {full('stddev_samp', 'close', 20)} AS std20, {full('avg', 'gain', 14)} AS g14,
          {full('avg', 'loss', 14)} AS l14, {full('min', 'low', 14)} AS low14, {full('max', 'high', 14)} AS high14
        FROM moves {W}""",
    "rolling": f"""
        SELECT code, date, rn, open, high, low, close, volume, tr, pdm, mdm, SMA_10,
          sma20 + 2 * std20 AS BB_upper, sma20 - 2 * std20 AS BB_lower,
          100 - 100 / (1 + g14 / (l14 + 1e-9::DOUBLE)) AS RSI_14, {full('avg', 'k', 3)} AS STOCHk_14_3_3
        FROM (SELECT *, 100 * ((close - low14) / (high14 - low14 + 1e-9::DOUBLE)) AS k FROM rolled) {W}""",
    "rows_rolling": "SELECT * FROM rolling",
    "means": f"WITH RECURSIVE e AS ({_ema('rows_rolling', EMA_SPECS)}) SELECT * FROM e",
    "directional": """
        SELECT code, rn, 100 * (abs(p - m) / (p + m + 1e-9::DOUBLE)) AS dx FROM (
          SELECT code, rn, 100 * (ep / (ATR_14 + 1e-9::DOUBLE)) AS p,
            100 * (abs(em) / (ATR_14 + 1e-9::DOUBLE)) AS m FROM means)""",
    "adx": f"WITH RECURSIVE e AS ({_ema('directional', {'ADX_14': ('dx', 14)})}) SELECT * FROM e",
    "indicators": """
        SELECT r.code, r.date, r.rn, r.open, r.high, r.low, r.close, r.volume, r.SMA_10, m.EMA_10, r.RSI_14,
          m.e12 - m.e26 AS MACD, r.BB_upper, r.BB_lower, m.ATR_14, a.ADX_14, r.STOCHk_14_3_3
        FROM rolling r JOIN means m USING (code, rn) JOIN adx a USING (code, rn)""",
    "featured": f"""
        SELECT code, date, close,
          {', '.join(f'{c} / nullif(lag({c}) OVER w, 0) - 1 AS {c}_pct_change' for c in CHANGES)},
          {', '.join(LEVELS)}, lead(close) OVER w / nullif(close, 0) - 1 AS target_pct_change
        FROM indicators {W}""",
    "raw_rows": f"""
        SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY code) AS n
        FROM featured WHERE target_pct_change IS NOT NULL {W}""",
    "bounds": """
        SELECT code, quantile_cont(target_pct_change, 0.33) AS lower_bound,
          quantile_cont(target_pct_change, 0.67) AS upper_bound
        FROM raw_rows WHERE pos <= floor(n * 0.7::DOUBLE) GROUP BY code""",
    "labelled": f"""
        SELECT r.* EXCLUDE (pos, n), row_number() OVER w AS pos, count(*) OVER (PARTITION BY code) AS n_rows,
          CASE WHEN target_pct_change > upper_bound THEN 2 WHEN target_pct_change < lower_bound THEN 0
            ELSE 1 END AS target_trend
        FROM raw_rows r JOIN bounds USING (code)
        WHERE {' AND '.join(f'{c} IS NOT NULL' for c in FEATURES)} {W}""",
    "scaler": f"""
        SELECT code, {', '.join(f'avg({c}) AS mean_{c}, CASE WHEN stddev_pop({c}) = 0 THEN 1 ELSE stddev_pop({c}) END AS std_{c}' for c in SCALED)}
        FROM labelled WHERE pos <= floor(n_rows * 0.7::DOUBLE) GROUP BY code""",
    "scaled": f"""
        SELECT l.code, l.date, l.pos, l.n_rows, l.close, l.target_trend, l.target_pct_change,
          {', '.join(f'(l.{c} - s.mean_{c}) / s.std_{c} AS z_{c}' for c in SCALED)}
        FROM labelled l JOIN scaler s USING (code)""",
    "windows": f"""
        SELECT *, pos - 14 AS window_no, n_rows - 15 AS n_windows,
          CASE WHEN pos - 14 <= floor((n_rows - 15) * 0.7::DOUBLE) THEN 'train'
            WHEN pos - 14 <= floor((n_rows - 15) * (0.7::DOUBLE + 0.15::DOUBLE)) THEN 'val' ELSE 'test' END AS split
        FROM (SELECT *, count(*) OVER (w ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS in_window,
            {', '.join(f'first_value(z_{c}) OVER (w ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS first_{c}, sum(z_{c}) OVER (w ROWS BETWEEN 14 PRECEDING AND CURRENT ROW) AS sum_{c}' for c in FEATURES)}
          FROM scaled {W})
        WHERE in_window = 15 AND pos - 14 <= n_rows - 15""",
    "outcomes": f"""
        SELECT code, date, close AS price, next_price, close_pct_change, target_pct_change,
          CASE WHEN target_pct_change > 0.1 THEN 2 WHEN target_pct_change < -0.1 THEN 0 ELSE 1 END AS actual,
          CASE WHEN volume_change > 0.3 THEN 2 WHEN volume_change < -0.3 THEN 0 ELSE 1 END AS signal
        FROM (SELECT *, volume / lag(volume) OVER w - 1 AS volume_change, close / nullif(lag(close) OVER w, 0) - 1 AS close_pct_change,
            lead(close) OVER w AS next_price, lead(close) OVER w / nullif(close, 0) - 1 AS target_pct_change
          FROM bars_day {W})
        WHERE close_pct_change IS NOT NULL AND target_pct_change IS NOT NULL""",
    "out_rows": f"""
        SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY code) AS n,
          CASE WHEN row_number() OVER w <= floor(count(*) OVER (PARTITION BY code) * 0.7::DOUBLE) THEN 'train'
            WHEN row_number() OVER w <= floor(count(*) OVER (PARTITION BY code) * (0.7::DOUBLE + 0.15::DOUBLE))
              THEN 'val' ELSE 'test' END AS split
        FROM outcomes {W}""",
    "ar1": """
        SELECT code, regr_slope(target_pct_change, close_pct_change) AS slope,
          regr_intercept(target_pct_change, close_pct_change) AS intercept
        FROM out_rows WHERE split = 'train' GROUP BY code""",
    "forecasts": """
        SELECT o.*, intercept + slope * close_pct_change AS predicted_change,
          price * (1 + (intercept + slope * close_pct_change)) AS predicted_price
        FROM out_rows o JOIN ar1 USING (code)""",
    "spread": """
        SELECT code, stddev_samp(target_pct_change - predicted_change) AS error_std
        FROM forecasts WHERE split = 'val' GROUP BY code""",
    "banded": """
        SELECT f.*, price * (1 + (predicted_change - 1.96::DOUBLE * error_std)) AS lower_price,
          price * (1 + (predicted_change + 1.96::DOUBLE * error_std)) AS upper_price
        FROM forecasts f JOIN spread USING (code) WHERE split = 'test'""",
    "states": """
        SELECT *, lead(1) OVER w IS NULL AS is_last, lag(price) OVER w AS prev_price,
          coalesce(last_value(CASE WHEN signal <> 1 THEN signal END IGNORE NULLS)
            OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 2 AS held,
          coalesce(last_value(CASE WHEN signal <> 1 THEN signal END IGNORE NULLS) OVER w, 0) = 2 AS state
        FROM outcomes WINDOW w AS (PARTITION BY code ORDER BY date)""",
    "growths": """
        SELECT *, CASE WHEN is_last THEN held ELSE state <> held END AS trade,
          (CASE WHEN held THEN (CASE WHEN is_last THEN next_price ELSE price END) / prev_price ELSE 1.0::DOUBLE END)
            * (CASE WHEN (CASE WHEN is_last THEN held ELSE state <> held END)
                THEN 1.0::DOUBLE - 0.001::DOUBLE ELSE 1.0::DOUBLE END) AS model_growth,
          CASE WHEN prev_price IS NULL THEN 1.0::DOUBLE - 0.001::DOUBLE ELSE price / prev_price END AS hold_growth
        FROM states""",
    "curves": """
        SELECT *, 1e8::DOUBLE * product(model_growth) OVER w AS model_equity,
          1e8::DOUBLE * product(hold_growth) OVER w AS hold_equity
        FROM growths WINDOW w AS (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING)""",
    "peaks": """
        SELECT *, greatest(max(model_equity) OVER w, 1e8::DOUBLE) AS model_peak,
          greatest(max(hold_equity) OVER w, 1e8::DOUBLE) AS hold_peak
        FROM curves WINDOW w AS (PARTITION BY code ORDER BY date ROWS UNBOUNDED PRECEDING)""",
}


SCALE = ["open", "close", "volume"]
BARS = ["open", "high", "low", "close", "volume"]


def _reg_sql(p: str) -> str:
    return f"""SELECT code, sqrt(avg((next_price - {p}) * (next_price - {p}))) AS rmse,
      avg(abs(next_price - {p})) AS mae,
      1 - sum((next_price - {p}) * (next_price - {p})) / (count(*) * var_pop(next_price)) AS r2
    FROM forecasts WHERE split = 'test' GROUP BY code"""


CTES["gap_rows"] = f"SELECT code, date, close, row_number() OVER w AS rn FROM null_day {W}"
CTES["gap_mean"] = f"WITH RECURSIVE e AS ({gap_ema('gap_rows', 'close', 10)}) SELECT code, rn, y FROM e"
CTES["next_rows"] = f"""
    SELECT code, date, close, t AS target_pct_change, row_number() OVER w AS pos, count(*) OVER (PARTITION BY code) AS n
    FROM (SELECT *, lead(close) OVER w / nullif(close, 0) - 1 AS t FROM bars_day {W}) WHERE t IS NOT NULL {W}"""
CTES["bounds_simple"] = """
    SELECT code, quantile_cont(target_pct_change, 0.33) AS lower_bound, quantile_cont(target_pct_change, 0.67) AS upper_bound
    FROM next_rows WHERE pos <= floor(n * 0.7::DOUBLE) GROUP BY code"""
CTES["labels_simple"] = """
    SELECT r.*, CASE WHEN target_pct_change > upper_bound THEN 2 WHEN target_pct_change < lower_bound THEN 0 ELSE 1 END AS target_trend
    FROM next_rows r JOIN bounds_simple USING (code)"""
CTES["next_bars"] = f"SELECT *, row_number() OVER w AS pos, count(*) OVER (PARTITION BY code) AS n FROM bars_day {W}"
CTES["unit_params"] = "SELECT code, " + ", ".join(
    f"min({c}) AS min_{c}, CASE WHEN max({c}) = min({c}) THEN 1 ELSE max({c}) - min({c}) END AS range_{c}"
    for c in BARS) + " FROM next_bars WHERE pos <= ceil(n * 0.8::DOUBLE) GROUP BY code"
CTES["unit_rows"] = "SELECT *, " + ", ".join(f"({c} - min_{c}) / range_{c} AS u_{c}" for c in BARS) + " FROM next_bars JOIN unit_params USING (code)"
CTES["base_rows"] = "SELECT *, count(*) OVER w AS k, " + ", ".join(
    f"first_value(u_{c}) OVER w AS first_{c}, sum(u_{c}) OVER w AS sum_{c}" for c in BARS) + (
    " FROM unit_rows WINDOW w AS (PARTITION BY code ORDER BY date ROWS BETWEEN 30 PRECEDING AND 1 PRECEDING)")
CTES["ar1_score"] = _reg_sql("predicted_price")
CTES["hold_score"] = _reg_sql("price")
CTES["tallies"] = "SELECT code, count(*)::DOUBLE AS s, count(*) FILTER (WHERE actual = signal)::DOUBLE AS c, " + ", ".join(
    f"count(*) FILTER (WHERE actual = {k})::DOUBLE AS t{k}, count(*) FILTER (WHERE signal = {k})::DOUBLE AS p{k}, "
    f"count(*) FILTER (WHERE actual = {k} AND signal = {k})::DOUBLE AS x{k}" for k in range(3)) + " FROM outcomes GROUP BY code"
CTES["ratios"] = "SELECT *, " + ", ".join(
    f"coalesce(x{k} / nullif(p{k}, 0), 0) AS precision_{n}, coalesce(x{k} / nullif(t{k}, 0), 0) AS recall_{n}"
    for k, n in enumerate(("down", "neutral", "up"))) + " FROM tallies"


def _on_intraday(name: str) -> str:
    """The same expression over the intraday bars, under names ending in ``_i``."""
    return re.sub(r"\b(" + "|".join(["bars_day", *_INDICATOR_CHAIN]) + r")\b", r"\1_i", CTES[name])


_INDICATOR_CHAIN = ["stepped", "moves", "rolled", "rolling", "rows_rolling", "means", "directional", "adx", "indicators"]
CTES["bars_day_i"] = "SELECT code, timestamp AS date, open, high, low, close, volume FROM bars_intraday"
CTES |= {f"{n}_i": _on_intraday(n) for n in _INDICATOR_CHAIN}


def _needs(text: str) -> list[str]:
    words = set(re.findall(r"[A-Za-z_][A-Za-z_0-9]*", text))
    return [n for n in CTES if n in words]


def sql(final: str) -> str:
    """``final`` preceded by the table expressions it uses, in dependency order."""
    order: list[str] = []

    def visit(text: str, me: str = "") -> None:
        for n in _needs(text):
            if n != me and n not in order:
                visit(CTES[n], n)
                if n not in order:
                    order.append(n)

    visit(final)
    if not order:
        return final
    parts = ", ".join(f"{n} AS MATERIALIZED ({' '.join(CTES[n].split())})" for n in order)
    return f"WITH {parts} {' '.join(final.split())}"
