"""Small bar series with gaps, NULL runs, ties, a one-row key and a hot key."""

import numpy as np
import pandas as pd

SCHEMA = "code string, date date, open double, high double, low double, close double, volume double"


def bars(seed=7, holes=True, sizes=(("HOT", 400), ("MID", 130), ("ONE", 1))):
    rng = np.random.default_rng(seed)
    frames = []
    for code, n in sizes:
        days = np.sort(rng.choice(np.arange(n * 2), n, replace=False))
        close = np.round(50 + np.cumsum(rng.normal(0, 1, n)).clip(-40, 40), 2)
        spread = np.round(rng.uniform(0, 2, (2, n)), 2)
        f = pd.DataFrame({
            "code": code, "date": (pd.Timestamp("2015-01-01") + pd.to_timedelta(days, "D")).date,
            "open": np.round(close + rng.normal(0, 0.5, n), 2), "high": close + spread[0],
            "low": close - spread[1], "close": close, "volume": rng.integers(0, 9, n).astype(float) * 10,
        })
        if holes:
            f.loc[rng.random(n) < 0.15, "close"] = np.nan
            if n > 200:
                f.loc[60:90, "close"] = np.nan
        if holes and code == "MID":
            f.loc[:6, "close"] = np.nan
        frames.append(f)
    return pd.concat(frames, ignore_index=True).sample(frac=1, random_state=seed).reset_index(drop=True)


def frame(spark, pdf):
    rows = [tuple(None if isinstance(v, float) and np.isnan(v) else v for v in r) for r in pdf.itertuples(index=False)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def ordered(pdf):
    return pdf.sort_values(["code", "date"]).reset_index(drop=True)


def collected(df):
    pdf = ordered(df.toPandas())
    for c in pdf.columns:
        if c not in ("code", "date", "split") and pdf[c].dtype == object:
            pdf[c] = pd.to_numeric(pdf[c])
    return pdf


def per_code(pdf, fn):
    """Series of fn(code frame) in (code, date) order."""
    return pd.concat([fn(g) for _, g in ordered(pdf).groupby("code", sort=True)]).reset_index(drop=True)


def same(got, want, tol=1e-9):
    got, want = got.astype(float).reset_index(drop=True), want.astype(float).reset_index(drop=True)
    assert (got.isna() == want.isna()).all()
    assert ((got - want).abs().fillna(0) <= tol * (1 + want.abs().fillna(0))).all()
