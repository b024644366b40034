"""Fixed values of the training and evaluation set-up; results depend on them."""

from __future__ import annotations

from dataclasses import dataclass

# Feature columns whose relative change is used, then those used as they are.
CHANGE_FEATURES = [
    "open", "high", "low", "close", "volume", "SMA_10", "EMA_10", "MACD", "BB_upper", "BB_lower", "ATR_14",
]
LEVEL_FEATURES = ["RSI_14", "ADX_14", "STOCHk_14_3_3"]
FEATURES = [f"{c}_pct_change" for c in CHANGE_FEATURES] + LEVEL_FEATURES

# Class numbers of the trend label.
DOWN, NEUTRAL, UP = 0, 1, 2
TREND_NAMES = {DOWN: "Down", NEUTRAL: "Neutral", UP: "Up"}

BASELINE_FEATURES = ["open", "high", "low", "close", "volume"]


@dataclass(frozen=True)
class Settings:
    window: int = 15
    train_ratio: float = 0.7
    val_ratio: float = 0.15
    lower_quantile: float = 0.33
    upper_quantile: float = 0.67
    min_rows: int = 100
    baseline_window: int = 30
    baseline_train_ratio: float = 0.8
    baseline_min_rows: int = 80
    regression_weight: float = 1.0
    class_weight: float = 5.0
    band: float = 1.96
    capital: float = 100_000_000.0
    fee: float = 0.001
    days_per_year: int = 252


DEFAULT = Settings()
