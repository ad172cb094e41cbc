"""Settings of the demand operators, immutable; change one with dataclasses.replace."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date


@dataclass(frozen=True)
class Calendar:
    train_end: date = date(2001, 7, 1)
    holdout: tuple[date, ...] = (date(2001, 8, 1), date(2001, 9, 1))
    first_month: date = date(1995, 1, 1)
    last_month: date = date(2002, 7, 1)


@dataclass(frozen=True)
class Segments:
    trailing_months: int = 12
    zero_ratio: float = 0.40


@dataclass(frozen=True)
class Features:
    lags: tuple[int, ...] = (1, 2, 3, 6, 12, 24)
    windows: tuple[int, ...] = (3, 6, 12)
    momentum_clip: float = 5.0
    growth_low: float = 0.1
    growth_high: float = 10.0
    required: tuple[tuple[int, tuple[str, ...]], ...] = (
        (1, ("lag_1", "lag_2", "lag_3", "rolling_mean_3")),
        (3, ("lag_1", "lag_3", "lag_6", "lag_12", "rolling_mean_6")),
        (12, ("lag_12", "lag_24", "rolling_mean_12")),
    )


@dataclass(frozen=True)
class Folds:
    """Walk-forward origins: `count` of them, `step` months apart, each with at least `least` months of history."""

    horizon: int
    count: int
    step: int
    least: int


#: Models that are tried for each segment and horizon.
ROSTER = {
    ("REGULAR", 1): ("seasonal_naive",),
    ("REGULAR", 3): ("seasonal_naive", "seasonal_avg3y"),
    ("REGULAR", 12): ("seasonal_avg3y",),
    ("INTERMITTENT", 1): ("croston_sba", "seasonal_naive"),
    ("INTERMITTENT", 3): ("croston_sba", "seasonal_avg3y"),
    ("INTERMITTENT", 12): ("seasonal_avg3y", "seasonal_naive"),
    ("DEAD", 1): ("zero",),
    ("DEAD", 3): ("zero",),
    ("DEAD", 12): ("zero",),
}
#: The roster's global regressors: one model of all series of the segment, by horizon. What they say has no SQL.
LEARNT = {("REGULAR", 1): ("gbt",), ("REGULAR", 3): ("gbt",)}

#: What a model of each horizon sees, besides the codes of its categories.
INPUTS = {
    1: ("lag_1", "lag_2", "lag_3", "mean_3", "std_3", "std_6", "mean_12", "month_sin", "month_cos", "month_of_year", "quarter", "year", "trend"),
    3: ("lag_1", "lag_3", "lag_6", "lag_12", "mean_3", "mean_6", "mean_12", "std_3", "std_6", "momentum_3", "month_sin", "month_cos", "month_of_year", "quarter", "year", "trend"),
    12: ("lag_12", "lag_24", "mean_12", "std_12", "std_6", "yoy_growth", "month_sin", "month_cos", "month_of_year", "quarter", "year", "trend"),
}
#: Months of history without which a row of a horizon isn't learnt from: its longest required lag.
HISTORY = {1: 3, 3: 12, 12: 24}

FOLDS = (Folds(1, 6, 3, 24), Folds(3, 4, 3, 24), Folds(12, 3, 12, 36))


@dataclass(frozen=True)
class Adjustments:
    """Fixed values of the corrections after a model, and of what a recursion feeds back."""

    shrink_threshold: float = 1.5
    shrink_weight: float = 0.8  # of the forecast; the rest is the mean of the last three months
    recursive_alpha: float = 0.7
    blend_threshold: float = 0.25
    blend_weight: float = 0.7
    cap_multiple: float = 2.0


#: The settings of the planning notebooks.
CAUTIOUS = Adjustments(shrink_threshold=1.3, shrink_weight=0.75, recursive_alpha=0.6, blend_threshold=0.20)


@dataclass(frozen=True)
class Shares:
    """Rules that split a parent's forecast among its children."""

    window: int = 12
    least_months: int = 6
    recency: bool = False
    recency_steps: tuple[tuple[int, float], ...] = ((2, 3.0), (5, 2.0))
    recency_rest: float = 1.0
    smoothing: float = 0.0
    cap: float = 0.0
    unseen: str = "equal"  # or "zero"


@dataclass(frozen=True)
class Profiles:
    near_dead_units: float = 10.0
    near_dead_months: int = 3
    recent_months: int = 6
    sparsity: float = 0.65
    child_months: float = 6.0
    dominant: float = 0.70
    stable: float = 0.10


@dataclass(frozen=True)
class Calibration:
    low: float
    high: float
    strong: tuple[int, float]
    moderate: tuple[int, float]
    weak: int = 1
    gate: float = 0.25


BACKTEST = Calibration(0.85, 1.15, (6, 500.0), (3, 200.0))
CROSS_VALIDATED = Calibration(0.80, 1.20, (8, 0.0), (4, 0.0), 2)
GLOBAL = Calibration(0.95, 1.05, (1, 0.0), (1, 0.0))
BOUNDS = 0.20
CROSTON_ALPHA = 0.2
MODEL_VERSION = "weftline-1"
