"""Immutable settings shared by every job."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date

# The look-back lengths, return look-backs and column names below must
# equal the published feature catalogue for results to line up.
LOOKBACK_DAYS = (30, 90, 180, 365)
RETURN_LOOKBACK_DAYS = (90, 180, 365)
TARGET = "revenue_2018_2019"
SCORED = "predicted_revenue_2018_2019"


@dataclass(frozen=True)
class FeatureSettings:
    """How the customer features are computed.

    ``keep_redundant`` keeps the columns that are dropped by default because they
    repeat another column; it also turns on the exact per-customer medians.
    ``hot_share`` and ``hot_floor`` say when a customer counts as hot (see
    ``operators.skew``).
    """

    reference_date: date = date(2017, 12, 31)
    keep_redundant: bool = False
    hot_share: float = 0.001
    hot_floor: int = 2_000_000

    def with_(self, **changes) -> "FeatureSettings":
        return replace(self, **changes)


@dataclass(frozen=True)
class LifetimeSettings:
    """RFM and lifetime-value settings.

    The horizon is counted in days, like every age in the RFM table. The published
    runs pass 24, meant as months but used as days; that stays the default.
    """

    period_end: date = date(2017, 12, 31)
    horizon_days: float = 24.0
    penalty: float = 0.01
    only_kept_items: bool = False


@dataclass(frozen=True)
class ModelSettings:
    """Two-stage model settings. Tree counts default to the published ones."""

    seed: int = 42
    validation_share: float = 0.2
    classifier_trees: int = 400
    regressor_trees: int = 300
    max_depth: int = 12
    min_leaf: int = 5
    thresholds: tuple[float, ...] = tuple(k * 5 / 100 for k in range(1, 11))


@dataclass(frozen=True)
class Paths:
    """Where tables are read and written; any URI Spark's file systems accept."""

    transactions: str
    train: str
    test: str
    features: str
    output: str
