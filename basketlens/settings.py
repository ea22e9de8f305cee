"""Parameter sets, validated once when they are created."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from basketlens.functions.days import check_day, check_length
from basketlens.functions.finance import check_amount, check_share, monthly_rate


@dataclass(frozen=True)
class FeatureWindows:
    cutoff: int = 2406
    lookback: int | None = None
    outcome: int | None = None

    def __post_init__(self) -> None:
        check_day(self.cutoff)
        if self.lookback is not None:
            check_length(self.lookback, "lookback")
        if self.outcome is not None:
            check_length(self.outcome, "outcome window")


@dataclass(frozen=True)
class SplitPlan:
    lookback: int = 90
    train_fraction: float = 0.6
    validation_fraction: float = 0.2

    def __post_init__(self) -> None:
        check_length(self.lookback, "lookback")
        shares = (self.train_fraction, self.validation_fraction)
        if any(not 0 < share < 1 for share in shares) or sum(shares) >= 1:
            raise ValueError("split fractions must be positive and leave room for a test split")


@dataclass(frozen=True)
class FinanceAssumptions:
    observed_history_days: int = 711
    days_per_month: float = 30.436875
    short_horizon: int = 12
    long_horizon: int = 24
    annual_discount_rate: float = 0.10
    contribution_margin: float = 0.25
    monthly_retention_rate: float = 0.90
    default_offer_cost: float = 5.0
    response_scenario: str = "one_average_basket"

    def __post_init__(self) -> None:
        if check_day(self.observed_history_days, "observed history") <= 0:
            raise ValueError("observed history must cover at least one day")
        if not math.isfinite(self.days_per_month) or self.days_per_month <= 0:
            raise ValueError("days per month must be positive")
        for months in (self.short_horizon, self.long_horizon):
            check_length(months, "horizon")
        monthly_rate(self.annual_discount_rate)
        check_share(self.contribution_margin, "contribution margin")
        check_share(self.monthly_retention_rate, "monthly retention")
        check_amount(self.default_offer_cost, "offer cost")
        if self.response_scenario != "one_average_basket":
            raise ValueError("the only supported response scenario is one_average_basket")

    @classmethod
    def from_mapping(cls, values: dict) -> "FinanceAssumptions":
        """Build from a configuration mapping in which every assumption must be stated."""
        horizons = values.get("horizon_months") or {}
        flat = {**values, "short_horizon": horizons.get("short"),
                "long_horizon": horizons.get("long")}
        names = [name for name in cls.__dataclass_fields__]
        missing = [name for name in names if flat.get(name) is None]
        if missing:
            raise ValueError(f"missing finance assumptions: {missing}")
        return cls(**{name: flat[name] for name in names})

    @property
    def observed_months(self) -> float:
        return self.observed_history_days / self.days_per_month

    @property
    def monthly_discount_rate(self) -> float:
        return monthly_rate(self.annual_discount_rate)


@dataclass(frozen=True)
class SensitivityGrid:
    margins: tuple[float, ...] = (0.15, 0.25, 0.35)
    retentions: tuple[float, ...] = (0.80, 0.90, 0.95)
    discount_rates: tuple[float, ...] = (0.05, 0.10, 0.15)
    offer_costs: tuple[float, ...] = (2.5, 5.0, 7.5)

    def __post_init__(self) -> None:
        for value in self.margins:
            check_share(value, "sensitivity margin")
        for value in self.retentions:
            check_share(value, "sensitivity retention")
        for value in self.discount_rates:
            monthly_rate(value)
        for value in self.offer_costs:
            check_amount(value, "sensitivity offer cost")


@dataclass(frozen=True)
class QualityRules:
    required: tuple[str, ...] = ()
    allowed: tuple[str, ...] = ()
    numeric: tuple[str, ...] = ()
    dates: dict[str, str] = field(default_factory=dict)
    max_null_rate: float = 1.0
