import pytest

from basketlens.functions.days import (
    feature_bounds, in_feature_window, in_outcome_window, outcome_bounds,
)
from basketlens.functions.finance import annuity_factor, monthly_rate
from basketlens.settings import (
    FeatureWindows, FinanceAssumptions, SensitivityGrid, SplitPlan,
)


def test_windows_are_half_open(frame):
    days = frame([(d,) for d in range(1, 6)], "DAY int")
    assert [r.DAY for r in in_feature_window(days, 4, 2).orderBy("DAY").collect()] == [2, 3]
    assert [r.DAY for r in in_outcome_window(days, 4, 2).orderBy("DAY").collect()] == [4, 5]
    assert in_feature_window(days, 4).count() == 3


def test_bounds_reject_wrong_values():
    assert feature_bounds(10) == (None, 10)
    assert outcome_bounds(10, 3) == (10, 13)
    for bad in (0, -1, True, 2.5):
        with pytest.raises(ValueError):
            feature_bounds(10, bad)
        with pytest.raises(ValueError):
            outcome_bounds(10, bad)
    for bad in (True, "4", 4.0):
        with pytest.raises(ValueError):
            feature_bounds(bad)


def test_settings_are_validated():
    with pytest.raises(ValueError):
        FeatureWindows(outcome=0)
    with pytest.raises(ValueError):
        SplitPlan(train_fraction=0.8, validation_fraction=0.2)
    for wrong in ({"contribution_margin": 1.2}, {"monthly_retention_rate": -0.1},
                  {"annual_discount_rate": float("nan")}, {"default_offer_cost": -1.0},
                  {"observed_history_days": 0}, {"days_per_month": 0.0},
                  {"response_scenario": "two_baskets"}):
        with pytest.raises(ValueError):
            FinanceAssumptions(**wrong)
    with pytest.raises(ValueError):
        SensitivityGrid(margins=(1.2,))


def test_assumptions_from_mapping_need_every_value():
    values = {"observed_history_days": 711, "days_per_month": 30.436875,
              "horizon_months": {"short": 12, "long": 24}, "annual_discount_rate": 0.1,
              "contribution_margin": 0.25, "monthly_retention_rate": 0.9,
              "default_offer_cost": 5.0, "response_scenario": "one_average_basket"}
    assert FinanceAssumptions.from_mapping(values).long_horizon == 24
    del values["contribution_margin"]
    with pytest.raises(ValueError, match="contribution_margin"):
        FinanceAssumptions.from_mapping(values)


def test_monthly_rate_compounds_to_the_annual_rate():
    assert (1 + monthly_rate(0.10)) ** 12 == pytest.approx(1.10)
    for bad in (-0.01, float("nan"), float("inf")):
        with pytest.raises(ValueError):
            monthly_rate(bad)
    step = 1 + monthly_rate(0.10)
    assert 20 * annuity_factor(0.9, 0.1, 2) == pytest.approx(20 / step + 18 / step ** 2)
