"""Discounting and offer arithmetic as column expressions and plain parameters."""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def check_share(value: float, name: str) -> float:
    if not math.isfinite(value) or not 0.0 <= value <= 1.0:
        raise ValueError(f"{name} must lie in [0, 1], got {value!r}")
    return float(value)


def check_amount(value: float, name: str) -> float:
    if not math.isfinite(value) or value < 0.0:
        raise ValueError(f"{name} must be finite and not negative, got {value!r}")
    return float(value)


def monthly_rate(annual_rate: float) -> float:
    """Effective monthly rate of an effective annual rate."""
    return math.pow(1.0 + check_amount(annual_rate, "annual rate"), 1.0 / 12.0) - 1.0


def annuity_factor(retention: float, annual_rate: float, months: int) -> float:
    """Present value of 1 per month that survives with ``retention`` per month.

    The factor depends on parameters only, so it enters plans as one literal.
    """
    check_share(retention, "monthly retention")
    if isinstance(months, bool) or not isinstance(months, int) or months <= 0:
        raise ValueError(f"horizon must be a positive number of months, got {months!r}")
    step = 1.0 + monthly_rate(annual_rate)
    return math.fsum(retention ** (month - 1) / step ** month for month in range(1, months + 1))


def clv(monthly_revenue: Column, margin: float, retention: float, annual_rate: float,
        months: int) -> Column:
    """Modeled customer value over a horizon; fails on negative or non-finite revenue."""
    factor = check_share(margin, "contribution margin") * annuity_factor(
        retention, annual_rate, months)
    usable = monthly_revenue.isNull() | ((monthly_revenue >= 0) & (monthly_revenue < math.inf))
    return F.when(usable, monthly_revenue * F.lit(factor)).otherwise(
        F.raise_error(F.lit("monthly revenue must be finite and not negative")).cast("double"))


def npv_of_array(cash_flows: Column, rate: float, margin: float = 1.0,
                 upfront_cost: float = 0.0) -> Column:
    """Net present value of an array of monthly cash flows, the first due in month 1."""
    step = 1.0 + check_amount(rate, "monthly rate")
    margin = check_share(margin, "contribution margin")
    discounted = F.transform(cash_flows, lambda flow, i: flow * margin / F.pow(F.lit(step), i + 1))
    return F.aggregate(discounted, F.lit(0.0), lambda total, value: total + value) - F.lit(
        check_amount(upfront_cost, "offer cost"))


def npv_sum(cash_flow: Column, month: Column, rate: float, margin: float = 1.0,
            upfront_cost: float = 0.0) -> Column:
    """Net present value as an aggregate over long cash flows: one row per month."""
    step = 1.0 + check_amount(rate, "monthly rate")
    margin = check_share(margin, "contribution margin")
    return F.sum(cash_flow * margin / F.pow(F.lit(step), month)) - F.lit(
        check_amount(upfront_cost, "offer cost"))


def offer_value(probability: Column, contribution: Column, cost: Column) -> Column:
    """Expected contribution of an offer less its cost; fails outside valid ranges."""
    valid = (probability.between(0.0, 1.0) & (contribution >= 0) & (contribution < math.inf)
             & (cost >= 0) & (cost < math.inf))
    return F.when(valid, probability * contribution - cost).otherwise(
        F.raise_error(F.lit("offer inputs are missing or out of range")).cast("double"))
