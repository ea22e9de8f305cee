"""Probability expressions shared by scoring, calibration and evaluation."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def sigmoid(x: Column, limit: float | None = None) -> Column:
    if limit is not None:
        x = F.greatest(F.lit(-limit), F.least(F.lit(limit), x))
    return 1.0 / (1.0 + F.exp(-x))


def platt(logit: Column, slope: float, intercept: float) -> Column:
    return sigmoid(F.lit(float(slope)) * logit + F.lit(float(intercept)), limit=80.0)


def clip(p: Column, eps: float) -> Column:
    return F.greatest(F.lit(eps), F.least(F.lit(1.0 - eps), p))


def log_loss(p: Column, label: Column, eps: float) -> Column:
    """Row-wise loss; average it to get the metric."""
    p = clip(p, eps)
    return -(label * F.ln(p) + (1 - label) * F.ln(1.0 - p))
