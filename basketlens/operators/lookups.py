"""Batch lookups and rankings over the feature, economics and offer tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.operators.marts import covered_campaigns, offers_per_household
from basketlens.operators.response import Calibrator

# The columns that lookups return, in their order.
CLV_METRICS = ("modeled_12_month_clv", "modeled_24_month_clv")
CAMPAIGN_FIELDS = (
    "CAMPAIGN", "campaign_type", "START_DAY", "END_DAY", "exposed_households",
    "coupon_redemption_count", "redeeming_households", "descriptive_redemption_rate",
    "spend_before_campaign", "spend_during_campaign", "spend_after_campaign",
    "campaign_window_complete", "post_campaign_observation_complete",
    "post_campaign_days_observed")
OFFER_FIELDS = (
    "household_key", "CAMPAIGN", "START_DAY", "calibrated_response_probability",
    "expected_contribution_if_response", "assumed_offer_cost", "break_even_offer_cost",
    "modeled_expected_offer_value")


def check_limit(limit: int, largest: int) -> int:
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= largest:
        raise ValueError(f"limit must lie between 1 and {largest}, got {limit!r}")
    return limit


def _status(found: Column) -> Column:
    return F.when(found, "found").otherwise("unavailable")


def customer_lookup(requests: DataFrame, customers: DataFrame, economics: DataFrame,
                    offers: DataFrame) -> DataFrame:
    """Behaviour, value and held-out scores for every requested household key."""
    values = economics.select(
        "household_key", "historical_revenue", "basket_count", *CLV_METRICS)
    scores = offers_per_household(offers, OFFER_FIELDS[1:])
    known = customers.withColumn("known", F.lit(True))
    return (requests.select("household_key").distinct()
            .join(known, "household_key", "left").join(values, "household_key", "left")
            .join(scores, "household_key", "left")
            .withColumn("status", _status(F.col("known"))).drop("known"))


def campaign_lookup(requests: DataFrame, campaigns: DataFrame) -> DataFrame:
    """The saved summary of every requested campaign."""
    known = campaigns.select(*CAMPAIGN_FIELDS).withColumn("known", F.lit(True))
    return (requests.select("CAMPAIGN").distinct().join(known, "CAMPAIGN", "left")
            .withColumn("status", _status(F.col("known"))).drop("known"))


def rank_customers(economics: DataFrame, limit: int = 10,
                   metric: str = "modeled_12_month_clv") -> DataFrame:
    if metric not in CLV_METRICS:
        raise ValueError(f"metric must be one of {CLV_METRICS}, got {metric!r}")
    return economics.select("household_key", metric, "historical_revenue", "basket_count").orderBy(
        F.desc(metric), "household_key").limit(check_limit(limit, 100))


def rank_campaigns(campaigns: DataFrame, redemptions: DataFrame, limit: int = 10) -> DataFrame:
    """Campaigns by redemption rate, among those whose interval was fully observed."""
    fields = [f for f in CAMPAIGN_FIELDS
              if not f.startswith("spend") and f != "post_campaign_days_observed"]
    return (covered_campaigns(campaigns, redemptions)
            .where(F.col("descriptive_redemption_rate").isNotNull()).select(*fields)
            .orderBy(F.desc("descriptive_redemption_rate"), "CAMPAIGN")
            .limit(check_limit(limit, 30)))


def offer_lookup(offers: DataFrame, household_key: int | None = None,
                 campaign: int | None = None, limit: int = 20) -> DataFrame:
    """Stored offers, best value first, optionally of one household or campaign."""
    if household_key is not None:
        offers = offers.where(F.col("household_key") == household_key)
    if campaign is not None:
        offers = offers.where(F.col("CAMPAIGN") == campaign)
    return offers.select(*OFFER_FIELDS).orderBy(
        F.desc("modeled_expected_offer_value"), "household_key", "CAMPAIGN").limit(
        check_limit(limit, 100))


def model_metrics(report: DataFrame, baselines: DataFrame, calibrator: Calibrator,
                  split: str = "test") -> DataFrame:
    """Stored metrics of one split, with how its scores were calibrated.

    Calibrated scores are reported for validation and test rows, baselines for the test split.
    """
    if split not in ("train", "validation", "test"):
        raise ValueError(f"unknown split {split!r}")
    chosen = report.where(F.col("data_split") == split)
    if split == "train":
        chosen = chosen.where(F.col("score_kind") != "calibrated")
    if split == "test":
        chosen = chosen.unionByName(baselines.where(F.col("data_split") == split))
    calibrated = F.col("score_kind") == "calibrated"
    return chosen.withColumns({
        "calibration_method": F.when(calibrated, "platt_scaling"),
        "calibration_split": F.when(calibrated, calibrator.fit_split)})
