"""Campaign and campaign-household tables: observed exposure, spend and redemption."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from basketlens.functions.days import between_days, feature_bounds, within_interval
from basketlens.operators.features import or_zero
from basketlens.settings import FeatureWindows

PERIODS = ("spend_before_campaign", "spend_during_campaign", "spend_after_campaign")


def eligible_campaigns(campaigns: DataFrame, windows: FeatureWindows) -> DataFrame:
    lower, upper = feature_bounds(windows.cutoff, windows.lookback)
    return campaigns.select(
        "CAMPAIGN", F.col("DESCRIPTION").alias("campaign_type"), "START_DAY", "END_DAY"
    ).where(between_days(F.col("START_DAY"), lower, upper))


def _exposures(eligible: DataFrame, assignments: DataFrame) -> DataFrame:
    return assignments.select("household_key", "CAMPAIGN").join(eligible, "CAMPAIGN")


def period_spend(exposures: DataFrame, transactions: DataFrame,
                 windows: FeatureWindows) -> DataFrame:
    """Spend before, during and after each campaign, per assigned household.

    Spend is first summed per (household, day).  A household then has at most
    one row per day of the calendar, so neither a very busy household nor the
    number of its campaigns can blow up the join on the household.
    """
    day, start, end = F.col("DAY"), F.col("START_DAY"), F.col("END_DAY")
    before = day < start
    if windows.lookback is not None:
        before &= day >= start - windows.lookback
    after = day > end
    if windows.outcome is not None:
        after &= day <= end + windows.outcome
    daily = (transactions.where(between_days(day, None, windows.cutoff))
             .groupBy("household_key", "DAY").agg(F.sum("SALES_VALUE").alias("sales")))
    parts = zip(PERIODS, (before, within_interval(day, start, end), after))
    return (daily.join(exposures.select("household_key", "CAMPAIGN", "START_DAY", "END_DAY"),
                       "household_key")
            .groupBy("household_key", "CAMPAIGN")
            .agg(*[F.sum(F.when(in_period, F.col("sales"))).alias(name)
                   for name, in_period in parts]))


def redemptions_per_day(redemptions: DataFrame) -> DataFrame:
    """At most one row per (household, campaign, day), whatever the number of coupons."""
    return redemptions.groupBy("household_key", "CAMPAIGN", "DAY").agg(
        F.count(F.lit(1)).alias("redeemed"))


def interval_redemptions(exposures: DataFrame, redemptions: DataFrame,
                         before_day: int | None = None) -> DataFrame:
    """Redemptions of a campaign by its assigned households within its interval."""
    per_day = redemptions_per_day(
        redemptions if before_day is None else redemptions.where(F.col("DAY") < before_day))
    spans = exposures.select("household_key", "CAMPAIGN", "START_DAY", "END_DAY")
    return (per_day.join(spans, ["household_key", "CAMPAIGN"])
            .where(within_interval(F.col("DAY"), F.col("START_DAY"), F.col("END_DAY")))
            .groupBy("household_key", "CAMPAIGN")
            .agg(F.sum("redeemed").alias("coupon_redemption_count")))


def _campaign_households_exact(eligible: DataFrame, assignments: DataFrame,
                               transactions: DataFrame, redemptions: DataFrame,
                               windows: FeatureWindows) -> DataFrame:
    """The campaign-household table with money in the type of its source."""
    exposures = _exposures(eligible, assignments)
    end = F.col("END_DAY")
    complete = end + (windows.outcome or 0) < windows.cutoff
    days_after = F.greatest(F.lit(0), F.lit(windows.cutoff - 1) - end)
    if windows.outcome is not None:
        days_after = F.least(days_after, F.lit(windows.outcome))
    keys = ["household_key", "CAMPAIGN"]
    before, during, after = (F.coalesce(F.col(name), F.lit(0).cast("decimal(18,4)"))
                             for name in PERIODS)
    return (exposures
            .join(period_spend(exposures, transactions, windows), keys, "left")
            .join(interval_redemptions(exposures, redemptions, windows.cutoff), keys, "left")
            .select(
                *keys, "campaign_type", "START_DAY", "END_DAY",
                F.lit(1).alias("campaign_exposure"), or_zero("coupon_redemption_count"),
                before.alias(PERIODS[0]), during.alias(PERIODS[1]),
                F.when(complete, after).alias(PERIODS[2]),
                days_after.alias("post_campaign_days_observed"),
                (end < windows.cutoff).alias("campaign_window_complete"),
                complete.alias("post_campaign_observation_complete")))


def _as_double(df: DataFrame) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("double") for name in PERIODS})


def campaign_households(campaigns: DataFrame, assignments: DataFrame, transactions: DataFrame,
                        redemptions: DataFrame, windows: FeatureWindows) -> DataFrame:
    """One row per assigned (household, campaign) that started before the cutoff."""
    return _as_double(_campaign_households_exact(
        eligible_campaigns(campaigns, windows), assignments, transactions, redemptions, windows))


def campaign_features(campaigns: DataFrame, assignments: DataFrame, transactions: DataFrame,
                      redemptions: DataFrame, windows: FeatureWindows) -> DataFrame:
    """One row per eligible campaign; without assignments counts are 0 and the rest null."""
    eligible = eligible_campaigns(campaigns, windows)
    totals = _campaign_households_exact(
        eligible, assignments, transactions, redemptions, windows
    ).groupBy("CAMPAIGN").agg(
        F.count(F.lit(1)).alias("exposed_households"),
        F.sum("coupon_redemption_count").alias("coupon_redemption_count"),
        F.count_if(F.col("coupon_redemption_count") > 0).alias("redeeming_households"),
        *[F.sum(name).alias(name) for name in PERIODS],
        F.bool_and("campaign_window_complete").alias("campaign_window_complete"),
        F.bool_and("post_campaign_observation_complete")
        .alias("post_campaign_observation_complete"),
        F.max("post_campaign_days_observed").alias("post_campaign_days_observed"))
    return _as_double(eligible.join(totals, "CAMPAIGN", "left").select(
        "CAMPAIGN", "campaign_type", "START_DAY", "END_DAY",
        or_zero("exposed_households"), or_zero("coupon_redemption_count"),
        or_zero("redeeming_households"), *PERIODS,
        "campaign_window_complete", "post_campaign_observation_complete",
        "post_campaign_days_observed",
        F.when(F.col("exposed_households") > 0,
               F.col("redeeming_households") / F.col("exposed_households"))
        .alias("descriptive_redemption_rate")))
