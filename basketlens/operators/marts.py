"""Reporting marts: headline figures, distributions, segments and joined profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.functions.bins import equal_width_bin
from basketlens.operators.campaigns import PERIODS
from basketlens.operators.ordering import first_by_rank, interpolated_quantiles, median
from basketlens.operators.quality import many_to_one
from basketlens.sources.sinks import stable

SEGMENTS = ("Lower modeled CLV", "Middle modeled CLV", "Higher modeled CLV")


def observed_maximum(df: DataFrame, column: str = "DAY") -> DataFrame:
    """Largest observed day; null when there are no rows."""
    return df.agg(F.max(column).alias(f"max_{column.lower()}"))


def covered_campaigns(campaigns: DataFrame, redemptions: DataFrame) -> DataFrame:
    """Campaigns that end within observed redemption days; all of them if none are known."""
    last_day = observed_maximum(redemptions).scalar()
    return campaigns.where(last_day.isNull() | (F.col("END_DAY") <= last_day))


def pooled_rate(redeeming: Column, exposed: Column) -> Column:
    return F.when(exposed > 0, redeeming / exposed)


def campaign_totals(campaigns: DataFrame) -> DataFrame:
    """Campaign count, exposures, redeeming households and their pooled rate."""
    exposed, redeeming = F.sum("exposed_households"), F.sum("redeeming_households")
    return campaigns.agg(
        F.count(F.lit(1)).alias("campaigns"),
        F.coalesce(exposed, F.lit(0)).alias("exposed_households"),
        F.coalesce(redeeming, F.lit(0)).alias("redeeming_households"),
        pooled_rate(redeeming, exposed).alias("pooled_redemption_rate"))


def campaign_totals_by_type(campaigns: DataFrame) -> DataFrame:
    exposed, redeeming = F.sum("exposed_households"), F.sum("redeeming_households")
    return campaigns.groupBy("campaign_type").agg(
        F.count(F.lit(1)).alias("campaigns"), exposed.alias("exposed_households"),
        redeeming.alias("redeeming_households"),
        pooled_rate(redeeming, exposed).alias("pooled_redemption_rate"))


def headline_figures(customers: DataFrame, economics: DataFrame, campaigns: DataFrame,
                     redemptions: DataFrame, offers: DataFrame) -> DataFrame:
    """One row of headline figures over the whole base."""
    values = stable(economics.select("modeled_12_month_clv"))
    rate = campaign_totals(covered_campaigns(campaigns, redemptions)).select(
        "pooled_redemption_rate").scalar()
    return customers.agg(
        F.count(F.lit(1)).alias("households"),
        F.sum("total_sales").alias("historical_sales"),
        F.sum("transaction_count").alias("observed_baskets"),
        F.avg("average_basket_value").alias("mean_basket_value")).withColumns({
            "mean_12_month_clv": values.agg(F.avg("modeled_12_month_clv")).scalar(),
            "median_12_month_clv": F.lit(median(values, "modeled_12_month_clv")).cast("double"),
            "pooled_redemption_rate": rate,
            "mean_response_probability": offers.agg(
                F.avg("calibrated_response_probability")).scalar(),
            "mean_offer_value": offers.agg(F.avg("modeled_expected_offer_value")).scalar()})


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between the smallest and the largest value, empty bins too.

    A column of one value has one bin.
    """
    low, high = df.agg(F.min(column)).scalar(), df.agg(F.max(column)).scalar()
    value = F.col(column)
    counts = df.where(value.isNotNull()).groupBy(
        equal_width_bin(value, low, high, bins).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spans = (df.agg(F.min(column).alias("low"), F.max(column).alias("high"))
             .where(F.col("low").isNotNull())
             .select("low", ((F.col("high") - F.col("low")) / bins).alias("width"),
                     F.explode(F.sequence(F.lit(0), F.when(
                         F.col("high") > F.col("low"), bins - 1).otherwise(0))).alias("bin")))
    return spans.join(counts, "bin", "left").select(
        "bin", (F.col("low") + F.col("bin") * F.col("width")).alias("lower_bound"),
        (F.col("low") + (F.col("bin") + 1) * F.col("width")).alias("upper_bound"),
        F.coalesce("n", F.lit(0)).alias("rows"))


def top_products(products: DataFrame, n: int = 10) -> DataFrame:
    """The best-selling products, smallest first as a bar chart lists them."""
    best = products.select("PRODUCT_ID", "DEPARTMENT", "total_sales").orderBy(
        F.desc("total_sales"), "PRODUCT_ID").limit(n)
    return best.orderBy("total_sales", F.desc("PRODUCT_ID"))


def spend_by_period(campaigns: DataFrame) -> DataFrame:
    """Long form of the before, during and after spend, with readable period names."""
    long = campaigns.select("CAMPAIGN", "campaign_type", *PERIODS).unpivot(
        ["CAMPAIGN", "campaign_type"], list(PERIODS), "campaign_period", "summed_spend")
    name = F.regexp_replace("campaign_period", "_campaign", "")
    return long.withColumn("campaign_period", F.initcap(F.regexp_replace(name, "_", " ")))


def offers_by_campaign(offers: DataFrame) -> DataFrame:
    return offers.groupBy("CAMPAIGN").agg(
        F.avg("calibrated_response_probability").alias("mean_response_probability"),
        F.avg("modeled_expected_offer_value").alias("mean_modeled_offer_value"),
        F.count(F.lit(1)).alias("scored_rows"))


def offer_slice(offers: DataFrame) -> DataFrame:
    """Size, reach, mean probability and shares above and below zero; one row."""
    value, rows = F.col("modeled_expected_offer_value"), F.count(F.lit(1))
    return offers.agg(
        rows.alias("scored_rows"), F.count_distinct("household_key").alias("unique_households"),
        F.avg("calibrated_response_probability").alias("mean_response_probability"),
        F.count_if(value > 0).alias("above_zero"), F.count_if(value < 0).alias("below_zero"),
        (F.count_if(value > 0) / rows).alias("share_above_zero"),
        (F.count_if(value < 0) / rows).alias("share_below_zero"))


def described_offers(offers: DataFrame, campaigns: DataFrame) -> DataFrame:
    """Offers with their campaign's type and end day, best probability first."""
    return many_to_one(
        offers, campaigns.select("CAMPAIGN", "campaign_type", "END_DAY"), ["CAMPAIGN"]
    ).orderBy(F.desc("calibrated_response_probability"), "household_key", "CAMPAIGN")


def value_segments(economics: DataFrame, value: str = "modeled_12_month_clv",
                   key: str = "household_key") -> tuple[DataFrame, list[tuple[int, int]]]:
    """Label households by third of modeled value; also ``(rows before, rows)`` per third.

    Two boundary rows decide every label, so labelling is a comparison and
    neither sorts nor shuffles the households.
    """
    base = stable(economics.select(key, value).where(F.col(value).isNotNull()))
    n = base.count()
    one, two = n // 3, 2 * n // 3
    in_first, in_second = first_by_rank(base, value, key, [one, two], n)
    label = F.when(in_first, SEGMENTS[0]).when(in_second, SEGMENTS[1]).otherwise(SEGMENTS[2])
    stretches = [(0, one), (one, two - one), (two, n - two)]
    return base.withColumn("value_segment", label), stretches


def segment_statistics(economics: DataFrame, value: str = "modeled_12_month_clv") -> DataFrame:
    """Box-plot figures per value segment.

    Segments are stretches of one order, so their quartiles are order
    statistics of the whole column.
    """
    segmented, stretches = value_segments(economics, value)
    filled = [(name, start, rows) for name, (start, rows) in zip(SEGMENTS, stretches) if rows]
    n = sum(rows for _, _, rows in filled)
    shares = (0.25, 0.5, 0.75)
    quartiles = interpolated_quantiles(
        segmented, value, [(start, rows, q) for _, start, rows in filled for q in shares], n)
    columns = []
    for j, name in enumerate(("lower_quartile", "median", "upper_quartile")):
        pick = F.lit(None).cast("double")
        for i, (segment, _, _) in enumerate(filled):
            pick = F.when(F.col("value_segment") == segment, quartiles[i * 3 + j]).otherwise(pick)
        columns.append(pick.alias(name))
    return segmented.groupBy("value_segment").agg(
        F.count(F.lit(1)).alias("households"), F.min(value).alias("smallest"),
        F.max(value).alias("largest")).select(
        "value_segment", "households", "smallest", *columns, "largest")


def offers_per_household(offers: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Offers of a household as one array ordered by start day, then campaign.

    The array holds at most one entry per campaign.
    """
    entry = F.struct("START_DAY", "CAMPAIGN", *[f for f in fields
                                                if f not in ("START_DAY", "CAMPAIGN")])
    return offers.groupBy("household_key").agg(
        F.sort_array(F.collect_list(entry)).alias("offers"))


def customer_profiles(customers: DataFrame, demographics: DataFrame, economics: DataFrame,
                      offers: DataFrame) -> DataFrame:
    """Behaviour, optional demographics, value and scored offers of every household."""
    value = economics.select("household_key", "modeled_12_month_clv", "modeled_24_month_clv")
    scored = offers_per_household(offers, (
        "calibrated_response_probability", "modeled_expected_offer_value",
        "assumed_offer_cost", "break_even_offer_cost"))
    known = demographics.withColumn("has_demographics", F.lit(True))
    return (customers.join(known, "household_key", "left")
            .join(value, "household_key", "left").join(scored, "household_key", "left")
            .withColumn("has_demographics", F.coalesce("has_demographics", F.lit(False)))
            .withColumn("scored_campaigns", F.coalesce(F.size("offers"), F.lit(0))))


def ordered_values(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values in order, as a selection list shows them."""
    return df.select(column).dropna().distinct().orderBy(column)
