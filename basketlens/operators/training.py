"""Point-in-time response data: chronological splits, history before the start, label after."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.contracts import RESPONSE_FEATURES
from basketlens.functions.days import before_start, between_days
from basketlens.operators.campaigns import interval_redemptions, redemptions_per_day
from basketlens.operators.features import uses_coupon
from basketlens.settings import SplitPlan

KEYS = ["household_key", "CAMPAIGN"]


def campaign_splits(campaigns: DataFrame, plan: SplitPlan) -> DataFrame:
    """Chronological splits by distinct start day, with a purge at each boundary.

    A campaign whose interval reaches the next split gets no split; it still
    counts as history.  The windows run over distinct start days only, of which
    there are no more than days in the calendar.
    """
    ordered = Window.orderBy("START_DAY")
    everything = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = campaigns.select("START_DAY").distinct().select(
        "START_DAY", F.row_number().over(ordered).alias("place"),
        F.count(F.lit(1)).over(everything).alias("n"))
    total = plan.train_fraction + plan.validation_fraction
    train_end = F.greatest(F.lit(1), F.floor(F.col("n") * plan.train_fraction))
    validation_end = F.least(
        F.greatest(train_end + 1, F.floor(F.col("n") * total)), F.col("n") - 1)
    enough = F.when(F.col("n") >= 3, F.col("place")).otherwise(
        F.raise_error(F.lit("at least three distinct campaign start days are required")))
    bounds = starts.select(
        "START_DAY", enough.alias("place"), train_end.alias("train_end"),
        validation_end.alias("validation_end"))
    placed = bounds.select(
        "START_DAY", "place", "train_end", "validation_end",
        F.min(F.when(F.col("place") > F.col("train_end"), F.col("START_DAY")))
        .over(everything).alias("validation_start"),
        F.min(F.when(F.col("place") > F.col("validation_end"), F.col("START_DAY")))
        .over(everything).alias("test_start"))
    split = (F.when(F.col("place") <= F.col("train_end"),
                    F.when(F.col("END_DAY") < F.col("validation_start"), "train"))
             .when(F.col("place") <= F.col("validation_end"),
                   F.when(F.col("END_DAY") < F.col("test_start"), "validation"))
             .otherwise("test"))
    return campaigns.join(placed, "START_DAY").select(
        "CAMPAIGN", "DESCRIPTION", "START_DAY", "END_DAY", split.alias("data_split"))


def observable_splits(campaigns: DataFrame, redemptions: DataFrame, plan: SplitPlan) -> DataFrame:
    """Splits of campaigns whose whole interval lies within observed redemption days."""
    last_day = redemptions.agg(F.max("DAY")).scalar()
    return campaign_splits(campaigns, plan).withColumn(
        "data_split", F.when(F.col("END_DAY") <= last_day, F.col("data_split")))


def exposure_spine(campaigns: DataFrame, assignments: DataFrame, redemptions: DataFrame,
                   plan: SplitPlan) -> DataFrame:
    """Assigned households with their campaign's interval and split, if it has one."""
    return assignments.select(*KEYS).join(
        observable_splits(campaigns, redemptions, plan), "CAMPAIGN").select(
        *KEYS, "DESCRIPTION", "START_DAY", "END_DAY", "data_split")


def _next_day(entity: str, lookback: int, counted: Column | None = None) -> Column:
    """Day on which the household meets the same entity again.

    Null if that is never or later than any window holding the present day, so
    the day of return takes at most ``lookback`` values per day.
    """
    later = (Window.partitionBy("household_key", entity).orderBy("DAY")
             .rowsBetween(1, Window.unboundedFollowing))
    day = F.col("DAY")
    again = F.min(day if counted is None else F.when(counted, day)).over(later)
    return F.when(again < day + lookback, again)


def days_of_interest(df: DataFrame, campaigns: DataFrame, lookback: int) -> DataFrame:
    """Drop days that no campaign's lookback window can reach, ahead of any shuffle."""
    reach = campaigns.agg(F.struct(
        (F.min("START_DAY") - lookback).alias("first"), F.max("START_DAY").alias("last"))).scalar()
    return df.where(between_days(F.col("DAY"), reach["first"], reach["last"]))


def history_ledger(transactions: DataFrame, products: DataFrame, redemptions: DataFrame,
                   assigned: DataFrame, lookback: int) -> DataFrame:
    """Everything a lookback window needs, reduced to household days.

    Distinct counts over a moving window need no distinct at window time: an
    entity seen on several days counts once if only its last day before the
    window's end counts.  So each row stores the next day the entity returns,
    and a window ending at ``START_DAY`` counts the row if that day is null or
    not before ``START_DAY``.  Rows of one household and day then collapse, so
    a household holds a bounded number of rows however much it buys.
    """
    # Structs that are null in rows of other kinds keep the rows small where all kinds meet.
    spent = transactions.groupBy("household_key", "DAY").agg(F.struct(
        F.sum("SALES_VALUE").alias("sales"), F.sum("QUANTITY").alias("quantity"),
        F.sum("RETAIL_DISC").alias("retail"), F.sum("COUPON_DISC").alias("coupon"),
        F.sum("COUPON_MATCH_DISC").alias("matched"),
        F.count(F.lit(1)).alias("lines")).alias("spent"))
    baskets = transactions.groupBy("household_key", "BASKET_ID", "DAY").agg(
        F.bool_or(F.col("SALES_VALUE").isNotNull()).alias("priced"),
        F.bool_or(uses_coupon()).alias("couponed"))
    per_basket = (baskets
                  .withColumns({
                      "basket_again": _next_day("BASKET_ID", lookback),
                      "priced_again": _next_day("BASKET_ID", lookback, F.col("priced")),
                      "coupon_again": _next_day("BASKET_ID", lookback, F.col("couponed"))})
                  .groupBy("household_key", "DAY", "basket_again", "priced_again", "coupon_again")
                  .agg(F.count("BASKET_ID").alias("baskets"),
                       F.count_if("priced").alias("priced_baskets"),
                       F.count_if("couponed").alias("coupon_baskets"))
                  .select("household_key", "DAY", F.struct(
                      "basket_again", "priced_again", "coupon_again", "baskets", "priced_baskets",
                      "coupon_baskets").alias("visits")))

    # Dealt by the windows' keys at once: a household hardly buys a product twice a day, so an
    # exchange for the distinct rows alone would move as many once more.
    product_days = (transactions.select("household_key", "PRODUCT_ID", "DAY")
                    .repartition("household_key", "PRODUCT_ID").distinct()
                    .withColumn("item_again", _next_day("PRODUCT_ID", lookback)))
    per_product = product_days.where(F.col("PRODUCT_ID").isNotNull()).groupBy(
        "household_key", "DAY", "item_again").agg(F.count(F.lit(1)).alias("products"))
    per_department = (product_days.join(products.select("PRODUCT_ID", "DEPARTMENT"), "PRODUCT_ID")
                      .where(F.col("DEPARTMENT").isNotNull())
                      .select("household_key", "DEPARTMENT", "DAY")
                      .repartition("household_key", "DEPARTMENT").distinct()
                      .withColumn("item_again", _next_day("DEPARTMENT", lookback))
                      .groupBy("household_key", "DAY", "item_again")
                      .agg(F.count(F.lit(1)).alias("departments")))

    redeemed = redemptions_per_day(redemptions)
    any_campaign = redeemed.groupBy("household_key", "DAY").agg(
        F.sum("redeemed").alias("redeemed"))
    earlier_campaign = (redeemed.join(
        assigned.select(*KEYS, F.col("START_DAY").alias("earlier_start")), KEYS)
        .groupBy("household_key", "DAY", "earlier_start")
        .agg(F.sum("redeemed").alias("redeemed_earlier"))
        .select("household_key", "DAY",
                F.struct("earlier_start", "redeemed_earlier").alias("earlier")))

    parts = [spent, per_basket, per_product, per_department, any_campaign, earlier_campaign]
    return reduce(lambda one, two: one.unionByName(two, allowMissingColumns=True), parts)


def response_dataset(campaigns: DataFrame, assignments: DataFrame, transactions: DataFrame,
                     products: DataFrame, redemptions: DataFrame, plan: SplitPlan) -> DataFrame:
    """One row per assigned (household, campaign) with history and an observable label."""
    n = plan.lookback
    spans = campaigns.select("CAMPAIGN", "START_DAY", "END_DAY")
    assigned = assignments.select(*KEYS).join(spans, "CAMPAIGN")
    exposures = exposure_spine(campaigns, assignments, redemptions, plan)
    # Earlier exposures of the household: a frame over its own campaigns, no self-join.
    earlier = (Window.partitionBy("household_key").orderBy("START_DAY").rangeBetween(-n, -1))
    spine = exposures.withColumn(
        "prior_campaign_exposure_count", F.count(F.lit(1)).over(earlier)
    ).where(F.col("data_split").isNotNull())

    ledger = history_ledger(
        days_of_interest(transactions, campaigns, n), products,
        days_of_interest(redemptions, campaigns, n), assigned, n).alias("past")
    day, start = F.col("past.DAY"), F.col("now.START_DAY")

    def last_seen(count: str, again: str) -> Column:
        final = F.col(again).isNull() | (F.col(again) >= start)
        return F.coalesce(F.sum(F.when(final, F.col(count))), F.lit(0))

    carried = [*KEYS, "DESCRIPTION", "START_DAY", "END_DAY", "data_split",
               "prior_campaign_exposure_count"]
    earlier_start, lines = F.col("earlier.earlier_start"), F.col("spent.lines")
    # Hashing the spine, which has a household's campaigns only, spares sorting the ledger.
    history = (ledger.join(
        spine.alias("now").hint("shuffle_hash"),
        (F.col("past.household_key") == F.col("now.household_key"))
        & before_start(day, start, n))
        .groupBy(*[F.col(f"now.{name}") for name in carried])
        .agg(
            F.sum(lines).alias("lines"),
            F.sum("spent.sales").cast("double").alias("historical_total_sales"),
            last_seen("visits.baskets", "visits.basket_again").alias("historical_basket_count"),
            F.sum("spent.quantity").alias("historical_total_quantity"),
            last_seen("products", "item_again").alias("historical_unique_products"),
            last_seen("departments", "item_again").alias("historical_unique_departments"),
            F.sum("spent.retail").cast("double").alias("historical_retail_discount"),
            (F.sum("spent.coupon") + F.sum("spent.matched")).cast("double")
            .alias("historical_coupon_discount"),
            (F.sum("spent.sales").cast("double")
             / F.nullif(last_seen("visits.priced_baskets", "visits.priced_again"), F.lit(0)))
            .alias("historical_average_basket_value"),
            last_seen("visits.coupon_baskets", "visits.coupon_again")
            .alias("historical_coupon_basket_count"),
            F.max(F.when(lines.isNotNull(), day)).alias("last_day"),
            F.coalesce(F.sum("redeemed"), F.lit(0)).alias("prior_coupon_redemption_count"),
            F.coalesce(F.sum(F.when(before_start(earlier_start, start, n),
                                    F.col("earlier.redeemed_earlier"))), F.lit(0))
            .alias("prior_campaign_redemption_count"))
        .where(F.col("lines") > 0))

    outcome = interval_redemptions(assigned, redemptions)
    return (history.join(outcome, KEYS, "left")
            .withColumns({
                "historical_purchase_frequency": F.col("historical_basket_count") / n,
                "historical_recency_days": F.col("START_DAY") - F.col("last_day"),
                "target_redeemed": F.col("coupon_redemption_count").isNotNull().cast("int")})
            .select(*KEYS, "DESCRIPTION", "START_DAY", "END_DAY", "data_split",
                    *RESPONSE_FEATURES, "target_redeemed"))


def split_summary(dataset: DataFrame) -> DataFrame:
    return dataset.groupBy("data_split").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("target_redeemed").alias("positives"))


def split_population(dataset: DataFrame) -> DataFrame:
    """Size, campaigns, start days and response rate per split."""
    return dataset.groupBy("data_split").agg(
        F.count(F.lit(1)).alias("observations"),
        F.count_distinct("CAMPAIGN").alias("campaigns"),
        F.min("START_DAY").alias("first_start_day"),
        F.max("START_DAY").alias("last_start_day"),
        F.avg("target_redeemed").alias("actual_positive_rate"))
