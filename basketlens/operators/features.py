"""Household and product feature tables over a leakage-safe day window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.functions.days import in_feature_window
from basketlens.settings import FeatureWindows


def uses_coupon() -> Column:
    """A line with a non-zero coupon or retailer-match discount."""
    return (F.coalesce(F.col("COUPON_DISC") != 0, F.lit(False))
            | F.coalesce(F.col("COUPON_MATCH_DISC") != 0, F.lit(False)))


def or_zero(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0)).cast("bigint").alias(column)


def household_features(transactions: DataFrame, products: DataFrame,
                       campaign_households: DataFrame, redemptions: DataFrame,
                       windows: FeatureWindows) -> DataFrame:
    """One row per household with at least one line in the window.

    Lines are reduced to two small grains before anything is counted per
    household: (household, basket) for money and baskets, and (household,
    product) for assortment.  The first step of each aggregate combines on the
    map side and shuffles on both keys, so one very busy household spreads over
    many tasks, and the catalog joins the reduced grain instead of the lines.
    """
    lines = in_feature_window(transactions, windows.cutoff, windows.lookback)

    baskets = lines.groupBy("household_key", "BASKET_ID").agg(
        F.sum("SALES_VALUE").alias("sales"),
        F.sum("QUANTITY").alias("quantity"),
        F.sum("RETAIL_DISC").alias("retail"),
        F.sum("COUPON_DISC").alias("coupon"),
        F.sum("COUPON_MATCH_DISC").alias("matched"),
        F.max(uses_coupon().cast("int")).alias("couponed"),
        F.min("DAY").alias("first_day"),
        F.max("DAY").alias("last_day"))
    spending = baskets.groupBy("household_key").agg(
        F.sum("sales").cast("double").alias("total_sales"),
        F.count("BASKET_ID").alias("transaction_count"),
        (F.sum("sales").cast("double") / F.nullif(F.count("sales"), F.lit(0)))
        .alias("average_basket_value"),
        F.sum("quantity").alias("total_quantity"),
        F.sum("couponed").alias("coupon_usage"),
        F.sum("retail").cast("double").alias("total_retail_discount"),
        (F.sum("coupon") + F.sum("matched")).cast("double").alias("total_coupon_discount"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"))

    # One name at a time: distinct counts of both together would hold each pair three times in
    # one task's memory, with both names as key.
    named = (lines.select("household_key", "PRODUCT_ID").distinct()
             .join(products.select("PRODUCT_ID", "DEPARTMENT", "COMMODITY_DESC"),
                   "PRODUCT_ID", "left"))
    departments = (named.groupBy("household_key", "DEPARTMENT")
                   .agg(F.count("PRODUCT_ID").alias("products"))
                   .groupBy("household_key").agg(
                       F.sum("products").alias("unique_products"),
                       F.count("DEPARTMENT").alias("unique_departments")))
    commodities = (named.select("household_key", "COMMODITY_DESC").distinct()
                   .groupBy("household_key").agg(
                       F.count("COMMODITY_DESC").alias("unique_commodities")))

    exposure = campaign_households.groupBy("household_key").agg(
        F.sum("campaign_exposure").alias("campaign_exposure_count"))
    redeemed = (in_feature_window(redemptions, windows.cutoff, windows.lookback)
                .groupBy("household_key").agg(F.count(F.lit(1)).alias("coupon_redemption_count")))

    day_range = F.col("last_day") - F.col("first_day")
    return (spending.join(departments, "household_key", "left")
            .join(commodities, "household_key", "left")
            .join(exposure, "household_key", "left")
            .join(redeemed, "household_key", "left")
            .select(
                "household_key", "total_sales", "transaction_count", "average_basket_value",
                "total_quantity", "unique_products", "unique_departments", "unique_commodities",
                or_zero("coupon_usage"), "total_retail_discount", "total_coupon_discount",
                or_zero("campaign_exposure_count"), or_zero("coupon_redemption_count"),
                day_range.alias("purchase_day_range"),
                (F.col("transaction_count") / (day_range + 1)).alias("purchase_frequency"),
                (F.lit(windows.cutoff) - F.col("last_day")).alias("recency_days")))


def product_features(transactions: DataFrame, products: DataFrame,
                     windows: FeatureWindows) -> DataFrame:
    """One row per catalog product, unsold products included.

    One chain of aggregates, each on a coarser key, yields units, baskets,
    households and repeat households together.
    """
    lines = in_feature_window(transactions, windows.cutoff, windows.lookback)
    sold = (lines.groupBy("PRODUCT_ID", "household_key", "BASKET_ID")
            .agg(F.sum("QUANTITY").alias("units"), F.sum("SALES_VALUE").alias("sales"),
                 F.count("SALES_VALUE").alias("priced"))
            .groupBy("PRODUCT_ID", "household_key")
            .agg(F.sum("units").alias("units"), F.sum("sales").alias("sales"),
                 F.sum("priced").alias("priced"), F.count(F.lit(1)).alias("baskets"))
            .groupBy("PRODUCT_ID")
            .agg(F.sum("units").alias("total_units_sold"),
                 F.sum("sales").cast("double").alias("sales"),
                 F.sum("priced").alias("priced"),
                 F.count("household_key").alias("number_of_households_purchasing"),
                 F.sum("baskets").alias("number_of_baskets_containing_product"),
                 F.count_if(F.col("baskets") > 1)
                 .alias("number_of_repeat_purchasing_households"),
                 F.count(F.lit(1)).alias("purchasing")))
    return products.join(sold, "PRODUCT_ID", "left").select(
        "PRODUCT_ID", "MANUFACTURER", "DEPARTMENT", "BRAND", "COMMODITY_DESC",
        "SUB_COMMODITY_DESC", "CURR_SIZE_OF_PRODUCT",
        or_zero("total_units_sold"),
        F.coalesce(F.col("sales"), F.lit(0.0)).alias("total_sales"),
        or_zero("number_of_households_purchasing"),
        (F.col("sales") / F.nullif(F.col("priced"), F.lit(0)))
        .alias("average_sales_value_per_occurrence"),
        or_zero("number_of_baskets_containing_product"),
        or_zero("number_of_repeat_purchasing_households"),
        (F.col("number_of_repeat_purchasing_households") / F.col("purchasing"))
        .alias("repeat_purchase_rate"))
