"""Schemas, keys and required columns of the retail tables."""

from __future__ import annotations

from pyspark.sql.types import (
    DataType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)

_TYPES: dict[str, DataType] = {
    "string": StringType(), "int": IntegerType(), "bigint": LongType(), "double": DoubleType()}


def _schema(columns: str) -> StructType:
    """A schema from ``name type, …``; needs no running session, unlike a DDL string."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, _TYPES[kind]) for name, kind in pairs])


# Names and types of the source tables' columns.
SOURCE_SCHEMAS: dict[str, StructType] = {
    "campaign_desc": _schema("DESCRIPTION string, CAMPAIGN int, START_DAY int, END_DAY int"),
    "campaign_table": _schema("DESCRIPTION string, household_key int, CAMPAIGN int"),
    "causal_data": _schema(
        "PRODUCT_ID int, STORE_ID int, WEEK_NO int, display string, mailer string"),
    "coupon": _schema("COUPON_UPC bigint, PRODUCT_ID int, CAMPAIGN int"),
    "coupon_redempt": _schema("household_key int, DAY int, COUPON_UPC bigint, CAMPAIGN int"),
    "hh_demographic": _schema(
        "classification_1 string, classification_2 string, classification_3 string, "
        "HOMEOWNER_DESC string, classification_5 string, classification_4 string, "
        "KID_CATEGORY_DESC string, household_key int"),
    "product": _schema(
        "PRODUCT_ID int, MANUFACTURER int, DEPARTMENT string, BRAND string, "
        "COMMODITY_DESC string, SUB_COMMODITY_DESC string, CURR_SIZE_OF_PRODUCT string"),
    "transaction_data": _schema(
        "household_key int, BASKET_ID bigint, DAY int, PRODUCT_ID int, QUANTITY int, "
        "SALES_VALUE double, STORE_ID int, RETAIL_DISC double, TRANS_TIME int, WEEK_NO int, "
        "COUPON_DISC double, COUPON_MATCH_DISC double"),
}

# The output tables' key columns and the columns that readers rely on.
OUTPUT_KEYS: dict[str, tuple[str, ...]] = {
    "customers": ("household_key",),
    "products": ("PRODUCT_ID",),
    "campaigns": ("CAMPAIGN",),
    "campaign_households": ("household_key", "CAMPAIGN"),
    "customer_economics": ("household_key",),
    "offers": ("household_key", "CAMPAIGN"),
}

OUTPUT_COLUMNS: dict[str, tuple[str, ...]] = {
    "customers": (
        "household_key", "total_sales", "transaction_count", "average_basket_value",
        "total_quantity", "unique_products", "unique_departments", "coupon_usage",
        "total_retail_discount", "total_coupon_discount", "purchase_frequency", "recency_days"),
    "products": (
        "PRODUCT_ID", "DEPARTMENT", "BRAND", "total_units_sold", "total_sales",
        "number_of_households_purchasing"),
    "campaign_households": (
        "household_key", "CAMPAIGN", "campaign_type", "START_DAY", "END_DAY",
        "coupon_redemption_count", "spend_before_campaign", "spend_during_campaign",
        "spend_after_campaign", "campaign_window_complete", "post_campaign_observation_complete",
        "post_campaign_days_observed"),
    "campaigns": (
        "CAMPAIGN", "campaign_type", "START_DAY", "END_DAY", "exposed_households",
        "redeeming_households", "descriptive_redemption_rate", "spend_before_campaign",
        "spend_during_campaign", "spend_after_campaign", "campaign_window_complete",
        "post_campaign_observation_complete", "post_campaign_days_observed"),
    "customer_economics": (
        "household_key", "modeled_12_month_clv", "modeled_24_month_clv",
        "assumed_contribution_margin"),
    "offers": (
        "household_key", "CAMPAIGN", "START_DAY", "calibrated_response_probability",
        "modeled_expected_offer_value", "assumed_offer_cost", "break_even_offer_cost"),
    "model_rows": ("household_key", "CAMPAIGN", "START_DAY", "data_split"),
}

# The model's inputs, in the order of its weights.
# The response model's inputs, in their order.
RESPONSE_FEATURES: tuple[str, ...] = (
    "historical_total_sales", "historical_basket_count", "historical_total_quantity",
    "historical_unique_products", "historical_unique_departments", "historical_retail_discount",
    "historical_coupon_discount", "historical_average_basket_value",
    "historical_coupon_basket_count", "historical_purchase_frequency",
    "historical_recency_days", "prior_coupon_redemption_count", "prior_campaign_exposure_count",
    "prior_campaign_redemption_count",
)
