"""Customer value, offer economics, summaries and sensitivity tables."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketlens.functions.finance import annuity_factor, clv, monthly_rate, offer_value
from basketlens.operators.ordering import lower_quantiles_of
from basketlens.operators.quality import many_to_one
from basketlens.settings import FinanceAssumptions, SensitivityGrid
from basketlens.sources.readers import literal_rows

def lower_medians(df: DataFrame, *columns: str) -> list[Column]:
    """The lower middle value of each column, exact at any size, as literals."""
    found = lower_quantiles_of(df, {name: [0.5] for name in columns})
    return [F.lit(found[name][0]).cast("double") for name in columns]


def customer_economics(customers: DataFrame, f: FinanceAssumptions) -> DataFrame:
    """Monthly revenue over the data's span, and discounted value over two horizons."""
    def value(months: int) -> Column:
        return clv(F.col("estimated_monthly_revenue"), f.contribution_margin,
                   f.monthly_retention_rate, f.annual_discount_rate, months)

    return (customers
            .withColumns({
                "observed_history_months": F.lit(f.observed_months),
                "historical_revenue": F.col("total_sales"),
                "basket_count": F.col("transaction_count"),
                "historical_quantity": F.col("total_quantity"),
                "estimated_monthly_revenue": F.col("total_sales") / F.lit(f.observed_months),
                "assumed_contribution_margin": F.lit(float(f.contribution_margin)),
                "monthly_discount_rate": F.lit(f.monthly_discount_rate)})
            .withColumn("estimated_monthly_contribution",
                        F.col("estimated_monthly_revenue") * F.col("assumed_contribution_margin"))
            .withColumns({"modeled_12_month_clv": value(f.short_horizon),
                          "modeled_24_month_clv": value(f.long_horizon)}))


def offer_economics(scored: DataFrame, economics: DataFrame, f: FinanceAssumptions) -> DataFrame:
    """One-average-basket response scenario per scored (household, campaign)."""
    buyers = economics.select("household_key", "average_basket_value", "modeled_12_month_clv")
    probability = F.col("calibrated_response_probability")
    contribution = F.col("average_basket_value") * F.lit(float(f.contribution_margin))
    cost = F.lit(float(f.default_offer_cost))
    return many_to_one(scored, buyers, ["household_key"]).withColumns({
        "assumed_offer_cost": cost,
        "expected_contribution_if_response": contribution,
        "break_even_offer_cost": probability * contribution,
        "modeled_expected_offer_value": offer_value(probability, contribution, cost)})


def clv_summary(economics: DataFrame) -> DataFrame:
    horizons = ("12", "24")
    values = [f"modeled_{h}_month_clv" for h in horizons]
    aggregates = [aggregate.alias(f"{name}_{h}")
                  for h, value, median in zip(horizons, values, lower_medians(economics, *values))
                  for name, aggregate in (
                      ("mean", F.avg(value)), ("median", median),
                      ("min", F.min(value)), ("max", F.max(value)))]
    usable = F.count_if(F.col("modeled_12_month_clv").isNotNull()
                        & F.col("modeled_24_month_clv").isNotNull())
    return economics.agg(*aggregates, usable.alias("usable_households"))


def offer_summary(offers: DataFrame) -> DataFrame:
    value = F.col("modeled_expected_offer_value")
    probability, expected = lower_medians(offers, "calibrated_response_probability",
                                          "modeled_expected_offer_value")
    return offers.agg(
        F.avg("calibrated_response_probability").alias("mean_probability"),
        probability.alias("median_probability"),
        F.avg(value).alias("mean_expected_value"),
        expected.alias("median_expected_value"),
        F.count_if(value > 0).alias("above_zero"),
        F.count_if(value < 0).alias("below_zero"),
        F.avg("break_even_offer_cost").alias("mean_break_even_offer_cost"))


def scenario_grid(spark: SparkSession, grid: SensitivityGrid, months: int) -> DataFrame:
    """All combinations of the stated assumptions with their annuity factor."""
    rows = [(m, r, d, c, annuity_factor(r, d, months)) for m, r, d, c in product(
        grid.margins, grid.retentions, grid.discount_rates, grid.offer_costs)]
    return literal_rows(
        spark, rows, "contribution_margin double, monthly_retention_rate double, "
                     "annual_discount_rate double, offer_cost double, factor double")


def one_factor_scenarios(spark: SparkSession, f: FinanceAssumptions,
                         grid: SensitivityGrid) -> DataFrame:
    """The base assumptions with one of them varied at a time."""
    base = {"contribution_margin": f.contribution_margin,
            "monthly_retention_rate": f.monthly_retention_rate,
            "annual_discount_rate": f.annual_discount_rate}
    varied = {"contribution_margin": grid.margins, "monthly_retention_rate": grid.retentions,
              "annual_discount_rate": grid.discount_rates}
    rows = []
    for name, values in varied.items():
        for value in values:
            case = {**base, name: value}
            rows.append((name, float(value), float(case["contribution_margin"]), annuity_factor(
                case["monthly_retention_rate"], case["annual_discount_rate"], f.short_horizon)))
    return literal_rows(
        spark, rows, "varied_assumption string, value double, margin double, factor double")


def _median_monthly_revenue(economics: DataFrame, f: FinanceAssumptions) -> Column:
    return lower_medians(economics, "historical_revenue")[0] / F.lit(f.observed_months)


def one_factor_sensitivity(economics: DataFrame, f: FinanceAssumptions,
                           grid: SensitivityGrid) -> DataFrame:
    revenue = _median_monthly_revenue(economics, f)
    return one_factor_scenarios(economics.sparkSession, f, grid).select(
        "varied_assumption", "value",
        (revenue * F.col("margin") * F.col("factor")).alias("median_modeled_12_month_clv"))


def full_sensitivity(economics: DataFrame, offers: DataFrame, f: FinanceAssumptions,
                     grid: SensitivityGrid) -> DataFrame:
    revenue = _median_monthly_revenue(economics, f)
    basket = offers.agg(F.avg(
        F.col("calibrated_response_probability") * F.col("average_basket_value"))).scalar()
    margin = F.col("contribution_margin")
    return scenario_grid(economics.sparkSession, grid, f.short_horizon).select(
        "contribution_margin", "monthly_retention_rate", "annual_discount_rate", "offer_cost",
        (revenue * margin * F.col("factor")).alias("median_modeled_12_month_clv"),
        (basket * margin - F.col("offer_cost")).alias("mean_modeled_expected_offer_value"))


def assumptions_table(spark: SparkSession, f: FinanceAssumptions) -> DataFrame:
    """The finance assumptions as names and text values."""
    rows = [(name, str(getattr(f, name))) for name in f.__dataclass_fields__]
    rows += [("observed_history_months", str(f.observed_months)),
             ("monthly_discount_rate", str(monthly_rate(f.annual_discount_rate)))]
    return literal_rows(spark, rows, "assumption string, setting string")
