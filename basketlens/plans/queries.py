"""Every operator as a query over one folder of test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from basketlens.functions.days import feature_bounds, outcome_bounds
from basketlens.functions.finance import monthly_rate, npv_of_array, npv_sum
from basketlens.operators import (
    campaigns as campaign_ops, chunking, directory, economics as money, evaluation, features, lookups, marts,
    network, quality, reports, response, retrieval, routing, training,
)
from basketlens.plans.retail import RetailAnalysis, StoredAnalysis
from basketlens.settings import FeatureWindows, QualityRules
from basketlens.sources import readers, sinks
from basketlens.sources.adapter import PreparedTables, RetailTables, prepared_tables

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

BOUNDED = FeatureWindows(cutoff=2000, lookback=90, outcome=30)
CENSUS_RULES = QualityRules(
    numeric=("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority"),
    dates={"o_orderdate": "yyyy-MM-dd", "o_orderstatus": "yyyy-MM-dd"}, max_null_rate=0.2)


_ANALYSES: dict[PreparedTables, StoredAnalysis] = {}


def analysis_of(spark: SparkSession, folder: str) -> StoredAnalysis:
    """The default analysis of a folder's present files; its stored tables serve a session."""
    tables = prepared_tables(spark, folder)
    if tables not in _ANALYSES:
        _ANALYSES[tables] = StoredAnalysis(tables)
    return _ANALYSES[tables]


def query(build: Callable[[RetailAnalysis], DataFrame]) -> Callable:
    """Register a query that starts from the default analysis of a folder."""
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return build(analysis_of(spark, folder))

    REGISTRY[build.__name__] = run
    return build


def rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.withColumns({name: F.round(name, digits) for name in names})


def _bounded(a: RetailAnalysis) -> RetailAnalysis:
    return RetailAnalysis(a.tables, windows=BOUNDED)


# Scans, windows and reports

@query
def parquet_projection(a: RetailAnalysis) -> DataFrame:
    return readers.read_parquet(a.tables.spark, f"{a.tables.folder}/customer.parquet",
                                ["c_custkey", "c_mktsegment"])


@query
def feature_window_lines(a: RetailAnalysis) -> DataFrame:
    return a.tables.lines_between(*feature_bounds(2000, 90)).select(
        "household_key", "BASKET_ID", "DAY", "PRODUCT_ID", "QUANTITY",
        F.col("SALES_VALUE").cast("double").alias("SALES_VALUE"))


@query
def outcome_window_lines(a: RetailAnalysis) -> DataFrame:
    return a.tables.lines_between(*outcome_bounds(2000, 30)).select(
        "household_key", "BASKET_ID", "DAY", "PRODUCT_ID", "QUANTITY",
        F.col("SALES_VALUE").cast("double").alias("SALES_VALUE"))


@query
def highest_value_customers(a: RetailAnalysis) -> DataFrame:
    return reports.run_report(a.tables.spark, "highest_value_customers", a.views)


@query
def highest_revenue_products(a: RetailAnalysis) -> DataFrame:
    return reports.run_report(a.tables.spark, "highest_revenue_products", a.views)


@query
def campaign_performance(a: RetailAnalysis) -> DataFrame:
    return reports.run_report(a.tables.spark, "campaign_performance", a.views)


@query
def customer_spend_by_department(a: RetailAnalysis) -> DataFrame:
    return reports.run_report(a.tables.spark, "customer_spend_by_department", a.views)


@query
def coupon_usage_by_customer_segment(a: RetailAnalysis) -> DataFrame:
    return reports.run_report(a.tables.spark, "coupon_usage_by_customer_segment", a.views)


# Feature tables

def _built(a: RetailAnalysis) -> RetailAnalysis:
    """The same analysis without its stored tables: feature queries build what they return."""
    return RetailAnalysis(a.tables)


@query
def household_features(a: RetailAnalysis) -> DataFrame:
    return _built(a).customers


@query
def household_features_bounded(a: RetailAnalysis) -> DataFrame:
    return _bounded(a).customers


@query
def product_features(a: RetailAnalysis) -> DataFrame:
    return _built(a).products


@query
def product_features_bounded(a: RetailAnalysis) -> DataFrame:
    return _bounded(a).products


@query
def campaign_household_features(a: RetailAnalysis) -> DataFrame:
    return _built(a).campaign_households


@query
def campaign_household_features_bounded(a: RetailAnalysis) -> DataFrame:
    return _bounded(a).campaign_households


@query
def campaign_features(a: RetailAnalysis) -> DataFrame:
    return _built(a).campaigns


@query
def campaign_features_bounded(a: RetailAnalysis) -> DataFrame:
    return _bounded(a).campaigns


# Quality

@query
def column_profile(a: RetailAnalysis) -> DataFrame:
    orders = a.tables.source("orders")
    text = orders.select(
        F.col("o_orderkey").cast("string"), "o_orderstatus", F.col("o_totalprice").cast("string"),
        F.col("o_orderdate").cast("date").cast("string").alias("o_orderdate"), "o_orderpriority",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).otherwise("  ")
        .alias("priority_note"))
    return quality.column_profile(text, CENSUS_RULES)


@query
def duplicate_documents(a: RetailAnalysis) -> DataFrame:
    return quality.duplicate_rows(a.tables.source("documents"), ["text", "lang"])


@query
def repeated_line_keys(a: RetailAnalysis) -> DataFrame:
    return quality.repeated_key_census(a.tables.source("lineitem"),
                                       ["l_orderkey", "l_linenumber"])


@query
def customers_without_events(a: RetailAnalysis) -> DataFrame:
    return quality.unmatched_keys(a.tables.source("customer"), ["c_custkey"],
                                  a.tables.source("events"), ["user_id"])


@query
def relationship_coverage(a: RetailAnalysis) -> DataFrame:
    t = a.tables
    relations = [
        ("transactions to products", t.transactions, ["PRODUCT_ID"], t.products, None),
        ("customers to events", t.source("customer"), ["c_custkey"], t.source("events"),
         ["user_id"]),
        ("redemptions to assignments", t.redemptions, ["household_key", "CAMPAIGN"],
         t.assignments, None),
        ("customers to demographics", t.source("customer"), ["c_custkey"], t.demographics,
         ["household_key"])]
    return reduce(DataFrame.unionByName, [quality.relationship_coverage(*r) for r in relations])


@query
def numeric_summary(a: RetailAnalysis) -> DataFrame:
    summary = quality.numeric_summary(a.tables.source("part"))
    return rounded(summary, "mean", "stddev")


@query
def economics_gate(a: RetailAnalysis) -> DataFrame:
    return quality.economics_gate(a.customers)


@query
def range_violations(a: RetailAnalysis) -> DataFrame:
    return quality.range_violations(a.offers, a.economics)


@query
def contract_violations(a: RetailAnalysis) -> DataFrame:
    return quality.contract_violations(a.output_tables)


@query
def observed_redemption_day(a: RetailAnalysis) -> DataFrame:
    return marts.observed_maximum(a.tables.redemptions)


@query
def transaction_schema(a: RetailAnalysis) -> DataFrame:
    """Types of the transaction columns with their observed rows and blanks."""
    lines = a.tables.transactions
    found = quality.column_profile(lines).select(
        F.col("column_name").alias("column"), "row_count", "null_count")
    return quality.schema_rows(lines).join(found, "column")


@query
def sample_records(a: RetailAnalysis) -> DataFrame:
    """The first products by key, read back from their JSON text."""
    records = quality.sample_records(a.tables.products, key=["PRODUCT_ID"])
    names = ("PRODUCT_ID", "DEPARTMENT", "BRAND", "COMMODITY_DESC", "CURR_SIZE_OF_PRODUCT")
    return records.select(F.json_tuple("record", *names).alias(*names))


@query
def csv_round_trip(a: RetailAnalysis) -> DataFrame:
    """Write products as CSV to the shared folder and read them back by contract."""
    path = sinks.fresh_path(a.tables.spark, "products_csv")
    a.tables.products.write.mode("overwrite").option("header", True).csv(path)
    schema = a.tables.products.schema
    return readers.read_csv(a.tables.spark, path, schema, columns=schema.names)


@query
def csv_inspection(a: RetailAnalysis) -> DataFrame:
    """Profile assignments as text and compare with the inferred read."""
    spark = a.tables.spark
    path = sinks.fresh_path(spark, "assignments_csv")
    a.tables.assignments.write.mode("overwrite").option("header", True).csv(path)
    text, typed = readers.read_csv_text(spark, path), readers.read_csv(spark, path)
    report = quality.inspect_table(
        "assignments", typed, text, QualityRules(numeric=("household_key", "DESCRIPTION")))
    profile = report["columns"].select(
        "dataset", "column_name", "row_count", "null_count", "invalid_numeric_count")
    return profile.join(report["drift"].select("dataset", "row_count_changed"), "dataset")


@query
def directory_inspection(a: RetailAnalysis) -> DataFrame:
    """Profile a folder of CSV files of three headers, some of them in many parts."""
    path = sinks.fresh_path(a.tables.spark, "inspected")
    for name, table, part in (("assignments", a.tables.assignments, "CAMPAIGN"),
                              ("campaigns", a.tables.campaigns, "DESCRIPTION"),
                              ("demographics", a.tables.demographics, "classification_1")):
        (table.withColumn(name, F.col(part)).write.partitionBy(name)
         .option("header", True).csv(f"{path}/{name}"))
    rules = QualityRules(numeric=("household_key", "DESCRIPTION"), max_null_rate=0.2)
    return directory.directory_profile(a.tables.spark, path, rules, directory.BY_FOLDER).select(
        "dataset", "column_name", "data_type", "row_count", "null_count", "null_rate_violation",
        "invalid_numeric_count", F.round("mean", 6).alias("mean"), "min", "max",
        "malformed_rows", "duplicate_rows")


@query
def parquet_round_trip(a: RetailAnalysis) -> DataFrame:
    """Write the training set by split and read one split back."""
    path = sinks.fresh_path(a.tables.spark, "response_dataset")
    sinks.write_parquet(a.dataset, path, ["data_split"])
    test = readers.read_parquet(a.tables.spark, path).where(F.col("data_split") == "test")
    return test.select("household_key", "CAMPAIGN", "historical_total_sales", "target_redeemed")


@query
def json_report_round_trip(a: RetailAnalysis) -> DataFrame:
    path = sinks.fresh_path(a.tables.spark, "split_summary")
    sinks.write_json_report(training.split_summary(a.dataset), path)
    return a.tables.spark.read.json(path).select("data_split", "rows", "positives")


# Training set

@query
def campaign_splits(a: RetailAnalysis) -> DataFrame:
    return training.observable_splits(a.tables.campaigns, a.tables.redemptions, a.plan)


@query
def exposure_spine(a: RetailAnalysis) -> DataFrame:
    t = a.tables
    return training.exposure_spine(t.campaigns, t.assignments, t.redemptions, a.plan)


@query
def response_dataset(a: RetailAnalysis) -> DataFrame:
    return a.dataset


@query
def split_summary(a: RetailAnalysis) -> DataFrame:
    return training.split_summary(a.dataset)


@query
def split_population(a: RetailAnalysis) -> DataFrame:
    return training.split_population(a.dataset)


# Response model

@query
def feature_statistics(a: RetailAnalysis) -> DataFrame:
    return rounded(response.feature_statistics(response.in_split(a.dataset, "train")),
                   "mean", "std", digits=4)


@query
def class_balance(a: RetailAnalysis) -> DataFrame:
    return response.class_balance(response.in_split(a.dataset, "train"))


@query
def standardized_features(a: RetailAnalysis) -> DataFrame:
    s = a.standardizer
    return a.stored_dataset.select(
        "household_key", "CAMPAIGN",
        *[F.round(s.column(name), 6).alias(name) for name in s.features])


@query
def frozen_network_scores(a: RetailAnalysis) -> DataFrame:
    return a.scores.select("household_key", "CAMPAIGN", "data_split", "logit",
                           "raw_probability", "calibrated_response_probability")


def _fit(a: RetailAnalysis, fit: Callable) -> tuple[DataFrame, response.Calibrator]:
    """Scores of a model fitted on training rows, and a calibrator fitted on validation rows."""
    s = a.standardizer
    model = fit(response.in_split(a.stored_dataset, "train"), s)
    scored = response.apply_model(a.stored_dataset, s, model)
    return scored, response.fit_calibrator(response.in_split(scored, "validation"))


@query
def fitted_logistic_report(a: RetailAnalysis) -> DataFrame:
    """The score equations of the fit: at the maximum, weighted sums of probability x input
    equal those of label x input.  Inputs are the features and a constant."""
    scored, _ = _fit(a, response.fit_logistic)
    train = response.in_split(a.stored_dataset, "train")
    weight = F.when(F.col("target_redeemed") == 1, response.class_balance(train).select(
        "positive_weight").scalar()).otherwise(1.0)
    rows = (response.in_split(scored, "train").select("household_key", "CAMPAIGN", "raw_probability")
            .join(train, ["household_key", "CAMPAIGN"])
            .select((weight * F.col("raw_probability")).alias("fitted"),
                    F.concat(F.array(F.lit(1.0)), a.standardizer.vector()).alias("x")))
    sums = rows.agg(*[F.round(F.sum(F.col("fitted") * F.get("x", F.lit(i))), 1).alias(name)
                      for i, name in enumerate(("constant", *a.standardizer.features))])
    return sums.unpivot([], list(sums.columns), "feature", "weighted_sum")


@query
def fitted_perceptron_report(a: RetailAnalysis) -> DataFrame:
    """Rows and positives by split, whether all scores are probabilities, raw and
    calibrated, and whether those of training rows rank better than chance."""
    scored, calibrator = _fit(a, response.fit_perceptron)
    both = scored.withColumn("calibrated", calibrator.probability(F.col("logit")))
    long = evaluation.long_scores(both, {"raw": "raw_probability", "calibrated": "calibrated"},
                                  ["data_split", "target_redeemed"])
    report = evaluation.full_report(long, ["data_split", "score_kind"])
    sound = long.groupBy("data_split", "score_kind").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("target_redeemed").alias("positives"),
        F.every(F.col("score").between(0, 1)).alias("probabilities"))
    return sound.join(report, ["data_split", "score_kind"]).select(
        "data_split", "score_kind", sound["rows"], sound["positives"], "probabilities",
        F.when((F.col("data_split") == "train") & (F.col("score_kind") == "raw"),
               F.col("roc_auc") > 0.5).alias("better_than_chance"))


@query
def fitted_network_report(a: RetailAnalysis) -> DataFrame:
    """The network fitted by data-parallel Adam, without and with class weights.

    Rows and positives by split, whether all scores are probabilities, whether the kept
    weights have the least validation loss, and for the network without weights whether it
    ranks training and validation rows better than every baseline.
    """
    keys, labels = ["data_split", "score_kind"], ["data_split", "target_redeemed"]
    parts, fits = [], {}
    for name, weighted in (("plain", False), ("weighted", True)):
        fits[name] = network.fit_network(a.stored_dataset, a.standardizer, weighted=weighted)
        scored = response.score(a.stored_dataset, a.standardizer, fits[name].network, keep=labels)
        parts.append(evaluation.long_scores(scored, {name: "raw_probability"}, labels))
    long = parts[0].unionByName(parts[1])
    report = evaluation.full_report(long, keys)
    baselines = evaluation.full_report(evaluation.long_scores(
        evaluation.baseline_scores(a.stored_dataset), evaluation.BASELINES, labels), keys)
    to_beat = baselines.groupBy("data_split").agg(
        F.max("roc_auc").alias("auc_to_beat"),
        F.max("pr_auc_average_precision").alias("precision_to_beat"))
    sound = long.groupBy(keys).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("target_redeemed").alias("positives"),
        F.every(F.col("score").between(0, 1)).alias("probabilities"))
    least = F.create_map(*[F.lit(value) for name, fit in fits.items() for value in (
        name, fit.best_validation_loss == min(step["validation_loss"] for step in fit.history)
        and fit.best_validation_loss < fit.history[0]["validation_loss"])])
    judged = (F.col("score_kind") == "plain") & (F.col("data_split") != "test")
    return sound.join(report.drop("rows", "positives"), keys).join(to_beat, "data_split").select(
        *keys, sound["rows"], sound["positives"], "probabilities",
        least[F.col("score_kind")].alias("least_validation_loss"),
        F.when(judged, (F.col("roc_auc") > F.col("auc_to_beat")) & (
            F.col("pr_auc_average_precision") > F.col("precision_to_beat"))).alias("beats_baselines"))


@query
def platt_calibrator(a: RetailAnalysis) -> DataFrame:
    """The calibrator's score equations: fitted positives, and their sum of logits."""
    validation = response.in_split(a.scores, "validation")
    calibrator = response.fit_calibrator(validation)
    fitted = calibrator.probability(F.col("logit"))
    return validation.agg(
        F.lit("platt_scaling").alias("method"), F.lit(calibrator.fit_rows).cast("bigint").alias("fit_rows"),
        F.lit(calibrator.fit_positive_rows).cast("bigint").alias("fit_positive_rows"),
        F.round(F.sum(fitted), 3).alias("fitted_positives"),
        F.round(F.sum(fitted * F.col("logit")), 3).alias("fitted_logits"))


@query
def ranking_metrics(a: RetailAnalysis) -> DataFrame:
    return rounded(evaluation.ranking_metrics(a.long_scores, ["data_split", "score_kind"]),
                   "roc_auc", "pr_auc_average_precision")


@query
def threshold_metrics(a: RetailAnalysis) -> DataFrame:
    # Rates near 0.2 make a lower threshold the informative one for these scores.
    report = evaluation.threshold_metrics(a.long_scores, ["data_split", "score_kind"], 0.25)
    doubles = [f.name for f in report.schema.fields if f.dataType.typeName() == "double"]
    return rounded(report, *doubles)


@query
def reliability_bins(a: RetailAnalysis) -> DataFrame:
    # Means over few six-digit scores end in a 5 too often for a coarser rounding.
    return rounded(
        evaluation.reliability_bins(a.long_scores, ["data_split", "score_kind"]),
        "lower_inclusive", "upper_bound", "mean_predicted_probability",
        "observed_redemption_rate", digits=10)


REPORT_DOUBLES = (
    "roc_auc", "pr_auc_average_precision", "accuracy", "precision", "recall", "f1",
    "brier_score", "log_loss", "expected_calibration_error")


def _report(df: DataFrame, *further: str) -> DataFrame:
    return rounded(df.select("data_split", "score_kind", "observations", *REPORT_DOUBLES, *further),
                   *REPORT_DOUBLES)


@query
def model_report(a: RetailAnalysis) -> DataFrame:
    return _report(a.model_report)


@query
def ranking_change(a: RetailAnalysis) -> DataFrame:
    return rounded(evaluation.ranking_change(a.model_report, ["data_split"]),
                   "roc_auc_delta", "pr_auc_average_precision_delta")


@query
def baseline_report(a: RetailAnalysis) -> DataFrame:
    return _report(a.baseline_report)


@query
def permutation_importance(a: RetailAnalysis) -> DataFrame:
    result = response.permutation_importance(
        response.in_split(a.stored_dataset, "validation"), a.standardizer, a.network,
        digits=6)
    return rounded(result, "mean_average_precision_decrease", "std_average_precision_decrease",
                   "mean_log_loss_increase")


@query
def metric_comparison(a: RetailAnalysis) -> DataFrame:
    both = a.model_report.unionByName(a.baseline_report.where(F.col("data_split") == "test"))
    metrics = [m for m in REPORT_DOUBLES if m != "expected_calibration_error"]
    table = evaluation.comparison_table(both, ["data_split", "score_kind"], metrics)
    return rounded(table, *metrics)


# Economics

@query
def household_npv(a: RetailAnalysis) -> DataFrame:
    """Discounted monthly sales of each household, over long rows and over arrays."""
    rate = monthly_rate(0.10)
    month = F.floor((F.col("DAY") - 1) / 30).cast("int") + 1
    monthly = a.tables.transactions.groupBy("household_key", month.alias("month")).agg(
        F.sum("SALES_VALUE").cast("double").alias("sales"))
    long = monthly.groupBy("household_key").agg(
        npv_sum(F.col("sales"), F.col("month"), rate, 0.25, 5.0).alias("npv"))
    by_month = F.map_from_entries(F.collect_list(F.struct("month", "sales")))
    arrays = monthly.groupBy("household_key").agg(
        by_month.alias("by_month"), F.max("month").alias("last")).select(
        "household_key", F.transform(
            F.sequence(F.lit(1), F.col("last")),
            lambda m: F.coalesce(F.try_element_at("by_month", m), F.lit(0.0))).alias("flows"))
    array = arrays.select("household_key",
                          npv_of_array(F.col("flows"), rate, 0.25, 5.0).alias("npv_of_array"))
    return rounded(long.join(array, "household_key"), "npv", "npv_of_array", digits=4)


@query
def customer_economics(a: RetailAnalysis) -> DataFrame:
    columns = ("estimated_monthly_revenue", "estimated_monthly_contribution",
               "modeled_12_month_clv", "modeled_24_month_clv")
    table = a.economics.select(
        "household_key", "historical_revenue", "basket_count", "historical_quantity",
        "observed_history_months", "assumed_contribution_margin", "monthly_discount_rate",
        *columns)
    return rounded(table, *columns, "observed_history_months", "monthly_discount_rate")


@query
def offer_economics(a: RetailAnalysis) -> DataFrame:
    return rounded(a.offers, "modeled_12_month_clv")


@query
def clv_summary(a: RetailAnalysis) -> DataFrame:
    summary = money.clv_summary(a.economics)
    return rounded(summary, *[c for c in summary.columns if c != "usable_households"])


@query
def offer_summary(a: RetailAnalysis) -> DataFrame:
    summary = money.offer_summary(a.offers)
    return rounded(summary, *[c for c in summary.columns if not c.endswith("_zero")])


@query
def one_factor_sensitivity(a: RetailAnalysis) -> DataFrame:
    return rounded(money.one_factor_sensitivity(a.economics, a.finance, a.grid),
                   "median_modeled_12_month_clv")


@query
def full_sensitivity(a: RetailAnalysis) -> DataFrame:
    return rounded(money.full_sensitivity(a.economics, a.offers, a.finance, a.grid),
                   "median_modeled_12_month_clv", "mean_modeled_expected_offer_value")


# Marts

@query
def headline_figures(a: RetailAnalysis) -> DataFrame:
    figures = marts.headline_figures(a.customers, a.economics, a.campaigns,
                                     a.tables.redemptions, a.offers)
    exact = ("households", "observed_baskets")
    return rounded(rounded(figures, "historical_sales", digits=2),
                   *[c for c in figures.columns if c not in (*exact, "historical_sales")])


def _histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    values = df.select(F.round(column, 6).alias(column))
    return rounded(marts.histogram(values, column, bins), "lower_bound", "upper_bound", digits=4)


@query
def clv_histogram(a: RetailAnalysis) -> DataFrame:
    return _histogram(a.economics, "modeled_12_month_clv", 40)


@query
def probability_histogram(a: RetailAnalysis) -> DataFrame:
    return _histogram(a.offers, "calibrated_response_probability", 30)


@query
def offer_value_histogram(a: RetailAnalysis) -> DataFrame:
    return _histogram(a.offers, "modeled_expected_offer_value", 35)


@query
def top_products(a: RetailAnalysis) -> DataFrame:
    return marts.top_products(a.products)


@query
def customer_profiles(a: RetailAnalysis) -> DataFrame:
    profiles = marts.customer_profiles(a.customers, a.tables.demographics, a.economics, a.offers)
    return rounded(profiles.select(
        "household_key", "total_sales", "transaction_count", "recency_days", "has_demographics",
        "classification_1", "modeled_12_month_clv", "modeled_24_month_clv", "scored_campaigns",
        F.array_join(F.transform("offers", lambda o: o["CAMPAIGN"].cast("string")), ",")
        .alias("campaigns_in_order")), "modeled_12_month_clv", "modeled_24_month_clv")


@query
def campaign_totals_by_type(a: RetailAnalysis) -> DataFrame:
    covered = marts.covered_campaigns(a.campaigns, a.tables.redemptions)
    return marts.campaign_totals_by_type(covered)


@query
def spend_by_period(a: RetailAnalysis) -> DataFrame:
    return marts.spend_by_period(a.campaigns)


@query
def offers_by_campaign(a: RetailAnalysis) -> DataFrame:
    return rounded(marts.offers_by_campaign(a.offers), "mean_response_probability",
                   "mean_modeled_offer_value")


@query
def value_segments(a: RetailAnalysis) -> DataFrame:
    values = a.economics.select("household_key", F.round("modeled_12_month_clv", 6)
                                .alias("modeled_12_month_clv"))
    return marts.value_segments(values)[0]


@query
def segment_statistics(a: RetailAnalysis) -> DataFrame:
    values = a.economics.select("household_key", F.round("modeled_12_month_clv", 6)
                                .alias("modeled_12_month_clv"))
    return rounded(marts.segment_statistics(values), "smallest", "lower_quartile", "median",
                   "upper_quartile", "largest", digits=4)


@query
def offer_slice(a: RetailAnalysis) -> DataFrame:
    return rounded(marts.offer_slice(a.offers), "mean_response_probability")


@query
def described_offers(a: RetailAnalysis) -> DataFrame:
    return marts.described_offers(a.offers, a.campaigns).select(
        "household_key", "CAMPAIGN", "campaign_type", "START_DAY", "END_DAY",
        "calibrated_response_probability", "break_even_offer_cost")


@query
def campaign_types(a: RetailAnalysis) -> DataFrame:
    return marts.ordered_values(a.campaigns, "campaign_type")


# Lookups

@query
def customer_lookup(a: RetailAnalysis) -> DataFrame:
    requests = a.tables.source("part").select(F.col("p_partkey").alias("household_key"))
    found = lookups.customer_lookup(requests, a.customers, a.economics, a.offers)
    return rounded(found.select(
        "household_key", "status", "total_sales", "transaction_count", "modeled_12_month_clv",
        F.array_join(F.transform("offers", lambda o: o["CAMPAIGN"].cast("string")), ",")
        .alias("campaigns_in_order")), "modeled_12_month_clv")


@query
def campaign_lookup(a: RetailAnalysis) -> DataFrame:
    requests = a.tables.source("supplier").select(F.col("s_suppkey").alias("CAMPAIGN"))
    return lookups.campaign_lookup(requests, a.campaigns)


@query
def rank_customers(a: RetailAnalysis) -> DataFrame:
    return rounded(lookups.rank_customers(a.economics, 25, "modeled_24_month_clv"),
                   "modeled_24_month_clv")


@query
def rank_campaigns(a: RetailAnalysis) -> DataFrame:
    return lookups.rank_campaigns(a.campaigns, a.tables.redemptions)


@query
def model_metrics(a: RetailAnalysis) -> DataFrame:
    found = [lookups.model_metrics(a.model_report, a.baseline_report, a.calibrator, split)
             for split in ("train", "validation", "test")]
    return _report(reduce(DataFrame.unionByName, found), "calibration_method", "calibration_split")


@query
def offer_lookup(a: RetailAnalysis) -> DataFrame:
    return lookups.offer_lookup(a.offers, campaign=20)


def question_table(tables: RetailTables) -> DataFrame:
    """Questions about the households, campaigns and lists that the tables contain."""
    key, segment = F.col("c_custkey").cast("string"), F.col("c_mktsegment")
    about_households = tables.source("customer").select(
        F.concat(F.lit("c"), key).alias("question_id"),
        F.when(segment == "BUILDING", F.concat(F.lit("What did household "), key,
                                               F.lit(" buy recently?")))
        .when(segment == "MACHINERY", F.concat(F.lit("Show offer economics for customer #"), key))
        .when(segment == "HOUSEHOLD", F.concat(F.lit("List the "), key,
                                               F.lit(" customers with highest modeled CLV")))
        .when(segment == "AUTOMOBILE", F.concat(F.lit("Stop at hh key "), key, F.lit(" please")))
        .otherwise(F.concat(F.lit("Rank the top "), key,
                            F.lit(" households by 24-month customer value"))).alias("question"))
    status = F.col("o_orderstatus")
    number = F.col("o_orderkey").cast("string")
    about_campaigns = tables.source("orders").select(
        F.concat(F.lit("o"), number).alias("question_id"),
        F.when(status == "F", F.concat(F.lit("Campaign "), number,
                                       F.lit(" redemption details, please")))
        .when(status == "O", F.concat(F.lit("Which "), number,
                                      F.lit(" campaigns have the best redemption rate?")))
        .otherwise(F.concat(F.lit("Modeled value of offers in campaign id "), number))
        .alias("question"))
    said = tables.source("conversations").select(
        F.concat(F.lit("t"), F.col("conv_id").cast("string"), F.lit("-"),
                 F.col("turn").cast("string")).alias("question_id"),
        F.when(F.col("role") == "user",
               F.concat(F.lit("What is the assumed retention rate used for CLV? "),
                        F.coalesce("text", F.lit(""))))
        .otherwise(F.coalesce("text", F.lit(""))).alias("question"))
    return about_households.unionByName(about_campaigns).unionByName(said)


@query
def tagged_questions(a: RetailAnalysis) -> DataFrame:
    return routing.tag_questions(question_table(a.tables)).drop("question")


@query
def answered_questions(a: RetailAnalysis) -> DataFrame:
    """How many rows answer each question, and the key of the first."""
    spark = a.tables.spark

    def placed(df: DataFrame, metric: str, key: str) -> DataFrame:
        order = Window.partitionBy("metric").orderBy(F.desc(metric), key)
        return df.withColumn("metric", F.lit(metric)).withColumn(
            "place", F.row_number().over(order))

    ranked = [placed(lookups.rank_customers(a.economics, 100, m), m, "household_key")
              for m in lookups.CLV_METRICS]
    tables = {
        "customer_lookup": lookups.customer_lookup(a.customers, a.customers, a.economics, a.offers),
        "campaign_lookup": lookups.campaign_lookup(a.campaigns, a.campaigns),
        "offer_economics_lookup": a.offers.select(*lookups.OFFER_FIELDS),
        "rank_customers": reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), ranked),
        "rank_campaigns": placed(lookups.rank_campaigns(a.campaigns, a.tables.redemptions, 30),
                                 "descriptive_redemption_rate", "CAMPAIGN"),
        "clv_assumptions": money.assumptions_table(spark, a.finance),
        "model_metrics": lookups.model_metrics(a.model_report, a.baseline_report, a.calibrator)}
    answered = routing.answer_questions(
        routing.tag_questions(question_table(a.tables)), tables)
    first = F.get("answer", F.lit(0))
    return answered.select(
        "question_id", "tool", "status",
        F.coalesce(F.size("answer"), F.lit(0)).cast("bigint").alias("rows"),
        F.get_json_object(first, "$.household_key").cast("bigint").alias("first_household"),
        F.get_json_object(first, "$.CAMPAIGN").cast("bigint").alias("first_campaign"))


# Text

@query
def tokenized_documents(a: RetailAnalysis) -> DataFrame:
    return retrieval.tokenize(a.tables.documents, "doc_id", "text")


@query
def collection_statistics(a: RetailAnalysis) -> DataFrame:
    return rounded(retrieval.collection_statistics(a.document_index), "average_length")


@query
def term_statistics(a: RetailAnalysis) -> DataFrame:
    return retrieval.term_statistics(a.document_index)


@query
def document_search(a: RetailAnalysis) -> DataFrame:
    return rounded(retrieval.search_index(a.document_index, a.tables.source("benchmark")),
                   "score")


@query
def document_chunks(a: RetailAnalysis) -> DataFrame:
    return chunking.chunk_documents(a.tables.documents)


def conversation_documents(tables: RetailTables) -> DataFrame:
    """Each turn as a short document: a heading, then its lines as paragraphs."""
    heading = F.concat(F.lit("## Turn "), F.col("turn").cast("string"), F.lit(" by "), F.col("role"))
    return tables.source("conversations").select(
        (F.col("conv_id") * 1000 + F.col("turn")).alias("doc_id"),
        F.concat(heading, F.lit("\n\n"), F.regexp_replace("text", "\n", "\n\n"))
        .alias("text"), F.lit("conversation").alias("title"))


@query
def conversation_chunks(a: RetailAnalysis) -> DataFrame:
    return chunking.chunk_documents(conversation_documents(a.tables), size=200)
