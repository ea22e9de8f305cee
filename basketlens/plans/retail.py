"""The whole analysis as lazily connected tables over one set of source tables."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass, field
from functools import cached_property
from typing import Protocol
from uuid import uuid4

from pyspark.sql import DataFrame, functions as F

from basketlens.functions.days import feature_bounds
from basketlens.operators import campaigns as campaign_ops
from basketlens.operators import economics as money
from basketlens.operators import evaluation, features, quality, response, retrieval, training
from basketlens.operators.response import Calibrator, FeedForward, Standardizer
from basketlens.plans.frozen import FROZEN_CALIBRATOR, FROZEN_NETWORK
from basketlens.settings import FeatureWindows, FinanceAssumptions, SensitivityGrid, SplitPlan
from basketlens.sources.sinks import stored, write_parquet

SCORE_DIGITS = 6


class SourceTables(Protocol):
    transactions: DataFrame
    products: DataFrame
    campaigns: DataFrame
    assignments: DataFrame
    redemptions: DataFrame
    demographics: DataFrame


class LookedUp(Mapping):
    """Tables by name, each built at its lookup."""

    def __init__(self, build: dict[str, Callable[[], DataFrame]]) -> None:
        self._build = build

    def __getitem__(self, name: str) -> DataFrame:
        return self._build[name]()

    def __iter__(self) -> Iterator[str]:
        return iter(self._build)

    def __len__(self) -> int:
        return len(self._build)


@dataclass(frozen=True)
class RetailAnalysis:
    """Feature tables, training set, scores and economics, each built on first use."""

    tables: SourceTables
    windows: FeatureWindows = FeatureWindows()
    plan: SplitPlan = SplitPlan()
    finance: FinanceAssumptions = FinanceAssumptions(observed_history_days=2405)
    grid: SensitivityGrid = SensitivityGrid()
    network: FeedForward = field(default=FROZEN_NETWORK)
    calibrator: Calibrator = field(default=FROZEN_CALIBRATOR)

    def _campaign_inputs(self) -> tuple:
        t = self.tables
        return t.campaigns, t.assignments, t.transactions, t.redemptions, self.windows

    @cached_property
    def campaign_households(self) -> DataFrame:
        return campaign_ops.campaign_households(*self._campaign_inputs())

    @cached_property
    def campaigns(self) -> DataFrame:
        return campaign_ops.campaign_features(*self._campaign_inputs())

    @cached_property
    def exposures(self) -> DataFrame:
        """Eligible assignments alone: all that household features need of campaigns."""
        eligible = campaign_ops.eligible_campaigns(self.tables.campaigns, self.windows)
        return (self.tables.assignments.join(eligible.select("CAMPAIGN"), "CAMPAIGN")
                .select("household_key", "CAMPAIGN", F.lit(1).alias("campaign_exposure")))

    def _window_lines(self) -> DataFrame:
        """Transactions of the feature window, from as few files as the tables allow."""
        between = getattr(self.tables, "lines_between", None)
        bounds = feature_bounds(self.windows.cutoff, self.windows.lookback)
        return between(*bounds) if between else self.tables.transactions

    @cached_property
    def customers(self) -> DataFrame:
        t = self.tables
        return features.household_features(
            self._window_lines(), t.products, self.exposures, t.redemptions, self.windows)

    @cached_property
    def products(self) -> DataFrame:
        return features.product_features(self._window_lines(), self.tables.products,
                                         self.windows)

    @cached_property
    def dataset(self) -> DataFrame:
        t = self.tables
        return training.response_dataset(t.campaigns, t.assignments, t.transactions, t.products,
                                         t.redemptions, self.plan)

    @cached_property
    def stored_dataset(self) -> DataFrame:
        """The training set, written once by split for all fitting, scoring and reporting."""
        return stored(self.dataset, f"response-{uuid4().hex}", ["data_split"])

    @cached_property
    def standardizer(self) -> Standardizer:
        return Standardizer.fit(response.in_split(self.stored_dataset, "train"))

    @cached_property
    def scores(self) -> DataFrame:
        """Raw and calibrated probabilities with labels, for evaluation."""
        scored = response.score(
            self.stored_dataset, self.standardizer, self.network, self.calibrator,
            keep=["household_key", "CAMPAIGN", "START_DAY", "data_split",
                  "prior_coupon_redemption_count", "target_redeemed"])
        return scored.withColumns({
            name: F.round(name, SCORE_DIGITS)
            for name in ("logit", "raw_probability", "calibrated_response_probability")})

    @cached_property
    def long_scores(self) -> DataFrame:
        return evaluation.long_scores(
            self.scores, {"raw": "raw_probability",
                          "calibrated": "calibrated_response_probability"},
            ["data_split", "target_redeemed"])

    @cached_property
    def model_report(self) -> DataFrame:
        return evaluation.full_report(self.long_scores, ["data_split", "score_kind"])

    @cached_property
    def baseline_report(self) -> DataFrame:
        scored = evaluation.long_scores(
            evaluation.baseline_scores(self.stored_dataset), evaluation.BASELINES,
            ["data_split", "target_redeemed"])
        return evaluation.full_report(scored, ["data_split", "score_kind"])

    @cached_property
    def economics(self) -> DataFrame:
        return money.customer_economics(self.customers, self.finance)

    @cached_property
    def held_out_scores(self) -> DataFrame:
        """Calibrated test scores; the label is not read."""
        test = response.in_split(self.stored_dataset, "test")
        scored = response.score(test, self.standardizer, self.network, self.calibrator,
                                keep=["household_key", "CAMPAIGN", "START_DAY"])
        return scored.select(
            "household_key", "CAMPAIGN", "START_DAY",
            F.round("calibrated_response_probability", SCORE_DIGITS)
            .alias("calibrated_response_probability"))

    @cached_property
    def offers(self) -> DataFrame:
        return money.offer_economics(self.held_out_scores, self.economics, self.finance)

    @property
    def output_tables(self) -> dict[str, DataFrame]:
        return {"customers": self.customers, "products": self.products,
                "campaigns": self.campaigns, "campaign_households": self.campaign_households,
                "customer_economics": self.economics, "offers": self.offers,
                "model_rows": self.stored_dataset}

    @property
    def views(self) -> Mapping[str, DataFrame]:
        """The tables that the SQL reports read, each built when it is looked up."""
        from basketlens.functions.days import in_feature_window

        return LookedUp({
            "customer_features": lambda: self.customers, "product_features": lambda: self.products,
            "campaign_features": lambda: self.campaigns,
            "campaign_household_features": lambda: self.campaign_households,
            "feature_transactions": lambda: in_feature_window(
                self.tables.transactions, self.windows.cutoff, self.windows.lookback),
            "products": lambda: self.tables.products,
            "household_demographics": lambda: self.tables.demographics})


@dataclass(frozen=True)
class StoredAnalysis(RetailAnalysis):
    """An analysis whose output tables are written once and read by all that serves from them."""

    def _kept(self, name: str, df: DataFrame) -> DataFrame:
        return stored(df, f"{name}-{uuid4().hex}")

    @cached_property
    def customers(self) -> DataFrame:
        return self._kept("customers", super().customers)

    @cached_property
    def products(self) -> DataFrame:
        return self._kept("products", super().products)

    @cached_property
    def campaigns(self) -> DataFrame:
        return self._kept("campaigns", super().campaigns)

    @cached_property
    def campaign_households(self) -> DataFrame:
        return self._kept("campaign-households", super().campaign_households)

    @cached_property
    def economics(self) -> DataFrame:
        return self._kept("economics", super().economics)

    @cached_property
    def offers(self) -> DataFrame:
        return self._kept("offers", super().offers)

    @cached_property
    def model_report(self) -> DataFrame:
        return self._kept("model-report", super().model_report)

    @cached_property
    def baseline_report(self) -> DataFrame:
        return self._kept("baseline-report", super().baseline_report)

    @cached_property
    def document_index(self) -> DataFrame:
        """Postings of the text corpus, for any number of searches."""
        return retrieval.stored_index(self.tables.documents, f"index-{uuid4().hex}")


def write_features(analysis: RetailAnalysis, folder: str) -> DataFrame:
    """Write the four feature tables; returns their paths, row counts and schemas."""
    outputs = {"customer_features": analysis.customers, "product_features": analysis.products,
               "campaign_features": analysis.campaigns,
               "campaign_household_features": analysis.campaign_households}
    written = [{"name": name, **write_parquet(df, f"{folder}/{name}")}
               for name, df in outputs.items()]
    return quality.output_metadata(analysis.customers.sparkSession, written)


def write_training_set(analysis: RetailAnalysis, path: str) -> dict:
    """Write the training set partitioned by split, so that readers prune to one split."""
    return write_parquet(analysis.dataset, path, ["data_split"])


def write_economics(analysis: RetailAnalysis, folder: str) -> DataFrame:
    """Check the inputs, then write customer and offer economics."""
    quality.require_clean_economics(analysis.customers)
    outputs = {"customer_economics": analysis.economics,
               "campaign_offer_economics": analysis.offers}
    written = [{"name": name, **write_parquet(df, f"{folder}/{name}")}
               for name, df in outputs.items()]
    return quality.output_metadata(analysis.customers.sparkSession, written)
