"""Plans that must keep their shape as data grows, and results against SQL."""

import re

import duckdb
import pytest

import __spark_entry__ as entry
from basketlens.operators import campaigns, features, retrieval, training
from basketlens.operators.reports import run_report
from basketlens.operators.retrieval import search
from basketlens.plans.retail import RetailAnalysis, StoredAnalysis
from basketlens.settings import FeatureWindows, SplitPlan
from basketlens.sources.adapter import PreparedTables, prepared_tables

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def analysis(spark):
    return RetailAnalysis(prepared_tables(spark, FOLDER))


def test_day_window_and_columns_reach_the_scan(analysis):
    plan = plan_of(features.product_features(
        analysis.tables.transactions, analysis.tables.products, FeatureWindows(2000, 90)))
    assert re.search(r"PushedFilters: \[[^\]]*LessThan\(DAY,2000\)", plan)
    assert re.search(r"PushedFilters: \[[^\]]*GreaterThanOrEqual\(DAY,1910\)", plan)
    read = re.search(r"FileScan parquet \[([^\]]*DAY[^\]]*)\]", plan).group(1)
    assert "RETAIL_DISC" not in read and "STORE_ID" not in read


def test_transactions_are_read_as_stored_after_a_window_of_them(spark):
    tables = PreparedTables(spark, FOLDER)
    assert tables.lines_between(1910, 2000).count() > 0
    assert "orders" not in plan_of(tables.transactions) and "Join" not in plan_of(tables.transactions)


@pytest.mark.parametrize("name", ["dataset", "customers", "products", "campaigns", "offers"])
def test_no_cartesian_products(analysis, name):
    plan = plan_of(getattr(analysis, name))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_spend_is_summed_per_household_day_before_the_join(analysis):
    t = analysis.tables
    exposed = t.assignments.join(t.campaigns, "CAMPAIGN")
    plan = plan_of(campaigns.period_spend(exposed, t.transactions, FeatureWindows()))
    join = min(i for i in (plan.find("SortMergeJoin"), plan.find("BroadcastHashJoin"),
                           plan.find("ShuffledHashJoin")) if i >= 0)
    assert plan.find("keys=[household_key", join) > join  # the aggregate feeds the join


def test_history_is_joined_after_reduction_with_the_range_in_the_join(analysis):
    t = analysis.tables
    plan = plan_of(training.response_dataset(
        t.campaigns, t.assignments, t.transactions, t.products, t.redemptions, SplitPlan()))
    assert re.search(r"Join \[household_key#\d+L\], \[household_key#\d+L\].*DAY#\d+ < START_DAY",
                     plan)


def test_the_ledger_is_not_sorted_and_carries_no_empty_money(analysis):
    t = analysis.tables
    plan = plan_of(training.response_dataset(
        t.campaigns, t.assignments, t.transactions, t.products, t.redemptions, SplitPlan()))
    assert re.search(r"ShuffledHashJoin \[household_key#\d+L\], \[household_key#\d+L\], Inner, BuildRight, "
                     r"\(.*DAY#\d+ < START_DAY", plan)
    ledger = training.history_ledger(t.transactions, t.products, t.redemptions,
                                     t.assignments.join(t.campaigns, "CAMPAIGN"), 90)
    # An empty decimal takes 24 bytes of each row, an empty struct 8.
    assert not [f for f in ledger.schema if f.dataType.typeName() == "decimal"]


def test_product_days_are_dealt_once_for_their_distinct_rows_and_windows(analysis):
    t = analysis.tables
    plan = plan_of(training.history_ledger(t.transactions, t.products, t.redemptions,
                                           t.assignments.join(t.campaigns, "CAMPAIGN"), 90))
    assert len(re.findall(r"Exchange hashpartitioning\(household_key#\d+L, PRODUCT_ID#\d+L, DAY#\d+,", plan)) == 0
    assert re.search(r"Exchange hashpartitioning\(household_key#\d+L, PRODUCT_ID#\d+L, \d+\), REPARTITION_BY_COL", plan)


def test_top_lists_do_not_sort_everything(spark, analysis):
    run = entry.queries()["highest_value_customers"]
    assert "TakeOrderedAndProject" in plan_of(run(spark, FOLDER))
    ranked = plan_of(search(analysis.tables.documents, analysis.tables.source("benchmark")))
    assert "WindowGroupLimit" in ranked and "Partial" in ranked.split("WindowGroupLimit", 2)[2]


def test_the_index_is_written_with_one_exchange(analysis, monkeypatch):
    written = []
    monkeypatch.setattr(retrieval, "stored", lambda df, name: written.append(df) or df)
    index = retrieval.stored_index(analysis.tables.documents, "index")
    assert plan_of(written[0]).count("Exchange ") == 1
    assert index.exceptAll(retrieval.postings(analysis.tables.documents)).isEmpty()


@pytest.mark.parametrize("report, built", [
    ("coupon_usage_by_customer_segment", {"customers"}), ("campaign_performance", {"campaigns"}),
    ("customer_spend_by_department", set())])
def test_a_report_builds_only_the_tables_it_names(spark, report, built):
    stored = StoredAnalysis(prepared_tables(spark, FOLDER))
    run_report(spark, report, stored.views)
    assert built == set(vars(stored)) & {"customers", "products", "campaigns", "campaign_households"}


def test_training_set_is_pruned_by_split(spark, analysis, tmp_path):
    from basketlens.plans.retail import write_training_set

    path = str(tmp_path / "dataset")
    assert write_training_set(analysis, path)["rows"] == analysis.dataset.count()
    plan = plan_of(spark.read.parquet(path).where("data_split = 'test'"))
    assert re.search(r"PartitionFilters: \[[^\]]*data_split", plan)


def test_entry_points_agree_on_names(spark):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", [
    "household_features_bounded", "campaign_features", "campaign_splits", "column_profile",
    "tagged_questions", "conversation_chunks", "document_chunks"])
def test_result_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("customer", "orders", "lineitem", "part", "nation", "documents",
                  "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{FOLDER}/{table}.parquet')")
    got = entry.queries()[name](spark, FOLDER)
    relation = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in relation.description]
    assert sorted(names) == sorted(got.columns)

    def text(rows):
        return sorted(str(tuple(row)) for row in rows)

    assert text(got.select(*names).collect()) == text(relation.fetchall())
