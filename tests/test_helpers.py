"""Readers, session, views, reports and stored tables that no query alone covers."""

import json
import math
from datetime import date
from decimal import Decimal

import pandas as pd
import pytest
from pyspark.sql import functions as F

from basketlens.operators.economics import assumptions_table
from basketlens.operators.ordering import lower_quantiles, values_at_ranks
from basketlens.operators import ordering
from basketlens.plans import queries
from basketlens.plans.retail import RetailAnalysis, StoredAnalysis, write_economics, write_features
from basketlens.settings import FinanceAssumptions
from basketlens.sources import readers, session, sinks
from basketlens.sources.adapter import RetailTables, prepared_tables

FOLDER = "/root/testdata/sf0.001"


def test_json_report_is_read_over_lines(spark, tmp_path):
    path = tmp_path / "report.json"
    path.write_text(json.dumps({"rows": 3, "splits": ["train", "test"]}, indent=2))
    assert tuple(readers.read_json_report(spark, str(path)).first()) == (3, ["train", "test"])


def test_literal_rows_and_views(spark):
    rows = readers.literal_rows(spark, [(1, "a"), (2, None)], "k int, v string")
    readers.register_views({"some_rows": rows})
    assert spark.sql("SELECT count(v) AS n FROM some_rows").first().n == 1


def test_session_settings(spark):
    found = session.get_session("tests")
    assert found.sparkContext is spark.sparkContext
    assert found.conf.get("spark.sql.adaptive.enabled") == "true"


def test_assumptions_name_every_setting(spark):
    rows = {r.assumption: r.setting for r in assumptions_table(
        spark, FinanceAssumptions(observed_history_days=365)).collect()}
    assert rows["observed_history_days"] == "365" and "monthly_discount_rate" in rows
    assert set(FinanceAssumptions.__dataclass_fields__) < set(rows)


def test_quantiles_are_exact_with_narrow_brackets(frame, monkeypatch):
    values = [float((i * 7919) % 20011) for i in range(20011)] + [5.0] * 4000
    df = frame([(v,) for v in values], "value double").cache()
    ordered = sorted(values)
    monkeypatch.setattr(ordering, "BRACKET_ROWS", 3)
    monkeypatch.setattr(ordering, "SKETCH_ACCURACY", 50)
    ranks = [1, 5, 100, 12000, 24010, 24011]
    assert values_at_ranks(df, "value", ranks, len(values)) == {r: ordered[r - 1] for r in ranks}
    assert lower_quantiles(df, "value", [0.5]) == [ordered[12005]]
    assert lower_quantiles(df.where("false"), "value", [0.5, 0.9]) == [None, None]


def test_many_columns_share_three_passes(spark, frame):
    rows = [(i % 97, float((i * 7919) % 5003), Decimal(i % 13) / 4, date(2020, 1, 1 + i % 28), 7, None)
            for i in range(9000)] + [(None, 1.5, None, None, 7, None)] * 50
    df = frame(rows, "a int, `b.c` double, d decimal(9,2), e date, f int, g double").cache()
    df.count()
    shares = {name: [0.0, 0.25, 0.5, 0.99, 1.0] for name in df.columns}
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("ranks", "ranks")
    try:
        found = ordering.lower_quantiles_of(df, shares)
        jobs = len(tracker.getJobIdsForGroup("ranks"))
        ordering.lower_quantiles_of(df, {"b.c": shares["b.c"]})
        single = len(tracker.getJobIdsForGroup("ranks")) - jobs
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    for i, name in enumerate(df.columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        assert found[name] == [values[max(1, math.ceil(q * len(values))) - 1] if values else None
                               for q in shares[name]], name
    assert jobs == single
    assert ordering.median(df, "a") == 48.0 and ordering.median(df, "g") is None


def test_a_misplaced_sketch_is_corrected(frame, monkeypatch):
    df = frame([(float(i % 1000),) for i in range(5000)], "v double")
    monkeypatch.setattr(ordering, "_sketched", lambda value, share, slack: F.array(
        F.max(value) - 1, F.max(value)))
    assert lower_quantiles(df, "v", [0.3, 0.9999]) == [299.0, 999.0]


def test_written_outputs_state_rows_and_schemas(spark, tmp_path):
    analysis = RetailAnalysis(prepared_tables(spark, FOLDER))
    for write in (write_features, write_economics):
        rows = write(analysis, str(tmp_path / write.__name__)).collect()
        assert rows
        for r in rows:
            table = spark.read.parquet(r.path)
            assert table.count() == r.rows and json.loads(r.schema)["fields"]


def test_serving_plans_read_stored_tables_only(spark):
    analysis = queries.analysis_of(spark, FOLDER)
    assert isinstance(analysis, StoredAnalysis)
    for name in ("rank_customers", "rank_campaigns", "customer_lookup", "campaign_lookup",
                 "offer_lookup", "top_products", "customer_profiles", "contract_violations"):
        plan = queries.REGISTRY[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
        assert "SALES_VALUE" not in plan and "/transactions" not in plan, name


def test_results_of_two_folders_stand_side_by_side(spark):
    names = ("csv_round_trip", "json_report_round_trip", "parquet_round_trip", "csv_inspection")
    for name in names:
        first = queries.REGISTRY[name](spark, FOLDER)
        expected = first.count()
        queries.REGISTRY[name](spark, FOLDER).count()
        assert first.count() == expected


def test_changed_files_are_derived_anew(spark, tmp_path):
    parts = pd.DataFrame({"p_partkey": [1, 2], "p_brand": ["Brand#1", "Brand#2"]})
    parts.to_parquet(tmp_path / "part.parquet")
    tables = prepared_tables(spark, str(tmp_path))
    assert tables is prepared_tables(spark, str(tmp_path))
    assert tables.campaigns.count() == 2
    pd.concat([parts, parts.assign(p_brand="Brand#3")]).to_parquet(tmp_path / "part.parquet")
    assert prepared_tables(spark, str(tmp_path)).campaigns.count() == 3
    assert RetailTables(spark, str(tmp_path)).campaigns.count() == 3


def test_fresh_paths_differ(spark):
    assert sinks.fresh_path(spark, "x") != sinks.fresh_path(spark, "x")


@pytest.mark.parametrize("question, tool", [
    ("which topic is of most value", None), ("rank households by clv", "rank_customers"),
    ("household 99999999999999999999 please", "customer_lookup")])
def test_whole_words_and_long_identifiers(frame, question, tool):
    from basketlens.operators.routing import tag_questions
    row = tag_questions(frame([(1, question)], "question_id int, question string")).first()
    assert row.tool == tool
    if tool == "customer_lookup":
        assert row.household_key is None and row.status == "unknown_identifier"
