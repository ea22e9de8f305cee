import math
import re

import pytest
from pyspark.sql import functions as F

from basketlens.contracts import SOURCE_SCHEMAS
from basketlens.functions.text import as_integer, as_number
from basketlens.operators import directory, quality
from basketlens.settings import QualityRules
from basketlens.sources import readers, sinks


def test_discovery_and_named_tables(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "one.csv").write_text("alpha,beta\n1,x\n2,y\n3,z\n")
    (tmp_path / "sub" / "TWO.CSV").write_text("gamma\n4\n")
    (tmp_path / "notes.txt").write_text("no")
    found = [r.path.rsplit("/", 1)[1] for r in readers.csv_listing(spark, str(tmp_path)).collect()]
    assert sorted(found) == ["TWO.CSV", "one.csv"]
    tables = readers.read_csv_tables(spark, str(tmp_path))
    assert tables["one"].dtypes == [("alpha", "int"), ("beta", "string")]
    assert tables["one"].count() == 3
    (tmp_path / "sub" / "one.csv").write_text("a\n1\n")
    with pytest.raises(ValueError, match="one"):
        readers.read_csv_tables(spark, str(tmp_path))


def test_contract_read_keeps_malformed_lines(spark, tmp_path):
    path = tmp_path / "campaign_table.csv"
    path.write_text('DESCRIPTION,household_key,CAMPAIGN\n"a, ""b""",1,2\nTypeA,x,2\nTypeA,1,2,9\nTypeB,3\n')
    df = readers.read_csv(spark, str(path), SOURCE_SCHEMAS["campaign_table"])
    rows = df.collect()
    assert rows[0].DESCRIPTION == 'a, "b"' and rows[0]._corrupt_record is None
    assert sum(r._corrupt_record is not None for r in rows) == 3
    assert quality.corrupt_records(df).first().corrupt_records == 3
    text = readers.read_csv_text(spark, str(path))
    assert all(t == "string" for _, t in text.dtypes)
    assert quality.inference_drift(text, df).first().row_count_changed is False


def test_optional_table_and_reports(spark, tmp_path, frame):
    schema = SOURCE_SCHEMAS["hh_demographic"]
    missing = readers.read_optional_csv(spark, str(tmp_path / "none.csv"), schema)
    assert missing.count() == 0 and "household_key" in missing.columns
    df = frame([(1, "a"), (2, "b")], "k int, split string")
    written = sinks.write_parquet(df, str(tmp_path / "t"), ["split"])
    assert written["rows"] == 2
    assert readers.read_parquet(spark, str(tmp_path / "t"), ["k"]).count() == 2
    sinks.write_json_report(df, str(tmp_path / "r"))
    assert spark.read.json(str(tmp_path / "r")).count() == 2


def test_quality_findings(frame):
    df = frame([("a", "10", "2024-01-01", "x")] * 2 + [(None, "bad", "not-a-date", "y")],
               "key string, amount string, event_day string, extra string")
    rules = QualityRules(required=("key", "missing"), allowed=("key", "amount", "event_day"),
                         numeric=("amount",), dates={"event_day": "yyyy-MM-dd"}, max_null_rate=0.2)
    assert quality.column_differences(df, rules) == {
        "missing_required": ["missing"], "unexpected": ["extra"]}
    assert quality.duplicate_rows(df).first().duplicate_rows == 1
    rows = {r.column_name: r for r in quality.column_profile(df, rules).collect()}
    assert rows["key"].null_count == 1 and rows["key"].null_rate_violation
    assert rows["amount"].invalid_numeric_count == 1
    assert rows["event_day"].invalid_date_count == 1
    assert not rows["extra"].null_rate_violation and rows["extra"].invalid_numeric_count is None


def test_no_rules_and_empty_table(frame):
    df = frame([], "observed_field string")
    row = quality.column_profile(df).first()
    assert (row.row_count, row.null_rate, row.null_rate_violation) == (0, 0.0, False)
    assert quality.column_differences(df, QualityRules()) == {
        "missing_required": [], "unexpected": []}
    assert quality.duplicate_rows(df).first().duplicate_rows == 0


def test_duplicates_treat_nulls_as_equal(frame):
    df = frame([(1, None), (1, None), (1, "a"), (None, None)], "a int, b string")
    assert quality.duplicate_rows(df).first().duplicate_rows == 1


def test_inventory_covers_every_table(frame):
    one, two = frame([(1, 2.0)], "a int, b double"), frame([("x",)], "c string")
    report = quality.inventory({"one": (one, one), "two": (two, two)})
    assert report["columns"].count() == 3 and report["numbers"].count() == 2
    assert {r.dataset for r in report["schema"].collect()} == {"one", "two"}


def test_references(frame):
    child = frame([(1,), (2,), (2,), (None,)], "k int")
    parent = frame([(1,), (1,)], "id int")
    assert [r.k for r in quality.unmatched_keys(child, ["k"], parent, ["id"]).collect()] == [2]
    row = quality.relationship_coverage("r", child, ["k"], parent, ["id"]).first()
    assert (row.child_keys, row.matched_keys, row.unmatched_keys) == (2, 1, 1)
    none = quality.relationship_coverage("r", child, ["k"], None).first()
    assert none.status == "not_evaluated_no_reference" and none.child_keys is None


def test_many_to_one(frame):
    facts = frame([(1, 1), (2, 1)], "h int, CAMPAIGN int")
    dim = frame([(1, "TypeA", 12)], "CAMPAIGN int, campaign_type string, END_DAY int")
    rows = quality.many_to_one(facts, dim, ["CAMPAIGN"]).collect()
    assert len(rows) == 2 and rows[0].campaign_type == "TypeA" and rows[0].END_DAY == 12
    with pytest.raises(Exception, match="not unique"):
        quality.many_to_one(facts, dim.union(dim), ["CAMPAIGN"]).collect()
    with pytest.raises(Exception, match="in the dimension"):
        quality.many_to_one(frame([(1, 9)], "h int, CAMPAIGN int"), dim, ["CAMPAIGN"]).collect()


GATE = ("household_key int, total_sales double, transaction_count bigint, "
        "average_basket_value double, total_quantity bigint, purchase_frequency double, "
        "recency_days int")


def test_economics_gate(frame):
    clean = [(1, 5.0, 1, 5.0, 2, 0.1, 3), (2, 6.0, 1, 6.0, 2, 0.1, 3)]
    assert quality.require_clean_economics(frame(clean, GATE))["rows"] == 2
    for bad in ((1, 5.0, 1, 5.0, 2, 0.1, 3), (3, None, 1, 5.0, 2, 0.1, 3),
                (3, math.inf, 1, 5.0, 2, 0.1, 3), (3, -1.0, 1, 5.0, 2, 0.1, 3),
                (3, math.nan, 1, 5.0, 2, 0.1, 3)):
        with pytest.raises(ValueError):
            quality.require_clean_economics(frame([*clean, bad], GATE))


@pytest.fixture()
def outputs(frame):
    return {
        "customers": frame([(1, 5.0, 1, 5.0, 1, 1, 1, 0, 0.0, 0.0, 0.1, 2)],
                           "household_key int, total_sales double, transaction_count int, "
                           "average_basket_value double, total_quantity int, unique_products int, "
                           "unique_departments int, coupon_usage int, total_retail_discount double, "
                           "total_coupon_discount double, purchase_frequency double, recency_days int"),
        "products": frame([(1, "D", "B", 1, 2.0, 1)],
                          "PRODUCT_ID int, DEPARTMENT string, BRAND string, total_units_sold int, "
                          "total_sales double, number_of_households_purchasing int"),
        "campaigns": frame([(7, "A", 1, 12, 1, 1, 1.0, 1.0, 1.0, 1.0, True, True, 3)],
                           "CAMPAIGN int, campaign_type string, START_DAY int, END_DAY int, "
                           "exposed_households int, redeeming_households int, "
                           "descriptive_redemption_rate double, spend_before_campaign double, "
                           "spend_during_campaign double, spend_after_campaign double, "
                           "campaign_window_complete boolean, "
                           "post_campaign_observation_complete boolean, post_campaign_days_observed int"),
        "campaign_households": frame([(1, 7, "A", 1, 12, 1, 1.0, 1.0, 1.0, True, True, 3)],
                                     "household_key int, CAMPAIGN int, campaign_type string, "
                                     "START_DAY int, END_DAY int, coupon_redemption_count int, "
                                     "spend_before_campaign double, spend_during_campaign double, "
                                     "spend_after_campaign double, campaign_window_complete boolean, "
                                     "post_campaign_observation_complete boolean, "
                                     "post_campaign_days_observed int"),
        "customer_economics": frame([(1, 10.0, 20.0, 0.25)],
                                    "household_key int, modeled_12_month_clv double, "
                                    "modeled_24_month_clv double, assumed_contribution_margin double"),
        "offers": frame([(1, 7, 1, 0.4, -3.0, 5.0, 2.0)],
                        "household_key int, CAMPAIGN int, START_DAY int, "
                        "calibrated_response_probability double, modeled_expected_offer_value double, "
                        "assumed_offer_cost double, break_even_offer_cost double"),
        "model_rows": frame([(1, 7, 1, "test")],
                            "household_key int, CAMPAIGN int, START_DAY int, data_split string")}


def test_contracts(frame, outputs):
    quality.require_contract(outputs)
    customers, offers, value = (outputs[n] for n in ("customers", "offers", "customer_economics"))
    broken = [
        ("customers", customers.union(customers)),
        ("offers", frame([(1, 7, 1, 1.01, -3.0, 5.0, 2.0)], offers.schema)),
        ("offers", frame([(1, 99, 1, 0.4, -3.0, 5.0, 2.0)], offers.schema)),
        ("offers", frame([(5, 7, 1, 0.4, -3.0, 5.0, 2.0)], offers.schema)),
        ("customer_economics", frame([(1, math.nan, 20.0, 0.25)], value.schema)),
        ("campaigns", outputs["campaigns"].limit(0))]
    for name, df in broken:
        with pytest.raises(ValueError, match="broken contracts"):
            quality.require_contract({**outputs, name: df})
    with pytest.raises(ValueError, match="lacks required columns"):
        quality.require_contract({**outputs, "products": outputs["products"].drop("BRAND")})
    with pytest.raises(ValueError, match="missing table"):
        quality.require_contract({k: v for k, v in outputs.items() if k != "offers"})
    with pytest.raises(ValueError, match="sections"):
        quality.require_report_sections({"a": 1}, ("a", "b"), "report")


def test_directory_profile_by_file(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"one{i}.csv").write_text("alpha,beta\n" + f"{i},x\n{i},x\n,2020-01-0{i % 9 + 1}\n")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "Two+words [1] 5%.CSV").write_text('g,g,\n1.5,true,"a, b"\nbad,FALSE\n')
    (tmp_path / "sub" / "days.csv").write_text("day,n\n2020-01-01,3000000000\n2020-01-02,1\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("alpha,beta\n")
    spark.sparkContext.setJobGroup("profile", "profile")
    try:
        rules = QualityRules(numeric=("beta",), dates={"beta": "yyyy-MM-dd"}, max_null_rate=0.3)
        rows = directory.directory_profile(spark, str(tmp_path), rules).collect()
        jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("profile"))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    found = {(r.dataset, r.column_name): r for r in rows}
    assert len(rows) == len(found) == 80 + 3 + 2
    assert jobs < 20  # three headers, 43 files; adaptive stages count as jobs
    for i in range(40):
        a, b = found[f"one{i}.csv", "alpha"], found[f"one{i}.csv", "beta"]
        assert (a.data_type, a.row_count, a.null_count, a.null_rate_violation) == ("int", 3, 1, True)
        assert (a.mean, a.min, a.max, a.duplicate_rows, a.malformed_rows) == (i, i, i, 1, 0)
        assert (b.data_type, b.invalid_numeric_count, b.invalid_date_count) == ("string", 3, 2)
        assert a.invalid_numeric_count is None and b.mean is None
    two = {name: r for (dataset, name), r in found.items() if dataset == "Two+words [1] 5%.CSV"}
    assert {n: r.data_type for n, r in two.items()} == {"g_0": "string", "g_1": "boolean", "_2": "string"}
    assert two["g_0"].malformed_rows == 1 and two["_2"].null_count == 1
    assert found["days.csv", "day"].data_type == "date" and found["days.csv", "n"].data_type == "bigint"


def test_directory_profile_of_an_empty_folder(spark, tmp_path):
    assert directory.directory_profile(spark, str(tmp_path)).count() == 0
    (tmp_path / "empty.csv").write_text("")
    assert directory.directory_profile(spark, str(tmp_path)).columns[0] == "dataset"


def test_words_are_not_cast_and_paths_not_taken_apart_row_by_row(spark, tmp_path):
    odd = ["12", " 12\n", "+7", "-0", "1.5", ".5", "5.", "1e5", "1E-3f", "2d", "0x1p3", "0x.8P1D", "NaN", "nan",
           " inf", "-Infinity", "+INF", "word", "2020-01-01", "1 2", "", " ", "-", "e5", "9223372036854775807",
           "-9223372036854775808", "9223372036854775808", "0000000000000000000012", "99999999999999999999", "٣",
           "12\x00", "\x7f7", "infinit", "1e400", "0x10", "1_000", None]
    text = spark.createDataFrame([(v,) for v in odd], "v string")
    for made, kind in ((as_integer, "bigint"), (as_number, "double")):
        rows = text.select("v", made(F.col("v")).alias("made"), F.col("v").try_cast(kind).alias("cast"))
        assert rows.where("NOT made <=> cast").collect() == []
    for day in ("1", "2"):
        (tmp_path / f"day={day}").mkdir()
        (tmp_path / f"day={day}" / "part.csv").write_text("kind,n\nTypeA,3000000000\nTypeB,2\n")
    profile = directory.directory_profile(spark, str(tmp_path), dataset=directory.BY_FOLDER)
    assert sorted((r.dataset, r.column_name, r.data_type, r.min) for r in profile.collect()) == [
        (f"day={day}", *rest) for day in "12" for rest in (("kind", "string", None), ("n", "bigint", 2.0))]
    plan = profile._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp_extract" not in plan and "url_decode" not in plan.lower()
    # Each value is parsed once, not once for each sum that reads it.
    assert len(re.findall(r"cast\(c\d+#\d+ as double\)", plan)) == 2
