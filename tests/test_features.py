import pytest

from basketlens.operators.campaigns import campaign_features, campaign_households
from basketlens.operators.features import household_features, product_features
from basketlens.settings import FeatureWindows

LINES = ("household_key int, BASKET_ID bigint, DAY int, PRODUCT_ID int, QUANTITY bigint, "
         "SALES_VALUE double, RETAIL_DISC double, COUPON_DISC double, COUPON_MATCH_DISC double")
WEEK = FeatureWindows(cutoff=8)


@pytest.fixture(scope="module")
def lines(frame):
    """Household 7 buys on days 2, 6 and, beyond the window, 8; household 9 on days 1 and 7."""
    return frame([
        (7, 31, 2, 501, 3, 9.0, -0.75, 0.0, 0.0), (7, 31, 2, 502, 1, 2.5, 0.0, -0.5, -0.25),
        (7, 32, 6, 501, 2, 6.5, 0.0, 0.0, 0.0), (7, 33, 8, 503, 9, 90.0, 0.0, 0.0, 0.0),
        (9, 34, 1, 502, 4, 8.0, 0.0, -1.0, 0.0), (9, 35, 7, 502, 1, 2.0, -0.25, 0.0, 0.0)], LINES)


@pytest.fixture(scope="module")
def products(frame):
    return frame([
        (501, 8, "Bakery", "House", "Bread", "Rye", "500 g"),
        (502, 8, None, "House", "Spread", None, None),
        (503, 6, "Drinks", "Maker", "Water", "Still", "1 l"),
        (504, 6, "Drinks", "Maker", None, None, None)],
        "PRODUCT_ID int, MANUFACTURER int, DEPARTMENT string, BRAND string, "
        "COMMODITY_DESC string, SUB_COMMODITY_DESC string, CURR_SIZE_OF_PRODUCT string")


def by_key(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


def test_households_before_the_cutoff(frame, lines, products):
    exposed = frame([(9, 4, 1), (9, 5, 1)],
                    "household_key int, CAMPAIGN int, campaign_exposure int")
    redeemed = frame([(9, 3, 4, 1), (9, 7, 4, 1), (9, 8, 5, 2)],
                     "household_key int, DAY int, CAMPAIGN int, COUPON_UPC bigint")
    rows = by_key(household_features(lines, products, exposed, redeemed, WEEK), "household_key")
    names = ("transaction_count", "total_sales", "average_basket_value", "total_quantity",
             "unique_products", "unique_departments", "unique_commodities", "coupon_usage",
             "total_retail_discount", "total_coupon_discount", "purchase_day_range",
             "recency_days", "campaign_exposure_count", "coupon_redemption_count")
    assert {k: [rows[k][n] for n in names] for k in rows} == {
        7: [2, 18.0, 9.0, 6, 2, 1, 2, 1, -0.75, -0.75, 4, 2, 0, 0],
        9: [2, 10.0, 5.0, 5, 1, 0, 1, 1, -0.25, -1.0, 6, 1, 2, 2]}
    assert rows[7].purchase_frequency == pytest.approx(2 / 5)
    assert rows[9].purchase_frequency == pytest.approx(2 / 7)


def test_sold_and_unsold_products(lines, products):
    rows = by_key(product_features(lines, products, WEEK), "PRODUCT_ID")
    names = ("total_units_sold", "total_sales", "number_of_households_purchasing",
             "number_of_baskets_containing_product", "number_of_repeat_purchasing_households",
             "repeat_purchase_rate", "DEPARTMENT")
    assert {k: [rows[k][n] for n in names] for k in (501, 502)} == {
        501: [5, 15.5, 1, 2, 1, 1.0, "Bakery"], 502: [6, 12.5, 2, 3, 1, 0.5, None]}
    assert rows[502].average_sales_value_per_occurrence == pytest.approx(12.5 / 3)
    for unsold in (rows[503], rows[504]):
        assert (unsold.total_sales, unsold.total_units_sold) == (0.0, 0)
        assert unsold.average_sales_value_per_occurrence is None
        assert unsold.repeat_purchase_rate is None
    assert len(rows) == 4


@pytest.fixture(scope="module")
def campaign_inputs(frame):
    """Campaign 31 runs on days 4 to 6, 32 only after the cutoff, 33 addresses nobody."""
    campaigns = frame([("TypeB", 31, 4, 6), ("TypeC", 32, 9, 12), ("TypeA", 33, 5, 5)],
                      "DESCRIPTION string, CAMPAIGN int, START_DAY int, END_DAY int")
    assigned = frame([(5, 31), (6, 31), (6, 32)], "household_key int, CAMPAIGN int")
    lines = frame([(5, 1, 10.0), (5, 4, 1.5), (5, 6, 2.5), (5, 7, 20.0), (5, 8, 0.5), (5, 9, 70.0),
                   (6, 2, 7.0), (6, 3, 1.0), (6, 5, 4.0), (6, 7, 3.0)],
                  "household_key int, DAY int, SALES_VALUE double")
    redeemed = frame([(5, 5, 31, 1), (6, 6, 31, 2), (6, 6, 31, 3), (6, 9, 32, 4)],
                     "household_key int, DAY int, CAMPAIGN int, COUPON_UPC bigint")
    return campaigns, assigned, lines, redeemed


SPEND = ("spend_before_campaign", "spend_during_campaign", "spend_after_campaign",
         "coupon_redemption_count", "post_campaign_days_observed",
         "campaign_window_complete", "post_campaign_observation_complete")


def test_spend_around_a_campaign(campaign_inputs):
    rows = by_key(campaign_households(*campaign_inputs, FeatureWindows(cutoff=9, outcome=2)),
                  "household_key", "CAMPAIGN")
    assert {k: [r[n] for n in SPEND] for k, r in rows.items()} == {
        (5, 31): [10.0, 4.0, 20.5, 1, 2, True, True], (6, 31): [8.0, 4.0, 3.0, 2, 2, True, True]}


def test_campaign_totals_and_a_campaign_without_households(campaign_inputs):
    rows = by_key(campaign_features(*campaign_inputs, FeatureWindows(cutoff=9, outcome=2)),
                  "CAMPAIGN")
    names = ("exposed_households", "redeeming_households", *SPEND[:4],
             "descriptive_redemption_rate")
    assert [rows[31][n] for n in names] == [2, 2, 18.0, 8.0, 23.5, 3, 1.0]
    assert set(rows) == {31, 33}
    assert [rows[33][n] for n in ("exposed_households", "redeeming_households")] == [0, 0]
    assert all(rows[33][n] is None for n in (
        "spend_before_campaign", "campaign_window_complete", "post_campaign_days_observed",
        "descriptive_redemption_rate"))


def test_a_cut_off_outcome_has_no_spend_after(campaign_inputs):
    rows = by_key(campaign_households(*campaign_inputs, FeatureWindows(cutoff=9, outcome=4)),
                  "household_key", "CAMPAIGN")
    assert [rows[5, 31][n] for n in SPEND[2:]] == [None, 1, 2, True, False]


def test_names_are_counted_without_multiplying_pairs(frame, lines, products):
    exposed = frame([(9, 4, 1)], "household_key int, CAMPAIGN int, campaign_exposure int")
    redeemed = frame([(9, 3, 4, 1)], "household_key int, DAY int, CAMPAIGN int, COUPON_UPC bigint")
    table = household_features(lines, products, exposed, redeemed, WEEK)
    assert "Expand" not in table._jdf.queryExecution().executedPlan().toString()
