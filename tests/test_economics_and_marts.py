import random
import statistics

import pytest
from pyspark.sql import functions as F

from basketlens.functions.finance import monthly_rate, npv_of_array, npv_sum
from basketlens.operators import economics, lookups, marts, ordering
from basketlens.settings import FinanceAssumptions, SensitivityGrid

CUSTOMERS = ("household_key int, total_sales double, transaction_count bigint, "
             "average_basket_value double, total_quantity bigint, purchase_frequency double, "
             "recency_days int")
MONTHLY = FinanceAssumptions(observed_history_days=30, days_per_month=30.0)


@pytest.fixture(scope="module")
def customers(frame):
    return frame([(1, 100.0, 2, 50.0, 4, 0.1, 2), (2, 0.0, 1, 0.0, 0, 0.0, 3)], CUSTOMERS)


def test_npv_over_arrays_and_rows(frame):
    expected = 25 / 1.1 + 25 / 1.21 - 5
    array = frame([([100.0, 100.0],)], "flows array<double>")
    assert array.select(npv_of_array(F.col("flows"), 0.10, 0.25, 5.0)).first()[0] == pytest.approx(
        expected)
    long = frame([(1, 100.0), (2, 100.0)], "month int, flow double")
    assert long.agg(npv_sum(F.col("flow"), F.col("month"), 0.10, 0.25, 5.0)).first()[0] == \
        pytest.approx(expected)


def test_customer_value(customers):
    rows = {r.household_key: r for r in economics.customer_economics(customers, MONTHLY).collect()}
    assert rows[1].estimated_monthly_revenue == 100.0
    assert rows[1].estimated_monthly_contribution == 25.0
    assert rows[1].modeled_24_month_clv > rows[1].modeled_12_month_clv > 0
    step = 1 + monthly_rate(0.1)
    assert rows[1].modeled_12_month_clv == pytest.approx(
        sum(25 * 0.9 ** (t - 1) / step ** t for t in range(1, 13)))
    assert rows[2].modeled_24_month_clv == 0.0


def offers_of(frame, p):
    scored = frame([(1, 7, 600, p)], "household_key int, CAMPAIGN int, START_DAY int, "
                                     "calibrated_response_probability double")
    buyers = frame([(1, 20.0, 9.0)], "household_key int, average_basket_value double, "
                                     "modeled_12_month_clv double")
    return economics.offer_economics(scored, buyers, FinanceAssumptions())


def test_offer_economics(frame):
    row = offers_of(frame, 0.4).first()
    assert (row.expected_contribution_if_response, row.break_even_offer_cost,
            row.modeled_expected_offer_value) == (5.0, 2.0, -3.0)
    for bad in (1.01, -0.1, None, float("nan")):
        with pytest.raises(Exception, match="out of range"):
            offers_of(frame, bad).collect()


def test_scenario_grid(spark):
    grid = SensitivityGrid((0.1, 0.2), (0.9,), (0.1,), (1.0, 2.0))
    rows = economics.scenario_grid(spark, grid, 12).collect()
    assert len(rows) == 4 and len({r.factor for r in rows}) == 1
    assert economics.scenario_grid(spark, SensitivityGrid(), 12).count() == 81
    assert economics.one_factor_scenarios(spark, FinanceAssumptions(), SensitivityGrid()).count() == 9


@pytest.mark.parametrize("hot", [0.0, 0.4])
def test_order_statistics_match_sorting(frame, hot):
    rng = random.Random(3)
    values = [5.0 if rng.random() < hot else round(rng.uniform(0, 50), 1) for _ in range(700)]
    df = frame([(i, v) for i, v in enumerate(values)], "k int, v double")
    ranks = [1, 2, 233, 234, 350, 466, 700]
    found = ordering.values_at_ranks(df, "v", ranks, 700)
    assert found == {r: sorted(values)[r - 1] for r in ranks}
    assert ordering.median(df, "v") == pytest.approx(statistics.median(values))
    by_order = sorted(range(700), key=lambda i: (values[i], i))
    sizes = [0, 233, 466, 700]
    for size, first in zip(sizes, ordering.first_by_rank(df, "v", "k", sizes, 700)):
        assert sorted(r.k for r in df.where(first).collect()) == sorted(by_order[:size])


def test_segments_put_the_remainder_on_top(frame):
    df = frame([(i, float(i)) for i in range(10)], "household_key int, modeled_12_month_clv double")
    segmented, _ = marts.value_segments(df)
    sizes = {r.value_segment: r["count"] for r in segmented.groupBy("value_segment").count().collect()}
    assert [sizes[s] for s in marts.SEGMENTS] == [3, 3, 4]
    figures = {r.value_segment: r for r in marts.segment_statistics(df).collect()}
    assert figures[marts.SEGMENTS[2]]["median"] == 7.5
    assert figures[marts.SEGMENTS[0]]["smallest"] == 0.0


def test_histogram_of_one_value_is_one_bin(frame):
    rows = marts.histogram(frame([(2.0,), (2.0,), (None,)], "v double"), "v", 5).collect()
    assert [(r.bin, r.rows) for r in rows] == [(0, 2)]


CAMPAIGN_DDL = ("CAMPAIGN int, campaign_type string, START_DAY int, END_DAY int, "
                "exposed_households bigint, coupon_redemption_count bigint, "
                "redeeming_households bigint, descriptive_redemption_rate double, "
                "spend_before_campaign double, spend_during_campaign double, "
                "spend_after_campaign double, campaign_window_complete boolean, "
                "post_campaign_observation_complete boolean, post_campaign_days_observed int")


@pytest.fixture(scope="module")
def campaigns(frame):
    def row(c, end, rate):
        return (c, "TypeA", end - 10, end, 40, 9, 9, rate, 1.0, 2.0, 3.0, True, True, 5)
    return frame([row(1, 40, 0.1), row(2, 50, 0.225), row(3, 70, 0.99), row(4, 45, None)],
                 CAMPAIGN_DDL)


def test_rankings(frame, campaigns):
    redeemed = frame([(1, 60)], "household_key int, DAY int")
    top = lookups.rank_campaigns(campaigns, redeemed, 1).collect()
    assert [r.CAMPAIGN for r in top] == [2]
    assert [r.CAMPAIGN for r in lookups.rank_campaigns(campaigns, redeemed, 30).collect()] == [2, 1]
    values = frame([(5, 100.0, 150.0, 1.0, 1), (123, 100.0, 160.0, 1.0, 1), (7, 90.0, 170.0, 1.0, 1)],
                   "household_key int, modeled_12_month_clv double, modeled_24_month_clv double, "
                   "historical_revenue double, basket_count bigint")
    assert [r.household_key for r in lookups.rank_customers(values, 2).collect()] == [5, 123]
    for call in (lambda: lookups.rank_customers(values, 101),
                 lambda: lookups.rank_customers(values, 5, "total_sales"),
                 lambda: lookups.rank_campaigns(campaigns, redeemed, 31)):
        with pytest.raises(ValueError):
            call()


def test_lookups(frame, customers, campaigns):
    value = economics.customer_economics(customers, MONTHLY)
    offers = frame([(1, 9, 30, 0.4, 5.0, 5.0, 2.0, -3.0), (1, 8, 20, 0.3, 5.0, 5.0, 1.5, -3.5)],
                   "household_key int, CAMPAIGN int, START_DAY int, "
                   "calibrated_response_probability double, "
                   "expected_contribution_if_response double, assumed_offer_cost double, "
                   "break_even_offer_cost double, modeled_expected_offer_value double")
    requests = frame([(1,), (999,)], "household_key int")
    found = {r.household_key: r for r in lookups.customer_lookup(
        requests, customers, value, offers).collect()}
    assert found[1].status == "found" and found[999].status == "unavailable"
    assert [o.CAMPAIGN for o in found[1].offers] == [8, 9]
    asked = frame([(2,), (77,)], "CAMPAIGN int")
    status = {r.CAMPAIGN: r.status for r in lookups.campaign_lookup(asked, campaigns).collect()}
    assert status == {2: "found", 77: "unavailable"}
    assert [r.CAMPAIGN for r in lookups.offer_lookup(offers, household_key=1).collect()] == [9, 8]
    assert lookups.offer_lookup(offers, campaign=8).count() == 1


def test_spend_by_period_names(campaigns):
    names = {r.campaign_period for r in marts.spend_by_period(campaigns).collect()}
    assert names == {"Spend Before", "Spend During", "Spend After"}
