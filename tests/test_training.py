import random

import duckdb
import pandas as pd
import pytest

from basketlens.contracts import RESPONSE_FEATURES
from basketlens.operators.training import campaign_splits, observable_splits, response_dataset
from basketlens.plans.oracle import STEPS, statement
from basketlens.settings import SplitPlan

CAMPAIGNS = "CAMPAIGN int, DESCRIPTION string, START_DAY int, END_DAY int"
LINES = ("household_key bigint, BASKET_ID bigint, DAY int, PRODUCT_ID bigint, QUANTITY int, "
         "SALES_VALUE double, RETAIL_DISC double, COUPON_DISC double, COUPON_MATCH_DISC double")


def test_history_is_the_lookback_before_each_start(frame):
    """Campaign 62 sees campaign 61, which began within its 7 days, and its redemption; 63 sees
    only its own early redemption, which belongs to no earlier campaign."""
    campaigns = frame([(61, "A", 30, 33), (62, "B", 36, 38), (63, "C", 50, 52)], CAMPAIGNS)
    assigned = frame([(4, 61), (4, 62), (4, 63)], "household_key bigint, CAMPAIGN int")
    lines = frame([(4, 900, 22, 1, 1, 50.0, 0.0, 0.0, 0.0),    # before every lookback of 7 days
                   (4, 901, 29, 1, 2, 12.5, -0.5, -2.0, 0.0),
                   (4, 902, 30, 2, 1, 8.0, 0.0, 0.0, 0.0),     # on a start day
                   (4, 903, 35, 2, 3, 6.0, 0.0, 0.0, 0.0),
                   (4, 904, 47, 1, 1, 3.25, 0.0, 0.0, 0.0)], LINES)
    products = frame([(1, "Bakery"), (2, None)], "PRODUCT_ID bigint, DEPARTMENT string")
    # Household 5's redemption shows that campaign 63 is observed to its end.
    redeemed = frame([(4, 61, 33), (4, 62, 39), (4, 63, 49), (5, 63, 52)],
                     "household_key bigint, CAMPAIGN int, DAY int")
    names = ("historical_total_sales", "historical_basket_count", "historical_recency_days",
             "historical_coupon_basket_count", "target_redeemed", "prior_coupon_redemption_count",
             "prior_campaign_exposure_count", "prior_campaign_redemption_count")
    rows = response_dataset(campaigns, assigned, lines, products, redeemed,
                            SplitPlan(7, 0.34, 0.33)).collect()
    assert {r.CAMPAIGN: [r[n] for n in names] for r in rows} == {
        61: [12.5, 1, 1, 1, 1, 0, 0, 0], 62: [26.5, 3, 1, 1, 0, 1, 1, 1],
        63: [3.25, 1, 3, 0, 0, 1, 0, 0]}


def test_equal_starts_share_a_split_and_overlaps_leave_it(frame):
    spans = [(1, 5, 6), (2, 9, 10), (3, 9, 12), (4, 9, 9), (5, 14, 16), (6, 21, 22), (7, 30, 31)]

    def splits(rows):
        table = frame([(i, "A", a, b) for i, a, b in rows], CAMPAIGNS)
        return {r.CAMPAIGN: r.data_split
                for r in campaign_splits(table, SplitPlan(90, 0.5, 0.25)).collect()}

    assert splits(spans) == {1: "train", 2: "train", 3: "train", 4: "train", 5: "validation",
                             6: "test", 7: "test"}
    overlapping = splits([(3, 9, 14), *[s for s in spans if s[0] != 3]])
    assert overlapping[3] is None and overlapping[2] == "train" and overlapping[5] == "validation"


def test_splits_with_27_starts(frame):
    campaigns = frame([(i, "A", 100 * i, 100 * i + 5) for i in range(1, 28)], CAMPAIGNS)
    sizes = campaign_splits(campaigns, SplitPlan()).groupBy("data_split").count().collect()
    assert {r.data_split: r["count"] for r in sizes} == {"train": 16, "validation": 5, "test": 6}


def test_unobservable_and_too_few_campaigns(frame):
    campaigns = frame([(i, "A", 10 * i, 10 * i + 1) for i in range(1, 6)], CAMPAIGNS)
    redeemed = frame([(1, 1, 45)], "household_key bigint, CAMPAIGN int, DAY int")
    splits = {r.CAMPAIGN: r.data_split for r in observable_splits(
        campaigns, redeemed, SplitPlan(90, 0.4, 0.2)).collect()}
    assert splits[5] is None and splits[4] == "test"
    with pytest.raises(Exception, match="three distinct"):
        campaign_splits(campaigns.limit(2), SplitPlan()).collect()


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_range_joins_on_skewed_random_data(frame, seed):
    """One household with a third of all lines, baskets over several days, null money."""
    rng = random.Random(seed)
    campaigns = [(c, "A", s := 40 + 12 * (c - c % 3), s + rng.choice([5, 12, 30]))
                 for c in range(1, 13)]
    assigned = [(h, c) for h in range(8) for c, *_ in campaigns if rng.random() < 0.6]
    lines = []
    for _ in range(900):
        h = 0 if rng.random() < 0.34 else rng.randrange(8)
        money = None if rng.random() < 0.05 else round(rng.uniform(1, 90), 2)
        coupon = rng.choice([0.0, 0.0, -1.0, None])
        lines.append((h, h * 1000 + rng.randrange(60), rng.randrange(1, 230), rng.randrange(12),
                      rng.randrange(1, 5), money, -0.5, coupon, 0.0))
    products = [(p, None if p % 5 == 0 else f"D{p % 3}") for p in range(10)]
    redeemed = [(h, c, max(1, rng.randrange(s - 15, e + 15))) for h, c in assigned
                for _, _, s, e in [campaigns[c - 1]] for _ in range(rng.randrange(3))]
    plan = SplitPlan(30, 0.5, 0.25)
    got = response_dataset(
        frame(campaigns, CAMPAIGNS), frame(assigned, "household_key bigint, CAMPAIGN int"),
        frame(lines, LINES), frame(products, "PRODUCT_ID bigint, DEPARTMENT string"),
        frame(redeemed, "household_key bigint, CAMPAIGN int, DAY int"), plan).toPandas()

    duck = duckdb.connect()
    tables = {
        "campaign_desc": pd.DataFrame(campaigns, columns=["CAMPAIGN", "DESCRIPTION", "START_DAY",
                                                          "END_DAY"]),
        "campaign_table": pd.DataFrame(assigned, columns=["household_key", "CAMPAIGN"]),
        "tx": pd.DataFrame(lines, columns=[c.split()[0] for c in LINES.split(", ")]),
        "catalog": pd.DataFrame(products, columns=["PRODUCT_ID", "DEPARTMENT"]),
        "coupon_redempt": pd.DataFrame(redeemed, columns=["household_key", "CAMPAIGN", "DAY"])}
    for name, table in tables.items():
        duck.register(name, table)
    sql = statement("SELECT * FROM dataset")
    for name in tables:  # the registered frames stand in for the derived tables
        sql = sql.replace(f"{name} AS ({STEPS[name]})", f"{name}_derived AS (SELECT 1)")
    sql = (sql.replace("0.6 AS DOUBLE", "0.5 AS DOUBLE").replace("0.8 AS DOUBLE", "0.75 AS DOUBLE")
           .replace("- 90", "- 30").replace("/ 90", "/ 30"))
    want = duck.execute(sql).df()
    keys = ["household_key", "CAMPAIGN"]
    got, want = (d.sort_values(keys).reset_index(drop=True) for d in (got, want))
    assert len(got) > 15 and got[keys].equals(want[keys].astype(got[keys].dtypes))
    for name in (*RESPONSE_FEATURES, "target_redeemed"):
        assert got[name].astype(float).tolist() == pytest.approx(
            want[name].astype(float).tolist(), nan_ok=True), name
