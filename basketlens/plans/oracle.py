"""DuckDB statements that state the expected result of the queries independently.

Named steps are plain SQL; a statement carries the steps it mentions as its WITH
clause.  The steps follow the definitions directly (range joins, distinct
counts, self-joins) rather than the way the Spark plans compute them.
"""

from __future__ import annotations

import re

from basketlens.contracts import RESPONSE_FEATURES
from basketlens.functions.text import STOP_WORDS
from basketlens.operators import routing as words
from basketlens.plans.frozen import FROZEN_CALIBRATOR, FROZEN_NETWORK
from basketlens.settings import FinanceAssumptions

STEPS: dict[str, str] = {}
ORACLE: dict[str, str] = {}


def statement(body: str) -> str:
    """Prefix a body with the steps it needs, directly or through other steps."""
    needed: set[str] = set()
    queue = [body]
    while queue:
        words = set(re.findall(r"[a-z_0-9]+", queue.pop()))
        for name in words & set(STEPS) - needed:
            needed.add(name)
            queue.append(STEPS[name])
    steps = [f"{name} AS ({STEPS[name]})" for name in STEPS if name in needed]
    return ("WITH " + ",\n".join(steps) + "\n" if steps else "") + body


def step(name: str, sql: str) -> None:
    STEPS[name] = sql.strip()


def oracle(name: str, body: str) -> None:
    ORACLE[name] = statement(body.strip())


# Retail tables over the test tables

step("tx", """
SELECT o_custkey AS household_key, o_orderkey AS BASKET_ID,
       CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) + 1 AS INTEGER) AS "DAY",
       l_partkey AS PRODUCT_ID, CAST(l_quantity AS INTEGER) AS QUANTITY, l_suppkey AS STORE_ID,
       CAST(price * (CAST(1 AS DECIMAL(4,2)) - share) AS DECIMAL(18,4)) AS SALES_VALUE,
       CASE WHEN l_returnflag = 'N' THEN CAST(-(price * share) AS DECIMAL(18,4))
            ELSE CAST(0 AS DECIMAL(18,4)) END AS RETAIL_DISC,
       CASE WHEN l_returnflag = 'R' THEN CAST(-(price * share) AS DECIMAL(18,4))
            ELSE CAST(0 AS DECIMAL(18,4)) END AS COUPON_DISC,
       CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F'
            THEN CAST(CAST(-(price * share) AS DECIMAL(18,4)) * CAST(0.5 AS DECIMAL(2,1)) AS DECIMAL(18,5))
            ELSE CAST(0 AS DECIMAL(18,5)) END AS COUPON_MATCH_DISC,
       l_returnflag = 'R' AS coupon_line
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
             CAST(l_discount AS DECIMAL(4,2)) AS share FROM lineitem)
JOIN orders ON l_orderkey = o_orderkey""")

step("catalog", """
SELECT p_partkey AS PRODUCT_ID, CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS MANUFACTURER,
       CASE WHEN p_size % 10 <> 0 THEN p_type END AS DEPARTMENT, p_brand AS BRAND,
       CASE WHEN p_size % 10 <> 0 THEN p_name END AS COMMODITY_DESC,
       p_brand AS SUB_COMMODITY_DESC,
       CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) END AS CURR_SIZE_OF_PRODUCT
FROM part""")

step("campaign_desc", """
SELECT 'Type' || substr('ABC', i % 3 + 1, 1) AS DESCRIPTION, i AS CAMPAIGN,
       CAST(1050 + 60 * ((i * 9) // 10) AS INTEGER) AS START_DAY,
       CAST(1050 + 60 * ((i * 9) // 10) + 30 + 15 * (i % 4) AS INTEGER) AS END_DAY
FROM (SELECT DISTINCT CAST(regexp_extract(p_brand, '([0-9]+)', 1) AS INTEGER) AS i FROM part)""")

step("campaign_table", """
SELECT c.c_custkey AS household_key, t.CAMPAIGN
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN (SELECT CAMPAIGN, CAMPAIGN % 5 AS region FROM campaign_desc
      UNION SELECT CAMPAIGN, (CAMPAIGN // 5) % 5 FROM campaign_desc) t
  ON n.n_regionkey = t.region""")

step("coupon_redempt", """
SELECT x.household_key, x."DAY", x.PRODUCT_ID AS COUPON_UPC, a.CAMPAIGN
FROM tx x JOIN campaign_table a ON x.household_key = a.household_key
JOIN campaign_desc d ON a.CAMPAIGN = d.CAMPAIGN
WHERE x.coupon_line
  AND x."DAY" BETWEEN d.START_DAY - 20 AND d.END_DAY + 20""")

step("hh_demographic", """
SELECT c_mktsegment AS classification_1, c_custkey AS household_key
FROM customer WHERE c_custkey IN (SELECT user_id FROM events)""")


# Feature tables, once with all history and once bounded on both sides

def _feature_steps(suffix: str, cutoff: int, lookback: int | None, outcome: int | None) -> None:
    window = f'"DAY" < {cutoff}' + (f' AND "DAY" >= {cutoff - lookback}' if lookback else "")
    starts = f"START_DAY < {cutoff}" + (f" AND START_DAY >= {cutoff - lookback}" if lookback else "")
    before = '"DAY" < START_DAY' + (f' AND "DAY" >= START_DAY - {lookback}' if lookback else "")
    after = '"DAY" > END_DAY' + (f' AND "DAY" <= END_DAY + {outcome}' if outcome else "")
    complete = f"END_DAY + {outcome or 0} < {cutoff}"
    observed = f"greatest(0, {cutoff} - END_DAY - 1)"
    observed = f"least({observed}, {outcome})" if outcome else observed
    step(f"window_tx{suffix}", f"SELECT * FROM tx WHERE {window}")
    step(f"eligible{suffix}", f"""
SELECT CAMPAIGN, DESCRIPTION AS campaign_type, START_DAY, END_DAY FROM campaign_desc WHERE {starts}""")
    step(f"exposed{suffix}", f"""
SELECT a.household_key, e.* FROM campaign_table a JOIN eligible{suffix} e USING (CAMPAIGN)""")
    step(f"campaign_households_exact{suffix}", f"""
SELECT e.household_key, e.CAMPAIGN, e.campaign_type, e.START_DAY, e.END_DAY,
       CAST(1 AS INTEGER) AS campaign_exposure,
       CAST(coalesce(r.n, 0) AS BIGINT) AS coupon_redemption_count,
       coalesce(s.b, 0) AS spend_before_campaign, coalesce(s.d, 0) AS spend_during_campaign,
       CASE WHEN {complete} THEN coalesce(s.a, 0) END AS spend_after_campaign,
       CAST({observed} AS INTEGER) AS post_campaign_days_observed,
       END_DAY < {cutoff} AS campaign_window_complete,
       {complete} AS post_campaign_observation_complete
FROM exposed{suffix} e
LEFT JOIN (SELECT household_key, CAMPAIGN,
                  sum(SALES_VALUE) FILTER ({before}) AS b,
                  sum(SALES_VALUE) FILTER ("DAY" BETWEEN START_DAY AND END_DAY) AS d,
                  sum(SALES_VALUE) FILTER ({after}) AS a
           FROM tx JOIN exposed{suffix} USING (household_key) WHERE "DAY" < {cutoff}
           GROUP BY ALL) s USING (household_key, CAMPAIGN)
LEFT JOIN (SELECT household_key, CAMPAIGN, count(*) AS n
           FROM coupon_redempt JOIN exposed{suffix} USING (household_key, CAMPAIGN)
           WHERE "DAY" BETWEEN START_DAY AND END_DAY AND "DAY" < {cutoff}
           GROUP BY ALL) r USING (household_key, CAMPAIGN)""")
    step(f"campaign_households{suffix}", f"""
SELECT household_key, CAMPAIGN, campaign_type, START_DAY, END_DAY, campaign_exposure,
       coupon_redemption_count, CAST(spend_before_campaign AS DOUBLE) AS spend_before_campaign,
       CAST(spend_during_campaign AS DOUBLE) AS spend_during_campaign,
       CAST(spend_after_campaign AS DOUBLE) AS spend_after_campaign, post_campaign_days_observed,
       campaign_window_complete, post_campaign_observation_complete
FROM campaign_households_exact{suffix}""")
    step(f"campaign_features{suffix}", f"""
SELECT e.CAMPAIGN, e.campaign_type, e.START_DAY, e.END_DAY,
       CAST(coalesce(n, 0) AS BIGINT) AS exposed_households,
       CAST(coalesce(red, 0) AS BIGINT) AS coupon_redemption_count,
       CAST(coalesce(hh, 0) AS BIGINT) AS redeeming_households,
       CAST(b AS DOUBLE) AS spend_before_campaign, CAST(d AS DOUBLE) AS spend_during_campaign,
       CAST(a AS DOUBLE) AS spend_after_campaign,
       campaign_window_complete, post_campaign_observation_complete, post_campaign_days_observed,
       CASE WHEN n > 0 THEN hh / n END AS descriptive_redemption_rate
FROM eligible{suffix} e LEFT JOIN (
  SELECT CAMPAIGN, count(*) AS n, sum(coupon_redemption_count) AS red,
         count(*) FILTER (coupon_redemption_count > 0) AS hh,
         sum(spend_before_campaign) AS b, sum(spend_during_campaign) AS d,
         sum(spend_after_campaign) AS a, bool_and(campaign_window_complete) AS campaign_window_complete,
         bool_and(post_campaign_observation_complete) AS post_campaign_observation_complete,
         max(post_campaign_days_observed) AS post_campaign_days_observed
  FROM campaign_households_exact{suffix} GROUP BY CAMPAIGN) t USING (CAMPAIGN)""")
    step(f"customer_features{suffix}", f"""
SELECT c.household_key, CAST(c.sales AS DOUBLE) AS total_sales, c.baskets AS transaction_count,
       b.average_basket_value, CAST(c.quantity AS BIGINT) AS total_quantity,
       c.unique_products, c.unique_departments, c.unique_commodities,
       CAST(coalesce(u.n, 0) AS BIGINT) AS coupon_usage,
       CAST(c.retail AS DOUBLE) AS total_retail_discount,
       CAST(c.coupon AS DOUBLE) AS total_coupon_discount,
       CAST(coalesce(x.n, 0) AS BIGINT) AS campaign_exposure_count,
       CAST(coalesce(r.n, 0) AS BIGINT) AS coupon_redemption_count,
       c.last_day - c.first_day AS purchase_day_range,
       c.baskets / (c.last_day - c.first_day + 1) AS purchase_frequency,
       {cutoff} - c.last_day AS recency_days
FROM (SELECT household_key, sum(SALES_VALUE) AS sales, count(DISTINCT BASKET_ID) AS baskets,
             sum(QUANTITY) AS quantity, count(DISTINCT PRODUCT_ID) AS unique_products,
             count(DISTINCT DEPARTMENT) AS unique_departments,
             count(DISTINCT COMMODITY_DESC) AS unique_commodities, sum(RETAIL_DISC) AS retail,
             sum(COUPON_DISC) + sum(COUPON_MATCH_DISC) AS coupon,
             min("DAY") AS first_day, max("DAY") AS last_day
      FROM window_tx{suffix} LEFT JOIN catalog USING (PRODUCT_ID) GROUP BY household_key) c
LEFT JOIN (SELECT household_key, CAST(sum(s) AS DOUBLE) / count(s) AS average_basket_value
           FROM (SELECT household_key, BASKET_ID, sum(SALES_VALUE) AS s FROM window_tx{suffix}
                 GROUP BY ALL) GROUP BY household_key) b USING (household_key)
LEFT JOIN (SELECT household_key, count(DISTINCT BASKET_ID) AS n FROM window_tx{suffix}
           WHERE COUPON_DISC <> 0 OR COUPON_MATCH_DISC <> 0 GROUP BY household_key) u USING (household_key)
LEFT JOIN (SELECT household_key, count(*) AS n FROM exposed{suffix} GROUP BY household_key) x USING (household_key)
LEFT JOIN (SELECT household_key, count(*) AS n FROM coupon_redempt WHERE {window}
           GROUP BY household_key) r USING (household_key)""")
    step(f"product_features{suffix}", f"""
SELECT p.PRODUCT_ID, p.MANUFACTURER, p.DEPARTMENT, p.BRAND, p.COMMODITY_DESC, p.SUB_COMMODITY_DESC,
       p.CURR_SIZE_OF_PRODUCT, CAST(coalesce(s.units, 0) AS BIGINT) AS total_units_sold,
       CAST(coalesce(s.sales, 0) AS DOUBLE) AS total_sales,
       coalesce(s.households, 0) AS number_of_households_purchasing,
       CAST(s.sales AS DOUBLE) / s.lines AS average_sales_value_per_occurrence,
       coalesce(s.baskets, 0) AS number_of_baskets_containing_product,
       CAST(coalesce(r.repeaters, 0) AS BIGINT) AS number_of_repeat_purchasing_households,
       r.repeaters / s.households AS repeat_purchase_rate
FROM catalog p
LEFT JOIN (SELECT PRODUCT_ID, sum(QUANTITY) AS units, sum(SALES_VALUE) AS sales, count(*) AS lines,
                  count(DISTINCT household_key) AS households,
                  count(DISTINCT (household_key, BASKET_ID)) AS baskets
           FROM window_tx{suffix} GROUP BY PRODUCT_ID) s USING (PRODUCT_ID)
LEFT JOIN (SELECT PRODUCT_ID, count(*) FILTER (n > 1) AS repeaters
           FROM (SELECT PRODUCT_ID, household_key, count(DISTINCT BASKET_ID) AS n
                 FROM window_tx{suffix} GROUP BY ALL) GROUP BY PRODUCT_ID) r USING (PRODUCT_ID)""")


_feature_steps("", 2406, None, None)
_feature_steps("_bounded", 2000, 90, 30)


def rounded(source: str, *names: str, digits: int = 6) -> str:
    """All columns of a step, some of them rounded."""
    changes = ", ".join(f"round({name}, {digits}) AS {name}" for name in names)
    return f"SELECT * REPLACE ({changes}) FROM {source}"


oracle("parquet_projection", "SELECT c_custkey, c_mktsegment FROM customer")
for _name, _low, _high in (("feature_window_lines", 1910, 2000), ("outcome_window_lines", 2000, 2030)):
    oracle(_name, f"""
SELECT household_key, BASKET_ID, "DAY", PRODUCT_ID, QUANTITY, CAST(SALES_VALUE AS DOUBLE) AS SALES_VALUE
FROM tx WHERE "DAY" >= {_low} AND "DAY" < {_high}""")
for _suffix in ("", "_bounded"):
    oracle(f"household_features{_suffix}", f"SELECT * FROM customer_features{_suffix}")
    oracle(f"product_features{_suffix}", f"SELECT * FROM product_features{_suffix}")
    oracle(f"campaign_household_features{_suffix}", f"SELECT * FROM campaign_households{_suffix}")
    oracle(f"campaign_features{_suffix}", f"SELECT * FROM campaign_features{_suffix}")

oracle("highest_value_customers", """
SELECT household_key, total_sales, transaction_count, average_basket_value,
       total_quantity, recency_days
FROM customer_features ORDER BY total_sales DESC, household_key LIMIT 100""")
oracle("highest_revenue_products", """
SELECT PRODUCT_ID, DEPARTMENT, BRAND, COMMODITY_DESC, total_units_sold, total_sales,
       number_of_households_purchasing, number_of_baskets_containing_product,
       repeat_purchase_rate
FROM product_features ORDER BY total_sales DESC, PRODUCT_ID LIMIT 100""")
oracle("campaign_performance", """
SELECT CAMPAIGN, campaign_type, START_DAY, END_DAY, exposed_households, coupon_redemption_count,
       redeeming_households, descriptive_redemption_rate,
       spend_before_campaign, spend_during_campaign, spend_after_campaign, campaign_window_complete,
       post_campaign_observation_complete
FROM campaign_features""")
oracle("customer_spend_by_department", """
SELECT household_key, DEPARTMENT, CAST(sum(SALES_VALUE) AS DOUBLE) AS total_sales
FROM window_tx JOIN product_features USING (PRODUCT_ID) GROUP BY ALL""")
oracle("coupon_usage_by_customer_segment", """
SELECT classification_1, count(*) AS households,
       avg(coupon_usage) AS average_coupon_discounted_baskets,
       CAST(sum(coupon_redemption_count) AS BIGINT) AS coupon_redemption_rows
FROM customer_features JOIN hh_demographic USING (household_key) GROUP BY classification_1""")

# Quality

step("order_text", """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderstatus,
       CAST(o_totalprice AS VARCHAR) AS o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority,
       CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority ELSE '  ' END AS priority_note
FROM orders""")


def _profile(column: str, numeric: bool = False, date: bool = False) -> str:
    blank = f"({column} IS NULL OR trim({column}) = '')"
    number = (f"count(*) FILTER (NOT {blank} AND TRY_CAST({column} AS DOUBLE) IS NULL)"
              if numeric else "CAST(NULL AS BIGINT)")
    day = (f"count(*) FILTER (NOT {blank} AND try_strptime({column}, '%Y-%m-%d') IS NULL)"
           if date else "CAST(NULL AS BIGINT)")
    return f"""
SELECT '{column}' AS column_name, count(*) AS row_count, count(*) FILTER ({blank}) AS null_count,
       {number} AS invalid_numeric_count, {day} AS invalid_date_count,
       count(*) FILTER ({blank}) / count(*) AS null_rate,
       count(*) FILTER ({blank}) / count(*) > 0.2 AS null_rate_violation
FROM order_text"""


oracle("column_profile", " UNION ALL ".join([
    _profile("o_orderkey", numeric=True), _profile("o_orderstatus", numeric=True, date=True),
    _profile("o_totalprice", numeric=True), _profile("o_orderdate", date=True),
    _profile("o_orderpriority", numeric=True), _profile("priority_note")]))
oracle("duplicate_documents", """
SELECT (SELECT count(*) FROM documents) - (SELECT count(*) FROM (SELECT DISTINCT text, lang FROM documents))
       AS duplicate_rows""")
oracle("repeated_line_keys", """
SELECT count(*) AS repeated_groups, CAST(coalesce(sum(n), 0) AS BIGINT) AS rows_in_groups
FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber) WHERE n > 1""")
oracle("customers_without_events", """
SELECT DISTINCT c_custkey FROM customer
WHERE c_custkey IS NOT NULL AND c_custkey NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""")


def _coverage(name: str, child: str, parent: str, match: str) -> str:
    return f"""
SELECT '{name}' AS relationship, 'evaluated' AS status, count(*) AS child_keys,
       count(*) FILTER (EXISTS (SELECT 1 FROM {parent} p WHERE {match})) AS matched_keys,
       count(*) FILTER (NOT EXISTS (SELECT 1 FROM {parent} p WHERE {match})) AS unmatched_keys
FROM (SELECT DISTINCT {child}) c"""


oracle("relationship_coverage", " UNION ALL ".join([
    _coverage("transactions to products", "PRODUCT_ID FROM tx", "catalog",
              "p.PRODUCT_ID = c.PRODUCT_ID"),
    _coverage("customers to events", "c_custkey FROM customer", "events", "p.user_id = c.c_custkey"),
    _coverage("redemptions to assignments", "household_key, CAMPAIGN FROM coupon_redempt",
              "campaign_table", "p.household_key = c.household_key AND p.CAMPAIGN = c.CAMPAIGN"),
    _coverage("customers to demographics", "c_custkey FROM customer", "hh_demographic",
              "p.household_key = c.c_custkey")]))
oracle("numeric_summary", " UNION ALL ".join(f"""
SELECT '{c}' AS column_name, count({c}) AS n, round(avg(CAST({c} AS DOUBLE)), 6) AS mean,
       round(stddev_samp(CAST({c} AS DOUBLE)), 6) AS stddev, CAST(min({c}) AS DOUBLE) AS min,
       CAST(quantile_disc({c}, 0.25) AS DOUBLE) AS p25, CAST(quantile_disc({c}, 0.5) AS DOUBLE) AS p50,
       CAST(quantile_disc({c}, 0.75) AS DOUBLE) AS p75, CAST(max({c}) AS DOUBLE) AS max
FROM part""" for c in ("p_partkey", "p_size", "p_retailprice")))
oracle("transaction_schema", " UNION ALL ".join(f"""
SELECT '{c}' AS "column", '{kind}' AS data_type, 'true' AS nullable, count(*) AS row_count,
       count(*) FILTER ("{c}" IS NULL) AS null_count
FROM tx""" for c, kind in (
    ("household_key", "bigint"), ("BASKET_ID", "bigint"), ("DAY", "int"), ("PRODUCT_ID", "bigint"),
    ("QUANTITY", "int"), ("SALES_VALUE", "decimal(18,4)"), ("STORE_ID", "bigint"),
    ("RETAIL_DISC", "decimal(18,4)"), ("COUPON_DISC", "decimal(18,4)"),
    ("COUPON_MATCH_DISC", "decimal(18,5)"), ("coupon_line", "boolean"))))
_GATE = ("total_sales", "transaction_count", "average_basket_value", "total_quantity",
         "purchase_frequency", "recency_days")
oracle("economics_gate", f"""
SELECT count(*) AS rows, count(DISTINCT household_key) AS unique_households,
       count(*) FILTER ({' OR '.join(f'{c} IS NULL' for c in _GATE)}) AS rows_with_missing_required,
       count(*) FILTER ({' OR '.join(f'NOT isfinite(CAST({c} AS DOUBLE))' for c in _GATE)}) AS nonfinite_rows,
       count(*) FILTER ({' OR '.join(f'{c} < 0' for c in _GATE)}) AS impossible_negative_rows
FROM customer_features""")
oracle("observed_redemption_day", 'SELECT max("DAY") AS max_day FROM coupon_redempt')
oracle("csv_round_trip", "SELECT * FROM catalog")
oracle("csv_inspection", """
SELECT 'assignments' AS dataset, 'DESCRIPTION' AS column_name, count(*) AS row_count,
       CAST(0 AS BIGINT) AS null_count, count(*) AS invalid_numeric_count, false AS row_count_changed
FROM campaign_table
UNION ALL SELECT 'assignments', 'household_key', count(*), 0, 0, false FROM campaign_table
UNION ALL SELECT 'assignments', 'CAMPAIGN', count(*), 0, NULL, false FROM campaign_table""")
oracle("directory_inspection", " UNION ALL ".join(f"""
SELECT '{table}=' || CAST({part} AS VARCHAR) AS dataset, '{column}' AS column_name,
       '{kind}' AS data_type, count(*) AS row_count,
       count(*) FILTER ({column} IS NULL) AS null_count,
       count(*) FILTER ({column} IS NULL) > 0.2 * count(*) AS null_rate_violation,
       {unfit} AS invalid_numeric_count,
       {f'round(avg({column}), 6)' if kind == 'int' else 'CAST(NULL AS DOUBLE)'} AS mean,
       {f'CAST(min({column}) AS DOUBLE)' if kind == 'int' else 'CAST(NULL AS DOUBLE)'} AS min,
       {f'CAST(max({column}) AS DOUBLE)' if kind == 'int' else 'CAST(NULL AS DOUBLE)'} AS max,
       CAST(0 AS BIGINT) AS malformed_rows,
       count(*) - count(DISTINCT ({row})) AS duplicate_rows
FROM {view} GROUP BY {part}""" for table, view, part, row, columns in (
    ("assignments", "(SELECT * FROM campaign_table JOIN campaign_desc USING (CAMPAIGN))", "CAMPAIGN", "DESCRIPTION, household_key, CAMPAIGN",
     (("DESCRIPTION", "string", "count(*)"), ("household_key", "int", "0"),
      ("CAMPAIGN", "int", "CAST(NULL AS BIGINT)"))),
    ("campaigns", "campaign_desc", "DESCRIPTION", "DESCRIPTION, CAMPAIGN, START_DAY, END_DAY",
     (("DESCRIPTION", "string", "count(*)"), ("CAMPAIGN", "int", "CAST(NULL AS BIGINT)"),
      ("START_DAY", "int", "CAST(NULL AS BIGINT)"), ("END_DAY", "int", "CAST(NULL AS BIGINT)"))),
    ("demographics", "hh_demographic", "classification_1", "classification_1, household_key",
     (("classification_1", "string", "CAST(NULL AS BIGINT)"), ("household_key", "int", "0"))))
    for column, kind, unfit in columns))

# Training set

step("starts", """
SELECT START_DAY, row_number() OVER (ORDER BY START_DAY) AS place, count(*) OVER () AS n
FROM (SELECT DISTINCT START_DAY FROM campaign_desc)""")
step("cuts", """
SELECT greatest(1, floor(n * CAST(0.6 AS DOUBLE))) AS train_end,
       least(greatest(greatest(1, floor(n * CAST(0.6 AS DOUBLE))) + 1, floor(n * CAST(0.8 AS DOUBLE))), n - 1)
       AS validation_end
FROM starts LIMIT 1""")
step("splits", """
SELECT d.CAMPAIGN, d.DESCRIPTION, d.START_DAY, d.END_DAY,
       CASE WHEN d.END_DAY <= (SELECT max("DAY") FROM coupon_redempt) THEN
         CASE WHEN s.place <= train_end
              THEN CASE WHEN d.END_DAY < (SELECT min(START_DAY) FROM starts WHERE place > train_end)
                        THEN 'train' END
              WHEN s.place <= validation_end
              THEN CASE WHEN d.END_DAY < (SELECT min(START_DAY) FROM starts WHERE place > validation_end)
                        THEN 'validation' END
              ELSE 'test' END END AS data_split
FROM campaign_desc d JOIN starts s USING (START_DAY), cuts""")
step("spine", """
SELECT a.household_key, s.* FROM campaign_table a JOIN splits s USING (CAMPAIGN)""")
step("history", """
SELECT s.household_key, s.CAMPAIGN, s.START_DAY, x.* EXCLUDE (household_key), c.DEPARTMENT
FROM spine s JOIN tx x ON x.household_key = s.household_key
  AND x."DAY" < s.START_DAY AND x."DAY" >= s.START_DAY - 90
LEFT JOIN catalog c ON c.PRODUCT_ID = x.PRODUCT_ID""")
step("dataset", """
SELECT s.household_key, s.CAMPAIGN, s.DESCRIPTION, s.START_DAY, s.END_DAY, s.data_split,
       CAST(h.sales AS DOUBLE) AS historical_total_sales, h.baskets AS historical_basket_count,
       CAST(h.quantity AS BIGINT) AS historical_total_quantity,
       h.products AS historical_unique_products, h.departments AS historical_unique_departments,
       CAST(h.retail AS DOUBLE) AS historical_retail_discount,
       CAST(h.coupon AS DOUBLE) AS historical_coupon_discount,
       b.average AS historical_average_basket_value,
       CAST(b.couponed AS BIGINT) AS historical_coupon_basket_count,
       h.baskets / 90 AS historical_purchase_frequency,
       s.START_DAY - h.last_day AS historical_recency_days,
       coalesce(r.n, 0) AS prior_coupon_redemption_count,
       coalesce(e.n, 0) AS prior_campaign_exposure_count,
       coalesce(q.n, 0) AS prior_campaign_redemption_count,
       CAST(CASE WHEN t.n > 0 THEN 1 ELSE 0 END AS INTEGER) AS target_redeemed
FROM spine s
JOIN (SELECT household_key, CAMPAIGN, sum(SALES_VALUE) AS sales, count(DISTINCT BASKET_ID) AS baskets,
             sum(QUANTITY) AS quantity, count(DISTINCT PRODUCT_ID) AS products,
             count(DISTINCT DEPARTMENT) AS departments, sum(RETAIL_DISC) AS retail,
             sum(COUPON_DISC) + sum(COUPON_MATCH_DISC) AS coupon, max("DAY") AS last_day
      FROM history GROUP BY ALL) h USING (household_key, CAMPAIGN)
JOIN (SELECT household_key, CAMPAIGN, CAST(sum(s) AS DOUBLE) / count(s) AS average, sum(c) AS couponed
      FROM (SELECT household_key, CAMPAIGN, BASKET_ID, sum(SALES_VALUE) AS s,
                   max(CASE WHEN COUPON_DISC <> 0 OR COUPON_MATCH_DISC <> 0 THEN 1 ELSE 0 END) AS c
            FROM history GROUP BY ALL) GROUP BY household_key, CAMPAIGN) b USING (household_key, CAMPAIGN)
LEFT JOIN (SELECT s.household_key, s.CAMPAIGN, count(*) AS n
           FROM spine s JOIN coupon_redempt r ON r.household_key = s.household_key
             AND r."DAY" < s.START_DAY AND r."DAY" >= s.START_DAY - 90 GROUP BY ALL) r
  USING (household_key, CAMPAIGN)
LEFT JOIN (SELECT cur.household_key, cur.CAMPAIGN, count(*) AS n
           FROM spine cur JOIN spine old ON old.household_key = cur.household_key
             AND old.START_DAY < cur.START_DAY AND old.START_DAY >= cur.START_DAY - 90 GROUP BY ALL) e
  USING (household_key, CAMPAIGN)
LEFT JOIN (SELECT cur.household_key, cur.CAMPAIGN, count(*) AS n
           FROM spine cur JOIN spine old ON old.household_key = cur.household_key
             AND old.START_DAY < cur.START_DAY AND old.START_DAY >= cur.START_DAY - 90
           JOIN coupon_redempt r ON r.household_key = cur.household_key AND r.CAMPAIGN = old.CAMPAIGN
             AND r."DAY" < cur.START_DAY AND r."DAY" >= cur.START_DAY - 90 GROUP BY ALL) q
  USING (household_key, CAMPAIGN)
LEFT JOIN (SELECT s.household_key, s.CAMPAIGN, count(*) AS n
           FROM spine s JOIN coupon_redempt r ON r.household_key = s.household_key
             AND r.CAMPAIGN = s.CAMPAIGN AND r."DAY" BETWEEN s.START_DAY AND s.END_DAY GROUP BY ALL) t
  USING (household_key, CAMPAIGN)
WHERE s.data_split IS NOT NULL""")

oracle("campaign_splits", "SELECT * FROM splits")
oracle("exposure_spine", "SELECT * FROM spine")
oracle("response_dataset", "SELECT * FROM dataset")
oracle("split_summary", """
SELECT data_split, count(*) AS rows, CAST(sum(target_redeemed) AS BIGINT) AS positives
FROM dataset GROUP BY data_split""")
oracle("json_report_round_trip", """
SELECT data_split, count(*) AS rows, CAST(sum(target_redeemed) AS BIGINT) AS positives
FROM dataset GROUP BY data_split""")
oracle("parquet_round_trip", """
SELECT household_key, CAMPAIGN, historical_total_sales, target_redeemed FROM dataset
WHERE data_split = 'test'""")
oracle("split_population", """
SELECT data_split, count(*) AS observations, count(DISTINCT CAMPAIGN) AS campaigns,
       min(START_DAY) AS first_start_day, max(START_DAY) AS last_start_day,
       avg(target_redeemed) AS actual_positive_rate
FROM dataset GROUP BY data_split""")

# Scores of the frozen network

step("statistics", " UNION ALL ".join(f"""
SELECT {i} AS place, '{f}' AS feature, coalesce(avg(CAST({f} AS DOUBLE)), 0) AS mean,
       coalesce(nullif(stddev_pop(CAST({f} AS DOUBLE)), 0), 1) AS std
FROM dataset WHERE data_split = 'train'""" for i, f in enumerate(RESPONSE_FEATURES)))
step("parameters", "SELECT " + ", ".join(
    f"max(mean) FILTER (place = {i}) AS m{i}, max(std) FILTER (place = {i}) AS s{i}"
    for i in range(len(RESPONSE_FEATURES))) + " FROM statistics")
step("standardized", "SELECT household_key, CAMPAIGN, START_DAY, data_split, target_redeemed, "
     "prior_coupon_redemption_count, " + ", ".join(
         f"(CAST({f} AS DOUBLE) - m{i}) / s{i} AS z{i}" for i, f in enumerate(RESPONSE_FEATURES))
     + " FROM dataset, parameters")


def _logit(inputs: list[str]) -> str:
    n = FROZEN_NETWORK
    units = [f"greatest(0, {b}" + "".join(f" + {w} * {x}" for w, x in zip(row, inputs)) + ")"
             for row, b in zip(n.hidden_weights, n.hidden_bias)]
    return f"{n.output_bias}" + "".join(f" + {w} * {u}" for w, u in zip(n.output_weights, units))


_INPUTS = [f"z{i}" for i in range(len(RESPONSE_FEATURES))]
_CALIBRATED = (f"1 / (1 + exp(-greatest(-80, least(80, {FROZEN_CALIBRATOR.slope} * logit "
               f"+ {FROZEN_CALIBRATOR.intercept}))))")
step("logits", f"SELECT *, CAST({_logit(_INPUTS)} AS DOUBLE) AS logit FROM standardized")
step("scores", f"""
SELECT household_key, CAMPAIGN, START_DAY, data_split, target_redeemed,
       prior_coupon_redemption_count, round(logit, 6) AS logit,
       round(1 / (1 + exp(-logit)), 6) AS raw_probability,
       round({_CALIBRATED}, 6) AS calibrated_response_probability
FROM logits""")
step("train_rate", "SELECT avg(target_redeemed) AS rate FROM dataset WHERE data_split = 'train'")
step("long_model", """
SELECT data_split, 'raw' AS score_kind, raw_probability AS score, target_redeemed AS y FROM scores
UNION ALL SELECT data_split, 'calibrated', calibrated_response_probability, target_redeemed FROM scores""")
step("long_baseline", """
SELECT data_split, 'majority_class' AS score_kind,
       CAST(CASE WHEN (SELECT rate FROM train_rate) >= 0.5 THEN 1 ELSE 0 END AS DOUBLE) AS score,
       target_redeemed AS y FROM dataset
UNION ALL SELECT data_split, 'constant_training_rate', (SELECT rate FROM train_rate), target_redeemed FROM dataset
UNION ALL SELECT data_split, 'prior_coupon_redemption_indicator',
       CAST(CASE WHEN prior_coupon_redemption_count > 0 THEN 1 ELSE 0 END AS DOUBLE), target_redeemed
FROM dataset""")


def _metric_steps(name: str, source: str, keys: str, threshold: float) -> None:
    """Ranking by comparing every positive with every negative, metrics by definition."""
    step(f"{name}_groups", f"""
SELECT {keys}, score, count(*) AS n, sum(y) AS pos, count(*) - sum(y) AS neg FROM {source}
GROUP BY {keys}, score""")
    step(f"{name}_auc", f"""
SELECT {keys}, sum(p.pos * q.neg * CASE WHEN p.score > q.score THEN 1.0
                                        WHEN p.score = q.score THEN 0.5 ELSE 0.0 END)
               / (sum(p.pos * q.neg)) AS roc_auc
FROM {name}_groups p JOIN {name}_groups q USING ({keys}) GROUP BY {keys}""")
    step(f"{name}_ap", f"""
SELECT {keys}, sum(pos * seen_pos / seen_n) / sum(pos) AS pr_auc_average_precision
FROM (SELECT {keys}, pos, CAST(sum(pos) OVER w AS DOUBLE) AS seen_pos, sum(n) OVER w AS seen_n
      FROM {name}_groups WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC)) GROUP BY {keys}""")
    step(f"{name}_counts", f"""
SELECT {keys}, count(*) AS observations, CAST({threshold} AS DOUBLE) AS threshold,
       count(*) FILTER (score < {threshold} AND y = 0) AS true_negative,
       count(*) FILTER (score >= {threshold} AND y = 0) AS false_positive,
       count(*) FILTER (score < {threshold} AND y = 1) AS false_negative,
       count(*) FILTER (score >= {threshold} AND y = 1) AS true_positive,
       avg(CASE WHEN score >= {threshold} THEN 1.0 ELSE 0.0 END) AS positive_prediction_rate,
       avg(score) AS mean_predicted_probability, avg(y) AS actual_positive_rate,
       avg((score - y) ** 2) AS brier_score,
       avg(-(y * ln(greatest(1e-12, least(1 - 1e-12, score)))
             + (1 - y) * ln(1 - greatest(1e-12, least(1 - 1e-12, score))))) AS log_loss
FROM {source} GROUP BY {keys}""")
    step(f"{name}_rates", f"""
SELECT *, (true_positive + true_negative) / observations AS accuracy,
       coalesce(true_positive / nullif(true_positive + false_positive, 0), 0) AS precision,
       coalesce(true_positive / nullif(true_positive + false_negative, 0), 0) AS recall,
       coalesce(2 * true_positive / nullif(2 * true_positive + false_positive + false_negative, 0), 0) AS f1
FROM {name}_counts""")
    step(f"{name}_bins", f"""
SELECT g.*, b.bin, CAST(b.bin * 0.1 AS DOUBLE) AS lower_inclusive,
       CAST((b.bin + 1) * 0.1 AS DOUBLE) AS upper_bound, b.bin = 9 AS upper_inclusive,
       count(s.score) AS count, avg(s.score) AS mean_predicted_probability,
       avg(s.y) AS observed_redemption_rate
FROM (SELECT DISTINCT {keys} FROM {source}) g
CROSS JOIN (SELECT CAST(unnest(range(10)) AS INTEGER) AS bin) b
LEFT JOIN {source} s ON {' AND '.join(f'g.{k.strip()} = s.{k.strip()}' for k in keys.split(','))}
  AND s.score >= b.bin * CAST(0.1 AS DOUBLE)
  AND (s.score < (b.bin + 1) * CAST(0.1 AS DOUBLE) OR b.bin = 9)
GROUP BY ALL""")
    step(f"{name}_report", f"""
SELECT r.*, a.roc_auc, p.pr_auc_average_precision, e.expected_calibration_error
FROM {name}_rates r JOIN {name}_auc a USING ({keys}) JOIN {name}_ap p USING ({keys})
JOIN (SELECT {keys}, sum(count * abs(mean_predicted_probability - observed_redemption_rate))
             / sum(count) AS expected_calibration_error FROM {name}_bins GROUP BY {keys}) e USING ({keys})""")


_metric_steps("model", "long_model", "data_split, score_kind", 0.5)
_metric_steps("quarter", "long_model", "data_split, score_kind", 0.25)
_metric_steps("base", "long_baseline", "data_split, score_kind", 0.5)

_REPORT = ("roc_auc", "pr_auc_average_precision", "accuracy", "precision", "recall", "f1",
           "brier_score", "log_loss", "expected_calibration_error")
_REPORT_SQL = ", ".join(f"round({m}, 6) AS {m}" for m in _REPORT)

oracle("feature_statistics", """
SELECT feature, round(mean, 4) AS mean, round(std, 4) AS std FROM statistics""")
oracle("class_balance", """
SELECT count(*) FILTER (target_redeemed = 1) AS positives,
       count(*) FILTER (target_redeemed = 0) AS negatives,
       count(*) FILTER (target_redeemed = 0) / count(*) FILTER (target_redeemed = 1) AS positive_weight
FROM dataset WHERE data_split = 'train'""")
oracle("standardized_features", "SELECT household_key, CAMPAIGN, " + ", ".join(
    f"round(z{i}, 6) AS {f}" for i, f in enumerate(RESPONSE_FEATURES)) + " FROM standardized")
oracle("frozen_network_scores", """
SELECT household_key, CAMPAIGN, data_split, logit, raw_probability, calibrated_response_probability
FROM scores""")
oracle("ranking_metrics", """
SELECT data_split, score_kind, round(roc_auc, 6) AS roc_auc,
       round(pr_auc_average_precision, 6) AS pr_auc_average_precision
FROM model_auc JOIN model_ap USING (data_split, score_kind)""")
oracle("threshold_metrics", """
SELECT data_split, score_kind, observations, threshold, round(accuracy, 6) AS accuracy,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       true_negative, false_positive, false_negative, true_positive,
       round(positive_prediction_rate, 6) AS positive_prediction_rate,
       round(mean_predicted_probability, 6) AS mean_predicted_probability,
       round(actual_positive_rate, 6) AS actual_positive_rate, round(brier_score, 6) AS brier_score,
       round(log_loss, 6) AS log_loss
FROM quarter_rates""")
oracle("reliability_bins", rounded(
    "model_bins", "lower_inclusive", "upper_bound", "mean_predicted_probability",
    "observed_redemption_rate", digits=10))
oracle("model_report", f"SELECT data_split, score_kind, observations, {_REPORT_SQL} FROM model_report")
oracle("baseline_report", f"SELECT data_split, score_kind, observations, {_REPORT_SQL} FROM base_report")
oracle("model_metrics", f"""
SELECT data_split, score_kind, observations, {_REPORT_SQL},
       CASE score_kind WHEN 'calibrated' THEN 'platt_scaling' END AS calibration_method,
       CASE score_kind WHEN 'calibrated' THEN 'validation' END AS calibration_split
FROM model_report WHERE data_split <> 'train' OR score_kind = 'raw'
UNION ALL
SELECT data_split, score_kind, observations, {_REPORT_SQL}, NULL, NULL
FROM base_report WHERE data_split = 'test'""")
_TABLE_SQL = ", ".join(f"round({m}, 6) AS {m}" for m in _REPORT[:-1])
oracle("metric_comparison", f"""
SELECT data_split, score_kind, {_TABLE_SQL} FROM model_report
UNION ALL SELECT data_split, score_kind, {_TABLE_SQL} FROM base_report WHERE data_split = 'test'""")
oracle("ranking_change", """
SELECT data_split, round(c.roc_auc - r.roc_auc, 6) AS roc_auc_delta,
       round(c.pr_auc_average_precision - r.pr_auc_average_precision, 6) AS pr_auc_average_precision_delta
FROM (SELECT * FROM model_report WHERE score_kind = 'calibrated') c
JOIN (SELECT * FROM model_report WHERE score_kind = 'raw') r USING (data_split)""")

# Fitted models, by what their maximum must satisfy

step("training_weight", """
SELECT CAST(count(*) FILTER (target_redeemed = 0) AS DOUBLE) / count(*) FILTER (target_redeemed = 1) AS w
FROM dataset WHERE data_split = 'train'""")
oracle("fitted_logistic_report", "SELECT 'constant' AS feature, round(sum(w * target_redeemed), 1) "
       "AS weighted_sum FROM standardized, training_weight WHERE data_split = 'train'" + "".join(f"""
UNION ALL SELECT '{f}', round(sum(w * target_redeemed * z{i}), 1)
FROM standardized, training_weight WHERE data_split = 'train'""" for i, f in enumerate(RESPONSE_FEATURES)))
oracle("fitted_perceptron_report", """
SELECT data_split, score_kind, count(*) AS rows, CAST(sum(target_redeemed) AS BIGINT) AS positives,
       true AS probabilities, CASE WHEN data_split = 'train' AND score_kind = 'raw' THEN true END AS better_than_chance
FROM dataset, (SELECT unnest(['raw', 'calibrated']) AS score_kind) GROUP BY 1, 2""")
oracle("fitted_network_report", """
SELECT data_split, score_kind, count(*) AS rows, CAST(sum(target_redeemed) AS BIGINT) AS positives,
       true AS probabilities, true AS least_validation_loss,
       CASE WHEN data_split <> 'test' AND score_kind = 'plain' THEN true END AS beats_baselines
FROM dataset, (SELECT unnest(['plain', 'weighted']) AS score_kind) GROUP BY 1, 2""")
oracle("platt_calibrator", """
SELECT 'platt_scaling' AS method, count(*) AS fit_rows,
       CAST(sum(target_redeemed) AS BIGINT) AS fit_positive_rows,
       round(CAST(sum(target_redeemed) AS DOUBLE), 3) AS fitted_positives,
       round(sum(target_redeemed * logit), 3) AS fitted_logits
FROM scores WHERE data_split = 'validation'""")
oracle("sample_records", """
SELECT CAST(PRODUCT_ID AS VARCHAR) AS PRODUCT_ID, DEPARTMENT, BRAND, COMMODITY_DESC, CURR_SIZE_OF_PRODUCT
FROM catalog ORDER BY catalog.PRODUCT_ID LIMIT 5""")

# Permutation sensitivity: rows in digest order take the next row's value

step("ring", f"""
SELECT r.repeat, v.*, row_number() OVER w AS place, count(*) OVER (PARTITION BY r.repeat) AS n
FROM (SELECT * FROM standardized WHERE data_split = 'validation') v
CROSS JOIN (SELECT unnest(generate_series(1, 10)) AS repeat) r
WINDOW w AS (PARTITION BY r.repeat ORDER BY
             md5('20260929:' || r.repeat || ':' || v.household_key || ':' || v.CAMPAIGN))""")
step("permuted", " UNION ALL ".join(f"""
SELECT '{f}' AS feature, a.repeat, a.target_redeemed AS y,
       round(1 / (1 + exp(-({_logit([f'b.z{k}' if k == i else f'a.z{k}' for k in range(len(RESPONSE_FEATURES))])}))), 6) AS score
FROM ring a JOIN ring b ON a.repeat = b.repeat AND b.place = a.place % a.n + 1"""
    for i, f in enumerate(RESPONSE_FEATURES)))
step("plain", """
SELECT 'none' AS feature, 0 AS repeat, target_redeemed AS y, round(1 / (1 + exp(-logit)), 6) AS score
FROM logits WHERE data_split = 'validation'""")
step("trials", "SELECT * FROM permuted UNION ALL SELECT * FROM plain")
_metric_steps("trial", "trials", "feature, repeat", 0.5)
step("trial_loss", """
SELECT feature, repeat, avg(-(y * ln(greatest(1e-7, least(1 - 1e-7, score)))
       + (1 - y) * ln(1 - greatest(1e-7, least(1 - 1e-7, score))))) AS loss
FROM trials GROUP BY feature, repeat""")
oracle("permutation_importance", """
SELECT t.feature, round(avg(b.ap - t.ap), 6) AS mean_average_precision_decrease,
       round(stddev_pop(b.ap - t.ap), 6) AS std_average_precision_decrease,
       round(avg(t.loss - b.loss), 6) AS mean_log_loss_increase
FROM (SELECT feature, pr_auc_average_precision AS ap, loss FROM trial_ap
      JOIN trial_loss USING (feature, repeat) WHERE feature <> 'none') t,
     (SELECT pr_auc_average_precision AS ap, loss FROM trial_ap
      JOIN trial_loss USING (feature, repeat) WHERE feature = 'none') b
GROUP BY t.feature""")

# Economics

_MONTHS = "(2405 / CAST(30.436875 AS DOUBLE))"
_RATE = "(pow(CAST(1.1 AS DOUBLE), CAST(1 AS DOUBLE) / 12) - 1)"


def _annuity(retention: str, annual: str, months: int) -> str:
    return (f"list_sum([pow(CAST({retention} AS DOUBLE), t - 1) / "
            f"pow(pow(1 + CAST({annual} AS DOUBLE), CAST(1 AS DOUBLE) / 12), t) "
            f"for t in range(1, {months + 1})])")


step("economics", f"""
SELECT *, total_sales AS historical_revenue, transaction_count AS basket_count,
       total_quantity AS historical_quantity, {_MONTHS} AS observed_history_months,
       CAST(0.25 AS DOUBLE) AS assumed_contribution_margin, {_RATE} AS monthly_discount_rate,
       total_sales / {_MONTHS} AS estimated_monthly_revenue,
       total_sales / {_MONTHS} * CAST(0.25 AS DOUBLE) AS estimated_monthly_contribution,
       total_sales / {_MONTHS} * CAST(0.25 AS DOUBLE) * {_annuity('0.9', '0.1', 12)} AS modeled_12_month_clv,
       total_sales / {_MONTHS} * CAST(0.25 AS DOUBLE) * {_annuity('0.9', '0.1', 24)} AS modeled_24_month_clv
FROM customer_features""")
step("offers", """
SELECT s.household_key, s.CAMPAIGN, s.START_DAY, s.calibrated_response_probability,
       e.average_basket_value, e.modeled_12_month_clv, CAST(5 AS DOUBLE) AS assumed_offer_cost,
       e.average_basket_value * CAST(0.25 AS DOUBLE) AS expected_contribution_if_response,
       s.calibrated_response_probability * (e.average_basket_value * CAST(0.25 AS DOUBLE)) AS break_even_offer_cost,
       s.calibrated_response_probability * (e.average_basket_value * CAST(0.25 AS DOUBLE)) - 5 AS modeled_expected_offer_value
FROM scores s JOIN economics e USING (household_key) WHERE s.data_split = 'test'""")

oracle("customer_economics", """
SELECT household_key, historical_revenue, basket_count, historical_quantity,
       round(observed_history_months, 6) AS observed_history_months, assumed_contribution_margin,
       round(monthly_discount_rate, 6) AS monthly_discount_rate,
       round(estimated_monthly_revenue, 6) AS estimated_monthly_revenue,
       round(estimated_monthly_contribution, 6) AS estimated_monthly_contribution,
       round(modeled_12_month_clv, 6) AS modeled_12_month_clv,
       round(modeled_24_month_clv, 6) AS modeled_24_month_clv
FROM economics""")
oracle("offer_economics", rounded("offers", "modeled_12_month_clv"))
oracle("household_npv", f"""
SELECT household_key, round(sum(sales * CAST(0.25 AS DOUBLE) / pow(1 + {_RATE}, month)) - 5, 4) AS npv,
       round(sum(sales * CAST(0.25 AS DOUBLE) / pow(1 + {_RATE}, month)) - 5, 4) AS npv_of_array
FROM (SELECT household_key, ("DAY" - 1) // 30 + 1 AS month, CAST(sum(SALES_VALUE) AS DOUBLE) AS sales
      FROM tx GROUP BY ALL) GROUP BY household_key""")
oracle("clv_summary", "SELECT " + ", ".join(
    f"round({fn}, 6) AS {name}_{h}" for h in (12, 24) for name, fn in (
        ("mean", f"avg(modeled_{h}_month_clv)"), ("median", f"quantile_disc(modeled_{h}_month_clv, 0.5)"),
        ("min", f"min(modeled_{h}_month_clv)"), ("max", f"max(modeled_{h}_month_clv)")))
    + ", count(modeled_12_month_clv) AS usable_households FROM economics")
oracle("offer_summary", """
SELECT round(avg(calibrated_response_probability), 6) AS mean_probability,
       round(quantile_disc(calibrated_response_probability, 0.5), 6) AS median_probability,
       round(avg(modeled_expected_offer_value), 6) AS mean_expected_value,
       round(quantile_disc(modeled_expected_offer_value, 0.5), 6) AS median_expected_value,
       count(*) FILTER (modeled_expected_offer_value > 0) AS above_zero,
       count(*) FILTER (modeled_expected_offer_value < 0) AS below_zero,
       round(avg(break_even_offer_cost), 6) AS mean_break_even_offer_cost
FROM offers""")
step("median_revenue", f"""
SELECT quantile_disc(historical_revenue, 0.5) / {_MONTHS} AS revenue FROM economics""")
step("cases", """
SELECT 'contribution_margin' AS varied_assumption, CAST(unnest([0.15, 0.25, 0.35]) AS DOUBLE) AS value
UNION ALL SELECT 'monthly_retention_rate', CAST(unnest([0.8, 0.9, 0.95]) AS DOUBLE)
UNION ALL SELECT 'annual_discount_rate', CAST(unnest([0.05, 0.1, 0.15]) AS DOUBLE)""")
step("settled", """
SELECT *, CASE WHEN varied_assumption = 'contribution_margin' THEN value ELSE 0.25 END AS m,
       CASE WHEN varied_assumption = 'monthly_retention_rate' THEN value ELSE 0.9 END AS r,
       CASE WHEN varied_assumption = 'annual_discount_rate' THEN value ELSE 0.1 END AS d
FROM cases""")
oracle("one_factor_sensitivity", f"""
SELECT varied_assumption, value, round(revenue * m * {_annuity('r', 'd', 12)}, 6)
       AS median_modeled_12_month_clv
FROM settled, median_revenue""")
oracle("full_sensitivity", f"""
SELECT contribution_margin, monthly_retention_rate, annual_discount_rate, offer_cost,
       round(revenue * contribution_margin
             * {_annuity('monthly_retention_rate', 'annual_discount_rate', 12)}, 6)
       AS median_modeled_12_month_clv,
       round(unit * contribution_margin - offer_cost, 6) AS mean_modeled_expected_offer_value
FROM (SELECT CAST(unnest([0.15, 0.25, 0.35]) AS DOUBLE) AS contribution_margin),
     (SELECT CAST(unnest([0.8, 0.9, 0.95]) AS DOUBLE) AS monthly_retention_rate),
     (SELECT CAST(unnest([0.05, 0.1, 0.15]) AS DOUBLE) AS annual_discount_rate),
     (SELECT CAST(unnest([2.5, 5.0, 7.5]) AS DOUBLE) AS offer_cost), median_revenue,
     (SELECT avg(calibrated_response_probability * average_basket_value) AS unit FROM offers)""")
oracle("range_violations", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) AS row_count, "
    f"count(*) FILTER ({c} IS NULL OR NOT isfinite({c}) OR {c} < 0{extra}) AS violations FROM {t}"
    for t, c, extra in (
        ("offers", "calibrated_response_probability", " OR calibrated_response_probability > 1"),
        ("economics", "modeled_12_month_clv", ""), ("economics", "modeled_24_month_clv", ""))))


def _key_rule(name: str, table: str, keys: str) -> str:
    return (f"SELECT '{name}: key is present and unique' AS rule, count(*) AS violations FROM "
            f"(SELECT count(*) AS n, bool_or({' OR '.join(f'{k.strip()} IS NULL' for k in keys.split(','))}) "
            f"AS gap FROM {table} GROUP BY {keys}) WHERE n > 1 OR gap")


def _reference_rule(rule: str, table: str, key: str, parent: str) -> str:
    return (f"SELECT '{rule}' AS rule, count(DISTINCT {key}) AS violations FROM {table} "
            f"WHERE {key} IS NOT NULL AND {key} NOT IN (SELECT {key} FROM {parent})")


oracle("contract_violations", " UNION ALL ".join([
    _key_rule("customers", "customer_features", "household_key"),
    _key_rule("products", "product_features", "PRODUCT_ID"),
    _key_rule("campaigns", "campaign_features", "CAMPAIGN"),
    _key_rule("campaign_households", "campaign_households", "household_key, CAMPAIGN"),
    _key_rule("customer_economics", "economics", "household_key"),
    _key_rule("offers", "offers", "household_key, CAMPAIGN"),
    _reference_rule("campaign_households: campaign exists", "campaign_households", "CAMPAIGN", "campaign_features"),
    _reference_rule("offers: campaign exists", "offers", "CAMPAIGN", "campaign_features"),
    _reference_rule("model_rows: campaign exists", "dataset", "CAMPAIGN", "campaign_features"),
    _reference_rule("offers: household exists", "offers", "household_key", "customer_features"),
    "SELECT 'customers: not empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM customer_features",
    "SELECT 'campaigns: not empty', CASE WHEN count(*) = 0 THEN 1 ELSE 0 END FROM campaign_features",
    *[f"SELECT '{c}: within range', count(*) FROM {t} WHERE {c} IS NULL OR NOT isfinite({c}) OR {c} < 0{extra}"
      for t, c, extra in (
          ("offers", "calibrated_response_probability", " OR calibrated_response_probability > 1"),
          ("economics", "modeled_12_month_clv", ""), ("economics", "modeled_24_month_clv", ""))]]))

# Marts

step("covered", """
SELECT * FROM campaign_features WHERE END_DAY <= (SELECT max("DAY") FROM coupon_redempt)""")
oracle("headline_figures", """
SELECT c.*, e.*, r.*, o.* FROM
  (SELECT count(*) AS households, round(sum(total_sales), 2) AS historical_sales,
          CAST(sum(transaction_count) AS BIGINT) AS observed_baskets,
          round(avg(average_basket_value), 6) AS mean_basket_value FROM customer_features) c,
  (SELECT round(avg(modeled_12_month_clv), 6) AS mean_12_month_clv,
          round(quantile_cont(modeled_12_month_clv, 0.5), 6) AS median_12_month_clv FROM economics) e,
  (SELECT round(sum(redeeming_households) / sum(exposed_households), 6) AS pooled_redemption_rate FROM covered) r,
  (SELECT round(avg(calibrated_response_probability), 6) AS mean_response_probability,
          round(avg(modeled_expected_offer_value), 6) AS mean_offer_value FROM offers) o""")
for _name, _table, _column, _bins in (
        ("clv_histogram", "economics", "modeled_12_month_clv", 40),
        ("probability_histogram", "offers", "calibrated_response_probability", 30),
        ("offer_value_histogram", "offers", "modeled_expected_offer_value", 35)):
    oracle(_name, f"""
SELECT b.bin, round(low + b.bin * ((high - low) / {_bins}), 4) AS lower_bound,
       round(low + (b.bin + 1) * ((high - low) / {_bins}), 4) AS upper_bound,
       count(*) FILTER (v.bin = b.bin) AS rows
FROM (SELECT CAST(unnest(generate_series(0, {_bins - 1})) AS INTEGER) AS bin) b,
     (SELECT v, CAST(least({_bins - 1}, floor((v - low) / (high - low) * {_bins})) AS INTEGER) AS bin, low, high
      FROM (SELECT round({_column}, 6) AS v, min(round({_column}, 6)) OVER () AS low,
                   max(round({_column}, 6)) OVER () AS high FROM {_table})) v
GROUP BY b.bin, low, high""")
oracle("top_products", """
SELECT PRODUCT_ID, DEPARTMENT, total_sales FROM product_features
ORDER BY total_sales DESC, PRODUCT_ID LIMIT 10""")
step("offer_lists", """
SELECT household_key, count(*) AS n,
       string_agg(CAST(CAMPAIGN AS VARCHAR), ',' ORDER BY START_DAY, CAMPAIGN) AS listed
FROM offers GROUP BY household_key""")
oracle("customer_profiles", """
SELECT c.household_key, c.total_sales, c.transaction_count, c.recency_days,
       d.household_key IS NOT NULL AS has_demographics, d.classification_1,
       round(e.modeled_12_month_clv, 6) AS modeled_12_month_clv,
       round(e.modeled_24_month_clv, 6) AS modeled_24_month_clv,
       CAST(coalesce(o.n, 0) AS INTEGER) AS scored_campaigns, o.listed AS campaigns_in_order
FROM customer_features c LEFT JOIN hh_demographic d USING (household_key)
LEFT JOIN economics e USING (household_key) LEFT JOIN offer_lists o USING (household_key)""")
oracle("campaign_totals_by_type", """
SELECT campaign_type, count(*) AS campaigns, CAST(sum(exposed_households) AS BIGINT) AS exposed_households,
       CAST(sum(redeeming_households) AS BIGINT) AS redeeming_households,
       sum(redeeming_households) / sum(exposed_households) AS pooled_redemption_rate
FROM covered GROUP BY campaign_type""")
oracle("spend_by_period", """
SELECT CAMPAIGN, campaign_type, 'Spend Before' AS campaign_period, spend_before_campaign AS summed_spend
FROM campaign_features
UNION ALL SELECT CAMPAIGN, campaign_type, 'Spend During', spend_during_campaign FROM campaign_features
UNION ALL SELECT CAMPAIGN, campaign_type, 'Spend After', spend_after_campaign FROM campaign_features""")
oracle("offers_by_campaign", """
SELECT CAMPAIGN, round(avg(calibrated_response_probability), 6) AS mean_response_probability,
       round(avg(modeled_expected_offer_value), 6) AS mean_modeled_offer_value, count(*) AS scored_rows
FROM offers GROUP BY CAMPAIGN""")
step("segments", """
SELECT household_key, v AS modeled_12_month_clv,
       CASE WHEN place / n <= CAST(1 AS DOUBLE) / 3 THEN 'Lower modeled CLV'
            WHEN place / n <= CAST(2 AS DOUBLE) / 3 THEN 'Middle modeled CLV'
            ELSE 'Higher modeled CLV' END AS value_segment
FROM (SELECT household_key, v, row_number() OVER (ORDER BY v, household_key) AS place, count(*) OVER () AS n
      FROM (SELECT household_key, round(modeled_12_month_clv, 6) AS v FROM economics))""")
oracle("value_segments", "SELECT * FROM segments")
oracle("segment_statistics", """
SELECT value_segment, count(*) AS households, round(min(modeled_12_month_clv), 4) AS smallest,
       round(quantile_cont(modeled_12_month_clv, 0.25), 4) AS lower_quartile,
       round(quantile_cont(modeled_12_month_clv, 0.5), 4) AS median,
       round(quantile_cont(modeled_12_month_clv, 0.75), 4) AS upper_quartile,
       round(max(modeled_12_month_clv), 4) AS largest
FROM segments GROUP BY value_segment""")
oracle("offer_slice", """
SELECT count(*) AS scored_rows, count(DISTINCT household_key) AS unique_households,
       round(avg(calibrated_response_probability), 6) AS mean_response_probability,
       count(*) FILTER (modeled_expected_offer_value > 0) AS above_zero,
       count(*) FILTER (modeled_expected_offer_value < 0) AS below_zero,
       count(*) FILTER (modeled_expected_offer_value > 0) / count(*) AS share_above_zero,
       count(*) FILTER (modeled_expected_offer_value < 0) / count(*) AS share_below_zero
FROM offers""")
oracle("described_offers", """
SELECT o.household_key, o.CAMPAIGN, c.campaign_type, o.START_DAY, c.END_DAY,
       o.calibrated_response_probability, o.break_even_offer_cost
FROM offers o JOIN campaign_features c USING (CAMPAIGN)""")
oracle("campaign_types", "SELECT DISTINCT campaign_type FROM campaign_features")

# Lookups

oracle("customer_lookup", """
SELECT p.p_partkey AS household_key,
       CASE WHEN c.household_key IS NULL THEN 'unavailable' ELSE 'found' END AS status,
       c.total_sales, c.transaction_count, round(e.modeled_12_month_clv, 6) AS modeled_12_month_clv,
       o.listed AS campaigns_in_order
FROM part p LEFT JOIN customer_features c ON c.household_key = p.p_partkey
LEFT JOIN economics e ON e.household_key = p.p_partkey
LEFT JOIN offer_lists o ON o.household_key = p.p_partkey""")
oracle("campaign_lookup", """
SELECT s.s_suppkey AS CAMPAIGN, c.campaign_type, c.START_DAY, c.END_DAY, c.exposed_households,
       c.coupon_redemption_count, c.redeeming_households,
       c.descriptive_redemption_rate,
       c.spend_before_campaign, c.spend_during_campaign, c.spend_after_campaign,
       c.campaign_window_complete, c.post_campaign_observation_complete, c.post_campaign_days_observed,
       CASE WHEN c.CAMPAIGN IS NULL THEN 'unavailable' ELSE 'found' END AS status
FROM supplier s LEFT JOIN campaign_features c ON c.CAMPAIGN = s.s_suppkey""")
oracle("rank_customers", """
SELECT household_key, round(modeled_24_month_clv, 6) AS modeled_24_month_clv, historical_revenue, basket_count
FROM economics ORDER BY economics.modeled_24_month_clv DESC, household_key LIMIT 25""")
oracle("rank_campaigns", """
SELECT CAMPAIGN, campaign_type, START_DAY, END_DAY, exposed_households, coupon_redemption_count,
       redeeming_households, descriptive_redemption_rate,
       campaign_window_complete, post_campaign_observation_complete
FROM covered WHERE descriptive_redemption_rate IS NOT NULL
ORDER BY covered.descriptive_redemption_rate DESC, CAMPAIGN LIMIT 10""")
oracle("offer_lookup", """
SELECT household_key, CAMPAIGN, START_DAY, calibrated_response_probability,
       expected_contribution_if_response, assumed_offer_cost, break_even_offer_cost,
       modeled_expected_offer_value
FROM offers WHERE CAMPAIGN = 20
ORDER BY offers.modeled_expected_offer_value DESC, household_key LIMIT 20""")


def _starts(*stems: str) -> str:
    return "regexp_matches(q, '\\b(?:" + "|".join(stems) + ")(?:s|d|ed|ing|ion|ions)?\\b')"


step("questions", r"""
SELECT 'c' || c_custkey AS question_id,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'What did household ' || c_custkey || ' buy recently?'
            WHEN 'MACHINERY' THEN 'Show offer economics for customer #' || c_custkey
            WHEN 'HOUSEHOLD' THEN 'List the ' || c_custkey || ' customers with highest modeled CLV'
            WHEN 'AUTOMOBILE' THEN 'Stop at hh key ' || c_custkey || ' please'
            ELSE 'Rank the top ' || c_custkey || ' households by 24-month customer value' END AS question
FROM customer
UNION ALL
SELECT 'o' || o_orderkey,
       CASE o_orderstatus WHEN 'F' THEN 'Campaign ' || o_orderkey || ' redemption details, please'
            WHEN 'O' THEN 'Which ' || o_orderkey || ' campaigns have the best redemption rate?'
            ELSE 'Modeled value of offers in campaign id ' || o_orderkey END
FROM orders
UNION ALL
SELECT 't' || conv_id || '-' || turn,
       CASE WHEN role = 'user' THEN 'What is the assumed retention rate used for CLV? ' || coalesce(text, '')
            ELSE coalesce(text, '') END
FROM conversations""")
step("read_questions", f"""
SELECT question_id, q,
       regexp_extract(q, '{words.HOUSEHOLD}', 1) <> '' AS has_household,
       regexp_extract(q, '{words.CAMPAIGN}', 1) <> '' AS has_campaign,
       TRY_CAST(nullif(regexp_extract(q, '{words.HOUSEHOLD}', 1), '') AS BIGINT) AS household_key,
       TRY_CAST(nullif(regexp_extract(q, '{words.CAMPAIGN}', 1), '') AS BIGINT) AS CAMPAIGN,
       coalesce(TRY_CAST(nullif(regexp_extract(q, '{words.COUNT}', 1), '') AS BIGINT),
                nullif(list_position([{', '.join(f"'{w}'" for w in words.NUMBER_WORDS)}],
                                     regexp_extract(q, '{words.COUNT_WORD}', 1)), 0), 10) AS asked
FROM (SELECT question_id, lower(question) AS q FROM questions)""")
step("routed", f"""
SELECT *, CASE
  WHEN has_household AND {_starts(*words.OFFER_DETAIL)} THEN 'offer_economics_lookup'
  WHEN has_household THEN 'customer_lookup'
  WHEN has_campaign AND {_starts(*words.CAMPAIGN_DETAIL)} THEN 'campaign_lookup'
  WHEN {_starts(*words.CAMPAIGN_WORD)} AND {_starts(*words.BEST)} AND {_starts(*words.REDEMPTION)}
    THEN 'rank_campaigns'
  WHEN {_starts(*words.MOST_VALUABLE)} AND {_starts(*words.CUSTOMER_VALUE)} THEN 'rank_customers'
  WHEN {_starts(*words.ASSUMPTION)} AND {_starts(*words.ASSUMPTION_USE)} THEN 'clv_assumptions'
  WHEN NOT ({_starts(*words.CALIBRATION)} AND {_starts(*words.EXPLANATION)})
    AND {_starts(*words.MODEL)} THEN 'model_metrics'
  WHEN {_starts(*words.OFFER)} AND {_starts(*words.OFFER_VALUE)}
    THEN 'offer_economics_lookup' END AS tool
FROM read_questions""")
step("tagged", f"""
SELECT question_id, tool, household_key, CAMPAIGN,
       CASE tool WHEN 'rank_customers' THEN CASE WHEN {_starts(*words.LONG_HORIZON)} THEN 'modeled_24_month_clv'
                                                 ELSE 'modeled_12_month_clv' END
                 WHEN 'rank_campaigns' THEN 'descriptive_redemption_rate' END AS metric,
       CASE tool WHEN 'rank_customers' THEN greatest(1, least(asked, 100))
                 WHEN 'rank_campaigns' THEN greatest(1, least(asked, 30)) END AS row_limit,
       CASE WHEN tool IS NULL THEN 'no_tool'
            WHEN has_household AND household_key IS NULL OR has_campaign AND CAMPAIGN IS NULL
              THEN 'unknown_identifier'
            WHEN tool = 'rank_customers' AND asked NOT BETWEEN 1 AND 100 THEN 'limit_clamped'
            WHEN tool = 'rank_campaigns' AND asked NOT BETWEEN 1 AND 30 THEN 'limit_clamped'
            ELSE 'routed' END AS status
FROM routed""")
oracle("tagged_questions", "SELECT * FROM tagged")
step("best_offers", """
SELECT household_key, CAMPAIGN, row_number() OVER (PARTITION BY household_key ORDER BY
         modeled_expected_offer_value DESC, CAMPAIGN) AS in_household,
       row_number() OVER (PARTITION BY CAMPAIGN ORDER BY
         modeled_expected_offer_value DESC, household_key) AS in_campaign,
       row_number() OVER (ORDER BY modeled_expected_offer_value DESC, household_key, CAMPAIGN) AS in_all
FROM offers""")
step("best_customers", """
SELECT 'modeled_12_month_clv' AS metric, household_key,
       row_number() OVER (ORDER BY modeled_12_month_clv DESC, household_key) AS place FROM economics
UNION ALL SELECT 'modeled_24_month_clv', household_key,
       row_number() OVER (ORDER BY modeled_24_month_clv DESC, household_key) FROM economics""")
step("best_campaigns", """
SELECT CAMPAIGN, row_number() OVER (ORDER BY descriptive_redemption_rate DESC, CAMPAIGN) AS place
FROM campaign_features
WHERE descriptive_redemption_rate IS NOT NULL
  AND END_DAY <= (SELECT max("DAY") FROM coupon_redempt)""")
step("answers", """
SELECT question_id, 1 AS place, c.household_key, NULL AS CAMPAIGN FROM tagged t
JOIN customer_features c ON c.household_key = t.household_key WHERE tool = 'customer_lookup'
UNION ALL SELECT question_id, 1, NULL, c.CAMPAIGN FROM tagged t
JOIN campaign_features c ON c.CAMPAIGN = t.CAMPAIGN WHERE tool = 'campaign_lookup'
UNION ALL SELECT question_id, in_household, o.household_key, o.CAMPAIGN FROM tagged t
JOIN best_offers o ON o.household_key = t.household_key AND (t.CAMPAIGN IS NULL OR t.CAMPAIGN = o.CAMPAIGN)
WHERE tool = 'offer_economics_lookup' AND (in_household <= 20 OR t.CAMPAIGN IS NOT NULL)
UNION ALL SELECT question_id, in_campaign, o.household_key, o.CAMPAIGN FROM tagged t
JOIN best_offers o ON o.CAMPAIGN = t.CAMPAIGN
WHERE tool = 'offer_economics_lookup' AND t.household_key IS NULL AND in_campaign <= 20
UNION ALL SELECT question_id, in_all, o.household_key, o.CAMPAIGN FROM tagged t
JOIN best_offers o ON in_all <= 20
WHERE tool = 'offer_economics_lookup' AND t.household_key IS NULL AND t.CAMPAIGN IS NULL
UNION ALL SELECT question_id, place, b.household_key, NULL FROM tagged t
JOIN best_customers b ON b.metric = t.metric AND place <= row_limit WHERE tool = 'rank_customers'
UNION ALL SELECT question_id, place, NULL, b.CAMPAIGN FROM tagged t
JOIN best_campaigns b ON place <= row_limit WHERE tool = 'rank_campaigns'
UNION ALL SELECT question_id, place, NULL, NULL FROM tagged,
  (SELECT unnest(generate_series(1, %d)) AS place) WHERE tool = 'clv_assumptions'
UNION ALL SELECT question_id, row_number() OVER (PARTITION BY question_id), NULL, NULL FROM tagged,
  (SELECT score_kind FROM model_report WHERE data_split = 'test'
   UNION ALL SELECT score_kind FROM base_report WHERE data_split = 'test')
WHERE tool = 'model_metrics'""" % (len(FinanceAssumptions.__dataclass_fields__) + 2))
oracle("answered_questions", """
SELECT t.question_id, t.tool,
       CASE WHEN t.tool IS NOT NULL AND a.n IS NULL THEN 'unavailable' ELSE t.status END AS status,
       coalesce(a.n, 0) AS rows, CAST(a.household AS BIGINT) AS first_household,
       CAST(a.campaign AS BIGINT) AS first_campaign
FROM tagged t LEFT JOIN (
  SELECT question_id, count(*) AS n, arg_min(household_key, place) AS household,
         arg_min(CAMPAIGN, place) AS campaign
  FROM answers GROUP BY question_id) a USING (question_id)""")

# Text

_STOPPED = ", ".join(f"'{w}'" for w in STOP_WORDS)


def _tokens(text: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({text}), '[a-z0-9_]+'), "
            f"lambda w: w NOT IN ({_STOPPED}))")


step("doc_tokens", f"""
SELECT doc_id, {_tokens("coalesce(text, '') || ' ' || coalesce(source, '')")} AS terms FROM documents""")
step("doc_terms", """
SELECT doc_id, length, term, count(*) AS tf
FROM (SELECT doc_id, len(terms) AS length, unnest(terms) AS term FROM doc_tokens) GROUP BY ALL""")
step("doc_frequency", "SELECT term, count(DISTINCT doc_id) AS document_frequency FROM doc_terms GROUP BY term")
step("doc_stats", "SELECT count(*) AS documents, avg(len(terms)) AS average_length FROM doc_tokens")
oracle("tokenized_documents", f"""
SELECT doc_id, CAST(unnest(range(len(t))) AS INTEGER) AS position, unnest(t) AS term
FROM (SELECT doc_id, {_tokens('text')} AS t FROM documents)""")
oracle("collection_statistics", """
SELECT documents, round(average_length, 6) AS average_length FROM doc_stats""")
oracle("term_statistics", "SELECT * FROM doc_frequency")
oracle("document_search", f"""
SELECT query_id, doc_id, round(score, 6) AS score, CAST(place AS INTEGER) AS place
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id) AS place
      FROM (SELECT query_id, doc_id, round(sum(
                     ln(1 + (documents - document_frequency + 0.5) / (document_frequency + 0.5))
                     * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * length / greatest(average_length, 1)))), 9) AS score
            FROM (SELECT item_id AS query_id, unnest({_tokens('text')}) AS term FROM benchmark)
            JOIN doc_terms USING (term) JOIN doc_frequency USING (term), doc_stats
            GROUP BY query_id, doc_id)
      WHERE score > 0)
WHERE place <= 4""")

# Chunks: a recursive walk over the paragraphs of each section

_SPACE = r"[\s\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{0b}]"


def _strip(text: str) -> str:
    return f"regexp_replace({text}, '^{_SPACE}+|{_SPACE}+$', '', 'g')"


def _chunk_steps(name: str, source: str, size: int) -> None:
    breaks = r"\r\n|[\n\r\x{0b}\x{0c}\x{1c}\x{1d}\x{1e}\x{85}\x{2028}\x{2029}]"
    step(f"{name}_sections", f"""
SELECT doc_id, title, place, {_strip("part")} AS section
FROM (SELECT doc_id, title, unnest(parts) AS part, unnest(range(len(parts))) AS place
      FROM (SELECT doc_id, title, string_split(
              replace(regexp_replace(text, '{breaks}', chr(10), 'g'), chr(10) || '#', chr(1) || '#'),
              chr(1)) AS parts FROM {source}))""")
    step(f"{name}_paragraphs", f"""
SELECT doc_id, title, place, string_split(section, chr(10) || chr(10)) AS parts
FROM {name}_sections WHERE length(section) > {size}""")
    fits = f"(held = '' OR length(held) + length(p) + 2 <= {size})"
    pieces = (f"[substr(p, CAST(k * {size} + 1 AS BIGINT), {size}) "
              f"for k in range(CAST(ceil(length(p) / {size}) AS BIGINT))]")
    step(f"{name}_walk", f"""
SELECT doc_id, title, place, parts, CAST(0 AS BIGINT) AS spot, CAST('' AS VARCHAR) AS held,
       CAST([] AS VARCHAR[]) AS out FROM {name}_paragraphs
UNION ALL
SELECT doc_id, title, place, parts, spot + 1,
       CASE WHEN length(p) > {size} THEN CASE WHEN {fits} THEN held ELSE '' END
            ELSE {_strip(f"(CASE WHEN {fits} THEN held ELSE '' END) || chr(10) || chr(10) || p")} END,
       list_concat(CASE WHEN {fits} THEN CAST([] AS VARCHAR[]) ELSE [held] END,
                   CASE WHEN length(p) > {size} THEN {pieces} ELSE CAST([] AS VARCHAR[]) END)
FROM (SELECT *, parts[spot + 1] AS p FROM {name}_walk WHERE spot < len(parts))""")
    step(f"{name}_texts", f"""
SELECT doc_id, title, place, spot, unnest(out) AS text, unnest(range(len(out))) AS k FROM {name}_walk
UNION ALL SELECT doc_id, title, place, spot + 1, held, 0 FROM {name}_walk
WHERE spot = len(parts) AND held <> ''
UNION ALL SELECT doc_id, title, place, 0, section, 0 FROM {name}_sections
WHERE section <> '' AND length(section) <= {size}""")


def _chunk_oracle(name: str, prefix: str) -> None:
    heading = "regexp_extract(text, '(?m)^(#.*)$', 1)"
    ORACLE[name] = statement(f"""
SELECT doc_id, doc_id || '-' || chunk_index AS chunk_id, chunk_index,
       CASE WHEN {heading} = '' THEN title
            ELSE {_strip(f"regexp_replace({heading}, '^[# ]+', '')")} END AS chunk_title,
       title AS source, CAST(NULL AS VARCHAR) AS category, text
FROM (SELECT *, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY place, spot, k) - 1 AS INTEGER)
             AS chunk_index FROM {prefix}_texts)""").replace("WITH ", "WITH RECURSIVE ", 1)


step("document_source", "SELECT doc_id, text, source AS title FROM documents")
step("turn_source", """
SELECT conv_id * 1000 + turn AS doc_id,
       '## Turn ' || turn || ' by ' || role || chr(10) || chr(10)
       || replace(text, chr(10), chr(10) || chr(10)) AS text, 'conversation' AS title
FROM conversations""")
_chunk_steps("document", "document_source", 1400)
_chunk_steps("turn", "turn_source", 200)
_chunk_oracle("document_chunks", "document")
_chunk_oracle("conversation_chunks", "turn")
