"""Tag plain questions with the lookup that answers them, for whole tables of questions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

# How identifiers and list lengths are written in questions.
HOUSEHOLD = r"\b(?:household|customer|hh)(?:\s+key)?\s*#?\s*(\d+)\b"
CAMPAIGN = r"\bcampaign(?:\s+id)?\s*#?\s*(\d+)\b"
COUNT = r"\b(\d{1,3})\s+(?:customers|households|campaigns)\b"
NUMBER_WORDS = ("one", "two", "three", "four", "five", "six", "seven", "eight", "nine", "ten")
COUNT_WORD = r"\b(" + "|".join(NUMBER_WORDS) + r")\s+(?:customers|households|campaigns)\b"

# The word stems that point to a topic.
OFFER_DETAIL = ("offer", "economics", "break-even", "break even")
OFFER = ("offer",)
OFFER_VALUE = ("value", "economics", "break-even", "break even")
CAMPAIGN_DETAIL = ("lookup", "details", "performance", "redemption", "spend", "campaign type")
CAMPAIGN_WORD = ("campaign",)
BEST = ("highest", "top", "rank", "best")
REDEMPTION = ("redemption", "redeeming", "rate")
MOST_VALUABLE = ("highest", "top", "rank", "customers with most")
CUSTOMER_VALUE = ("clv", "customer value")
LONG_HORIZON = ("24",)
ASSUMPTION = ("assumption", "retention rate", "contribution margin", "discount rate")
ASSUMPTION_USE = ("clv", "finance", "offer", "used", "configured")
CALIBRATION = ("calibrat",)
EXPLANATION = ("what does", "what is", "explain", "how does", "how is")
MODEL = ("model", "roc-auc", "average precision", "calibration", "brier", "baseline", "evaluated")

LARGEST_LIST = {"rank_customers": 100, "rank_campaigns": 30}


#: How a word may go on after its stem: "topic" is no mention of "top".
ENDINGS = r"(?:s|d|ed|ing|ion|ions)?\b"


def _mentions(text: Column, *stems: str) -> Column:
    """Some word or phrase of the text is one of the stems, as it is or with a usual ending."""
    return text.rlike(r"\b(?:" + "|".join(stems) + ")" + ENDINGS)


def _number(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, pattern, 1)
    return F.when(found != "", found.try_cast("bigint"))


def _named(text: Column, pattern: str) -> Column:
    """Whether an identifier is written, be it too long for a number."""
    return F.regexp_extract(text, pattern, 1) != ""


def tag_questions(questions: DataFrame, text_column: str = "question") -> DataFrame:
    """Add tool, identifiers, metric, list length and a status to every question.

    Rules apply in a fixed order and the first that holds decides.  A list
    length outside a tool's range is brought into it and marked as clamped.
    """
    text = F.lower(F.col(text_column))
    household, campaign = _number(text, HOUSEHOLD), _number(text, CAMPAIGN)
    word = F.regexp_extract(text, COUNT_WORD, 1)
    spelled = F.array_position(F.array(*[F.lit(w) for w in NUMBER_WORDS]), word)
    asked = F.coalesce(_number(text, COUNT), F.when(spelled > 0, spelled),
                       F.lit(10)).cast("bigint")

    def about(*topics: tuple[str, ...]) -> Column:
        return reduce(lambda a, b: a & b, [_mentions(text, *stems) for stems in topics])

    rules = (
        ("offer_economics_lookup", _named(text, HOUSEHOLD) & about(OFFER_DETAIL)),
        ("customer_lookup", _named(text, HOUSEHOLD)),
        ("campaign_lookup", _named(text, CAMPAIGN) & about(CAMPAIGN_DETAIL)),
        ("rank_campaigns", about(CAMPAIGN_WORD, BEST, REDEMPTION)),
        ("rank_customers", about(MOST_VALUABLE, CUSTOMER_VALUE)),
        ("clv_assumptions", about(ASSUMPTION, ASSUMPTION_USE)),
        ("model_metrics", ~about(CALIBRATION, EXPLANATION) & about(MODEL)),
        ("offer_economics_lookup", about(OFFER, OFFER_VALUE)))
    tool = F.coalesce(*[F.when(condition, name) for name, condition in rules])

    tagged = questions.withColumns({
        "tool": tool, "household_key": household, "CAMPAIGN": campaign, "asked_rows": asked})
    chosen = F.col("tool")
    largest = F.coalesce(*[F.when(chosen == name, F.lit(most))
                           for name, most in LARGEST_LIST.items()])
    rows = F.greatest(F.lit(1), F.least(F.col("asked_rows"), largest))
    return tagged.withColumns({
        "metric": F.when(chosen == "rank_customers", F.when(
            about(LONG_HORIZON), "modeled_24_month_clv").otherwise("modeled_12_month_clv"))
        .when(chosen == "rank_campaigns", "descriptive_redemption_rate"),
        "row_limit": F.when(largest.isNotNull(), rows).cast("bigint"),
        "status": F.when(chosen.isNull(), "no_tool")
        .when((_named(text, HOUSEHOLD) & F.col("household_key").isNull())
              | (_named(text, CAMPAIGN) & F.col("CAMPAIGN").isNull()), "unknown_identifier")
        .when(largest.isNotNull() & (rows != F.col("asked_rows")), "limit_clamped")
        .otherwise("routed")}).drop("asked_rows")


def answer_questions(tagged: DataFrame, tables: Mapping[str, DataFrame],
                     key: str = "question_id", most: int = 20) -> DataFrame:
    """The rows that answer tagged questions, as JSON texts in an array, with a status.

    ``tables`` holds the served tables by tool: ``customer_lookup`` by household_key,
    ``campaign_lookup`` by CAMPAIGN, ``offer_economics_lookup`` by both, the rankings with
    ``place`` (and ``metric`` where there are several), ``clv_assumptions`` and
    ``model_metrics`` whole.  Answers are listed once per tool and key, not per question: what
    depends on no identifier is one small map that every question looks into, all else meets
    the questions in one equality join.  So questions are tagged once and never multiplied by the rows
    that answer them.  Lists hold at most ``most`` offers or the asked rows; a question about
    offers in general gets the best of all.
    """
    def record(df: DataFrame, *keys: str) -> DataFrame:
        plain = [name for name in df.columns if name != "place"]
        order = F.col("place") if "place" in df.columns else F.lit(1)
        return df.select(*keys, order.alias("place"),
                         F.to_json(F.struct(*sorted(plain))).alias("record"))

    offers = tables["offer_economics_lookup"]

    def best_of(*keys: str) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(
            F.desc("modeled_expected_offer_value"), "household_key", "CAMPAIGN")
        return record(offers.withColumn("place", F.row_number().over(order))
                      .where(F.col("place") <= most), *keys)

    def listed(df: DataFrame, *keys: str) -> DataFrame:
        """One ordered list of the answering rows for each key."""
        return df.groupBy(*keys).agg(F.array_sort(F.collect_list(
            F.struct(F.col("place").cast("int").alias("place"), "record"))).alias("list"))

    def named(df: DataFrame, name: str, *keys: str) -> DataFrame:
        k1, k2 = [*[F.col(k).cast("bigint") for k in keys], *[F.lit(0).cast("bigint")] * 2][:2]
        return df.select(F.lit(name).alias("by"), k1.alias("k1"), k2.alias("k2"), "place", "record")

    both, one, other, none = (f"offer_economics_lookup:{n}" for n in ("both", "household", "campaign", ""))
    best = offers.orderBy(F.desc("modeled_expected_offer_value"), "household_key", "CAMPAIGN").limit(
        most).withColumn("by", F.lit(none))
    best = best.withColumn("place", F.row_number().over(Window.partitionBy("by").orderBy(
        F.desc("modeled_expected_offer_value"), "household_key", "CAMPAIGN")))
    ranked = {tool: record(tables[tool], "metric").withColumn("by", F.concat(F.lit(f"{tool}:"), "metric"))
              for tool in LARGEST_LIST}
    whole = {tool: record(tables[tool].withColumn("by", F.lit(tool)), "by")
             for tool in ("clv_assumptions", "model_metrics")}
    general = listed(reduce(DataFrame.unionByName, [df.select("by", "place", "record") for df in (
        record(best, "by"), *ranked.values(), *whole.values())]), "by").agg(
        F.map_from_entries(F.collect_list(F.struct("by", "list")))).scalar()
    keyed = listed(reduce(DataFrame.unionByName, [
        named(record(tables["customer_lookup"], "household_key"), "customer_lookup", "household_key"),
        named(record(tables["campaign_lookup"], "CAMPAIGN"), "campaign_lookup", "CAMPAIGN"),
        named(best_of("household_key", "CAMPAIGN"), both, "household_key", "CAMPAIGN"),
        named(best_of("household_key"), one, "household_key"),
        named(best_of("CAMPAIGN"), other, "CAMPAIGN")]), "by", "k1", "k2")

    tool, household, campaign = F.col("tool"), F.col("household_key"), F.col("CAMPAIGN")
    by = F.when(F.col("status") != "unknown_identifier", F.when(
        tool.isin(*LARGEST_LIST), F.concat_ws(":", tool, "metric"))
        .when(tool == "offer_economics_lookup", F.when(household.isNotNull(), F.when(
            campaign.isNotNull(), both).otherwise(one))
            .when(campaign.isNotNull(), other).otherwise(none)).otherwise(tool))
    k1 = F.when(F.col("by").isin("customer_lookup", both, one), household).when(
        F.col("by").isin("campaign_lookup", other), campaign)
    # Questions without a key are spread by their own, with -1 as a second one that no list has.
    asked = tagged.withColumn("by", F.coalesce(by, F.lit(""))).withColumns({
        "k1": F.coalesce(k1, F.xxhash64(key)).cast("bigint"),
        "k2": F.when(F.col("by") == both, campaign).when(k1.isNotNull(), 0).otherwise(-1)
        .cast("bigint")})
    found = F.coalesce("list", F.try_element_at(general, F.col("by")))
    within = F.filter("found", lambda x: F.col("row_limit").isNull() | (x["place"] <= F.col("row_limit")))
    answer = F.transform(F.when(F.size(within) > 0, within), lambda x: x["record"])
    others = [name for name in tagged.columns if name != key]
    return asked.join(keyed, ["by", "k1", "k2"], "left").withColumn("found", found).select(
        key, *others, answer.alias("answer")).withColumn(
        "status", F.when(F.col("tool").isNotNull() & F.col("answer").isNull(), "unavailable")
        .otherwise(F.col("status")))
