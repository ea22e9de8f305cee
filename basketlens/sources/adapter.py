"""The retail tables, derived from the order tables of the test data.

Campaigns are run by manufacturers: one per brand in the catalog, addressed to
the households of one or two sales regions.  A coupon line counts as redeemed
for every campaign its household is assigned to and whose interval, with a
margin of 20 days, holds the line's day.  Demographics are known of households with
events.  Money is exact decimal.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from basketlens.functions.days import between_days
from basketlens.sources.layout import ClusteredTable, Extent, store_clustered
from basketlens.sources.sinks import shared_folder, state_of, stored

FIRST_DATE = "1995-01-01"
#: The last campaign ends after the calendar, so it cannot be observed to its end.
FIRST_CAMPAIGN_DAY = 1050
REDEMPTION_MARGIN = 20


def _money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


@dataclass(frozen=True)
class RetailTables:
    """Lazily derived retail tables over one folder of test tables."""

    spark: SparkSession
    folder: str

    def source(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def transactions(self) -> DataFrame:
        return self._derived_transactions()

    def _derived_transactions(self) -> DataFrame:
        price = _money("l_extendedprice")
        share = F.col("l_discount").cast("decimal(4,2)")
        discount = (-(price * share)).cast("decimal(18,4)")
        none = F.lit(0).cast("decimal(18,4)")
        used_coupon = F.col("l_returnflag") == "R"
        baskets = self.source("orders").select(
            F.col("o_orderkey").alias("BASKET_ID"), F.col("o_custkey").alias("household_key"),
            _order_day().alias("DAY"))
        lines = self.source("lineitem").select(
            F.col("l_orderkey").alias("BASKET_ID"),
            F.col("l_partkey").alias("PRODUCT_ID"),
            F.col("l_suppkey").alias("STORE_ID"),
            F.col("l_quantity").cast("int").alias("QUANTITY"),
            (price * (F.lit(1).cast("decimal(4,2)") - share)).cast("decimal(18,4)")
            .alias("SALES_VALUE"),
            F.when(F.col("l_returnflag") == "N", discount).otherwise(none).alias("RETAIL_DISC"),
            F.when(used_coupon, discount).otherwise(none).alias("COUPON_DISC"),
            F.when(used_coupon & (F.col("l_linestatus") == "F"),
                   (discount * F.lit("0.5").cast("decimal(2,1)")).cast("decimal(18,5)"))
            .otherwise(F.lit(0).cast("decimal(18,5)")).alias("COUPON_MATCH_DISC"),
            used_coupon.alias("coupon_line"))
        return lines.join(baskets, "BASKET_ID").select(
            "household_key", "BASKET_ID", "DAY", "PRODUCT_ID", "QUANTITY", "SALES_VALUE",
            "STORE_ID", "RETAIL_DISC", "COUPON_DISC", "COUPON_MATCH_DISC", "coupon_line")

    def lines_between(self, lower: int | None, upper: int) -> DataFrame:
        """Transactions of the days ``[lower, upper)``."""
        return self.transactions.where(between_days(F.col("DAY"), lower, upper))

    @cached_property
    def products(self) -> DataFrame:
        unclassified = F.col("p_size") % 10 == 0
        return self.source("part").select(
            F.col("p_partkey").alias("PRODUCT_ID"),
            _brand_number().alias("MANUFACTURER"),
            F.when(~unclassified, F.col("p_type")).alias("DEPARTMENT"),
            F.col("p_brand").alias("BRAND"),
            F.when(~unclassified, F.col("p_name")).alias("COMMODITY_DESC"),
            F.col("p_brand").alias("SUB_COMMODITY_DESC"),
            F.when(F.col("p_size") % 3 != 0, F.col("p_size").cast("string"))
            .alias("CURR_SIZE_OF_PRODUCT"))

    @cached_property
    def campaigns(self) -> DataFrame:
        number = F.col("CAMPAIGN")
        start = FIRST_CAMPAIGN_DAY + 60 * F.floor(number * 9 / 10)
        return (self.source("part").select(_brand_number().alias("CAMPAIGN")).distinct()
                .select(
                    F.concat(F.lit("Type"), F.substring(F.lit("ABC"), number % 3 + 1, F.lit(1)))
                    .alias("DESCRIPTION"),
                    "CAMPAIGN",
                    start.cast("int").alias("START_DAY"),
                    (start + 30 + 15 * (number % 4)).cast("int").alias("END_DAY")))

    @cached_property
    def assignments(self) -> DataFrame:
        number = F.col("CAMPAIGN")
        targets = self.campaigns.select(
            "CAMPAIGN", "DESCRIPTION",
            F.explode(F.array_distinct(F.array(
                (number % 5).cast("int"), (F.floor(number / 5) % 5).cast("int"))))
            .alias("n_regionkey"))
        regions = self.source("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), "n_regionkey")
        return (self.source("customer").select(F.col("c_custkey").alias("household_key"),
                                               "c_nationkey")
                .join(regions, "c_nationkey").join(targets, "n_regionkey")
                .select("DESCRIPTION", "household_key", "CAMPAIGN"))

    @cached_property
    def redemptions(self) -> DataFrame:
        margin = F.lit(REDEMPTION_MARGIN)
        intervals = self.assignments.join(
            self.campaigns.drop("DESCRIPTION"), "CAMPAIGN").select(
            "household_key", "CAMPAIGN", "START_DAY", "END_DAY")
        coupon_lines = self.transactions.where("coupon_line").select(
            "household_key", "DAY", F.col("PRODUCT_ID").alias("COUPON_UPC"))
        lines, spans = coupon_lines.alias("l"), intervals.alias("s")
        return lines.join(
            spans, (F.col("l.household_key") == F.col("s.household_key"))
            & F.col("DAY").between(F.col("START_DAY") - margin, F.col("END_DAY") + margin)
        ).select("l.household_key", "DAY", "COUPON_UPC", "CAMPAIGN")

    @cached_property
    def demographics(self) -> DataFrame:
        known = self.source("events").select(F.col("user_id").alias("c_custkey"))
        return self.source("customer").join(known, "c_custkey", "left_semi").select(
            F.col("c_mktsegment").alias("classification_1"),
            F.col("c_custkey").alias("household_key"))

    @cached_property
    def documents(self) -> DataFrame:
        return self.source("documents").select("doc_id", "text", F.col("source").alias("title"))


class PreparedTables(RetailTables):
    """The derived tables, written once per session and then read as stored tables.

    Transaction files follow a curve over days and households, so that day windows open a
    small share of them and a crowded day or household splits over files.
    """

    @cached_property
    def place(self) -> str:
        return f"retail-{uuid.uuid4().hex}"

    def _stored(self, name: str, df: DataFrame) -> DataFrame:
        return stored(df, f"{self.place}/{name}")

    @cached_property
    def campaigns(self) -> DataFrame:
        return self._stored("campaigns", super().campaigns)

    @cached_property
    def assignments(self) -> DataFrame:
        return self._stored("assignments", super().assignments)

    @cached_property
    def clustered_transactions(self) -> ClusteredTable:
        days = self.source("orders").agg(F.min(_order_day()).alias("first"),
                                         F.max(_order_day()).alias("last")).first()
        # Every line has the day of an order; the rows only decide on the number of files.
        extent = Extent(days.first, days.last, self.source("lineitem").count())
        # Not by super().transactions, whose value would stay as that of this table too.
        return store_clustered(self._derived_transactions(), f"{self.place}/transactions", "DAY",
                               "household_key", extent=extent)

    @cached_property
    def transactions(self) -> DataFrame:
        return self.clustered_transactions.rows

    def lines_between(self, lower: int | None, upper: int) -> DataFrame:
        return self.clustered_transactions.between(lower, upper)

    @cached_property
    def redemptions(self) -> DataFrame:
        return self._stored("redemptions", super().redemptions)


_PREPARED: dict[tuple[str, str, str], PreparedTables] = {}


def prepared_tables(spark: SparkSession, folder: str) -> PreparedTables:
    """The stored tables of a folder, derived on first use and after a change of its files."""
    key = (shared_folder(spark), folder, state_of(spark, folder))
    if key not in _PREPARED:
        _PREPARED[key] = PreparedTables(spark, folder)
    return _PREPARED[key]


def _order_day() -> Column:
    return F.datediff(F.col("o_orderdate").cast("date"), F.lit(FIRST_DATE).cast("date")) + 1


def _brand_number() -> Column:
    return F.regexp_extract("p_brand", r"(\d+)", 1).cast("int")
