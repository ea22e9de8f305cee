"""Profiling, contracts and validated joins.  Findings are rows; nothing is repaired."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from basketlens.operators.ordering import lower_quantiles_of
from basketlens.contracts import OUTPUT_COLUMNS, OUTPUT_KEYS
from basketlens.functions.text import is_blank
from basketlens.settings import QualityRules


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column_differences(df: DataFrame, rules: QualityRules) -> dict[str, list[str]]:
    """Missing and unexpected columns; metadata only, no job."""
    present = set(df.columns)
    return {"missing_required": sorted(set(rules.required) - present),
            "unexpected": sorted(present - set(rules.allowed)) if rules.allowed else []}


def column_profile(df: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Row, blank, invalid-number and invalid-date counts per column, in one pass.

    A column without a numeric or date rule has null in the matching count.
    """
    def findings(name: str) -> Column:
        value, blank = F.col(_quoted(name)), is_blank(F.col(_quoted(name)))
        unparsed = F.lit(None).cast("bigint")
        number = (F.count_if(~blank & value.try_cast("double").isNull())
                  if name in rules.numeric else unparsed)
        date = (F.count_if(~blank & F.try_to_timestamp(value, F.lit(rules.dates[name])).isNull())
                if name in rules.dates else unparsed)
        return F.struct(F.lit(name).alias("column_name"), F.count(F.lit(1)).alias("row_count"),
                        F.count_if(blank).alias("null_count"),
                        number.alias("invalid_numeric_count"), date.alias("invalid_date_count"))

    rate = F.when(F.col("row_count") > 0,
                  F.col("null_count") / F.col("row_count")).otherwise(0.0)
    return (df.agg(F.array(*[findings(name) for name in df.columns]).alias("found"))
            .select(F.inline("found"))
            .withColumn("null_rate", rate)
            .withColumn("null_rate_violation", F.col("null_rate") > rules.max_null_rate))


def duplicate_rows(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each distinct row, nulls being equal; one row.

    Rows shuffle as a 64-bit hash with their count.  Rows that share a hash
    are then compared in full, so a hash collision is not taken for a copy.
    """
    columns = [_quoted(name) for name in columns or df.columns]
    hashed = df.select(*columns, F.xxhash64(*columns).alias("__row_hash"))
    repeated = (hashed.groupBy("__row_hash").agg(F.count(F.lit(1)).alias("__rows"))
                .where("__rows > 1").select("__row_hash"))
    surplus = (hashed.join(repeated, "__row_hash", "left_semi")
               .groupBy(*columns).agg((F.count(F.lit(1)) - 1).alias("__extra")))
    return surplus.agg(F.coalesce(F.sum("__extra"), F.lit(0)).alias("duplicate_rows"))


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key groups that hold more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")


def repeated_key_census(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return repeated_keys(df, keys).agg(
        F.count(F.lit(1)).alias("repeated_groups"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows_in_groups"))


def unmatched_keys(child: DataFrame, child_keys: Sequence[str], parent: DataFrame,
                   parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct child keys without a parent; keys with a null part are not judged."""
    names = list(child_keys)
    known = parent.select(*[F.col(p).alias(c) for c, p in
                            zip(names, parent_keys or names)]).distinct()
    return child.select(*names).dropna().distinct().join(known, names, "left_anti")


def relationship_coverage(name: str, child: DataFrame, child_keys: Sequence[str],
                          parent: DataFrame | None,
                          parent_keys: Sequence[str] | None = None) -> DataFrame:
    """Distinct child keys, how many have a parent and how many do not; one row."""
    keys = child.select(*child_keys).dropna().distinct()
    label = F.lit(name).alias("relationship")
    if parent is None:
        blank = F.lit(None).cast("bigint")
        return child.limit(0).agg(F.lit("not_evaluated_no_reference").alias("status")).select(
            label, "status", blank.alias("child_keys"), blank.alias("matched_keys"),
            blank.alias("unmatched_keys"))
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(
        child_keys, parent_keys or child_keys)]).distinct().withColumn("known", F.lit(1))
    return keys.join(known, list(child_keys), "left").agg(
        F.count(F.lit(1)).alias("child_keys"), F.count("known").alias("matched_keys")).select(
        label, F.lit("evaluated").alias("status"), "child_keys", "matched_keys",
        (F.col("child_keys") - F.col("matched_keys")).alias("unmatched_keys"))


def schema_rows(df: DataFrame) -> DataFrame:
    """Column name, type and nullability as rows."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), str(f.nullable).lower()) for f in df.schema.fields],
        "column string, data_type string, nullable string")


def numeric_summary(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, range and quartiles of numeric columns.

    Quartiles are exact lower values, of all columns together in three passes; the rest takes
    one.
    """
    columns = list(columns or [f.name for f in df.schema.fields
                               if isinstance(f.dataType, NumericType)])

    doubles = df.select(*[F.col(_quoted(name)).cast("double").alias(name) for name in columns])
    found = lower_quantiles_of(doubles, {name: (0.25, 0.5, 0.75) for name in columns})

    def summary(name: str) -> Column:
        value, quartiles = F.col(_quoted(name)).cast("double"), found[name]
        return F.struct(
            F.lit(name).alias("column_name"), F.count(value).alias("n"),
            F.avg(value).alias("mean"), F.stddev_samp(value).alias("stddev"),
            F.min(value).alias("min"),
            *[F.lit(q).cast("double").alias(f"p{p}") for q, p in zip(quartiles, (25, 50, 75))],
            F.max(value).alias("max"))

    return df.agg(F.array(*[summary(name) for name in columns]).alias("s")).select(F.inline("s"))


def sample_records(df: DataFrame, n: int = 5, key: Sequence[str] = ()) -> DataFrame:
    """The first rows as JSON text: by key, or any rows without one."""
    rows = df.orderBy(*key) if key else df
    return rows.limit(n).select(F.to_json(F.struct("*")).alias("record"))


def inference_drift(as_text: DataFrame, inferred: DataFrame) -> DataFrame:
    """Whether type inference changed the number of rows read; one row."""
    text_rows = as_text.agg(F.count(F.lit(1)).alias("text_rows"))
    typed_rows = inferred.agg(F.count(F.lit(1))).scalar()
    return text_rows.withColumn("inferred_rows", typed_rows).withColumn(
        "row_count_changed", F.col("text_rows") != F.col("inferred_rows"))


def corrupt_records(df: DataFrame, column: str = "_corrupt_record") -> DataFrame:
    """Lines that did not fit the contract of a CSV read, and values that did; one row.

    Counting the parsed values keeps every column in the scan, without which the
    parser would not notice what is wrong with a line.
    """
    values = [F.col(_quoted(name)).isNotNull().cast("int") for name in df.columns
              if name != column]
    return df.agg(F.count(column).alias("corrupt_records"),
                  F.sum(reduce(lambda a, b: a + b, values)).alias("parsed_values"))


def inspect_table(name: str, typed: DataFrame, as_text: DataFrame, rules: QualityRules,
                  sample_size: int = 5) -> dict[str, DataFrame]:
    """All findings about one file, each a small DataFrame tagged with its name."""
    tag = F.lit(name).alias("dataset")
    report = {
        "schema": schema_rows(typed),
        "columns": column_profile(as_text, rules),
        "duplicates": duplicate_rows(as_text),
        "drift": inference_drift(as_text, typed),
        "sample": sample_records(typed, sample_size),
    }
    if any(isinstance(f.dataType, NumericType) for f in typed.schema.fields):
        report["numbers"] = numeric_summary(typed)
    return {kind: df.select(tag, "*") for kind, df in report.items()}


def inventory(tables: Mapping[str, tuple[DataFrame, DataFrame]],
              rules: Mapping[str, QualityRules] | None = None,
              sample_size: int = 5) -> dict[str, DataFrame]:
    """Findings about all files, one DataFrame per kind of finding."""
    reports = [inspect_table(name, typed, text, (rules or {}).get(name, QualityRules()),
                             sample_size) for name, (typed, text) in tables.items()]
    kinds = ("schema", "columns", "duplicates", "drift", "sample", "numbers")
    return {kind: reduce(DataFrame.unionByName, [r[kind] for r in reports if kind in r])
            for kind in kinds if any(kind in r for r in reports)}


ECONOMIC_INPUTS = ("total_sales", "transaction_count", "average_basket_value",
                   "total_quantity", "purchase_frequency", "recency_days")


def economics_gate(customers: DataFrame) -> DataFrame:
    """Counts of everything that would spoil customer economics; one row.

    Repeated keys are counted on one row per key with its row count, so the
    gate needs a single shuffle on the household key.
    """
    def any_of(conditions: list[Column]) -> Column:
        return F.coalesce(reduce(lambda a, b: a | b, conditions), F.lit(False))

    values = [F.col(name).cast("double") for name in ECONOMIC_INPUTS]
    per_key = customers.groupBy("household_key").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_of([v.isNull() for v in values]) | F.col("household_key").isNull())
        .alias("missing"),
        F.count_if(any_of([F.isnan(v) | (F.abs(v) == math.inf) for v in values]))
        .alias("nonfinite"),
        F.count_if(any_of([v < 0 for v in values])).alias("negative"))
    return per_key.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("unique_households"),
        F.coalesce(F.sum("missing"), F.lit(0)).alias("rows_with_missing_required"),
        F.coalesce(F.sum("nonfinite"), F.lit(0)).alias("nonfinite_rows"),
        F.coalesce(F.sum("negative"), F.lit(0)).alias("impossible_negative_rows"))


def require_clean_economics(customers: DataFrame) -> dict:
    found = economics_gate(customers).first().asDict()
    bad = {k: found[k] for k in ("rows_with_missing_required", "nonfinite_rows",
                                 "impossible_negative_rows") if found[k]}
    if found["rows"] != found["unique_households"]:
        bad["repeated_households"] = found["rows"] - found["unique_households"]
    if bad:
        raise ValueError(f"customer features are not fit for economics: {bad}")
    return found


def range_violations(offers: DataFrame, economics: DataFrame) -> DataFrame:
    """Rows with a missing or impossible probability or customer value."""
    def outside(column: str, high: float) -> Column:
        value = F.col(column).try_cast("double")
        return value.isNull() | F.isnan(value) | (value < 0) | (value > high)

    largest_finite = 1.7976931348623157e308
    checks = [(offers, "calibrated_response_probability", 1.0),
              (economics, "modeled_12_month_clv", largest_finite),
              (economics, "modeled_24_month_clv", largest_finite)]
    return reduce(DataFrame.unionByName, [
        df.agg(F.lit(column).alias("column_name"), F.count(F.lit(1)).alias("row_count"),
               F.count_if(outside(column, high)).alias("violations"))
        for df, column, high in checks])


def contract_violations(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Every broken rule of the output tables: keys, references, ranges; one row per rule.

    Missing tables and columns raise at once, since later rules need them.
    """
    for name, required in OUTPUT_COLUMNS.items():
        if name not in tables:
            raise ValueError(f"missing table {name}")
        missing = sorted(set(required) - set(tables[name].columns))
        if missing:
            raise ValueError(f"{name} lacks required columns {missing}")

    def count_rows(rule: str, df: DataFrame) -> DataFrame:
        return df.agg(F.lit(rule).alias("rule"), F.count(F.lit(1)).alias("violations"))

    checks = []
    for name, keys in OUTPUT_KEYS.items():
        df = tables[name]
        no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        checks.append(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).agg(
            F.lit(f"{name}: key is present and unique").alias("rule"),
            F.count_if((F.col("n") > 1) | no_key).alias("violations")))
    for name in ("campaign_households", "offers", "model_rows"):
        checks.append(count_rows(f"{name}: campaign exists", unmatched_keys(
            tables[name], ["CAMPAIGN"], tables["campaigns"])))
    checks.append(count_rows("offers: household exists", unmatched_keys(
        tables["offers"], ["household_key"], tables["customers"])))
    for name in ("customers", "campaigns"):
        checks.append(tables[name].limit(1).agg(
            F.lit(f"{name}: not empty").alias("rule"),
            (1 - F.count(F.lit(1))).alias("violations")))
    ranges = range_violations(tables["offers"], tables["customer_economics"])
    checks.append(ranges.select(
        F.concat("column_name", F.lit(": within range")).alias("rule"), "violations"))
    return reduce(DataFrame.unionByName, checks)


def require_contract(tables: Mapping[str, DataFrame]) -> None:
    broken = contract_violations(tables).where("violations > 0").collect()
    if broken:
        raise ValueError("broken contracts: " + "; ".join(
            f"{r.rule} ({r.violations})" for r in broken))


def require_report_sections(report: Mapping[str, object], sections: Sequence[str],
                            name: str) -> None:
    missing = sorted(set(sections) - set(report))
    if missing:
        raise ValueError(f"{name} lacks sections {missing}")


def many_to_one(facts: DataFrame, dimension: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Attach a dimension without adding or losing rows; fails while running otherwise.

    The dimension is reduced to one row per key first, so a repeated key can
    never multiply facts; repeats and gaps raise where they are met.
    """
    keys = list(keys)
    payload = [c for c in dimension.columns if c not in keys]
    one = dimension.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("dimension_rows"),
        *[F.first(c).alias(c) for c in payload])
    rows = F.col("dimension_rows")
    checked = (F.when(rows == 1, True)
               .when(rows.isNull(), F.raise_error(
                   F.lit(f"no {', '.join(keys)} in the dimension")).cast("boolean"))
               .otherwise(F.raise_error(
                   F.lit(f"{', '.join(keys)} is not unique in the dimension")).cast("boolean")))
    return facts.join(one, keys, "left").where(checked).drop("dimension_rows")


def output_metadata(spark: SparkSession, written: Sequence[dict]) -> DataFrame:
    """Name, path, rows and schema of written tables as a small table."""
    return spark.createDataFrame(
        [(w["name"], w["path"], w["rows"], w["schema"]) for w in written],
        "name string, path string, rows long, schema string")
