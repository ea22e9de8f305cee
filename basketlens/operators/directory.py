"""Findings about all CSV files of a folder, in one scan per header."""

from __future__ import annotations

import csv
import re
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketlens.functions.text import as_integer, as_number, is_blank
from basketlens.settings import QualityRules
from basketlens.sources.readers import CORRUPT, CSV_OPTIONS

BY_FILE, BY_FOLDER = r"([^/]+)$", r"([^/]+)/[^/]+$"
SCHEMA = ("dataset string, column_name string, data_type string, row_count bigint, "
          "null_count bigint, null_rate double, null_rate_violation boolean, "
          "invalid_numeric_count bigint, invalid_date_count bigint, mean double, stddev double, "
          "min double, max double, malformed_rows bigint, duplicate_rows bigint")
_FILES = {"recursiveFileLookup": "true", "pathGlobFilter": "*.[cC][sS][vV]"}


def csv_headers(spark: SparkSession, root: str, dataset: str = BY_FILE) -> DataFrame:
    """The distinct first lines of the CSV files below a folder, with their files: paths
    as named and as metadata state them, and datasets."""
    lines = (spark.read.options(**_FILES).text(root)
             .where(F.col("_metadata.file_block_start") == 0)
             .select(F.col("_metadata.file_path").alias("file"), "value",
                     F.monotonically_increasing_id().alias("place")))
    return (lines.groupBy("file").agg(F.min_by("value", "place").alias("header"))
            .coalesce(1)  # one row per file, all of which the caller collects
            .withColumn("path", _plain(F.col("file")))
            .groupBy("header").agg(F.sort_array(F.collect_list(F.struct(
                "path", "file", F.regexp_extract("path", dataset, 1).alias("dataset"))))
                .alias("files")))


def column_names(header: str) -> list[str]:
    """The names in a header line; one that is blank or repeated gets its position added."""
    names = next(csv.reader([header.lstrip("﻿")]), [])
    low = [name.strip().lower() for name in names]
    return [name if name.strip() and low.count(name.strip().lower()) == 1 else f"{name}_{i}"
            for i, name in enumerate(names)]


def _plain(path: Column) -> Column:
    """A file's path as it is named, which metadata state with escapes."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _literally(path: str) -> str:
    """A path without patterns for files of several names."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _read_values(names: list[str], rules: QualityRules) -> list[Column]:
    """What each value is, evaluated once per row ahead of the sums that read it."""
    def of(i: int, name: str) -> Column:
        value = F.col(f"c{i}")
        whole = as_integer(value)
        return F.struct(
            is_blank(value).alias("blank"), as_number(value).alias("number"),
            whole.alias("bigint"), whole.between(-2**31, 2**31 - 1).alias("int"),
            value.try_cast("date").isNotNull().alias("date"),
            F.lower(F.trim(value)).isin("true", "false").alias("boolean"),
            *([F.try_to_timestamp(value, F.lit(rules.dates[name])).isNotNull().alias("day")]
              if name in rules.dates else []))
    return [of(i, name).alias(f"v{i}") for i, name in enumerate(names)]


def _findings(rows: DataFrame, names: list[str], rules: QualityRules) -> DataFrame:
    """Findings per dataset and column of the files of one header."""
    def of(i: int, name: str) -> Column:
        value = F.col(f"v{i}")
        blank, number = value["blank"], value["number"]
        fits = {"int": F.coalesce(value["int"], F.lit(False)), "bigint": value["bigint"].isNotNull(),
                "double": number.isNotNull(), "date": value["date"], "boolean": value["boolean"]}
        unfit = {kind: F.count_if(~blank & ~fit) for kind, fit in fits.items()}
        some = F.count_if(~blank) > 0
        kind = F.coalesce(*[F.when(some & (n == 0), k) for k, n in unfit.items()], F.lit("string"))
        unparsed = F.lit(None).cast("bigint")
        day = F.count_if(~blank & ~value["day"]) if name in rules.dates else unparsed
        return F.struct(
            F.lit(name).alias("column_name"), kind.alias("data_type"),
            F.count(F.lit(1)).alias("row_count"), F.count_if(blank).alias("null_count"),
            (unfit["double"] if name in rules.numeric else unparsed).alias("invalid_numeric_count"),
            day.alias("invalid_date_count"),
            *[F.when(some & (unfit["double"] == 0), measure(number)).alias(label)
              for label, measure in (("mean", F.avg), ("stddev", F.stddev_samp),
                                     ("min", F.min), ("max", F.max))])

    columns = [f"c{i}" for i in range(len(names))]
    # Copies are counted by a digest first, so that rows shuffle as 24 bytes and equal rows
    # of a crowded file combine ahead of the exchange.
    digest = F.md5(F.to_json(F.struct(*columns, CORRUPT)))
    copies = (rows.groupBy("dataset", F.unhex(digest).alias("digest"))
              .agg((F.count(F.lit(1)) - 1).alias("extra"))
              .groupBy("dataset").agg(F.sum("extra").alias("duplicate_rows")))
    return (rows.select("dataset", CORRUPT, *_read_values(names, rules)).groupBy("dataset").agg(
                F.array(*[of(i, name) for i, name in enumerate(names)]).alias("found"),
                F.count(CORRUPT).alias("malformed_rows"))
            .join(copies, "dataset")
            .select("dataset", "malformed_rows", "duplicate_rows", F.inline("found")))


def directory_profile(spark: SparkSession, root: str, rules: QualityRules = QualityRules(),
                      dataset: str = BY_FILE) -> DataFrame:
    """Profile of every column of every CSV file below a folder, one row each.

    Files are grouped by their header line, and each distinct header is one scan of all its
    files, keyed by the file a row came from: the number of jobs grows with the
    headers, not with the files.  ``dataset`` is the pattern whose first group names the
    dataset of a path: the file, or with ``BY_FOLDER`` the folder of part files.  Files of one
    dataset with different headers are separate findings under the same name.

    Types, blanks, unfit numbers and dates, moments and range of numbers, malformed lines and
    surplus copies of rows come from that scan; lines that end within quotes are
    malformed, as in any read by lines.  A file without a line has no findings, one
    with a header only has none either.
    """
    parts, headers = [], csv_headers(spark, root, dataset).collect()  # one row per distinct header
    if not headers:
        return spark.createDataFrame([], SCHEMA)
    # A small table of files names the datasets: to take them from each row's path would cost
    # more than to read the row.
    found = [file for header in headers for file in header.files]
    files = spark.createDataFrame(pa.table({name: pa.array([f[name] for f in found], pa.string())
                                            for name in ("file", "dataset")}))
    for header in headers:
        names = column_names(header.header)
        schema = StructType([*[StructField(f"c{i}", StringType()) for i in range(len(names))],
                             StructField(CORRUPT, StringType())])
        if not names:
            continue
        rows = (spark.read.options(**CSV_OPTIONS).schema(schema)
                .csv([_literally(f.path) for f in header.files])
                .withColumn("file", F.col("_metadata.file_path")).join(files, "file", "left"))
        parts.append(_findings(rows, names, rules))
    if not parts:
        return spark.createDataFrame([], SCHEMA)
    found = reduce(DataFrame.unionByName, parts)
    rate = F.col("null_count") / F.col("row_count")
    return found.withColumns({
        "null_rate": rate, "null_rate_violation": rate > rules.max_null_rate}).select(
        *[field.split()[0] for field in SCHEMA.split(", ")])
