"""CSV, Parquet and JSON readers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import PurePosixPath

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

CORRUPT = "_corrupt_record"

CSV_OPTIONS = {
    "header": "true", "mode": "PERMISSIVE", "encoding": "UTF-8", "quote": '"', "escape": '"',
    "columnNameOfCorruptRecord": CORRUPT,
}


def csv_listing(spark: SparkSession, root: str) -> DataFrame:
    """CSV files below a folder, extension in any case; file contents are not read."""
    return (spark.read.format("binaryFile")
            .option("recursiveFileLookup", True)
            .option("pathGlobFilter", "*.[cC][sS][vV]")
            .load(root).select("path", "length").orderBy("path"))


def read_csv(spark: SparkSession, path: str, schema: StructType | None = None,
             columns: Sequence[str] | None = None,
             options: Mapping[str, str] | None = None) -> DataFrame:
    """Read CSV by contract, or with inferred types when no schema is given.

    With a schema, malformed lines keep their text in ``_corrupt_record``.
    """
    reader = spark.read.options(**{**CSV_OPTIONS, **(options or {})})
    if schema is None:
        df = reader.option("inferSchema", True).csv(path)
    else:
        with_corrupt = StructType([*schema.fields, StructField(CORRUPT, StringType())])
        df = reader.schema(with_corrupt).csv(path)
    return df.select(*columns) if columns else df


def read_csv_text(spark: SparkSession, path: str,
                  options: Mapping[str, str] | None = None) -> DataFrame:
    """Read every column as text, so malformed tokens stay visible to checks."""
    return (spark.read.options(**{**CSV_OPTIONS, **(options or {})})
            .option("inferSchema", False).csv(path))


def read_csv_tables(spark: SparkSession, root: str,
                    schemas: Mapping[str, StructType] | None = None,
                    options: Mapping[str, str] | None = None) -> dict[str, DataFrame]:
    """One DataFrame per CSV file, by file stem; two files of one stem are an error."""
    tables: dict[str, DataFrame] = {}
    for row in csv_listing(spark, root).select("path").toLocalIterator():
        stem = PurePosixPath(row.path).stem
        if stem in tables:
            raise ValueError(f"two CSV files share the name {stem!r}")
        tables[stem] = read_csv(spark, row.path, (schemas or {}).get(stem), options=options)
    return tables


def read_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def read_optional_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A supplemental dimension: a missing file reads as an empty table."""
    try:
        return read_csv(spark, path, schema).drop(CORRUPT)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_json_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("multiLine", True).json(path)


def register_views(tables: Mapping[str, DataFrame]) -> None:
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def literal_rows(spark: SparkSession, rows: Sequence[tuple],
                 schema: StructType | str) -> DataFrame:
    """A small dimension from parameters, with its schema stated."""
    return spark.createDataFrame(list(rows), schema)
