"""The SQL reports, run against registered views."""

from __future__ import annotations

from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SQL_FOLDER = Path(__file__).resolve().parent.parent / "sql"


def run_report(spark: SparkSession, name: str, tables: Mapping[str, DataFrame]) -> DataFrame:
    """Run a report over the given tables, without registering session-wide views.

    Only tables that the report names are looked up, as a lookup may build and store one.
    """
    text = (SQL_FOLDER / f"{name}.sql").read_text()
    return spark.sql(text, **{key: tables[key] for key in tables if "{" + key + "}" in text})
