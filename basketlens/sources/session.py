"""Session settings that the operators are designed for."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Mapping
from pathlib import Path

from pyspark.sql import SparkSession

RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join key even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(name: str, settings: Mapping[str, str] | None = None) -> SparkSession:
    """Reuse the running session or build one; never stops anything."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**RECOMMENDED, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def with_package(spark: SparkSession) -> SparkSession:
    """The session, with this package sent to its Python workers once."""
    context = spark.sparkContext
    if not getattr(context, "retail_package_sent", False):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as held:
            for module in sorted(package.rglob("*.py")):
                held.write(module, module.relative_to(package.parent))
        context.addPyFile(str(archive))
        context.retail_package_sent = True
    return spark
