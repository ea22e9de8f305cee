"""Writers, and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence
from hashlib import md5

from pyspark.sql import DataFrame, SparkSession


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> dict:
    """Overwrite a table and report its rows, which the written files' footers state.

    (An observed metric would do too, but a session that has observed one can
    no longer serialize fitted classifiers of Spark 4.1.)
    """
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path).count()
    return {"path": path, "rows": rows, "schema": df.schema.json()}


def write_json_report(report: DataFrame, path: str) -> None:
    """Write a report of a few rows as one JSON file."""
    report.coalesce(1).write.mode("overwrite").json(path)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; local sessions without one get a scratch folder."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get(
            "spark.checkpoint.dir", None)
        if folder is None:
            if not context.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            folder = tempfile.mkdtemp(prefix="basketlens-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call has."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def state_of(spark: SparkSession, folder: str) -> str:
    """A digest of a folder's files: paths, lengths and times of change."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    listing = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(path, True)
    found = []
    while listing.hasNext():
        status = listing.next()
        found.append(f"{status.getPath()}:{status.getLen()}:{status.getModificationTime()}")
    return md5("\n".join(sorted(found)).encode()).hexdigest()


def stored(df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write a table that many plans read below the shared folder, and read it from there.

    Unlike a checkpoint it is columnar, so readers prune partitions and columns
    and skip row groups by their filters.
    """
    path = f"{shared_folder(df.sparkSession)}/{name}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path).select(*df.columns)


def stable(df: DataFrame) -> DataFrame:
    """Compute a frame once and keep it in the shared folder.

    Used where several jobs read the same intermediate: the result survives
    lost executors and later jobs do not repeat the work behind it.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
