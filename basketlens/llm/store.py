"""Intermediate tables in the shared folder, so that lost executors cost a reread only."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a scratch folder for local sessions without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(frame: DataFrame) -> DataFrame:
    """``frame`` written as Parquet below the shared folder and read back."""
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/llm-{uuid.uuid4().hex}"
    frame.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def hashed_sample(frame: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """The ``rows`` rows of least hash of ``key``, or all of a smaller frame.

    Of a larger one only the share of hashes that holds them with room to spare is ordered,
    so that the one task that orders sees some more than ``rows`` rows, not some of each task.
    """
    count = frame.count()
    place = (F.xxhash64(key).cast("double") + 2.0 ** 63) / 2.0 ** 64
    if count > rows:
        share = (rows + 6 * rows ** 0.5 + 20) / count
        frame = frame.where(place <= share)
    return frame.orderBy(F.xxhash64(key), key).limit(rows)


def one_text_each(frame: DataFrame) -> DataFrame:
    """(doc_id, text) with the text of least hash of each id, combined on the map side."""
    return (frame.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text"), F.col("text"))).alias("least"))
            .select("doc_id", F.col("least.text").alias("text")))


#: Bytes of a batch that goes to a Python worker, where the session sets no other bound.
BATCH_BYTES = 8 << 20


def bounded_batches(spark: SparkSession) -> SparkSession:
    """The session, with Arrow batches bounded by bytes unless it bounds them itself.

    Long texts come by the thousand in batches of rows; each batch is held by the executor
    and by its worker at once, so whole documents are passed in small ones.
    """
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(bound, None) is None:
        spark.conf.set(bound, str(BATCH_BYTES))
    return spark


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, lengthened until ``frame`` has no column of that name in any case."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shipped(spark: SparkSession) -> SparkSession:
    """The session, with this package's modules sent to its Python workers once."""
    context = spark.sparkContext
    if not getattr(context, "llm_package_sent", False):
        package = Path(__file__).resolve().parent.parent
        archive = Path(tempfile.mkdtemp(prefix="llm-")) / f"{package.name}.zip"
        with zipfile.ZipFile(archive, "w") as held:
            for module in sorted(package.rglob("*.py")):
                held.write(module, module.relative_to(package.parent))
        context.addPyFile(str(archive))
        context.llm_package_sent = True
    return spark
