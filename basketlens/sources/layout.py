"""Tables stored along a space-filling curve over days and keys, with each file's days.

A file holds a stretch of days of a part of the keys, so a window of days opens a small
share of the files, while a crowded day still splits by key and a hot key by day.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from basketlens.functions.days import between_days
from basketlens.sources.sinks import stored

#: Bits of each of the two coordinates.
CURVE_BITS = 16
#: A task sorts the rows of one file, which fit its memory.
ROWS_A_FILE = 1_000_000


def curve_place(day: Column, key: Column, first: int, last: int) -> Column:
    """Place on the curve: the bits of the day within its range and of the key's hash in turn.

    The day comes first in each pair of bits; null days lie at the beginning.
    """
    steps = 1 << CURVE_BITS
    scaled = F.coalesce(F.floor((day - F.lit(first)) * F.lit(steps) / F.lit(last - first + 1)),
                        F.lit(0)).cast("long")
    spread = F.shiftrightunsigned(F.xxhash64(key), 64 - CURVE_BITS)

    def apart(value: Column) -> Column:
        """The bits of a coordinate with a zero before each."""
        for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
            value = value.bitwiseOR(F.shiftleft(value, shift)).bitwiseAND(F.lit(mask).cast("long"))
        return value

    return F.shiftleft(apart(scaled), 1).bitwiseOR(apart(spread))


@dataclass(frozen=True)
class ClusteredTable:
    """A stored table, and one row (file, low, high, rows) of days for each of its files."""

    rows: DataFrame
    files: DataFrame
    day: str

    def files_between(self, lower: int | None, upper: int) -> list[str]:
        """The files that hold a day in ``[lower, upper)``: at most as many as there are files."""
        overlap = F.col("low") < upper if lower is None else (
            (F.col("low") < upper) & (F.col("high") >= lower))
        return [row.file for row in self.files.where(overlap).select("file").sort("file").collect()]

    def between(self, lower: int | None, upper: int) -> DataFrame:
        """The rows of ``[lower, upper)``, from the files that hold any."""
        paths = self.files_between(lower, upper)
        if not paths:
            return self.rows.limit(0)
        reader = self.rows.sparkSession.read.schema(self.rows.schema)
        return reader.parquet(*paths).where(between_days(F.col(self.day), lower, upper))


@dataclass(frozen=True)
class Extent:
    """Days that hold all of a table's, and about how many rows it has."""

    first: int | None
    last: int | None
    rows: int


def store_clustered(df: DataFrame, name: str, day: str, key: str, rows_a_file: int = ROWS_A_FILE,
                    extent: Extent | None = None) -> ClusteredTable:
    """Write ``df`` in ranges of the curve, sorted by day inside, with the days of its files.

    Ranges are balanced by rows.  Runs the jobs that count, write and read the days; a known
    ``extent`` saves the count, which builds ``df`` once more.
    """
    ends = extent or df.agg(F.min(day).alias("first"), F.max(day).alias("last"),
                            F.count(F.lit(1)).alias("rows")).first()
    files = max(df.sparkSession.sparkContext.defaultParallelism, -(-ends.rows // rows_a_file))
    place = curve_place(F.col(day), F.col(key), ends.first or 0, ends.last or 0)
    # The rest of a row tells the many lines of a key and a day apart.
    kept = stored(df.repartitionByRange(files, place, day, key, F.xxhash64(*df.columns))
                  .sortWithinPartitions(day, key), name)
    days = kept.select("_metadata.file_path", day).groupBy(F.col("file_path").alias("file")).agg(
        F.min(day).alias("low"), F.max(day).alias("high"), F.count(F.lit(1)).alias("rows"))
    return ClusteredTable(kept, stored(days.coalesce(1), f"{name}-days"), day)
