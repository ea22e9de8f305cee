import random

import pytest
from pyspark.sql import functions as F

from basketlens.sources.layout import CURVE_BITS, Extent, curve_place, store_clustered


@pytest.fixture(scope="module")
def lines(spark):
    """Four years of lines; one household and one day hold many of them."""
    rng = random.Random(2)
    rows = [(rng.randrange(1461) if i % 5 else 700, 7 if i % 3 == 0 else rng.randrange(3000), i)
            for i in range(30_000)]
    return spark.createDataFrame(rows, "DAY int, household_key long, line int")


def bits(value):
    return [value >> i & 1 for i in range(CURVE_BITS)]


def test_the_curve_takes_bits_in_turn(spark):
    rows = spark.createDataFrame([(d, k) for d in (0, 1, 5, 99) for k in range(20)], "d int, k long")
    steps = 1 << CURVE_BITS
    for row in rows.select("d", "k", curve_place(F.col("d"), F.col("k"), 0, 99).alias("place"),
                           F.xxhash64("k").alias("hash")).collect():
        day, key = row.d * steps // 100, (row.hash % 2**64) >> (64 - CURVE_BITS)
        assert row.place == sum(b << (2 * i + 1) for i, b in enumerate(bits(day))) + sum(
            b << (2 * i) for i, b in enumerate(bits(key)))


def test_a_window_opens_a_small_share_of_the_files(lines):
    table = store_clustered(lines, "layout-test/lines", "DAY", "household_key", rows_a_file=300)
    files = table.files.collect()
    assert len(files) > 80 and sum(f.rows for f in files) == 30_000
    assert max(f.rows for f in files) < 4 * 300
    for lower, upper in ((100, 130), (1300, 1330), (0, 30)):
        found = table.between(lower, upper)
        assert len(found.inputFiles()) < 0.2 * len(files)
        expected = lines.where(f"DAY >= {lower} AND DAY < {upper}")
        assert found.exceptAll(expected).count() == 0 and found.count() == expected.count()
    # A day that holds a fifth of all lines still lies in many files.
    assert len(table.files_between(700, 701)) > 10
    assert table.between(None, 50).count() == lines.where("DAY < 50").count()
    assert table.between(5000, 5030).count() == 0
    assert table.rows.count() == 30_000


def test_nothing_to_store(lines):
    table = store_clustered(lines.limit(0), "layout-test/none", "DAY", "household_key")
    assert table.rows.count() == 0 and table.between(0, 10).count() == 0


def test_a_known_extent_saves_a_pass(spark, lines):
    """The table is built once for the range bounds, once for the exchange, not for a count."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    passed = lines.mapInArrow(counted, lines.schema)
    table = store_clustered(passed, "layout-test/extent", "DAY", "household_key", rows_a_file=300,
                            extent=Extent(-5, 1500, 31_000))
    assert seen.value <= 2 * 30_000
    assert table.rows.exceptAll(lines).count() == 0 and table.rows.count() == 30_000
    assert table.between(100, 130).count() == lines.where("DAY >= 100 AND DAY < 130").count()
