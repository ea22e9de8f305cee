"""Mixing sources to target weights by Efraimidis-Spirakis sampling, in DataFrame functions only.

A document's key is ``-ln(u) / weight`` with ``u`` uniform from the digest of its id and
``weight`` from its quality label: the smallest keys of a source are a weighted sample
without replacement.  A source first gives its documents in complete epochs; the rest of
its target is filled in key order by a prefix sum over sizes.

The prefix sum never orders a whole source in one task.  Keys map monotonically to
``BINS`` bins, sizes are summed per (source, bin) with map-side combining, and only the
documents of the one bin in which the target falls are ordered row by row.

Defined results: a null text has size 0; a null source is a source of its own, last in
order; repeated rows are documents of their own; documents of size 0 are never selected;
an empty table gives an empty result; other columns of the input are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.store import free_name, stored

WORD = r"[^\x20\x09-\x0D]+"
SOURCE_WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
BINS = 4_096
#: A source may hold most rows; each meets its plan in so many parts.
SALTS = 64
#: Sampling weight by quality label; documents without a label take the middle one.
QUALITY_WEIGHTS = {1: 2.0, 0: 0.5}
UNLABELLED_WEIGHT = 1.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column) -> Column:
    """A number in (0, 1) from the first 52 bits of the key's MD5."""
    digits = F.substring(F.md5(F.coalesce(key.cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)


def source_targets(sizes: DataFrame, repeats: int = MOST_REPEATS) -> DataFrame:
    """Target words per source: shares by weight, none above ``repeats`` times its size.

    ``sizes`` has one row per source (``source``, ``source_size``).  Resharing the excess
    until none is above ends where every target is the smaller of its cap and
    weight x level, with one level for all; sources are capped in order of cap / weight.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in SOURCE_WEIGHTS])
    weighted = sizes.withColumn(
        "weight", F.element_at(
            cycle, ((F.row_number().over(order) - 1) % len(SOURCE_WEIGHTS) + 1).cast("int")))
    capped = Window.orderBy((F.col("source_size") / F.col("weight")).asc(),
                            F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    before = capped.rowsBetween(Window.unboundedPreceding, -1)
    levels = (weighted
              .withColumn("total", F.sum("source_size").over(everything))
              .withColumn("open_weight", F.sum("weight").over(
                  capped.rowsBetween(Window.currentRow, Window.unboundedFollowing)))
              .withColumn("left", F.col("total") - repeats * F.coalesce(
                  F.sum("source_size").over(before), F.lit(0)))
              .withColumn("fits", F.col("left") * F.col("weight")
                          <= repeats * F.col("source_size") * F.col("open_weight"))
              .withColumn("first", F.min(F.when(F.col("fits"), F.struct(
                  F.row_number().over(capped), "left", "open_weight"))).over(everything)))
    level = F.col("weight") * F.col("first.left") / F.col("first.open_weight")
    cap = (repeats * F.col("source_size")).cast("double")
    return levels.select(
        "source", "source_size",
        F.when(F.col("first").isNull() | (cap <= level), cap).otherwise(level).alias("target"))


def mix(documents: DataFrame, quality: DataFrame, repeats: int = MOST_REPEATS) -> DataFrame:
    """How many words of each document the mix takes.

    ``documents`` has doc_id, text, source; ``quality`` has doc_id, quality (repeated ids
    count with their highest label).  Returns doc_id, size, source_size, target, taken and
    repeats, the number of times that the document is written.
    """
    labels = (quality.where(F.col("doc_id").isNotNull()).groupBy("doc_id")
              .agg(F.max("quality").alias("quality")))
    weight = F.coalesce(*[F.when(F.col("quality") == q, F.lit(w))
                          for q, w in QUALITY_WEIGHTS.items()], F.lit(UNLABELLED_WEIGHT))
    key = -F.log(uniform(F.col("doc_id"))) / weight
    sized = stored(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size"))
        .join(labels, "doc_id", "left")
        .select("doc_id", "source", "size", key.alias("key"))
        .withColumn("bin", F.floor((1 - F.exp(-F.col("key"))) * BINS).cast("int")))
    bins = stored(sized.groupBy("source", "bin").agg(F.sum("size").alias("words")))
    targets = stored(source_targets(
        bins.groupBy("source").agg(F.sum("words").alias("source_size")), repeats)
        .withColumn("epochs", F.when(F.col("source_size") > 0, F.floor(
            F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long"))
        .withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")))

    names = F.col("one.source").eqNullSafe(F.col("two.source"))
    ordered = Window.partitionBy("source").orderBy("bin")
    filled = (bins.withColumn("before", F.sum("words").over(ordered) - F.col("words")).alias("one")
              .join(targets.alias("two"), names)
              .where((F.col("before") < F.col("rest"))
                     & (F.col("before") + F.col("words") >= F.col("rest"))
                     & (F.col("words") > 0))
              .groupBy(F.col("one.source").alias("source"))
              .agg(F.min(F.struct("bin", "before")).alias("edge")))
    plan = (targets.alias("one").join(filled.alias("two"), names, "left")
            .select(F.col("one.source").alias("plan_source"), "source_size", "target", "epochs",
                    "rest", "edge",
                    F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("plan_salt")))
    salt = F.pmod(F.xxhash64("doc_id", "size"), F.lit(SALTS)).cast("int")
    placed = (sized.withColumn("salt", salt)
              .join(plan, F.col("source").eqNullSafe(F.col("plan_source"))
                    & (F.col("salt") == F.col("plan_salt")))
              .withColumn("at_edge", F.coalesce(F.col("bin") == F.col("edge.bin"), F.lit(False))))
    inside = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    reached = F.col("edge.before") + F.sum("size").over(
        inside.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # The document at the target is taken if that comes nearer to it than leaving it out.
    edge = (placed.where("at_edge")
            .withColumn("extra", (reached - F.col("size") / 2 <= F.col("rest")).cast("long")))
    others = placed.where(~F.col("at_edge")).withColumn(
        "extra", F.coalesce(F.col("bin") < F.col("edge.bin"), F.lit(False)).cast("long"))
    times = F.least(F.col("epochs") + F.when(F.col("size") > 0, F.col("extra")).otherwise(F.lit(0)),
                    F.lit(repeats).cast("long"))
    return (edge.unionByName(others)
            .select("doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
                    (F.col("size") * times).alias("taken"), times.alias("repeats")))


def write_out(documents: DataFrame, quality: DataFrame, repeats: int = MOST_REPEATS) -> DataFrame:
    """The mixed documents themselves, each as often as the mix takes it, with all columns.

    Rows that share a doc_id are taken as one: as often as the first of them.
    """
    mixed_id, times = (free_name(documents, name) for name in ("mixed_id", "mix_repeats"))
    chosen = (mix(documents, quality, repeats).where("repeats > 0")
              .groupBy(F.col("doc_id").alias(mixed_id)).agg(F.max("repeats").alias(times)))
    return (documents.join(chosen, F.col("doc_id").eqNullSafe(F.col(mixed_id)))
            .withColumn(free_name(documents, "mix_copy"),
                        F.explode(F.sequence(F.lit(1).cast("long"), F.col(times))))
            .drop(mixed_id, times))
