"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from basketlens.llm import (
    bpe, decontam, fingerprints, language, lm, mixing, near, private, quality, quotes, runs,
    toxicity, tries)
from basketlens.llm.store import shipped


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return shipped(spark).read.parquet(f"{folder}/{name}.parquet")


def fold(parts: int) -> Column:
    """Remainder of the CRC-32 of the id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % parts


def op1_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    """Base and further spans of personal data in every document."""
    documents = table(spark, folder, "documents")
    return private.personal_data(documents, private.train(documents))


def op2_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return fingerprints.fingerprints(table(spark, folder, "documents"))


def op3_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log probabilities of all documents, learned from four of five folds of the ids.

    Of the training documents, every tenth hash is held out while weights are learned.
    """
    part = F.when(fold(5) == 1, 0).when(F.pmod(F.xxhash64("doc_id"), F.lit(10)) == 0, 2).otherwise(1)
    return lm.scores(table(spark, folder, "documents"), part)


def op4_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that a mix of all documents takes of each, by source targets."""
    mixed = mixing.mix(table(spark, folder, "documents"), table(spark, folder, "labels"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Category probabilities of every document, and whether it is toxic."""
    documents = table(spark, folder, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, folder, "labels")))


def op6_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality score of every document, learned from two of three folds of the ids."""
    documents = table(spark, folder, "documents").withColumn("held_out", fold(3) == 1)
    model = quality.learn(documents.where(~F.col("held_out")),
                          table(spark, folder, "labels").where(fold(3) != 1))
    return quality.rate(documents, model)


def op7_language(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from three of four folds of the ids."""
    documents = table(spark, folder, "documents").withColumn("held_out", fold(4) == 2)
    return language.predict(documents, language.learn(documents.where(~F.col("held_out"))))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that benchmark windows hit, and the items."""
    return decontam.contamination(table(spark, folder, "documents"),
                                  table(spark, folder, "benchmark")).drop("items")


def op9_quotation_links(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as quoting replies, linked, ordered by reply and freed of quotes."""
    mail = quotes.as_mail(table(spark, folder, "conversations"), ["role"])
    return quotes.conversations(mail, ["role"]).select(
        F.col("scope").alias("conv_id"), "turn", "role", F.col("parent").alias("parent_turn"),
        F.col("root").alias("root_turn"), "depth", F.col("body").alias("text"))


def op10_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class, copy group and number of links of every document."""
    return near.near_classes(table(spark, folder, "documents"))


def with_planted_periods(documents: DataFrame) -> DataFrame:
    """Documents (doc_id, text) of which one in ten, by the CRC-32 of its id, was made periodic.

    Of n words, those from a = g % n on become the words a + (i - a) % p with
    p = 1 + floor((n - a) / (3 + g % 8)), where g is a tenth of the CRC-32.  A text under a null
    id is left as it is.
    """
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), 1)
    code = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g, n = F.floor(code / 10), F.size(words)
    planted = documents.select("doc_id", "text", F.when(
        code % 10 == 0, F.struct(words.alias("words"), (g % F.greatest(n, F.lit(1))).cast("int").alias("a"),
                                 (3 + g % 8).cast("int").alias("parts"))).alias("plan"))
    plan = planted["plan"]
    start, size = plan["a"], F.size(plan["words"])
    period = 1 + F.floor((size - start) / plan["parts"]).cast("int")
    rebuilt = F.array_join(F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.get(plan["words"], F.when(i < start, i).otherwise(
            start + (i - start) % period))), " ")
    return planted.select("doc_id", F.when(size > 0, rebuilt).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Periodic runs of every document, some made periodic, and the texts without repetitions."""
    found = runs.periodic_runs(with_planted_periods(table(spark, folder, "documents")))
    longest = F.array_max(F.transform("runs", lambda run: F.struct(
        run["length"].alias("length"), (-run["start"]).alias("before"),
        (-run["period"]).alias("shorter"))))
    listed = F.array_join(F.transform("runs", lambda run: F.concat_ws(
        ",", *[run[name].cast("string") for name in ("start", "length", "period")])), "\n")
    length, period = F.col("best")["length"], -F.col("best")["shorter"]
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best")["before"]).alias("start"), length.alias("length"), period.alias("period"),
        F.floor(1000 * length / period).alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(listed, F.lit("\n"))).otherwise(""), 256)
        .alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def op12_bpe(spark: SparkSession, folder: str, vocabulary: str | None = None) -> DataFrame:
    """Byte-level BPE tokens of every document and the text that they stand for."""
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoded = bpe.encode(table(spark, folder, "documents"), bpe.load(vocabulary), decoded=True)
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """All nodes of the trie of conversations that share their first turns in groups of 20."""
    head = F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4
    return tries.trie(*tries.with_shared_heads(table(spark, folder, "conversations"), 20, head))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_personal_data": op1_personal_data,
    "op2_fingerprints": op2_fingerprints,
    "op3_lm_scores": op3_lm_scores,
    "op4_mixing": op4_mixing,
    "op5_toxicity": op5_toxicity,
    "op6_quality": op6_quality,
    "op7_language": op7_language,
    "op8_decontamination": op8_decontamination,
    "op9_quotation_links": op9_quotation_links,
    "op10_jaccard_join": op10_jaccard_join,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_bpe": op12_bpe,
    "op13_prefix_trie": op13_prefix_trie,
}
