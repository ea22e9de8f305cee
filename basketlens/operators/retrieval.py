"""BM25 retrieval over a table of documents, for many queries at once."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketlens.functions.text import tokens
from basketlens.sources.sinks import stored


@dataclass(frozen=True)
class Bm25:
    k1: float = 1.5
    b: float = 0.75
    limit: int = 4
    min_score: float = 0.0
    # Scores that differ only by the order of summation count as tied.
    tie_digits: int = 9


def tokenize(documents: DataFrame, key: str, text: str) -> DataFrame:
    """Tokens of every text in order of appearance, one row each."""
    return documents.select(key, F.posexplode(tokens(F.col(text))).alias("position", "term"))


def _body_tokens() -> Column:
    return tokens(F.concat_ws(" ", F.coalesce("text", F.lit("")), F.coalesce("title", F.lit(""))))


#: Parts into which each asked term's postings are dealt, as a term may be in most documents.
SALTS = 32


def postings(documents: DataFrame) -> DataFrame:
    """Term frequency per document, with the document's length, from one pass over the texts.

    The empty term, which no text holds, stands for the document itself once.
    """
    counted = documents.select("doc_id", _body_tokens().alias("terms")).select(
        "doc_id", F.size("terms").alias("length"),
        F.explode(F.concat(F.array(F.lit("")), F.col("terms"))).alias("term"))
    return counted.groupBy("doc_id", "term", "length").agg(
        F.count(F.lit(1)).alias("frequency"))


def stored_index(documents: DataFrame, name: str) -> DataFrame:
    """Postings written as they were counted, each file's rows of a term side by side.

    A term of many documents lies in all files, so no task holds it whole.  Ordering by a
    hash needs no comparison of texts, and leaves the rows of the empty term, which is less
    than all others, on pages of their own, so that readers skip the rest.
    """
    return stored(postings(documents).sortWithinPartitions(F.xxhash64("term")), name)


def collection_statistics(index: DataFrame) -> DataFrame:
    """Number of documents and mean length; one row."""
    return index.where("term = ''").agg(
        F.count(F.lit(1)).alias("documents"), F.avg("length").alias("average_length"))


def term_statistics(index: DataFrame) -> DataFrame:
    """Number of documents holding each term."""
    return index.where("term <> ''").groupBy("term").agg(
        F.count(F.lit(1)).alias("document_frequency"))


def search(documents: DataFrame, queries: DataFrame, settings: Bm25 = Bm25(),
           query_key: str = "item_id") -> DataFrame:
    """The best documents per query, from texts that are indexed for this search alone."""
    return search_index(postings(documents), queries, settings, query_key)


def search_index(index: DataFrame, queries: DataFrame, settings: Bm25 = Bm25(),
                 query_key: str = "item_id") -> DataFrame:
    """The best documents per query: score descending, then document key.

    Only asked terms take part, and a term's postings meet their queries in ``SALTS`` parts.
    The top-k filter on the rank lets every task keep only its k best rows per query
    ahead of the exchange, so a query matching most documents stays spread.
    """
    asked = (queries.select(F.col(query_key).alias("query_id"),
                            F.explode(tokens(F.col("text"))).alias("term"))
             .groupBy("query_id", "term").agg(F.count(F.lit(1)).alias("repeats")))
    collection = collection_statistics(index).select(
        F.struct("documents", "average_length")).scalar()
    total, mean_length = collection["documents"], F.greatest(
        collection["average_length"], F.lit(1.0))
    df = F.col("document_frequency")
    weighted = asked.join(term_statistics(index), "term").withColumn(
        "idf", F.ln(1 + (total - df + 0.5) / (df + 0.5))).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = index.where("term <> ''").withColumn(
        "salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)).cast("int"))
    tf, k1, b = F.col("frequency"), settings.k1, settings.b
    part = F.col("repeats") * F.col("idf") * tf * (k1 + 1) / (
        tf + k1 * (1 - b + b * F.col("length") / mean_length))
    scores = (dealt.join(weighted, ["term", "salt"]).groupBy("query_id", "doc_id")
              .agg(F.sum(part).alias("total"))
              .where((F.col("total") > 0) & (F.col("total") >= settings.min_score))
              .select("query_id", "doc_id", F.round("total", settings.tie_digits).alias("score")))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "doc_id")
    return scores.withColumn("place", F.row_number().over(best)).where(
        F.col("place") <= settings.limit)
