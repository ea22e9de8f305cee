"""Split documents at headings and pack paragraphs into chunks of bounded length."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

MAX_CHARS = 1400
_EDGES = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def _strip(text: Column) -> Column:
    return F.regexp_replace(text, _EDGES, "")


def _pieces(paragraph: Column, size: int) -> Column:
    """Cut one text into consecutive pieces of a fixed length."""
    count = F.ceil(F.length(paragraph) / size).cast("int")
    return F.transform(F.sequence(F.lit(0), count - 1),
                       lambda i: F.substring(paragraph, i * size + 1, F.lit(size)))


def _pack(section: Column, size: int) -> Column:
    """Pack the paragraphs of an oversize section in their order.

    The fold keeps finished chunks and one open chunk.  A paragraph that does
    not fit closes the open chunk; one that is itself oversize is cut up.
    """
    empty = F.array().cast("array<string>")
    start = F.struct(empty.alias("done"), F.lit("").alias("open"))

    def step(state: Column, paragraph: Column) -> Column:
        fits = (state["open"] == "") | (
            F.length(state["open"]) + F.length(paragraph) + 2 <= size)
        closed = F.when(fits, state["done"]).otherwise(
            F.concat(state["done"], F.array(state["open"])))
        kept = F.when(fits, state["open"]).otherwise("")
        oversize = F.length(paragraph) > size
        return F.struct(
            F.when(oversize, F.concat(closed, _pieces(paragraph, size))).otherwise(closed)
            .alias("done"),
            F.when(oversize, kept).otherwise(
                _strip(F.concat(kept, F.lit("\n\n"), paragraph))).alias("open"))

    packed = F.aggregate(F.split(section, "\n\n"), start, step)
    return F.when(packed["open"] == "", packed["done"]).otherwise(
        F.concat(packed["done"], F.array(packed["open"])))


def chunk_documents(documents: DataFrame, size: int = MAX_CHARS, key: str = "doc_id",
                    category: str | None = None) -> DataFrame:
    """One row per chunk: id, title, source, category and text, in document order.

    Every line that opens with ``#`` starts a section.  A section within the
    bound is one chunk; a longer one is packed by paragraph.
    """
    if size < 1:
        raise ValueError("chunk size must be positive")
    lines = F.regexp_replace("text", r"\R|[\x1c-\x1e]", "\n")
    sections = F.transform(F.split(lines, "\n(?=#)"), _strip)
    chunks = F.flatten(F.transform(sections, lambda section: F.when(
        F.length(section) > size, _pack(section, size))
        .when(section == "", F.array().cast("array<string>"))
        .otherwise(F.array(section))))
    heading = F.regexp_extract("chunk_text", r"(?m)^(#.*)$", 1)
    title = F.when(heading == "", F.col("title")).otherwise(
        _strip(F.regexp_replace(heading, "^[# ]+", "")))
    kind = F.lit(category).cast("string") if category is None or category not in documents.columns \
        else F.col(category)
    return documents.select(
        key, F.col("title"), kind.alias("category"),
        F.posexplode(chunks).alias("chunk_index", "chunk_text")).select(
        key, F.concat_ws("-", F.col(key).cast("string"), "chunk_index").alias("chunk_id"),
        "chunk_index", title.alias("chunk_title"), F.col("title").alias("source"), "category",
        F.col("chunk_text").alias("text"))
