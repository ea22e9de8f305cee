"""Text expressions: tokens, stop words, identifiers inside questions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The stop words that the retrieval scores leave out.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "at", "be", "by", "can", "did", "do", "does", "for", "from",
    "had", "has", "have", "how", "i", "in", "is", "it", "me", "of", "on", "or", "our", "the",
    "this", "to", "was", "we", "what", "when", "where", "which", "who", "why", "with", "would",
    "you",
)


def tokens(text: Column) -> Column:
    """Lower-case ASCII word tokens in order of appearance, without stop words."""
    words = F.regexp_extract_all(F.lower(text), F.lit("([a-z0-9_]+)"), F.lit(1))
    return F.filter(words, lambda word: ~word.isin(*STOP_WORDS))


def is_blank(value: Column) -> Column:
    return value.isNull() | (F.trim(value.cast("string")) == "")


# What casts accept is told by patterns first: a cast that fails raises and catches an error,
# which takes some 20 microseconds a value.
_EDGE = r"[\x00-\x20\x7f]*"
_INTEGER = rf"^{_EDGE}[-+]?0*[0-9]{{1,19}}{_EDGE}$"
_NUMBER = (rf"^{_EDGE}[-+]?(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][-+]?[0-9]+)?[fFdD]?"
           rf"|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][-+]?[0-9]+[fFdD]?|(?i:nan|inf(?:inity)?)){_EDGE}$")


def as_integer(value: Column) -> Column:
    """``try_cast`` of text to bigint, which does not fail on words."""
    return F.when(value.rlike(_INTEGER), value.try_cast("bigint"))


def as_number(value: Column) -> Column:
    """``try_cast`` of text to double, which does not fail on words."""
    return F.when(value.rlike(_NUMBER), value.try_cast("double"))
