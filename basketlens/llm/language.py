"""Language identification by bit-sliced n-gram Bloom filters.

One table of bit slots serves all languages: the words at a slot have one bit per language,
64 to a word, so a look-up of an n-gram reads one row of words per hash, and their bitwise
AND says at once which languages hold it.  Per text and language the hits are counted
(popcounts of one bit's column), the share expected from false positives is taken off, and
the language with the largest corrected share wins.

Letter n-grams of all learned documents are counted by language, within tasks first.  A
language holds an n-gram that it shows at least ``LEAST_RATE`` times as often, relative to
its size, as the languages do on average, in ``LEAST_COUNT`` places or more and in at least
``LEAST_SHARE`` of its n-grams.  So a language holds at most 1 / ``LEAST_SHARE`` n-grams, and the
table, of which the driver gets the bits by slot, has a size set by the languages alone.

Defined results: a null text, or one without a letter, is ``und`` with score 0; documents
with a null lang, or without letters, teach nothing; ties go to the language that sorts
first; with nothing learned every text is ``und``; any number of languages is told apart,
for 8 MB of table and a pass over the hits of a text per 64 and per one of them; repeated
rows give a row each and count as often as they stand there; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.store import stored
from basketlens.llm.words import mixed, slices

GRAM = 4
SLOT_BITS = 20
HASHES = 2
#: Languages of one word of the table.
WORD = 64
LEAST_SHARE = 2.0 ** -18
#: Distinct n-grams of a task that are counted together before they are sent on.
COUNTED = 1 << 20
LEAST_RATE = 1.5
LEAST_COUNT = 3
UNDECIDED = "und"
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)
_LOWER[~_LETTER] = 32


def grams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The byte n-grams of each row as numbers, other characters as blanks; and their rows.

    N-grams of blanks only, and those across rows, are left out.
    """
    count = max(len(data) - GRAM + 1, 0)
    plain, total = _LOWER[data], np.zeros(count, np.uint64)
    letters = _LETTER[data]
    some = np.zeros(count, np.uint8)
    for place in range(GRAM):
        total = total << np.uint64(8) | plain[place:place + count]
        some += letters[place:place + count]
    keep = some >= 2
    for back in range(1, GRAM):
        at = bounds[1:-1] - back
        keep[at[(at >= 0) & (at < count)]] = False
    at = np.flatnonzero(keep)
    return total[at], np.searchsorted(bounds, at, side="right") - 1


def has_letter(text: str) -> bool:
    return any(c.isalpha() for c in text)


def _lettered(column: pa.Array, first: int, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which rows have a letter; only those without an ASCII letter are looked at singly."""
    ascii_letter = _LETTER[data] & (data < 128)
    sums = np.concatenate([[0], np.cumsum(ascii_letter)])
    known = sums[bounds[1:]] > sums[bounds[:-1]]
    for row in np.flatnonzero(~known & (np.diff(bounds) > 0)):
        known[row] = has_letter(column[first + int(row)].as_py())
    return known


def _count(batches: Iterator[pa.RecordBatch], languages: Sequence[str]) -> Iterator[pa.RecordBatch]:
    """A task's n-gram counts by language, sent on whenever there are many."""
    width, number = np.uint64(len(languages)), {name: i for i, name in enumerate(languages)}
    keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def batch_of() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array((keys // width).astype(np.int64)), pa.array((keys % width).astype(np.int32)),
             pa.array(counts)], names=["gram", "language", "seen"])

    for batch in batches:
        names = np.array([number[n] for n in batch.column(0).to_pylist()], np.uint64)
        for first, last, data, bounds in slices(batch.column(1)):
            found, rows = grams(data, bounds)
            new, times = np.unique(found * width + names[first + rows], return_counts=True)
            keys, place = np.unique(np.concatenate([keys, new]), return_inverse=True)
            counts = np.bincount(place, np.concatenate([counts, times]), len(keys)).astype(np.int64)
            if len(keys) > COUNTED:
                yield batch_of()
                keys, counts = keys[:0], counts[:0]
    yield batch_of()


@dataclass(frozen=True)
class LanguageFilters:
    """The languages, the bit-sliced table (words x slots), and each one's false-positive rate."""

    languages: tuple[str, ...]
    slots: np.ndarray
    false_rate: np.ndarray


def slots_of(grams: np.ndarray) -> list[np.ndarray]:
    """The slots of each n-gram, one array per hash."""
    return [(mixed(grams.astype(np.uint64), seed=40 + i) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
            for i in range(HASHES)]


def masks_of(slots: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Per word of languages, the bits of those that hold each n-gram."""
    first, *others = slots_of(grams)
    masks = slots[:, first]
    for places in others:
        masks &= slots[:, places]
    return masks


def _inserted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The slots, words and bits of (n-gram, language number) rows."""
    for batch in batches:
        held = batch.column(1).to_numpy()
        bits = pa.array((np.uint64(1) << (held % WORD).astype(np.uint64)).view(np.int64))
        for places in slots_of(batch.column(0).to_numpy()):
            yield pa.RecordBatch.from_arrays(
                [pa.array(places), pa.array(held // WORD, pa.int32()), bits], names=["slot", "word", "bits"])


def filters_of(languages: Sequence[str], slot: np.ndarray, word: np.ndarray,
               bits: np.ndarray) -> LanguageFilters:
    """The table from its words; a language's false-positive rate is its fill to the hashes."""
    slots = np.zeros(((len(languages) + WORD - 1) // WORD, 1 << SLOT_BITS), np.uint64)
    slots[word, slot] = bits.view(np.uint64)
    fill = np.array([float((slots[i // WORD] >> np.uint64(i % WORD) & np.uint64(1)).mean())
                     for i in range(len(languages))])
    return LanguageFilters(tuple(languages), slots, fill ** HASHES)


def telling_grams(counts: DataFrame, languages: int) -> DataFrame:
    """The (gram, language) rows that the filters hold, of (gram, language, seen)."""
    totals = counts.groupBy("language").agg(F.sum("seen").alias("total"))
    rated = (counts.join(F.broadcast(totals), "language")  # one row per language
             .withColumn("rate", F.col("seen") / F.col("total"))
             .withColumn("mean", F.sum("rate").over(Window.partitionBy("gram")) / languages))
    often = (F.col("seen") >= LEAST_COUNT) & (F.col("rate") >= LEAST_SHARE)
    telling = F.col("rate") >= LEAST_RATE * F.col("mean")
    return rated.where(often & telling if languages > 1 else often).select("gram", "language")


def learn(documents: DataFrame) -> LanguageFilters:
    """Filters from all rows of ``documents`` (text, lang)."""
    taught = (documents.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
              .select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text")))
    languages = sorted(r["lang"] for r in taught.select("lang").distinct().collect())
    if not languages:
        none = np.zeros(0, np.int64)
        return filters_of((), none, none, none)
    counts = stored(taught.mapInArrow(lambda batches: _count(batches, languages),
                                      "gram long, language int, seen long")
                    .groupBy("gram", "language").agg(F.sum("seen").alias("seen")))
    # One row per slot and word: at most the table itself, whatever the corpus.
    table = (telling_grams(counts, len(languages))
             .mapInArrow(_inserted, "slot long, word int, bits long")
             .groupBy("slot", "word").agg(F.bit_or("bits").alias("bits")).toArrow())
    return filters_of(languages, *[table.column(n).to_numpy() for n in ("slot", "word", "bits")])


def _predict(batches: Iterator[pa.RecordBatch], model: LanguageFilters) -> Iterator[pa.RecordBatch]:
    width = len(model.languages)
    names = pa.array([*model.languages, UNDECIDED], pa.string())
    for batch in batches:
        column = batch.column(2)
        for first, last, data, bounds in slices(column):
            count = last - first
            found, rows = grams(data, bounds)
            masks = masks_of(model.slots, found)
            edges = np.searchsorted(rows, np.arange(count + 1))
            total = np.diff(edges)
            share = np.zeros((count, max(width, 1)))
            for i in range(width):
                hits = np.concatenate([[0], np.cumsum(masks[i // WORD] >> np.uint64(i % WORD) & np.uint64(1),
                                                            dtype=np.int64)])
                held = hits[edges[1:]] - hits[edges[:-1]]
                rate = min(model.false_rate[i], 0.999)
                share[:, i] = np.clip((held / np.maximum(total, 1) - rate) / (1 - rate), 0, 1)
            best = share.argmax(1)
            top = share[np.arange(count), best]
            known = _lettered(column, first, data, bounds) & (width > 0)
            score = np.where(known, top / np.maximum(share.sum(1), 1e-12), 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, count), batch.column(1).slice(first, count),
                 names.take(pa.array(np.where(known, best, width))), pa.array(np.clip(score, 0, 1))],
                names=["doc_id", "held_out", "lang_pred", "score"])


def predict(documents: DataFrame, model: LanguageFilters) -> DataFrame:
    """doc_id, held_out, lang_pred and score; ``documents`` has doc_id, held_out and text."""
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"), "held_out",
                             F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda batches: _predict(batches, model),
                        "doc_id long, held_out boolean, lang_pred string, score double"))
