"""Benchmark decontamination by winnowing.

A window is 13 consecutive item words; an item of fewer words, but not none, is one
window.  Both sides keep the least 7-gram hash of every 13-word stretch (7 grams of 7
words), so a shared window shares its fingerprint, and extending a shared gram by at most
6 equal words either way covers every shared window that the gram is the fingerprint of.
Items of 1 to 12 words are matched through grams of their own length, none of which is
left out.

Documents are read once.  A Bloom filter of fixed size over the benchmark's fingerprints
drops, in the scan's task, the document fingerprints that no item has; it only saves
shuffle, and with a benchmark too large for it every fingerprint would go to the join.
What passes is joined to the items' fingerprints by hash and extended by comparing the
neighbouring word hashes that both sides carry.

Defined results: null texts have no words; repeated rows give a row each; a null item_id
is not listed; items with equal texts all count; an empty benchmark leaves every document
clean; other columns of the inputs are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.store import free_name
from basketlens.llm.words import ALPHANUMERIC, gram_hashes, mixed, slices, whole_grams, word_hashes

WINDOW_WORDS = 13
GRAM_WORDS = 7
MARGIN = WINDOW_WORDS - GRAM_WORDS
#: A document is contaminated from one hit word in so many words on.
CONTAMINATED_SHARE = 20
FILTER_BITS = 22

_FOUND = pa.list_(pa.struct([("hash", pa.int64()), ("at", pa.int64()), ("room", pa.int32()),
                             ("around", pa.binary())]))
_FOUND_DDL = "array<struct<hash: long, at: long, room: int, around: binary>>"


def fingerprints(words: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of the least gram of every window within a row, once each."""
    grams = gram_hashes(words, GRAM_WORDS)
    windows = whole_grams(bounds, WINDOW_WORDS)
    if not len(windows):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = len(grams) - MARGIN
    least, where = grams[:count].copy(), np.zeros(count, np.int64)
    for step in range(1, MARGIN + 1):
        here = grams[step:step + count]
        lower = here < least
        least[lower] = here[lower]
        where[lower] = step
    at = windows + where[windows]
    at = at[np.append(True, at[1:] != at[:-1])]
    at = np.unique(at)
    return grams[at], at


def _surrounding(words: np.ndarray, bounds: np.ndarray, at: np.ndarray, length: int
                 ) -> tuple[list[bytes], np.ndarray]:
    """Word hashes around each gram, within its row, and how many of them come before it."""
    row = np.searchsorted(bounds, at, side="right") - 1
    low = np.maximum(at - MARGIN, bounds[row])
    high = np.minimum(at + length + MARGIN, bounds[row + 1])
    return [words[a:b].tobytes() for a, b in zip(low, high)], (at - low).astype(np.int32)


def _marks(words: np.ndarray, bounds: np.ndarray, lengths: list[int]
           ) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Fingerprints, then all grams of each short length: hashes, positions, length."""
    hashes, at = fingerprints(words, bounds)
    yield mixed(hashes, seed=100 + WINDOW_WORDS), at, GRAM_WORDS
    for length in lengths:
        at = whole_grams(bounds, length)
        yield mixed(gram_hashes(words, length)[at], seed=100 + length), at, length


def _slots(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64((1 << FILTER_BITS) - 1)
    return hashes & mask, (hashes >> np.uint64(32)) & mask


def _item_marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Fingerprints of items; a short item's only gram is all its words."""
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(1)):
            words, _, _, bounds = word_hashes(data, offsets, ALPHANUMERIC)
            counts = np.diff(bounds)
            short = sorted({int(n) for n in counts if 0 < n < WINDOW_WORDS})
            rows: list[list] = [[], [], [], [], []]
            for i, (hashes, at, length) in enumerate(_marks(words, bounds, short)):
                row = np.searchsorted(bounds, at, side="right") - 1
                if i:
                    own = counts[row] == length
                    hashes, at, row = hashes[own], at[own], row[own]
                around, before = _surrounding(words, bounds, at, length)
                rows[0] += row.tolist()
                rows[1] += hashes.view(np.int64).tolist()
                rows[2] += before.tolist()
                rows[3] += around
                rows[4] += [length if i else 0] * len(at)
            ids = batch.column(0).slice(first, last - first)
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(rows[0], pa.int64())), pa.array(rows[1], pa.int64()),
                 pa.array(rows[2], pa.int32()), pa.array(rows[3], pa.binary()),
                 pa.array(rows[4], pa.int32())],
                names=["item_id", "item_hash", "item_room", "item_around", "short"])


def _filter_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One partial Bloom filter per task."""
    bits = np.zeros(1 << FILTER_BITS, bool)
    for batch in batches:
        for slot in _slots(batch.column(0).to_numpy().view(np.uint64)):
            bits[slot] = True
    yield pa.RecordBatch.from_arrays([pa.array([np.packbits(bits).tobytes()], pa.binary())],
                                     names=["bits"])


def _merge_filters(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for batch in batches:
        for one in batch.column(0):
            total |= np.frombuffer(one.as_py(), np.uint8)
    yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["bits"])


def _scan(batches: Iterator[pa.RecordBatch], packed: bytes, lengths: list[int]
          ) -> Iterator[pa.RecordBatch]:
    bits = np.unpackbits(np.frombuffer(packed, np.uint8)).astype(bool)
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(2)):
            words, _, _, bounds = word_hashes(data, offsets, ALPHANUMERIC)
            owner, found = [], [[], [], [], []]
            for hashes, at, length in _marks(words, bounds, lengths):
                one, two = _slots(hashes)
                keep = bits[one]
                keep[keep] = bits[two[keep]]
                hashes, at = hashes[keep], at[keep]
                around, before = _surrounding(words, bounds, at, length)
                row = np.searchsorted(bounds, at, side="right") - 1
                owner.append(row)
                found[0].append(hashes.view(np.int64))
                found[1].append(at - bounds[row])
                found[2].append(before)
                found[3] += around
            order = np.argsort(owner := np.concatenate(owner), kind="stable")
            entries = pa.StructArray.from_arrays(
                [pa.array(np.concatenate(x)[order]) for x in found[:3]]
                + [pa.array(found[3], pa.binary()).take(pa.array(order))],
                fields=list(_FOUND.value_type))
            starts = np.searchsorted(owner[order], np.arange(last - first + 1)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first),
                 batch.column(1).slice(first, last - first), pa.array(np.diff(bounds)),
                 pa.ListArray.from_arrays(pa.array(starts), entries)],
                names=["row", "doc_id", "n_words", "found"])


def _agreeing(mine: list[np.ndarray], theirs: list[np.ndarray]) -> np.ndarray:
    """How many leading words agree, pair by pair."""
    count = np.zeros(len(mine), np.int64)
    for i, (a, b) in enumerate(zip(mine, theirs)):
        n = min(len(a), len(b))
        differ = np.flatnonzero(a[:n] != b[:n])
        count[i] = differ[0] if len(differ) else n
    return count


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Word ranges of shared windows from joined fingerprints; ``start`` is null for none."""
    for batch in batches:
        columns = {n: batch.column(n) for n in batch.schema.names}
        met = np.flatnonzero(columns["item_around"].is_valid())
        start, stop = np.full((2, batch.num_rows), -1, np.int64)
        sides = {"mine": ("around", "room"), "theirs": ("item_around", "item_room")}
        before, after = {}, {}
        for side, (around, room) in sides.items():
            held = [np.frombuffer(x.as_py(), np.uint64) for x in columns[around].take(pa.array(met))]
            rooms = columns[room].take(pa.array(met)).to_pylist()
            before[side] = [h[:r][::-1] for h, r in zip(held, rooms)]
            after[side] = [h[r:] for h, r in zip(held, rooms)]
        left = _agreeing(before["mine"], before["theirs"])
        right = _agreeing(after["mine"], after["theirs"])
        short = columns["short"].take(pa.array(met)).to_numpy(zero_copy_only=False).astype(np.int64)
        at = columns["at"].take(pa.array(met)).to_numpy(zero_copy_only=False)
        whole = np.where(short > 0, right >= short, left + right >= WINDOW_WORDS)
        good = met[whole]
        start[good] = np.where(short > 0, at, at - left)[whole]
        stop[good] = np.where(short > 0, at + short, at + right)[whole]
        none = start < 0
        yield pa.RecordBatch.from_arrays(
            [columns["row"], columns["doc_id"], columns["n_words"], columns["item_id"],
             pa.array(start, mask=none), pa.array(stop, mask=none)],
            names=["row", "doc_id", "n_words", "item_id", "start", "stop"])


def contamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Per document the words hit by benchmark windows and the items that they are of.

    Returns doc_id, n_words, n_hit, n_items, items (sorted item_ids as strings),
    items_sha256 and contaminated.
    """
    marks = (benchmark.select("item_id", F.col("text").cast("string"))
             .mapInArrow(_item_marks, "item_id {}, item_hash long, item_room int, item_around binary, "
                         "short int".format(benchmark.schema["item_id"].dataType.simpleString())))
    # Fixed sizes: one filter of 2**FILTER_BITS bits, and at most 12 lengths of short items.
    partial = marks.select("item_hash").mapInArrow(_filter_words, "bits binary")
    packed = partial.coalesce(1).mapInArrow(_merge_filters, "bits binary").first()["bits"]
    lengths = [r["short"] for r in marks.where("short > 0").select("short").distinct().collect()]
    scanned = documents.select(
        F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string")).mapInArrow(
            lambda batches: _scan(batches, packed, sorted(lengths)),
            f"row long, doc_id long, n_words long, found {_FOUND_DDL}")
    # Rows without a hit keep a hash of their own, so that they spread over the join's tasks.
    points = (scanned.select("row", "doc_id", "n_words", F.explode_outer("found").alias("f"))
              .select("row", "doc_id", "n_words", F.col("f.at").alias("at"),
                      F.col("f.room").alias("room"), F.col("f.around").alias("around"),
                      F.coalesce(F.col("f.hash"), F.xxhash64("row")).alias("hash"),
                      F.col("f").isNotNull().alias("marked")))
    item_side = marks.distinct()
    extended = (points.join(item_side, F.col("marked") & (F.col("hash") == F.col("item_hash")), "left")
                .select("row", "doc_id", "n_words", "item_id", "at", "room", "around",
                        "item_room", "item_around", "short")
                .mapInArrow(_extend, "row long, doc_id long, n_words long, item_id {}, start long, "
                            "stop long".format(
                                benchmark.schema["item_id"].dataType.simpleString())))
    name = F.when(F.col("start").isNotNull(), F.col("item_id").cast("string"))
    ranges = (extended.groupBy("row", "start", "stop")
              .agg(F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
                   F.collect_set(name).alias("names")))
    earlier = (Window.partitionBy("row").orderBy("start", "stop")
               .rowsBetween(Window.unboundedPreceding, -1))
    fresh = ranges.withColumn("from", F.greatest(
        "start", F.coalesce(F.max("stop").over(earlier), F.lit(0).cast("long"))))
    result = (fresh.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.coalesce(F.sum(F.greatest(F.col("stop") - F.col("from"), F.lit(0))),
                   F.lit(0)).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("names")))).alias("items")))
    return result.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        ((F.col("n_hit") > 0) & (CONTAMINATED_SHARE * F.col("n_hit") >= F.col("n_words")))
        .alias("contaminated"), "items")


def without_contaminated(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, that are not contaminated, each judged by its own text."""
    key = F.xxhash64(F.col("doc_id").cast("long"), F.col("text"))
    judged = contamination(documents.select(key.alias("doc_id"), "text"), benchmark)
    name = free_name(documents, "bad_key")
    bad = judged.where("contaminated").select(F.col("doc_id").alias(name)).distinct()
    return documents.withColumn(name, key).join(bad, name, "left_anti").drop(name)
