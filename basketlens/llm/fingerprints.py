"""Document fingerprints by content-defined chunking.

A gear hash of the last 32 bytes decides where a chunk may end: with a strict mask up to
the normal size and a loose one beyond it, which draws chunk sizes together.  Boundaries
depend on nearby bytes only, so after an edit the chunks fall into step again.  A text's
fingerprint is the set of its chunk digests with their lengths; the share of its bytes in
chunks that another text also has measures containment.

Chunks have 32 to 256 bytes, so that a hash's 32 bytes always lie within the chunk.  The
next document is found without ordering the table in one task: documents are dealt into
ranges of ids, and the first of each range also goes to the range before it as a guest.

Defined results: a null text is empty; two empty texts are alike (1), an empty and another
one are not (0); documents without id come first; rows of one id are ordered by text and
count as documents; the document after the last is the first, its own if it is alone;
other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.words import SLICE_BYTES, mixed, slices, span_hashes

LEAST, NORMAL, MOST = 32, 64, 256
STRICT_BITS, LOOSE_BITS = 6, 4
#: Documents of one range, about 10 MB of text.
RANGE_ROWS = 3_000
_GEAR = np.random.default_rng(4_096).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """Sum of gear[byte] << distance over the last 32 bytes, by doubling the span."""
    hashes = _GEAR[data]
    for shift in (1, 2, 4, 8, 16):
        later = hashes[shift:] + (hashes[:-shift] << np.uint32(shift))
        hashes = np.concatenate([hashes[:shift], later])
    return hashes


def chunk_ends(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks of all rows, and the rows' offsets among them."""
    hashes = gear_hashes(data)
    loose = np.flatnonzero(hashes >> np.uint32(32 - LOOSE_BITS) == 0) + 1
    strict = loose[hashes[loose - 1] >> np.uint32(32 - STRICT_BITS) == 0].tolist()
    loose, ends, at = loose.tolist(), [], [0]
    s = o = 0
    for start, stop in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        while stop - start > LEAST:
            last = min(start + MOST, stop)
            s = bisect_left(strict, start + LEAST, s)
            if s < len(strict) and strict[s] < min(start + NORMAL, last):
                start = strict[s]
            else:
                o = bisect_left(loose, start + NORMAL, o)
                start = loose[o] if o < len(loose) and loose[o] < last else last
            ends.append(start)
        if stop > start:
            ends.append(stop)
        at.append(len(ends))
    return np.array(ends, np.int64), np.array(at, np.int64)


def chunk_sets(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """Per row the sorted chunk entries: 48 bits of digest, 16 bits of length."""
    if not len(data):
        return [np.zeros(0, np.uint64)] * (len(bounds) - 1)
    ends, at = chunk_ends(data, bounds)
    starts = np.concatenate([[0], ends[:-1]])
    digests = mixed(span_hashes(data, starts, ends), seed=9)
    entries = digests & np.uint64(0xFFFFFFFFFFFF0000) | (ends - starts).astype(np.uint64)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    order = np.lexsort((entries, row))
    entries, row = entries[order], row[order]
    fresh = np.ones(len(row), bool)
    fresh[1:] = (entries[1:] != entries[:-1]) | (row[1:] != row[:-1])
    entries = entries[fresh]
    edges = np.searchsorted(row[fresh], np.arange(len(at)))
    return [entries[a:b] for a, b in zip(edges[:-1], edges[1:])]


def containment(mine: np.ndarray, theirs: np.ndarray) -> float:
    """Share of the weight of ``mine``, by chunk length, that ``theirs`` has too."""
    if not len(mine):
        return float(not len(theirs))
    if not len(theirs):
        return 0.0
    at = np.minimum(np.searchsorted(theirs, mine), len(theirs) - 1)
    lengths = (mine & np.uint64(0xFFFF)).astype(np.int64)
    return float(lengths[theirs[at] == mine].sum() / lengths.sum())


def printed(entries: np.ndarray) -> str:
    return entries.astype(">u8").tobytes().hex()


def edited_texts(data: np.ndarray, bounds: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """All rows but the last with their last quarter replaced from the next, and their lengths.

    Lengths are in code points, as is the quarter.
    """
    heads = np.flatnonzero((data & 0xC0) != 0x80)
    first = np.searchsorted(heads, bounds)
    counts = np.diff(first)
    places = np.append(heads, bounds[-1])
    quarter = counts[:-1] // 4
    cut = places[first[1:-1] - quarter]
    cut[quarter == 0] = bounds[1:-1][quarter == 0]
    taken = places[first[1:-1] + np.minimum(quarter, counts[1:])]
    taken = np.where(quarter > 0, taken, bounds[1:-1])
    raw = data.tobytes()
    return [raw[a:b] + raw[c:d] for a, b, c, d in zip(
        bounds[:-2].tolist(), cut.tolist(), bounds[1:-1].tolist(), taken.tolist())], counts


_ROWS = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                   ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                   ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _compare(ids: pa.Array, texts: pa.Array, sets: list[np.ndarray], counts: np.ndarray,
             edited: list[bytes], wanted: np.ndarray) -> pa.RecordBatch:
    joined = np.frombuffer(b"".join(edited), np.uint8)
    other = chunk_sets(joined, np.cumsum([0, *map(len, edited)]))
    own = [printed(s) for s in sets[:-1]]
    columns = [ids.slice(0, len(edited)), pa.array(counts[:-1]),
               pa.array([sha256(e).hexdigest() for e in edited], pa.string()),
               pa.array(own, pa.string()), pa.array([printed(o) for o in other], pa.string()),
               pa.array([containment(a, b) for a, b in zip(sets, other)], pa.float64()),
               pa.array([containment(a, b) for a, b in zip(sets, sets[1:])], pa.float64())]
    return pa.RecordBatch.from_arrays(columns, schema=_ROWS).filter(pa.array(wanted))


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the row after it; a row's range must match, and guests only follow."""
    carried = None
    for batch in batches:
        if not batch.num_rows:
            continue
        if carried is not None:
            batch = pa.concat_batches([carried, batch])
        at, limit = 0, batch.num_rows - 1
        ranges = batch.column(0).to_numpy()
        guests = batch.column(1).to_numpy(zero_copy_only=False)
        sizes = batch.column(3)
        while at < limit:
            # Rows at..last, the last of them only as the next document.
            step = next(slices(sizes.slice(at, limit - at), SLICE_BYTES // 2))[1]
            last = at + step
            _, _, data, bounds = next(slices(sizes.slice(at, step + 1), 1 << 62))
            edited, counts = edited_texts(data, bounds)
            wanted = (ranges[at:last] == ranges[at + 1:last + 1]) & ~guests[at:last]
            yield _compare(batch.column(2).slice(at, step), sizes, chunk_sets(data, bounds),
                           counts, edited, wanted)
            at = last
        carried = batch.slice(limit, 1)


def _range_of(bounds: list[int]):
    """Number of bounds at or below the id: a coarse and then a fine step over sorted bounds."""
    if not bounds:
        return F.lit(0)
    width = max(int(len(bounds) ** 0.5), 1)
    every = F.array(*[F.lit(b) for b in bounds])
    coarse = F.array(*[F.lit(b) for b in bounds[::width]])
    below = F.size(F.filter(coarse, lambda b: b <= F.col("doc_id")))
    part = F.slice(every, (below - 1) * width + 1, width)
    fine = F.size(F.filter(part, lambda b: b <= F.col("doc_id")))
    return F.when(F.col("doc_id").isNull() | (below == 0), F.lit(0)).otherwise(
        (below - 1) * width + fine)


def fingerprints(documents: DataFrame, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Fingerprints of every document and of its edited text, and their likenesses."""
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                            F.col("text").cast("string").alias("text"))
    # The driver holds one bound and one first id per range, as a range partitioner does.
    count = rows.count()
    parts = max(1, -(-count // range_rows))
    steps = [i / parts for i in range(1, parts)]
    bounds = (sorted({b for b in rows.agg(F.percentile_approx(
        "doc_id", steps, max(10_000, 20 * parts))).first()[0] or []}) if steps else [])
    ranged = rows.withColumn("range", _range_of(bounds).cast("int"))
    around = Window.orderBy("range")
    heads = (ranged.groupBy("range").agg(
        F.min("doc_id").alias("head"), F.max(F.col("doc_id").isNull()).alias("without")))
    heads = heads.select(
        F.when(F.col("without"), F.lit(None).cast("long")).otherwise(F.col("head")).alias("head"),
        F.coalesce(F.lag("range").over(around), F.max("range").over(Window.partitionBy()))
        .alias("before"))
    hosted = (ranged.join(F.broadcast(heads), F.col("doc_id").eqNullSafe(F.col("head")), "left")
              .withColumn("range", F.explode(F.when(
                  F.col("before").isNull(), F.array("range")).otherwise(
                      F.array("range", -1 - F.col("before")))))
              .select(F.when(F.col("range") < 0, -1 - F.col("range")).otherwise(F.col("range"))
                      .alias("range"), (F.col("range") < 0).alias("guest"), "doc_id",
                      F.coalesce("text", F.lit("")).alias("text")))
    return (hosted.repartition(parts, "range")
            .sortWithinPartitions("range", "guest", F.col("doc_id").asc_nulls_first(), "text")
            .mapInArrow(_pairs, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                        "edited_fingerprint string, near_edited double, near_next double"))
