"""Periodic runs of words, found by recompression without suffix arrays.

A run is a stretch of consecutive words with smallest period q and a length of at least
``max(6, 4 * q)`` that neither neighbouring word extends with period q.

1. Recompress.  The words of a slice of texts, numbered exactly, with a mark of its own
   after each text, form one sequence.  Rounds of block compression (equal neighbours become
   one symbol) and pair compression (a symbol of one half of the alphabet and a next one of
   the other half become one symbol) shrink it to a single symbol: a run-length grammar,
   kept as one array of symbols, parents and first children per round.
2. Extend.  How far the words from two places on agree is asked of the grammar: both places
   climb while their symbols agree, taking at most one block or symbol per round to stand at
   the start of a parent, and descend where symbols differ.  Backwards the same holds of the
   mirrored grammar.  All questions of a slice climb together.
3. Candidates.  A run of period q holds a multiple m of 3 * q (counted from the text's start) such
   that m + q is inside as well, so the places m and m + q for all q and m, a harmonic number
   of them, meet every run.  Those whose words agree are extended both ways; stretches that
   are long enough are runs, and the least period found for a stretch is its smallest.

Defined results: words are runs of characters other than 20 and 09-0D (hexadecimal); a null
or empty text has no words and no runs and collapses to the empty text; each row is taken
for itself, so repeated rows repeat their result; an empty table gives an empty result;
other columns of the input are ignored.  Texts are never cut: arrays grow with the
longest text, candidates are handled in bounded parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from basketlens.llm.words import VISIBLE, mixed, slices, word_hashes

MIN_LENGTH = 6
MIN_EXPONENT = 4
CANDIDATES_AT_ONCE = 1 << 20
BYTES_AT_ONCE = 4 << 20


@dataclass(frozen=True)
class Round:
    """Symbols before a round of compression, and their grouping under the symbols after it."""

    symbols: np.ndarray
    parent: np.ndarray
    first: np.ndarray       # first child of each parent, and the number of symbols
    blocks: bool            # whether equal neighbours were grouped, or pairs

    def mirrored(self) -> Round:
        count, parents = len(self.symbols), len(self.first) - 1
        return Round(self.symbols[::-1], parents - 1 - self.parent[::-1],
                     count - self.first[::-1], self.blocks)


def _grouped(symbols: np.ndarray, starts: np.ndarray, blocks: bool) -> Round:
    parent = np.cumsum(starts) - 1
    return Round(symbols, parent, np.append(np.flatnonzero(starts), len(symbols)), blocks)


def recompress(symbols: np.ndarray) -> list[Round]:
    """The rounds that shrink a sequence of numbers to one symbol."""
    rounds, fresh, turn = [], int(symbols.max(initial=-1)) + 1, 0
    while len(symbols) > 1:
        starts = np.append(True, symbols[1:] != symbols[:-1])
        if not starts.all():
            level = _grouped(symbols, starts, True)
            rounds.append(level)
            sizes = np.diff(level.first)
            symbols = symbols[level.first[:-1]].copy()
            long = np.flatnonzero(sizes > 1)
            names, which = np.unique(symbols[long] * (len(level.symbols) + 1) + sizes[long],
                                     return_inverse=True)
            symbols[long] = fresh + which
            fresh += len(names)
        turn += 1
        half = (mixed(symbols.view(np.uint64), seed=turn) >> np.uint64(63)).astype(bool)
        # Of the two ways to order the halves of the alphabet the one with more pairs.
        one, two = half[:-1] & ~half[1:], ~half[:-1] & half[1:]
        pairs = np.flatnonzero(one if one.sum() >= two.sum() else two)
        if len(pairs):
            starts = np.ones(len(symbols), bool)
            starts[pairs + 1] = False
            level = _grouped(symbols, starts, False)
            rounds.append(level)
            names, which = np.unique(symbols[pairs] * fresh + symbols[pairs + 1],
                                     return_inverse=True)
            symbols = symbols[level.first[:-1]].copy()
            symbols[level.parent[pairs]] = fresh + which
            fresh += len(names)
    return rounds


def common_extensions(rounds: list[Round], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For how many symbols the sequence agrees from each pair of places on.

    The places of a pair differ, and a symbol that occurs once ends their agreement.
    """
    begin, a, b = a, a.copy(), b.copy()
    top = np.zeros(len(a), np.int64)
    on = np.arange(len(a))
    for number, level in enumerate(rounds):
        x, y = a[on], b[on]
        equal = level.symbols[x] == level.symbols[y]
        top[on[~equal]] = number
        on, x, y = on[equal], x[equal], y[equal]
        up_x, up_y = level.parent[x], level.parent[y]
        if level.blocks:
            rest_x, rest_y = level.first[up_x + 1] - x, level.first[up_y + 1] - y
            uneven = rest_x != rest_y
            least = np.minimum(rest_x, rest_y)[uneven]
            stop = on[uneven]
            a[stop], b[stop], top[stop] = x[uneven] + least, y[uneven] + least, number
            on, x, y, up_x, up_y = (values[~uneven] for values in (on, x, y, up_x, up_y))
        inner = (x != level.first[up_x]) | (y != level.first[up_y])
        a[on], b[on] = up_x + inner, up_y + inner
        if not len(on):
            break
    if len(on):
        raise ValueError("the agreement of two places does not end")
    for number in range(int(top.max(initial=0)), 0, -1):
        level = rounds[number - 1]
        on = np.flatnonzero(top >= number)
        x, y = level.first[a[on]], level.first[b[on]]
        equal = level.symbols[x] == level.symbols[y]
        if level.blocks:
            least = np.minimum(level.first[a[on] + 1] - x, level.first[b[on] + 1] - y)
            a[on], b[on] = x + equal * least, y + equal * least
        else:
            a[on], b[on] = x + equal, y + equal
    return a - begin


def _candidates(bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and periods to try for texts that begin at ``bounds``, in bounded parts."""
    most = np.diff(bounds) // MIN_EXPONENT
    row = np.repeat(np.arange(len(most)), most)
    period = np.arange(len(row)) - np.repeat(np.cumsum(most) - most, most) + 1
    step = (MIN_EXPONENT - 1) * period
    count = (np.diff(bounds)[row] - period - 1) // step + 1
    ends = np.cumsum(count)
    low = 0
    while low < len(row):
        done = ends[low - 1] if low else 0
        high = max(int(np.searchsorted(ends, done + CANDIDATES_AT_ONCE, side="right")), low + 1)
        for begin in range(0, int(ends[high - 1] - done), CANDIDATES_AT_ONCE):
            # One period alone may have more places than are handled at once.
            which = np.arange(begin, min(begin + CANDIDATES_AT_ONCE, int(ends[high - 1] - done)))
            owner = np.searchsorted(ends[low:high] - done, which, side="right") + low
            place = which + done - (ends[owner] - count[owner])
            yield bounds[row[owner]] + place * step[owner], period[owner]
        low = high


def find_runs(symbols: np.ndarray, bounds: np.ndarray
              ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and smallest period of all runs of a concatenation of texts.

    ``symbols`` holds the word numbers of all texts, text i from ``bounds[i]`` on.  Runs
    come by start, then period.
    """
    none = np.zeros(0, np.int64)
    if not len(symbols) or np.diff(bounds).max() < MIN_LENGTH:
        return none, none, none
    texts, known = len(bounds) - 1, int(symbols.max()) + 1
    places = np.arange(len(symbols)) + np.repeat(np.arange(1, texts + 1), np.diff(bounds))
    marked = np.empty(len(symbols) + texts + 1, np.int64)
    marked[places] = symbols
    marked[np.append(0, bounds[1:] + np.arange(1, texts + 1))] = known + np.arange(texts + 1)
    rounds = mirror = None
    found = []
    for place, period in _candidates(bounds):
        agrees = symbols[place] == symbols[place + period]
        place, period = place[agrees], period[agrees]
        if not len(place):
            continue
        if rounds is None:
            rounds = recompress(marked)
            mirror = [level.mirrored() for level in rounds]
        a, last = places[place], len(marked) - 1
        ahead = common_extensions(rounds, a, a + period)
        behind = common_extensions(mirror, last - (a - 1 + period), last - (a - 1))
        length = ahead + behind + period
        long = length >= np.maximum(MIN_LENGTH, MIN_EXPONENT * period)
        start = (place - behind)[long]
        found.append(np.unique(np.stack([start, start + length[long], period[long]]), axis=1))
    if not found:
        return none, none, none
    start, end, period = np.unique(np.concatenate(found, axis=1), axis=1)
    least = np.append(True, (start[1:] != start[:-1]) | (end[1:] != end[:-1]))[:len(start)]
    start, end, period = start[least], end[least], period[least]
    order = np.lexsort((period, start))
    return start[order], end[order], period[order]


def _numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words only."""
    held = np.ascontiguousarray(data[VISIBLE.inside[data]])
    offsets = np.append(0, np.cumsum(ends - starts))
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [
        None, pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(held)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def _joined(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> bytes:
    """The words with a space after each."""
    parts, low = [], 0
    sizes = np.cumsum(ends - starts + 1)
    while low < len(starts):
        done = sizes[low - 1] if low else 0
        high = max(int(np.searchsorted(sizes, done + BYTES_AT_ONCE, side="right")), low + 1)
        length = ends[low:high] - starts[low:high] + 1
        stops = np.cumsum(length)
        at = np.arange(stops[-1]) + np.repeat(starts[low:high] - stops + length, length)
        part = data[np.minimum(at, len(data) - 1)]
        part[stops - 1] = 32
        parts.append(part.tobytes())
        low = high
    return b"".join(parts)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _periodic(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, last, data, offsets in slices(batch.column(1)):
            _, starts, ends, bounds = word_hashes(data, offsets, VISIBLE)
            start, end, period = find_runs(_numbers(data, starts, ends), bounds)
            row = np.searchsorted(bounds, start, side="right") - 1
            change = np.zeros(len(starts) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, end, -1)
            kept = np.flatnonzero(np.cumsum(change[:-1]) == 0)
            joined = _joined(data, starts[kept], ends[kept])
            at = np.append(0, np.cumsum(ends[kept] - starts[kept] + 1))[np.searchsorted(kept, bounds)]
            runs = pa.StructArray.from_arrays(
                [pa.array(start - bounds[row]), pa.array(end - start), pa.array(period)],
                fields=list(_RUN))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, last - first), pa.array(np.diff(bounds)),
                pa.ListArray.from_arrays(
                    pa.array(np.searchsorted(row, np.arange(last - first + 1)).astype(np.int32)), runs),
                pa.array([joined[a:max(b - 1, a)] for a, b in zip(at[:-1], at[1:])],
                         pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])


def periodic_runs(documents: DataFrame) -> DataFrame:
    """Runs of every text of (doc_id, text), and the text without their repetitions.

    Returns doc_id, n_words, runs (by start, then period; start and length in words, from 0)
    and collapsed: the words joined by one space, without those that any run holds after
    its first period.
    """
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", documents["text"].cast("string")).mapInArrow(
        _periodic, f"doc_id {kind}, n_words long, "
        "runs array<struct<start: long, length: long, period: long>>, collapsed string")
