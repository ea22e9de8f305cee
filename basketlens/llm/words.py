"""Word and n-gram hashes of whole texts, straight from Arrow's UTF-8 buffers.

A batch's texts are one byte array, so tokenizing is a handful of numpy passes for any
number of texts, and a text of any length is cut only between words.  A word's hash is a
polynomial in its bytes modulo 2**64: with prefix sums of byte * base**position, a word
is a difference of two sums times base**-start, and every word costs the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once, so that the arrays of a task stay within some tens of MB.
SLICE_BYTES = 2 << 20
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)
_rng = np.random.default_rng(20_250)
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(values: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    values = values ^ np.uint64((seed * 0x632BE59BD9B4E019 + 0x2545F4914F6CDD1D) % (1 << 64))
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(29)
    values *= np.uint64(0xCF1BBCDCB7A56463)
    values ^= values >> np.uint64(32)
    return values


@dataclass(frozen=True)
class Alphabet:
    """Which bytes belong to words, and each byte's value after A-Z became a-z."""

    inside: np.ndarray
    value: np.ndarray


def _alphabet(inside: np.ndarray) -> Alphabet:
    lower = np.arange(256)
    lower[65:91] += 32
    return Alphabet(inside, _BYTE[lower])


_every = np.arange(256)
#: Words of letters and digits: every byte but 00-2F, 3A-40, 5B-60 and 7B-7F.
ALPHANUMERIC = _alphabet((_every >= 128) | ((_every >= 48) & (_every <= 57))
                         | ((_every >= 65) & (_every <= 90)) | ((_every >= 97) & (_every <= 122)))
#: Words between white space (20 and 09-0D).
VISIBLE = _alphabet(~((_every == 32) | ((_every >= 9) & (_every <= 13))))

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(length: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < length:
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(max(length, SLICE_BYTES + 1), base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps)
    return _powers[0], _powers[1]


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A string column's bytes and its row offsets (one more than rows); null is empty."""
    column = pc.fill_null(column, "")
    width = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, width)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8),
            bounds.astype(np.int64))


def slices(column: pa.Array, limit: int = SLICE_BYTES
           ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Consecutive rows ``[first, last)`` of about ``limit`` bytes, with bytes and offsets."""
    if not len(column):
        return
    data, bounds = utf8(column)
    first, rows = 0, len(column)
    while first < rows:
        last = int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last, data[bounds[first]:bounds[last]], bounds[first:last + 1] - bounds[first]
        first = last


def _piece(data: np.ndarray, begins: np.ndarray, alphabet: Alphabet):
    inside = alphabet.inside[data]
    cut = np.zeros(len(data) + 1, bool)
    cut[begins] = True
    cut[-1] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:-1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last)
    up, down = _power_tables(len(data))
    terms = alphabet.value[data]
    terms *= up[:len(data)]
    sums = np.cumsum(terms)
    hashes = sums[ends] - sums[starts] + terms[starts]
    hashes *= down[starts]
    return mixed(hashes), starts, ends + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the byte ranges ``[start, end)``, which are not empty and lie in order.

    Long arrays are taken in pieces that end with a range.
    """
    hashes, low = np.empty(len(starts), np.uint64), 0
    while low < len(starts):
        high = max(int(np.searchsorted(ends, starts[low] + SLICE_BYTES, side="right")), low + 1)
        first, last = int(starts[low]), int(ends[high - 1])
        up, down = _power_tables(last - first)
        terms = _BYTE[data[first:last]]
        terms *= up[:last - first]
        sums = np.cumsum(terms)
        a, b = starts[low:high] - first, ends[low:high] - 1 - first
        hashes[low:high] = (sums[b] - sums[a] + terms[a]) * down[a]
        low = high
    return hashes


def word_hashes(data: np.ndarray, offsets: np.ndarray, alphabet: Alphabet):
    """Hashes, byte starts and byte ends of all words, and the rows' offsets among them."""
    parts, at = [], 0
    while at < len(data):
        stop = min(at + SLICE_BYTES, len(data))
        if stop < len(data):
            tail = np.flatnonzero(~alphabet.inside[data[at:stop]])
            if len(tail):
                stop = at + int(tail[-1]) + 1
            else:
                rest = np.flatnonzero(~alphabet.inside[data[stop:]])
                stop = stop + int(rest[0]) + 1 if len(rest) else len(data)
        here = offsets[np.searchsorted(offsets, at):np.searchsorted(offsets, stop)] - at
        hashes, starts, ends = _piece(data[at:stop], here, alphabet)
        parts.append((hashes, starts + at, ends + at))
        at = stop
    if not parts:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets), np.int64)
    hashes, starts, ends = (np.concatenate(x) if len(parts) > 1 else x[0] for x in zip(*parts))
    return hashes, starts, ends, np.searchsorted(starts, offsets)


def gram_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the ``length`` words from each position on; shorter by ``length - 1``."""
    count = max(len(words) - length + 1, 0)
    total = np.full(count, np.uint64(length))
    for place in range(length):
        total += words[place:place + count] * _PLACE[place]
    return mixed(total, seed=length)


def whole_grams(bounds: np.ndarray, length: int) -> np.ndarray:
    """Positions where a gram of ``length`` words lies within one row."""
    count = max(int(bounds[-1]) - length + 1, 0)
    keep = np.ones(count, bool)
    for back in range(1, length):
        at = bounds[1:-1] - back
        keep[at[(at >= 0) & (at < count)]] = False
    return np.flatnonzero(keep)


def shingles(words: np.ndarray, bounds: np.ndarray, length: int
             ) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of every row, in order, with row offsets.

    A row of fewer words than ``length``, but not none, has one shingle of all its words.
    """
    at = whole_grams(bounds, length)
    grams = gram_hashes(words, length)[at]
    counts = np.diff(bounds)
    short = np.flatnonzero((counts > 0) & (counts < length))
    owner = np.searchsorted(bounds, at, side="right") - 1
    if len(short):
        extra = np.array([gram_hashes(words[bounds[r]:bounds[r + 1]], int(counts[r]))[0]
                          for r in short], np.uint64)
        owner, grams = np.concatenate([owner, short]), np.concatenate([grams, extra])
        order = np.argsort(owner, kind="stable")
        owner, grams = owner[order], grams[order]
    return grams, np.searchsorted(owner, np.arange(len(bounds)))
