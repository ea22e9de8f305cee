"""Personal data in whole texts: fixed patterns, and a character model that adds spans.

The base patterns are matched leftmost and without overlap for each kind, in linear time
for texts of any length.  A bidirectional LSTM over character classes with CRF transitions,
trained in numpy on labelled spans, marks further spans: numbers and addresses written
in other forms than the patterns know.  The labelled spans are base matches, as they are
and rewritten into such forms, in the text around them.

A span holds a mark (a digit, an at sign or "(at)"), so texts without one are not decoded.
Windows of ``WINDOW`` characters overlap by half and are read where they hold a mark.  What
the LSTM says of a character is averaged over its windows, and the CRF is decoded once over
each stretch of windows, so that a span may be longer than a window and lie anywhere.  A
stretch whose edge a span reaches is read on until none does, or to the ends of the text.
Spans that overlap no base span are kept.  Memory grows with the longest stretch.

The model is fitted on the driver from at most ``SAMPLE_ROWS`` documents (least hashes of
the id among documents of at most ``SAMPLE_CHARS`` characters with a digit or an at sign),
``WINDOWS_A_TEXT`` windows of each and ``TRAIN_WINDOWS`` windows in all.  These bounds hold
for learning alone; spans are looked for in all texts as a whole.

Defined results: a null text is empty; offsets are in code points, end exclusive; repeated
rows give a row each; without labelled spans the model adds none; other columns are kept
by ``redacted`` and ignored by ``personal_data``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketlens.llm.store import hashed_sample
from basketlens.llm.words import slices, utf8

KINDS = ("email", "ip", "card", "phone")
SAMPLE_ROWS = 1_500
SAMPLE_CHARS = 100_000
WINDOWS_A_TEXT = 12
TRAIN_WINDOWS = 2_560
WINDOW = 64
STEP = WINDOW // 2
CONFIDENCE = 0.95
HIDDEN = 12
BATCH = 64
EPOCHS = 12
DECODED_AT_ONCE = 2_048
#: Characters at a stretch's edge where a tag has the stretch read on; rows and bytes in one call.
EDGE = 8
ROWS_AT_ONCE = 2_048
BYTES_AT_ONCE = 2 << 20

_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
# A run of digits that starts a match whole starts it anywhere, so only its start is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_WORDED = re.compile(r"\(at\)")
_ANCHOR = np.zeros(256, bool)
_ANCHOR[[64, *range(48, 58)]] = True

Span = tuple[int, int, int]  # start, kind, end


def emails(text: str) -> Iterator[Span]:
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(_LOCAL))
        found = _DOMAIN.match(text, at) if start < at else None
        free = found.end() if found else at + 1
        if found:
            yield start, 0, free
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """All base spans by start, then kind."""
    found = list(emails(text))
    for m in _IP.finditer(text):
        if all(len(x := part.lstrip("0")) <= 3 and int(x or 0) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in _PHONE.finditer(text):
        if 10 <= len(_DIGIT.findall(m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


# --- characters and tags ---------------------------------------------------------------

_MARKS = "\n\t @.-+()_%#*$&!,:;/\\\"'=|[]<>?"
CLASSES = 7 + len(_MARKS)
_CLASS = np.full(129, 6, np.uint8)
_CLASS[ord("0"):ord("9") + 1] = 1
_CLASS[ord("a"):ord("f") + 1] = 2
_CLASS[ord("g"):ord("z") + 1] = 3
_CLASS[ord("A"):ord("Z") + 1] = 4
_CLASS[128] = 5
for _i, _c in enumerate(_MARKS):
    _CLASS[ord(_c)] = 7 + _i
TAGS = 1 + 2 * len(KINDS)  # 0 outside, then first and further characters of each kind


def _allowed() -> np.ndarray:
    """0 where a tag may follow another, very low where not; first row: a window's start."""
    moves = np.full((TAGS + 1, TAGS), -1e4)
    moves[:, 0] = moves[0] = 0
    for kind in range(len(KINDS)):
        first = 1 + 2 * kind
        moves[:, first] = 0
        moves[[first + 1, first + 2], first + 1] = 0
    return moves


ALLOWED = _allowed()


def classes_of(text: str) -> np.ndarray:
    """A class number per code point; 0 is kept for padding."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return _CLASS[np.minimum(points, 128)]


@dataclass
class Tagger:
    """Weights: both directions' input and recurrent gates, emissions, transitions."""

    inputs: np.ndarray      # 2 x CLASSES x 4H, by character class
    recurrent: np.ndarray   # 2 x H x 4H
    emit: np.ndarray        # 2H x TAGS
    bias: np.ndarray        # TAGS
    moves: np.ndarray       # (TAGS + 1) x TAGS, as ALLOWED

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.emit, self.bias, self.moves]


def fresh_tagger(seed: int = 11, kind: type = np.float32) -> Tagger:
    rng = np.random.default_rng(seed)
    inputs = rng.normal(0, 0.4, (2, CLASSES, 4 * HIDDEN))
    inputs[:, :, HIDDEN:2 * HIDDEN] += 1.0  # gates start by remembering
    arrays = (inputs, rng.normal(0, 0.25, (2, HIDDEN, 4 * HIDDEN)),
              rng.normal(0, 0.25, (2 * HIDDEN, TAGS)), np.zeros(TAGS), np.zeros((TAGS + 1, TAGS)))
    return Tagger(*[a.astype(kind) for a in arrays])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def run_lstm(model: Tagger, codes: np.ndarray, keep: bool = False):
    """Hidden states (2, batch, length, H) of both directions, each in its reading order."""
    batch, length = codes.shape
    both = np.stack([codes, codes[:, ::-1]])
    h, c = np.zeros((2, 2, batch, HIDDEN), model.inputs.dtype)
    hidden, held = np.empty((2, batch, length, HIDDEN), model.inputs.dtype), []
    direction = np.arange(2)[:, None]
    for t in range(length):
        z = model.inputs[direction, both[:, :, t]] + h @ model.recurrent
        gates = _sigmoid(z[:, :, :3 * HIDDEN])
        i, f, o = (gates[:, :, k * HIDDEN:(k + 1) * HIDDEN] for k in range(3))
        g = np.tanh(z[:, :, 3 * HIDDEN:])
        before = c
        c = f * c + i * g
        squashed = np.tanh(c)
        if keep:
            held.append((h, before, i, f, o, g, squashed))
        h = o * squashed
        hidden[:, :, t] = h
    return hidden, both, held


def emissions(model: Tagger, hidden: np.ndarray) -> np.ndarray:
    joined = np.concatenate([hidden[0], hidden[1][:, ::-1]], axis=2)
    return joined @ model.emit + model.bias


def _log_sum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return (top + np.log(np.exp(x - top).sum(axis=axis, keepdims=True))).squeeze(axis)


def forward_backward(scores: np.ndarray, moves: np.ndarray):
    """Log weights of prefixes and suffixes, and of all tag sequences."""
    batch, length, _ = scores.shape
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    alpha[:, 0] = scores[:, 0] + moves[0]
    inner = moves[1:]
    for t in range(1, length):
        alpha[:, t] = scores[:, t] + _log_sum(alpha[:, t - 1, :, None] + inner, 1)
    for t in range(length - 2, -1, -1):
        beta[:, t] = _log_sum(inner + (scores[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
    return alpha, beta, _log_sum(alpha[:, -1], 1)


def loss_gradient(model: Tagger, codes: np.ndarray, tags: np.ndarray):
    """Mean negative log-likelihood of the tags, and gradients in the order of arrays()."""
    batch, length = codes.shape
    hidden, both, held = run_lstm(model, codes, keep=True)
    scores, moves = emissions(model, hidden), (model.moves + ALLOWED).astype(model.moves.dtype)
    alpha, beta, total = forward_backward(scores, moves)
    rows, steps = np.arange(batch)[:, None], np.arange(length)[None, :]
    gold = scores[rows, steps, tags].sum(1) + moves[0, tags[:, 0]] + moves[tags[:, :-1] + 1, tags[:, 1:]].sum(1)
    d_scores = np.exp(alpha + beta - total[:, None, None])
    d_moves = np.zeros_like(moves)
    d_moves[0] = d_scores[:, 0].sum(0)
    for t in range(1, length):
        d_moves[1:] += np.exp(alpha[:, t - 1, :, None] + moves[1:]
                              + (scores[:, t] + beta[:, t] - total[:, None])[:, None, :]).sum(0)
    d_scores[rows, steps, tags] -= 1
    np.subtract.at(d_moves[0], tags[:, 0], 1)
    np.subtract.at(d_moves, (tags[:, :-1] + 1, tags[:, 1:]), 1)
    d_scores /= batch
    joined = np.concatenate([hidden[0], hidden[1][:, ::-1]], axis=2)
    flat = d_scores.reshape(-1, TAGS)
    d_emit, d_bias = joined.reshape(-1, 2 * HIDDEN).T @ flat, flat.sum(0)
    d_joined = d_scores @ model.emit.T
    d_hidden = np.stack([d_joined[:, :, :HIDDEN], d_joined[:, ::-1, HIDDEN:]])
    d_inputs, d_recurrent = np.zeros_like(model.inputs), np.zeros_like(model.recurrent)
    dh, dc = np.zeros((2, 2, batch, HIDDEN), model.inputs.dtype)
    every = np.empty((2, length, batch, 4 * HIDDEN), model.inputs.dtype)
    for t in range(length - 1, -1, -1):
        before_h, before_c, i, f, o, g, squashed = held[t]
        dh = dh + d_hidden[:, :, t]
        dc = dc + dh * o * (1 - squashed ** 2)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before_c * f * (1 - f),
                             dh * squashed * o * (1 - o), dc * i * (1 - g ** 2)], axis=2)
        every[:, t] = dz
        d_recurrent += before_h.transpose(0, 2, 1) @ dz
        dh, dc = dz @ model.recurrent.transpose(0, 2, 1), dc * f
    for d in range(2):
        order = both[d].T.ravel()
        flat = every[d].reshape(-1, 4 * HIDDEN)
        by_class = np.argsort(order, kind="stable")
        present, starts = np.unique(order[by_class], return_index=True)
        d_inputs[d, present] = np.add.reduceat(flat[by_class], starts, axis=0)
    return (total - gold).mean(), [d_inputs, d_recurrent, d_emit, d_bias, d_moves / batch]


def fit_tagger(codes: np.ndarray, tags: np.ndarray, epochs: int = EPOCHS, rate: float = 0.03,
               seed: int = 12) -> Tagger:
    """Adam over shuffled batches with a falling rate; the same rows give the same model."""
    model, rng, step = fresh_tagger(), np.random.default_rng(seed), 0
    first, second = ([np.zeros_like(a) for a in model.arrays()] for _ in range(2))
    steps = epochs * max(1, -(-len(codes) // BATCH))
    for _ in range(epochs):
        order = rng.permutation(len(codes))
        for low in range(0, len(order), BATCH):
            part, step = order[low:low + BATCH], step + 1
            _, gradients = loss_gradient(model, codes[part], tags[part])
            norm = np.sqrt(sum(float((g ** 2).sum()) for g in gradients))
            for a, m, v, g in zip(model.arrays(), first, second, gradients):
                g = g * min(1.0, 5.0 / max(norm, 1e-9))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                a -= (rate * (1 - 0.9 * step / steps) * (m / (1 - 0.9 ** step))
                      / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8))
    return model


def decode(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Best tag sequence of each row of emissions, and each tag's marginal probability.

    Weights are brought back to a sum of one at every character, so that they neither grow
    nor lose digits along a stretch of any length.
    """
    batch, length, _ = scores.shape
    inner = moves[1:]
    alpha = np.empty_like(scores)
    back = np.empty((length, batch, TAGS), np.int8)
    best = alpha[:, 0] = scores[:, 0] + moves[0]
    for t in range(1, length):
        steps = best[:, :, None] + inner
        back[t] = steps.argmax(1)
        best = steps.max(1) + scores[:, t]
        best -= best.max(1, keepdims=True)
        here = scores[:, t] + _log_sum(alpha[:, t - 1, :, None] + inner, 1)
        alpha[:, t] = here - _log_sum(here, 1)[:, None]
    tags = np.empty((batch, length), np.int8)
    tags[:, -1] = best.argmax(1)
    rows = np.arange(batch)
    for t in range(length - 1, 0, -1):
        tags[:, t - 1] = back[t, rows, tags[:, t]]
    sure, beta = np.empty((batch, length), scores.dtype), np.zeros_like(best)
    for t in range(length - 1, -1, -1):
        both = alpha[:, t] + beta
        sure[:, t] = np.exp(both[rows, tags[:, t]] - _log_sum(both, 1))
        beta = _log_sum(inner + (scores[:, t] + beta)[:, None, :], 2)
        beta -= beta.max(1, keepdims=True)
    return tags, sure


# --- windows of whole texts ------------------------------------------------------------

def marks_of(text: str, codes: np.ndarray) -> np.ndarray:
    """Which characters mark a possible span: digits, at signs and those of "(at)"."""
    marks = (codes == 1) | (codes == 7 + _MARKS.index("@"))
    for m in _WORDED.finditer(text):
        marks[m.start():m.end()] = True
    return marks


def last_window(length: int) -> int:
    return max(0, -(-(length - WINDOW) // STEP))


def window_starts(marks: np.ndarray) -> np.ndarray:
    """Starts of the text's windows that hold a mark."""
    anchors = np.flatnonzero(marks)
    grid = np.unique(np.concatenate([anchors // STEP, anchors // STEP - 1]))
    return np.unique(np.clip(grid, 0, last_window(len(marks)))) * STEP


def window_codes(codes: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.zeros(len(codes) + WINDOW, np.uint8)
    padded[:len(codes)] = codes
    return padded[starts[:, None] + np.arange(WINDOW)[None, :]]


def window_spans(tags: np.ndarray, sure: np.ndarray) -> Iterator[tuple[int, int, int, int, float]]:
    """Runs of tags in decoded stretches: stretch, start, kind, end, least marginal."""
    opens = np.argwhere((tags > 0) & (tags % 2 == 1))
    for w, s in opens:
        kind, e = (tags[w, s] - 1) // 2, s + 1
        while e < tags.shape[1] and tags[w, e] == 2 + 2 * kind:
            e += 1
        yield int(w), int(s), int(kind), int(e), float(sure[w, s:e].min())


def reconcile(spans: list[tuple[int, int, int, float]]) -> list[Span]:
    """The non-overlapping spans (start, kind, end, weight) of greatest total weight."""
    spans = sorted({s[:3]: s for s in sorted(spans, key=lambda x: x[3])}.values(),
                   key=lambda x: (x[2], x[0], x[1]))
    ends = [s[2] for s in spans]
    total, took = [0.0], []
    for n, (start, _, end, weight) in enumerate(spans):
        before = int(np.searchsorted(ends[:n], start, side="right"))
        value = total[before] + weight * (end - start)
        took.append((before, value > total[n]))
        total.append(max(value, total[n]))
    chosen, n = [], len(spans)
    while n:
        before, taken = took[n - 1]
        if taken:
            chosen.append(spans[n - 1][:3])
        n = before if taken else n - 1
    return sorted(chosen)


_NEARNESS = np.minimum(np.arange(1, WINDOW + 1), np.arange(WINDOW, 0, -1)).astype(np.float32)[:, None]


def averaged_emissions(model: Tagger, windows: np.ndarray, at: np.ndarray, odd: np.ndarray,
                       length: int) -> np.ndarray:
    """Emissions of ``length`` characters laid end to end, over the windows that start ``at``.

    A window counts more towards its middle; ``odd`` tells overlapping windows apart.
    """
    total = np.zeros((length, TAGS), np.float32)
    weight = np.zeros((length, 1), np.float32)
    for low in range(0, len(windows), DECODED_AT_ONCE):
        part = slice(low, low + DECODED_AT_ONCE)
        found = emissions(model, run_lstm(model, windows[part])[0]) * _NEARNESS
        for side in (False, True):
            places = at[part][odd[part] == side][:, None] + np.arange(WINDOW)
            total[places] += found[odd[part] == side]
            weight[places] += _NEARNESS
    return total / weight


def _decoded(model: Tagger, codes: list[np.ndarray], starts: dict[int, np.ndarray]
             ) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Text, start, tags and marginals of each stretch of overlapping windows."""
    owner = np.repeat(list(starts), [len(s) for s in starts.values()])
    flat = np.concatenate(list(starts.values()))
    first = np.ones(len(flat), bool)
    first[1:] = (owner[1:] != owner[:-1]) | (np.diff(flat) != STEP)
    heads = np.flatnonzero(first)
    counts = np.diff(np.append(heads, len(flat)))
    order = np.argsort(counts, kind="stable")  # stretches of a length are decoded together
    sizes = (counts + 1) * STEP
    begins = np.empty(len(heads), np.int64)
    begins[order] = np.cumsum(sizes[order]) - sizes[order]
    number = np.arange(len(flat)) - np.repeat(heads, counts)
    windows = np.concatenate([window_codes(codes[n], s) for n, s in starts.items()])
    scores = averaged_emissions(model, windows, np.repeat(begins, counts) + number * STEP,
                                number % 2 == 1, int(sizes.sum()))
    # A span goes on from before a stretch, but not from before the text.
    whole = begins[flat[heads] == 0]
    scores[whole[:, None], np.arange(2, TAGS, 2)] -= 1e4
    moves = (model.moves + ALLOWED).astype(np.float32)
    low = 0
    while low < len(order):
        length = int(sizes[order[low]])
        high = int(np.searchsorted(sizes[order], length, side="right"))
        high = min(high, low + max(1, DECODED_AT_ONCE * WINDOW // length))
        begin = begins[order[low]]
        tags, sure = decode(scores[begin:begin + (high - low) * length].reshape(-1, length, TAGS), moves)
        for k, head in enumerate(heads[order[low:high]]):
            yield int(owner[head]), int(flat[head]), tags[k], sure[k]
        low = high


def model_spans(model: Tagger, texts: list[str], bases: list[list[Span]],
                confidence: float = CONFIDENCE) -> list[list[Span]]:
    """Per text the spans that the model adds to the base spans."""
    codes = [classes_of(t) for t in texts]
    marks = [marks_of(t, c) for t, c in zip(texts, codes)]
    todo = {n: s for n, m in enumerate(marks) if len(s := window_starts(m))}
    found: list[list] = [[] for _ in texts]
    while todo:
        more: dict[int, list[np.ndarray]] = {}
        for n in todo:
            found[n] = []
        for n, start, tags, sure in _decoded(model, codes, todo):
            # Read on by as many windows as there are, where a span reaches an inner edge.
            reach = []
            if start > 0 and tags[:EDGE].any():
                reach.append(np.arange(max(0, start - len(tags)), start, STEP))
            if start + len(tags) < len(codes[n]) and tags[-EDGE:].any():
                stop = min(start + 2 * len(tags), last_window(len(codes[n])) * STEP + STEP)
                reach.append(np.arange(start + len(tags) - STEP, stop, STEP))
            if reach:
                more.setdefault(n, []).extend(reach)
            for _, s, kind, e, p in window_spans(tags[None], sure[None]):
                if p >= confidence and start + e <= len(codes[n]) and marks[n][start + s:start + e].any():
                    found[n].append((start + s, kind, start + e, p))
        todo = {n: np.unique(np.concatenate([todo[n], *reach])) for n, reach in more.items()}
    return [reconcile([s for s in own if not any(s[0] < b[2] and b[0] < s[2] for b in base)])
            if own else [] for own, base in zip(found, bases)]


# --- labelled spans --------------------------------------------------------------------

def _rewritten(rng: np.random.Generator, kind: int, span: str) -> str:
    """A span as it is, or in a form that the base patterns do not know."""
    if rng.random() < 0.5:
        return span
    digits = "".join(_DIGIT.findall(span))
    if kind == 0:
        return span.replace("@", [" @ ", "[@]", "(@)", " (at) "][rng.integers(4)], 1)
    if kind == 1:
        return span.replace(".", [" . ", "[.]", "(.)"][rng.integers(3)])
    if kind == 2:
        return ["./_"[rng.integers(3)]][0].join(digits[i:i + 4] for i in range(0, len(digits), 4))
    return ["({}) {}-{}", "{}-{}-{}", "{}.{}.{}"][rng.integers(3)].format(
        digits[-10:-7], digits[-7:-4], digits[-4:])


def labelled_windows(texts: list[str], count: int = TRAIN_WINDOWS, seed: int = 13
                     ) -> tuple[np.ndarray, np.ndarray]:
    """Windows of sample texts, coded and tagged, with base spans partly rewritten."""
    rng = np.random.default_rng(seed)
    windows, tagged = [], []
    for text in texts:
        pieces, marks, at, last_end = [], [], 0, 0
        for start, kind, end in base_spans(text):
            if start < last_end:
                continue
            fresh = _rewritten(rng, kind, text[start:end])
            pieces += [text[last_end:start], fresh]
            at += start - last_end
            marks.append((at, kind, at + len(fresh)))
            at, last_end = at + len(fresh), end
        changed = "".join(pieces) + text[last_end:]
        codes = classes_of(changed)
        tags = np.zeros(len(codes) + WINDOW, np.int64)
        for start, kind, end in marks:
            tags[start:end] = 2 + 2 * kind
            tags[start] = 1 + 2 * kind
        held = marks_of(changed, codes)
        held |= tags[:len(codes)] > 0
        starts = window_starts(held)
        if len(starts) > WINDOWS_A_TEXT:
            starts = rng.choice(starts, WINDOWS_A_TEXT, replace=False)
        for s, one in zip(starts, window_codes(codes, starts)):
            windows.append(one)
            tagged.append(tags[s:s + WINDOW])
    if not windows:
        return np.zeros((0, WINDOW), np.uint8), np.zeros((0, WINDOW), np.int64)
    some = rng.permutation(len(windows))[:count]
    return np.stack(windows)[some], np.stack(tagged)[some]


def train(documents: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Tagger | None:
    """Fit the tagger on a bounded sample of documents; none where no span is labelled."""
    marked = (documents.select("doc_id", F.col("text").cast("string").alias("text"))
              .where(F.col("text").rlike("[0-9@]") & (F.length("text") <= SAMPLE_CHARS)))
    sample = hashed_sample(marked, sample_rows).select("text").toArrow()
    codes, tags = labelled_windows(sample.column("text").to_pylist())
    return fit_tagger(codes, tags) if (tags > 0).any() else None


# --- over tables -----------------------------------------------------------------------

def _found(column: pa.Array, model: Tagger | None) -> Iterator[tuple[int, str, list[Span], list[Span]]]:
    """Row, text, base spans and added spans of the rows that hold a mark."""
    if not len(column):
        return
    data, bounds = utf8(column)
    data = data[:bounds[-1]]
    marks = np.flatnonzero(_ANCHOR[data[bounds[0]:]]) + bounds[0]
    opens = np.flatnonzero(data[bounds[0]:len(data) - 3] == ord("(")) + bounds[0]
    for place, sign in enumerate(b"at)", 1):
        opens = opens[data[opens + place] == sign]
    rows = np.unique(np.searchsorted(bounds, np.concatenate([marks, opens]), side="right") - 1)
    sizes = np.cumsum(bounds[rows + 1] - bounds[rows])
    low = 0
    while low < len(rows):
        before = sizes[low - 1] if low else 0
        high = int(np.searchsorted(sizes, before + BYTES_AT_ONCE, side="right"))
        high = max(low + 1, min(high, low + ROWS_AT_ONCE))
        part, low = rows[low:high], high
        texts = [column[int(r)].as_py() for r in part]
        bases = [base_spans(t) for t in texts]
        added = model_spans(model, texts, bases) if model else [[] for _ in texts]
        yield from zip(map(int, part), texts, bases, added)


def listed(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(spans))


def _report(batches: Iterator[pa.RecordBatch], model: Tagger | None) -> Iterator[pa.RecordBatch]:
    nothing = sha256(b"").hexdigest()
    for batch in batches:
        counts = np.zeros((batch.num_rows, len(KINDS)), np.int64)
        digests, spans = [nothing] * batch.num_rows, [""] * batch.num_rows
        extra = np.zeros(batch.num_rows, np.int64)
        for row, _, base, added in _found(batch.column(1), model):
            for _, kind, _ in base:
                counts[row, kind] += 1
            digests[row] = sha256(listed(base).encode()).hexdigest()
            spans[row], extra[row] = listed(base + added), len(added)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(counts[:, k]) for k in range(len(KINDS))],
             pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(extra)],
            names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans", "n_added"])


def personal_data(documents: DataFrame, model: Tagger | None) -> DataFrame:
    """doc_id, base spans by kind, their digest, all spans, and how many the model added."""
    return (documents.select(F.col("doc_id").cast("long").alias("doc_id"),
                             F.col("text").cast("string").alias("text"))
            .mapInArrow(lambda batches: _report(batches, model),
                        "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
                        + ", base_sha256 string, spans string, n_added long"))


def masked(text: str, spans: list[Span]) -> str:
    """The text with every span, overlapping ones together, replaced by its kind in brackets."""
    pieces, at = [], 0
    for start, kind, end in sorted(spans):
        if start >= at:
            pieces += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = max(at, end)
    return "".join(pieces) + text[at:]


def _redact(batches: Iterator[pa.RecordBatch], model: Tagger | None, text_at: int, size_at: int
            ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fresh: dict[int, str] = {}
        for row, text, base, added in _found(batch.column(text_at), model):
            if base or added:
                fresh[row] = masked(text, base + added)
        rows = np.array(sorted(fresh), np.int64)
        for first, last, _, _ in slices(batch.column(text_at)):  # changed a slice at a time
            part = batch.slice(first, last - first)
            changed = rows[np.searchsorted(rows, first):np.searchsorted(rows, last)]
            if len(changed):
                columns = list(part.columns)
                columns[text_at] = _replaced(columns[text_at], changed - first,
                                             [fresh[row] for row in changed])
                if size_at >= 0:
                    columns[size_at] = _replaced(columns[size_at], changed - first,
                                                 [len(fresh[row]) for row in changed])
                part = pa.RecordBatch.from_arrays(columns, schema=part.schema)
            yield part


def _replaced(column: pa.Array, rows: np.ndarray, values: list) -> pa.Array:
    """``column`` with other values in some rows."""
    at = np.arange(len(column))
    at[rows] = len(column) + np.arange(len(rows))
    return pa.concat_arrays([column, pa.array(values, column.type)]).take(pa.array(at))


def redacted(documents: DataFrame, model: Tagger | None) -> DataFrame:
    """The documents with personal data masked in ``text``, and ``n_chars`` (if any) brought along."""
    names = documents.columns
    size_at = names.index("n_chars") if "n_chars" in names else -1
    return documents.mapInArrow(
        lambda batches: _redact(batches, model, names.index("text"), size_at), documents.schema)
