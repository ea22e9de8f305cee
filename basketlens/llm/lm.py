"""Language-model scores by deleted interpolation of unigrams and bigrams.

A token's probability mixes its bigram and unigram maximum-likelihood estimates and the
add-half unigram; the mixture weights depend on how often the context was seen, in
buckets by powers of two.  They are learned by expectation-maximisation on counts that are
held out of the estimates: the tokens of one training part, predicted from the others.

Counts of n-grams are exact and cover all training documents.  Texts are dealt into
batches; a batch sends each n-gram it holds once, with its own counts, as sorted packed
arrays to the n-gram's bucket.  A bucket sums over batches and answers each of them, so a
frequent n-gram is one entry per batch, not one row per use, and texts move once.  The
batch keeps, per token, the counts that its probability needs; weights and totals follow
from all batches, and a last pass over the kept counts scores every document.

The counts behind the weights are gathered on a grid of count sizes (exact up to 8,
eighths of an octave beyond), whose extent does not grow with the corpus.

Defined results: tokens are runs of anything but white space, A-Z lowered, then one end; a
null or empty text is an end alone; documents without id hash as an empty id; repeated
rows count and are scored one by one; with no training document every count is 0; other
columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.store import stored
from basketlens.llm.words import VISIBLE, mixed, slices, word_hashes

#: Documents of one batch, about 5 MB of text, and batches that one bucket answers for.
BATCH_ROWS = 1_500
BATCHES_PER_BUCKET = 3
CONTEXT_BUCKETS = 24
EM_STEPS = 60
#: Weights of bigram, unigram and add-half unigram where no held-out token has the context.
PRIOR = (0.4, 0.4, 0.2)
LEAST_WEIGHT = 1e-6
_END = np.uint64(0x1B873593CC9E2D51)
_LEFT, _RIGHT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xA0761D6478BD642F)


def packed(values: np.ndarray) -> bytes:
    """64-bit numbers by byte planes, so that leading zero bytes lie together."""
    return np.ascontiguousarray(values.astype(np.uint64)).view(np.uint8).reshape(-1, 8).T.tobytes()


def unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view(np.uint64).ravel()


def squeezed(values: np.ndarray) -> bytes:
    """Packed and compressed, behind the count: most counts are small and most gaps alike."""
    return len(values).to_bytes(8, "little") + pa.compress(packed(values), "zstd", asbytes=True)


def expanded(data: bytes) -> np.ndarray:
    count = int.from_bytes(data[:8], "little")
    return unpacked(pa.decompress(data[8:], 8 * count, "zstd", asbytes=True))


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, an end after each, and the texts' offsets among them."""
    parts, counts = [], []
    for first, last, data, offsets in slices(texts):
        words, _, _, bounds = word_hashes(data, offsets, VISIBLE)
        rows = last - first
        here = np.full(len(words) + rows, _END, np.uint64)
        keep = np.ones(len(here), bool)
        keep[bounds[1:] + np.arange(rows)] = False
        here[keep] = words
        parts.append(here)
        counts.append(np.diff(bounds) + 1)
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64)
    return np.concatenate(parts), np.concatenate([[0], np.cumsum(np.concatenate(counts))])


def ngram_keys(stream: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """56-bit keys of each token (even) and of each token after the one before it (odd).

    The end of a text comes before the first token of the next, and of the first text.
    """
    before = np.concatenate([[_END], stream[:-1]]) if len(stream) else stream
    one = (mixed(stream, seed=21) >> np.uint64(8)) & ~np.uint64(1)
    two = (mixed(stream * _LEFT + before * _RIGHT, seed=22) >> np.uint64(8)) | np.uint64(1)
    return one, two


def bucket_edges(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Offsets of the buckets, equal ranges of keys, in sorted keys."""
    edges = np.array([(b << 56) // buckets for b in range(1, buckets)], np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])


def _sorted_rows(table: pa.Table) -> pa.Table:
    """Rows of a batch in an order that does not depend on how the shuffle brought them."""
    return table.sort_by([("row", "ascending")]).combine_chunks()


def _distinct(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, np.ndarray]:
    """A batch's rows, text offsets, sorted n-gram keys and each n-gram's place among them."""
    table = _sorted_rows(table)
    text = table.column("text")
    stream, at = tokens(text.chunk(0) if text.num_chunks else pa.array([], pa.string()))
    keys, place = np.unique(np.concatenate(ngram_keys(stream)), return_inverse=True)
    return table, at, keys, place


def _ask(key: tuple, table: pa.Table, buckets: int) -> pa.Table:
    """Packed n-grams of a batch, by bucket, with counts in training and in the held-out part."""
    rows, at, keys, place = _distinct(table)
    used = np.tile(np.repeat(rows.column("part").to_numpy(), np.diff(at)), 2)
    trained = np.bincount(place[used > 0], minlength=len(keys))
    held = np.bincount(place[used == 2], minlength=len(keys))
    edges = bucket_edges(keys, buckets)
    full = np.flatnonzero(np.diff(edges))
    columns: list[list] = [[], [], []]
    for b in full:
        part = slice(edges[b], edges[b + 1])
        steps = keys[part].copy()
        steps[1:] -= keys[part][:-1]
        for column, values in zip(columns, (steps, trained[part], held[part])):
            column.append(squeezed(values))
    return pa.table({"bucket": pa.array(full.astype(np.int32)),
                     "batch": pa.array([key[0].as_py()] * len(full), pa.int32()),
                     "keys": pa.array(columns[0], pa.binary()),
                     "trained": pa.array(columns[1], pa.binary()),
                     "held": pa.array(columns[2], pa.binary())})


def _answer(table: pa.Table) -> pa.Table:
    """Sum a bucket's counts over batches and answer each batch in its own order."""
    pieces = [np.cumsum(expanded(k.as_py()), dtype=np.uint64) for k in table.column("keys")]
    keys, place = np.unique(np.concatenate(pieces), return_inverse=True)
    ends = np.cumsum([0, *map(len, pieces)])
    del pieces
    sums = []
    for name in ("trained", "held"):
        total = np.zeros(len(keys), np.uint64)
        for value, a, b in zip(table.column(name), ends[:-1], ends[1:]):
            total[place[a:b]] += expanded(value.as_py())  # keys of one batch are distinct
        sums.append(total)
    words = int(((sums[0] > 0) & (keys & np.uint64(1) == 0)).sum())
    batch = table.column("batch").to_numpy()
    return pa.table({
        "batch": pa.array(batch.astype(np.int32)), "bucket": table.column("bucket").cast(pa.int32()),
        "trained": pa.array([squeezed(sums[0][place[a:b]]) for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
        "held": pa.array([squeezed(sums[1][place[a:b]]) for a, b in zip(ends[:-1], ends[1:])], pa.binary()),
        "words": pa.array(np.where(batch == batch.min(), words, 0).astype(np.int64))})


def size_class(counts: np.ndarray) -> np.ndarray:
    """Class of a count: itself up to 8, then eighths of an octave."""
    large = np.maximum(counts, 1).astype(np.float64)
    return np.where(counts <= 8, counts, 8 + np.rint(8 * (np.log2(large) - 3)).clip(1)).astype(np.int64)


def class_size(classes: np.ndarray) -> np.ndarray:
    return np.where(classes <= 8, classes, 2.0 ** (3 + (classes - 8) / 8))


_KEPT = pa.schema([
    ("doc_id", pa.int64()), ("part", pa.int32()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
    ("token", pa.binary()), ("pair", pa.binary()), ("start", pa.int64()), ("words", pa.int64()),
    ("grid", pa.list_(pa.struct([("cell", pa.int64()), ("mass", pa.int64())])))])
_KEPT_DDL = ("doc_id long, part int, n_tokens long, n_known long, token binary, pair binary, "
             "start long, words long, grid array<struct<cell: long, mass: long>>")


def _keep(texts: pa.Table, answers: pa.Table) -> pa.Table:
    """Per document the training counts of its tokens and pairs; a batch's grid in its first row."""
    rows, at, keys, place = _distinct(texts)
    answers = answers.sort_by([("bucket", "ascending")])
    trained, held = (np.concatenate([expanded(x.as_py()) for x in answers.column(name)])
                     for name in ("trained", "held"))
    half = len(place) // 2
    token, pair = trained[place[:half]], trained[place[half:]]
    token_held, pair_held = held[place[:half]], held[place[half:]]
    part = rows.column("part").to_numpy()
    ends = at[1:] - 1
    before = np.concatenate([[ends[0]], np.arange(half - 1)])  # an end stands before each text
    asked = np.repeat(part == 2, np.diff(at))
    left = [(x - y)[asked] for x, y in ((pair, pair_held), (token[before], token_held[before]),
                                        (token, token_held))]
    classes = [size_class(x.astype(np.int64)) for x in left]
    cells, mass = np.unique(classes[0] << 40 | classes[1] << 20 | classes[2], return_counts=True)
    grid = pa.StructArray.from_arrays([pa.array(cells, pa.int64()), pa.array(mass, pa.int64())],
                                      fields=list(_KEPT.field("grid").type.value_type))
    count = len(rows)
    known = np.add.reduceat((token > 0).astype(np.int64), at[:-1])
    pairs = list(zip(at[:-1], at[1:]))
    return pa.Table.from_arrays([
        rows.column("doc_id"), rows.column("part").cast(pa.int32()), pa.array(np.diff(at)), pa.array(known),
        pa.array([packed(token[a:b]) for a, b in pairs], pa.binary()),
        pa.array([packed(pair[a:b]) for a, b in pairs], pa.binary()),
        pa.array(np.full(count, token[ends[0]], np.int64)),
        pa.array(np.append(answers.column("words").to_numpy().sum(), np.zeros(count - 1, np.int64))),
        pa.ListArray.from_arrays(pa.array(np.append(0, np.full(count, len(cells))).astype(np.int32)), grid)],
        schema=_KEPT)


def context_bucket(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(count.astype(np.float64) + 1).astype(np.int64), CONTEXT_BUCKETS - 1)


def learn_weights(cells: np.ndarray, mass: np.ndarray, total: float, words: int,
                  steps: int = EM_STEPS) -> np.ndarray:
    """Mixture weights by context bucket (rows), from the grid of held-out tokens."""
    pair, context, token = (class_size(cells >> s & 0xFFFFF) for s in (40, 20, 0))
    estimates = np.column_stack([
        pair / np.maximum(context, 1), token / max(total, 1),
        (token + 0.5) / (total + 0.5 * (words + 1))])
    bucket = context_bucket(context)
    weights = np.tile(np.array(PRIOR), (CONTEXT_BUCKETS, 1))
    for _ in range(steps):
        share = estimates * weights[bucket]
        share *= (mass / share.sum(axis=1))[:, None]
        gathered = np.column_stack([np.bincount(bucket, weights=share[:, k], minlength=CONTEXT_BUCKETS)
                                    for k in range(3)])
        sums = gathered.sum(axis=1, keepdims=True)
        weights = np.where(sums > 0, gathered / np.maximum(sums, 1e-300), weights)
        weights = np.maximum(weights, LEAST_WEIGHT)
        weights /= weights.sum(axis=1, keepdims=True)
    return weights


def log_scores(token: np.ndarray, pair: np.ndarray, start: int, total: int, words: int,
               weights: np.ndarray) -> tuple[float, float]:
    """log10 of the add-half unigram and of the mixture, summed over a document's tokens."""
    context = np.concatenate([[start], token[:-1]]).astype(np.float64)
    base = (token + 0.5) / (total + 0.5 * (words + 1))
    mix = weights[context_bucket(context)]
    p = mix[:, 0] * pair / np.maximum(context, 1) + mix[:, 1] * token / max(total, 1) + mix[:, 2] * base
    return float(np.log10(base).sum()), float(np.log10(p).sum())


def _score(batches: Iterator[pa.RecordBatch], total: int, words: int, weights: np.ndarray
           ) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [log_scores(unpacked(t.as_py()).astype(np.float64), unpacked(p.as_py()).astype(np.float64),
                           s.as_py(), total, words, weights)
                for t, p, s in zip(*(batch.column(n) for n in ("token", "pair", "start")))]
        base, score = np.array(both, np.float64).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(batch.column("part").to_numpy() == 0),
             batch.column("n_tokens"), batch.column("n_known"),
             pa.array(np.full(batch.num_rows, total, np.int64)), pa.array(base), pa.array(score)],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])


def scores(documents: DataFrame, part: Column, batch_rows: int = BATCH_ROWS) -> DataFrame:
    """Scores of all documents; ``part`` is 0 for none, 1 for training, 2 for training whose
    counts are held out when the weights are learned.

    Returns doc_id, held_out (part 0), n_tokens, n_known, train_tokens, base_score, score.
    """
    count = documents.count()
    batches = max(1, -(-count // batch_rows))
    buckets = max(1, -(-batches // BATCHES_PER_BUCKET))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    dealt = documents.select(
        F.pmod(F.xxhash64("doc_id", text), F.lit(batches)).cast("int").alias("batch"),
        F.xxhash64("doc_id", text).alias("row"), F.col("doc_id").cast("long").alias("doc_id"),
        part.cast("int").alias("part"), text.alias("text"))
    asked = dealt.groupBy("batch").applyInArrow(
        lambda key, table: _ask(key, table, buckets),
        "bucket int, batch int, keys binary, trained binary, held binary")
    answers = asked.groupBy("bucket").applyInArrow(
        _answer, "batch int, bucket int, trained binary, held binary, words long")
    kept = stored(dealt.groupBy("batch").cogroup(answers.groupBy("batch"))
                  .applyInArrow(_keep, _KEPT_DDL))
    sums = kept.agg(F.sum("words"), F.sum(F.when(F.col("part") > 0, F.col("n_tokens"))),
                    F.sum(F.when(F.col("part") == 2, F.col("n_tokens")))).first()
    words, total, held = (int(x or 0) for x in sums)
    grid = (kept.where(F.size("grid") > 0).select(F.explode("grid").alias("g"))
            .groupBy("g.cell").agg(F.sum("g.mass").alias("mass")).toArrow())
    weights = learn_weights(grid.column("cell").to_numpy(), grid.column("mass").to_numpy(),
                            float(total - held), words)
    return kept.select("doc_id", "part", "n_tokens", "n_known", "token", "pair", "start").mapInArrow(
        lambda batches: _score(batches, total, words, weights),
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double")
