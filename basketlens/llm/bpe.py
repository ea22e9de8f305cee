"""Byte-level BPE encoding and decoding: speculate, verify, merge only what fails.

1. Speculate.  Every distinct word of a slice is covered from the left by the longest
   tokens of the vocabulary.
2. Verify.  A cover is the exact encoding if and only if no merge ever crosses the border
   of two neighbouring tokens.  Whether one does depends on the two tokens alone: on the
   right-hand parts of the left token and the left-hand parts of the right one that exist
   at the same time.  All distinct neighbouring pairs are checked at once, by walking both
   chains of parts back in time in step.
3. Merge.  Words with a crossed border are merged exactly, lowest rank first, leftmost
   first, with a heap, so a word of any length costs n log n.

Only tokens that their own bytes encode to are proposed; the same check finds them when the
vocabulary is read.  A token that two merges make is never proposed, nor is one made of it.

Texts are cut before white space that follows other characters, where words always end, so
a text of any length is held in pieces.  Special tokens stand for themselves wherever their
text occurs, as the reader of such vocabulary files does by default.

Defined results: a null or empty text has no tokens; each row is encoded for itself, so
repeated rows repeat their result; an empty table gives an empty result; ids outside the
vocabulary and null ids decode to nothing; bytes that are no UTF-8 decode to U+FFFD; other columns of the
input are ignored.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterator
from dataclasses import dataclass, field
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from basketlens.llm.words import slices

#: Words that split a text: contractions, letters, digits, other marks, white space.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Words of a slice that are resolved at once.
WORDS_AT_ONCE = 300_000
PIECE_CHARS = 1 << 20
#: Words and tokens that a worker keeps for later slices; a full store is emptied.
KEPT_WORDS = 300_000
KEPT_TOKENS = 2_000_000
#: Words up to this many bytes are covered and merged together, in step.
SHORT_BYTES = 64
MERGED_AT_ONCE = 1 << 13
#: Stands for a character that is neither letter nor digit nor white space.
_SYMBOL = "\u2190"
_NEVER = np.int64(1) << np.int64(62)


def byte_letters() -> list[str]:
    """The letter by which such files write each byte: itself if visible, else from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
    letters, hidden = {b: chr(b) for b in visible}, 0
    for b in range(256):
        if b not in letters:
            letters[b], hidden = chr(256 + hidden), hidden + 1
    return [letters[b] for b in range(256)]


@dataclass
class Vocabulary:
    """Tokens, merges and special tokens, with what the checks need."""

    pieces: list[bytes | None]      # bytes of each id
    left: np.ndarray                # halves of each merged id, -1 for others
    right: np.ndarray
    born: np.ndarray                # rank of the merge that makes each id, -1 for others
    codes: np.ndarray               # merges as left * ids + right, ascending
    ranks: np.ndarray
    merged: np.ndarray              # id that each merge makes
    specials: dict[str, int]
    foreign: str = ""               # newer letters and digits that the reader does not know
    own: np.ndarray = field(default_factory=lambda: np.zeros(0, bool))

    def __post_init__(self) -> None:
        self.own = self._encode_to_themselves()

    def merges_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Index among the merges of each pair, or -1."""
        if not len(self.codes):
            return np.full(len(left), -1)
        code = left.astype(np.int64) * len(self.pieces) + right
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return np.where(self.codes[at] == code, at, -1)

    def crossed(self, left: np.ndarray, right: np.ndarray, halves: bool = False) -> np.ndarray:
        """Whether a merge crosses the border of each pair of tokens.

        With ``halves`` the merge of the two whole tokens does not count.
        """
        found = np.zeros(len(left), bool)
        at = np.arange(len(left))
        x, y = np.asarray(left, np.int64), np.asarray(right, np.int64)
        x_ends, y_ends = np.full(len(at), _NEVER), np.full(len(at), _NEVER)
        while len(at):
            if halves:
                hit, halves = np.zeros(len(at), bool), False
            else:
                merge = self.merges_of(x, y)
                rank = np.where(merge >= 0, self.ranks[merge], _NEVER)
                # Equal merges are done leftmost first: x's own one first, y's own one last.
                hit = (rank < x_ends) & (rank <= y_ends) & (merge >= 0)
            found[at[hit]] = True
            on = ~hit & ((self.born[x] >= 0) | (self.born[y] >= 0))
            at, x, y, x_ends, y_ends = at[on], x[on], y[on], x_ends[on], y_ends[on]
            later = self.born[x] > self.born[y]
            x_ends, y_ends = (np.where(later, self.born[x], x_ends),
                              np.where(later, y_ends, self.born[y]))
            x, y = np.where(later, self.right[x], x), np.where(later, y, self.left[y])
        return found

    def _encode_to_themselves(self) -> np.ndarray:
        own = np.array([piece is not None and len(piece) == 1 for piece in self.pieces])
        made = np.flatnonzero(self.born >= 0)
        whole = ~self.crossed(self.left[made], self.right[made], halves=True)
        for token, fine in zip(made[np.argsort(self.born[made])],
                               whole[np.argsort(self.born[made])]):
            own[token] = fine and own[self.left[token]] and own[self.right[token]]
        repeated = np.bincount(self.merged, minlength=len(own)) > 1
        while True:  # tokens that two merges make, and all that hold them
            holds = (self.born >= 0) & (repeated[self.left] | repeated[self.right]) & ~repeated
            if not holds.any():
                return own & ~repeated
            repeated |= holds


def load(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file with byte-level words and BPE merges."""
    held = json.loads(Path(path).read_text(encoding="utf-8"))
    model, ids = held["model"], held["model"]["vocab"]
    if model["type"] != "BPE" or held["pre_tokenizer"]["type"] != "ByteLevel":
        raise ValueError("the file holds no byte-level BPE vocabulary")
    byte = {letter: b for b, letter in enumerate(byte_letters())}
    specials = {token["content"]: token["id"] for token in held["added_tokens"]}
    size = max([*ids.values(), *specials.values()]) + 1
    pieces: list[bytes | None] = [None] * size
    for token, number in ids.items():
        pieces[number] = bytes(byte[letter] for letter in token)
    for token, number in specials.items():
        pieces[number] = token.encode()
    left, right, born = np.full((3, size), -1, np.int64)
    pairs = [tuple(merge.split(" ") if isinstance(merge, str) else merge)
             for merge in model["merges"]]
    ends = np.array([(ids[a], ids[b], ids[a + b]) for a, b in pairs], np.int64).reshape(-1, 3)
    ranks = np.arange(len(ends))
    left[ends[::-1, 2]], right[ends[::-1, 2]], born[ends[::-1, 2]] = (
        ends[::-1, 0], ends[::-1, 1], ranks[::-1])
    codes = ends[:, 0] * size + ends[:, 1]
    order = np.argsort(codes)
    return Vocabulary(pieces, left, right, born, codes[order], ranks[order], ends[order, 2],
                      specials, _unknown_letters(path))


def _unknown_letters(path: str) -> str:
    """Letters and digits of this Unicode version that the reader of the file does not know."""
    from tokenizers import Tokenizer

    split = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
    every = "".join(map(chr, [*range(128, 0xD800), *range(0xE000, 0x110000)]))
    unknown = []
    for kind, known in (("L", "a"), ("N", "1")):
        for run in regex.findall(rf"\p{{{kind}}}+", every):
            for begin in range(0, len(run), 256):
                part = run[begin:begin + 256]
                if len(split(known + part)) > 1:
                    unknown += [c for c in part if len(split(known + c)) > 1]
    return "".join(unknown)


class Encoder:
    """Encodes many words at once and keeps the tokens of frequent ones."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        self.vocabulary = v = vocabulary
        self.numbers = {piece: i for i, piece in enumerate(v.pieces)
                        if piece is not None and v.own[i]}
        self.letters = np.array([self.numbers.get(bytes([b]), -1) for b in range(256)])
        self.ranked = dict(zip(v.codes.tolist(), zip(v.ranks.tolist(), v.merged.tolist())))
        longest: dict[bytes, int] = {}
        for piece in self.numbers:
            longest[piece[:2]] = max(longest.get(piece[:2], 0), len(piece))
        self.longest = longest
        self._grow()
        self.failed = 0
        self._forget()
        self.words = regex.compile(WORD)
        self.foreign = frozenset(v.foreign)
        self.shadows = dict.fromkeys(map(ord, v.foreign), _SYMBOL)
        self.special = regex.compile("|".join(
            regex.escape(token) for token in sorted(v.specials, key=len, reverse=True))
        ) if v.specials else None

    def _forget(self) -> None:
        """Empty the store: word i has ``lengths[i]`` tokens from ``starts[i]`` on."""
        self.kept = {token: i for i, token in enumerate(self.vocabulary.specials)}
        self.tokens = np.array(list(self.vocabulary.specials.values()), np.int32)
        self.lengths = np.ones(len(self.tokens), np.int64)

    def _grow(self) -> None:
        """A trie of all proposed tokens: per node its token, per inner node its children."""
        edges: dict[int, int] = {}
        tokens = [-1]
        for piece, number in self.numbers.items():
            node = 0
            for byte in piece:
                node = edges.setdefault(node << 8 | byte, len(tokens))
                if node == len(tokens):
                    tokens.append(-1)
            tokens[node] = number
        keys = np.fromiter(edges, np.int64, len(edges))
        inner = np.unique(keys >> 8)
        self.token = np.array(tokens)
        self.inner = np.full(len(tokens), len(inner))
        self.inner[inner] = np.arange(len(inner))
        # One row more, without children, stands for all nodes that end a token.
        self.children = np.full((len(inner) + 1, 256), -1, np.int32)
        self.children[self.inner[keys >> 8], keys & 255] = np.fromiter(
            edges.values(), np.int32, len(edges))

    def covers(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The longest tokens of short words from the left, all words in step."""
        sizes = np.array([len(word) for word in words])
        ends = np.cumsum(sizes)
        data = np.append(np.frombuffer(b"".join(words), np.uint8), np.uint8(0))
        word, at, ends = np.arange(len(words)), ends - sizes, ends
        end = ends[word]
        node, best, after = (np.zeros(len(words), np.int64) for _ in range(3))
        owners, found = [], []
        while len(word):
            child = np.where(at < end, self.children[self.inner[node], data[at]], -1)
            dead = child < 0
            token = np.where(dead, -1, self.token[child])
            at = at + 1
            best, after = np.where(token >= 0, token, best), np.where(token >= 0, at, after)
            if dead.any():
                owners.append(word[dead])
                found.append(best[dead])
                at, node = np.where(dead, after, at), np.where(dead, 0, child)
                on = ~dead | (after < end)
                word, at, end, node, best, after = (
                    values[on] for values in (word, at, end, node, best, after))
            else:
                node = child
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(found)[order], np.bincount(owner, minlength=len(words))

    def merges(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Exact merges of short words: the least, leftmost merge of each word per round."""
        v, owners, found = self.vocabulary, [], []
        by_size = np.argsort([len(word) for word in words], kind="stable")
        made = np.full(int(v.ranks.max(initial=-1)) + 1, -1)
        made[v.ranks] = v.merged
        never = len(made)
        for begin in range(0, len(by_size), MERGED_AT_ONCE):
            held = by_size[begin:begin + MERGED_AT_ONCE]
            width = len(words[held[-1]])
            sizes = np.array([len(words[i]) for i in held])
            letters = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in held), np.uint8)
            parts = self.letters[letters].reshape(len(held), width)
            cols = np.arange(width)
            parts[cols >= sizes[:, None]] = -1

            def ranked(left: np.ndarray, right: np.ndarray) -> np.ndarray:
                merge = v.merges_of(left, right)
                return np.where((merge >= 0) & (left >= 0) & (right >= 0), v.ranks[merge], never)

            ranks = np.full((len(held), width), never)
            ranks[:, :-1] = ranked(parts[:, :-1].ravel(), parts[:, 1:].ravel()
                                   ).reshape(len(held), width - 1)
            rows = np.arange(len(held))
            while len(rows):
                place = ranks.argmin(axis=1)
                least = ranks[np.arange(len(rows)), place]
                done = least == never
                if done.any():
                    owners.append(np.repeat(held[rows[done]], sizes[done]))
                    found.append(parts[done][cols < sizes[done][:, None]])
                    rows, sizes, parts, ranks, place, least = (
                        values[~done] for values in (rows, sizes, parts, ranks, place, least))
                    if not len(rows):
                        break
                own = np.arange(len(rows))
                for table, last in ((parts, -1), (ranks, never)):
                    moved = np.concatenate(
                        [table[:, 1:], np.full((len(rows), 1), last)], axis=1)
                    np.copyto(table, moved, where=cols > place[:, None])
                parts[own, place] = made[least]
                sizes = sizes - 1
                following = np.minimum(place + 1, width - 1)
                ranks[own, place] = np.where(
                    place + 1 < sizes, ranked(made[least], parts[own, following]), never)
                before = np.flatnonzero(place > 0)
                ranks[before, place[before] - 1] = ranked(
                    parts[before, place[before] - 1], made[least[before]])
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        return np.concatenate(found)[order], np.bincount(owner, minlength=len(words))

    def cover(self, word: bytes) -> list[int]:
        """The longest tokens from the left, of a word of any length."""
        numbers, longest, found, at = self.numbers, self.longest, [], 0
        while at < len(word):
            for end in range(at + min(longest.get(word[at:at + 2], 1), len(word) - at), at, -1):
                number = numbers.get(word[at:end])
                if number is not None:
                    break
            found.append(number)
            at = end
        return found

    def merge(self, word: bytes) -> list[int]:
        """Exact merging: lowest rank first, leftmost first."""
        size, ids, merges = len(word), len(self.vocabulary.pieces), self.ranked
        parts = self.letters[np.frombuffer(word, np.uint8)].tolist()
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        heap = []
        for i in range(size - 1):
            found = merges.get(parts[i] * ids + parts[i + 1])
            if found:
                heap.append((found[0], i, parts[i], parts[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, x, y, whole = heapq.heappop(heap)
            j = after[i] if parts[i] == x else size
            if j >= size or parts[j] != y:
                continue
            parts[i], parts[j], after[i] = whole, -1, after[j]
            if after[j] < size:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < size:
                    found = merges.get(parts[a] * ids + parts[b])
                    if found:
                        heapq.heappush(heap, (found[0], a, parts[a], parts[b], found[1]))
        return [part for part in parts if part >= 0]

    def resolve(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of distinct words in order: covers, or exact merges where a border is crossed."""
        held = [word.encode() for word in words]
        tokens, lengths = self._by_size(held, np.arange(len(held)), self.covers, self.cover)
        failing = self.failing(tokens, lengths)
        self.failed += len(failing)
        if not len(failing):
            return tokens, lengths
        merged, sizes = self._by_size(held, failing, self.merges, self.merge)
        starts = np.cumsum(lengths) - lengths
        starts[failing] = len(tokens) + np.cumsum(sizes) - sizes
        lengths[failing] = sizes
        return np.concatenate([tokens, merged])[spread(starts, lengths)], lengths

    def _by_size(self, held: list[bytes], which: np.ndarray, together, alone
                 ) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of the words ``which``: short ones together, each long one alone."""
        long = [i for i, at in enumerate(which) if len(held[at]) > SHORT_BYTES]
        if not long:
            return together([held[at] for at in which])
        lengths, parts = np.zeros(len(which), np.int64), []
        short = np.setdiff1d(np.arange(len(which)), long)
        tokens = np.zeros(0, np.int64)
        if len(short):
            tokens, lengths[short] = together([held[which[i]] for i in short])
        starts = np.zeros(len(which), np.int64)
        starts[short] = np.cumsum(lengths[short]) - lengths[short]
        done = len(tokens)
        for i in long:
            parts.append(alone(held[which[i]]))
            starts[i], lengths[i] = done, len(parts[-1])
            done += lengths[i]
        return np.concatenate([tokens, *map(np.asarray, parts)])[spread(starts, lengths)], lengths

    def failing(self, tokens: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Which covers have a border that a merge crosses."""
        ends, size = np.cumsum(lengths), len(self.vocabulary.pieces)
        inner = np.ones(max(len(tokens) - 1, 0), bool)
        inner[ends[:-1] - 1] = False
        at = np.flatnonzero(inner)
        codes, which = np.unique(tokens[at].astype(np.int64) * size + tokens[at + 1],
                                 return_inverse=True)
        wrong = self.vocabulary.crossed(*np.divmod(codes, size))[which]
        return np.unique(np.searchsorted(ends, at[wrong], side="right"))

    def encode_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all words in order, and how many each word has."""
        coded = pa.array(words, pa.large_string()).dictionary_encode()
        distinct = coded.dictionary.to_pylist()
        at = np.array([self.kept.get(word, -1) for word in distinct])
        fresh = np.flatnonzero(at < 0)
        if len(fresh):
            new = [distinct[i] for i in fresh]
            tokens, lengths = self.resolve(new)
            at[fresh] = len(self.lengths) + np.arange(len(new))
            self.kept.update(zip(new, at[fresh].tolist()))
            self.tokens = np.concatenate([self.tokens, tokens.astype(np.int32)])
            self.lengths = np.concatenate([self.lengths, lengths])
        starts = np.cumsum(self.lengths) - self.lengths
        place = at[coded.indices.to_numpy()]
        lengths = self.lengths[place]
        tokens = self.tokens[spread(starts[place], lengths)]
        if len(self.kept) > KEPT_WORDS or len(self.tokens) > KEPT_TOKENS:
            self._forget()
        return tokens, lengths

    def words_of(self, text: str) -> list[str]:
        """Words of a text without special tokens; letters unknown to the reader are symbols."""
        if text.isascii() or self.foreign.isdisjoint(text):
            return self.words.findall(text)
        return [text[word.start():word.end()]
                for word in self.words.finditer(text.translate(self.shadows))]

    def split(self, text: str) -> Iterator[list[str]]:
        """Words of a text, in lists of bounded length unless a word is longer."""
        at = 0
        for special in [*(self.special.finditer(text) if self.special else ()), None]:
            end = special.start() if special else len(text)
            while at < end:
                cut = _SAFE.search(text, at + PIECE_CHARS, end) if end - at > PIECE_CHARS else None
                stop = cut.start() if cut else end
                yield self.words_of(text[at:stop])
                at = stop
            if special:
                yield [special.group()]
                at = special.end()

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of all texts in order, and how many each text has."""
        found, sizes = [np.zeros(0, np.int32)], np.zeros(len(texts), np.int64)
        words: list[str] = []
        owners: list[tuple[int, int]] = []

        def flush() -> None:
            if words:
                tokens, lengths = self.encode_words(words)
                found.append(tokens)
                rows = np.repeat([row for row, _ in owners], [count for _, count in owners])
                np.add.at(sizes, rows, lengths)
                words.clear()
            owners.clear()

        for row, text in enumerate(texts):
            for part in self.split(text or ""):
                words += part
                owners.append((row, len(part)))
                if len(words) >= WORDS_AT_ONCE:
                    flush()
        flush()
        return np.concatenate(found), sizes


#: White space after another character: no word holds both.
_SAFE = regex.compile(r"(?<=\S)\s")


def spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices ``start, start + 1, …`` of all ranges one after the other."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - ends + lengths, lengths)


class Decoder:
    """Bytes of tokens, by gathering from one array of all tokens' bytes."""

    def __init__(self, vocabulary: Vocabulary) -> None:
        sizes = [len(piece or b"") for piece in vocabulary.pieces]
        self.data = np.frombuffer(b"".join(piece or b"" for piece in vocabulary.pieces), np.uint8)
        # One empty token more stands for ids that the vocabulary does not hold.
        self.sizes = np.array([*sizes, 0], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def decode(self, tokens: np.ndarray, sizes: np.ndarray) -> list[str]:
        """The texts of consecutive lists of tokens."""
        known = np.where((tokens >= 0) & (tokens < len(self.sizes) - 1), tokens,
                         len(self.sizes) - 1)
        parts = [self.data[spread(self.starts[part], self.sizes[part])].tobytes()
                 for part in (known[i:i + WORDS_AT_ONCE]
                              for i in range(0, len(known), WORDS_AT_ONCE))]
        data = b"".join(parts)
        ends = np.append(0, np.cumsum(self.sizes[known]))[np.append(0, np.cumsum(sizes))]
        return [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:])]


def _encode(batches: Iterator[pa.RecordBatch], shared, decoded: bool) -> Iterator[pa.RecordBatch]:
    encoder, decoder = Encoder(shared.value), Decoder(shared.value) if decoded else None
    for batch in batches:
        for first, last, _, _ in slices(batch.column(1)):
            tokens, sizes = encoder.encode(batch.column(1).slice(first, last - first).to_pylist())
            ids = pa.ListArray.from_arrays(
                pa.array(np.append(0, np.cumsum(sizes)).astype(np.int32)), pa.array(tokens))
            columns = [batch.column(0).slice(first, last - first), ids]
            if decoder:
                columns.append(pa.array(decoder.decode(tokens, sizes), pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "text"][:len(columns)])


def encode(documents: DataFrame, vocabulary: Vocabulary, decoded: bool = False) -> DataFrame:
    """(doc_id, ids) of every document; with ``decoded`` also the text that the ids stand for.

    The vocabulary is broadcast: its size is that of the file, whatever the documents.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return documents.select("doc_id", documents["text"].cast("string")).mapInArrow(
        lambda batches: _encode(batches, shared, decoded),
        f"doc_id {kind}, ids array<int>" + (", text string" if decoded else ""))


def _decode(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    decoder = Decoder(shared.value)
    for batch in batches:
        lists = batch.column(1)
        ids, held = lists.flatten(), lists.value_lengths().fill_null(0).to_numpy(False)
        tokens = ids.fill_null(-1).to_numpy(False)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), lists, pa.array(decoder.decode(tokens, held), pa.string())],
            names=["doc_id", "ids", "text"])


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(doc_id, ids, text): the text that each row's ids stand for."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", encoded["ids"].cast("array<int>")).mapInArrow(
        lambda batches: _decode(batches, shared), f"doc_id {kind}, ids array<int>, text string")
