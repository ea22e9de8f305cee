from __future__ import annotations

import json
import random
from hashlib import sha256

import numpy as np
import pytest

from basketlens.llm import bpe, queries

public_tokenizers = pytest.importorskip("public_tokenizers")
tokenizers = pytest.importorskip("tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


def lists(encoder, texts):
    tokens, sizes = encoder.encode(texts)
    ends = np.cumsum(sizes)
    return [tokens[end - size:end].tolist() for end, size in zip(ends, sizes)]


def odd_texts(rng):
    pools = ["aaaab ", "the quick's we'll  \t\n", "0123456789 ", "<|endoftext|> x", "=-_* ",
             "éß中文字ह😀՘\U000323b0Ᲊ 1a!", "\x1c\x1d\x85\xa0　 a"]
    texts = []
    for _ in range(1500):
        pool = rng.choice(pools) + rng.choice(pools)
        texts.append("".join(rng.choice(pool) for _ in range(rng.randint(0, 60))))
    texts += ["".join(rng.choice("abcdefghijklmnoprstuvwxyzABC") for _ in range(rng.randint(1, 40)))
              for _ in range(4000)]
    texts += [letter * n for letter in "a =0\n" for n in range(1, 140)]
    return texts + ["<|endoftext|>" * 3, "<|endoftext|", " <|endoftext|>  <|endoftext|>cd  ", ""]


def test_as_the_library_does(vocabulary, library):
    texts = odd_texts(random.Random(3))
    encoder, decoder = bpe.Encoder(vocabulary), bpe.Decoder(vocabulary)
    expected = [found.ids for found in library.encode_batch(texts, add_special_tokens=False)]
    assert lists(encoder, texts) == expected
    assert 0 < encoder.failed < len(encoder.kept)
    tokens, sizes = encoder.encode(texts)
    assert decoder.decode(tokens, sizes) == texts


def test_covers_with_no_crossed_border_are_exact(vocabulary, monkeypatch):
    rng = random.Random(8)
    words = list({"".join(rng.choice("ethaoinsrl") for _ in range(rng.randint(2, 12)))
                  for _ in range(3000)})
    encoder = bpe.Encoder(vocabulary)
    exact = [encoder.merge(word.encode()) for word in words]
    covers = [encoder.cover(word.encode()) for word in words]
    crossed = [any(vocabulary.crossed(np.array(cover[:-1]), np.array(cover[1:])))
               if len(cover) > 1 else False for cover in covers]
    assert [cover != merged for cover, merged in zip(covers, exact)] == crossed
    assert 100 < sum(crossed) < 2900


def test_tokens_that_do_not_encode_to_themselves_are_not_proposed(tmp_path):
    # "ab" + "c" comes before "b" + "c" + the rest, so "bcd" is cut off whenever "a" precedes,
    # and "abcd" of ("a", "bcd") can never be reached from its own bytes.
    letters = bpe.byte_letters()
    ids = {letter: i for i, letter in enumerate(letters)}
    merges = [("a", "b"), ("b", "c"), ("bc", "d"), ("a", "bcd"), ("d", "d"), ("dd", "d"), ("d", "dd")]
    for left, right in merges:
        ids.setdefault(left + right, len(ids))
    path = tmp_path / "small.json"
    path.write_text(json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [],
        "normalizer": None, "post_processor": None,
        "pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                          "use_regex": True},
        "decoder": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True,
                    "use_regex": True},
        "model": {"type": "BPE", "dropout": None, "unk_token": None,
                  "continuing_subword_prefix": None, "end_of_word_suffix": None,
                  "fuse_unk": False, "byte_fallback": False, "vocab": ids,
                  "merges": [list(pair) for pair in merges]}}))
    vocabulary, rng = bpe.load(str(path)), random.Random(1)
    assert not vocabulary.own[ids["abcd"]] and not vocabulary.own[ids["ddd"]]
    assert vocabulary.own[ids["bcd"]] and vocabulary.own[ids["dd"]]
    texts = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 14))) for _ in range(2000)]
    found = tokenizers.Tokenizer.from_file(str(path)).encode_batch(texts)
    assert lists(bpe.Encoder(vocabulary), texts) == [item.ids for item in found]


def test_long_texts_are_held_in_pieces(vocabulary, library, monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice(["word", "  ", " x'll ", "\n\n \t", "123 ", "ünï "])
                   for _ in range(4000))
    whole = lists(bpe.Encoder(vocabulary), [text, None, text])
    monkeypatch.setattr(bpe, "PIECE_CHARS", 50)
    monkeypatch.setattr(bpe, "WORDS_AT_ONCE", 97)
    monkeypatch.setattr(bpe, "KEPT_WORDS", 5)
    assert lists(bpe.Encoder(vocabulary), [text, None, text]) == whole
    assert whole == [library.encode(text, add_special_tokens=False).ids, [], whole[0]]
    endless = "ab" * 100_000
    assert lists(bpe.Encoder(vocabulary), [endless]) == [library.encode(endless).ids]


def test_rows_of_all_kinds(spark, documents, vocabulary, library):
    rows = [(1, None), (2, ""), (3, "Hello there"), (3, "Hello there"), (None, " é")]
    held = spark.createDataFrame([(*row, "?") for row in rows],
                                 "doc_id long, text string, ids string")
    encoded = bpe.encode(held, vocabulary)
    decoded = bpe.decode(encoded, vocabulary)
    assert sorted(map(str, decoded.collect())) == sorted(
        map(str, bpe.encode(held, vocabulary, decoded=True).collect()))
    assert sorted(((r.doc_id, r.ids, r.text) for r in decoded.collect()), key=str) == sorted(
        ((i, library.encode(text or "").ids, text or "") for i, text in rows), key=str)
    assert bpe.encode(documents([]), vocabulary).count() == 0


def test_decoding_of_any_ids(spark, vocabulary, library):
    rng = random.Random(5)
    rows = [(i, [rng.randrange(50_257) for _ in range(rng.randint(0, 12))]) for i in range(300)]
    strange = [(400, [-1, 50_257, None, 72]), (401, None), (402, [50_256])]
    found = bpe.decode(spark.createDataFrame(rows + strange, "doc_id long, ids array<int>"),
                       vocabulary)
    texts = {row.doc_id: row.text for row in found.collect()}
    assert [texts[i] for i, _ in rows] == [library.decode(ids, skip_special_tokens=False)
                                          for _, ids in rows]
    assert [texts[i] for i in (400, 401, 402)] == ["i", "", "<|endoftext|>"]


def test_the_query(spark, tmp_path, library):
    rows = list(enumerate([*odd_texts(random.Random(6))[:500], None]))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"{tmp_path}/documents.parquet")
    found = {row.doc_id: tuple(row)[1:] for row in queries.op12_bpe(spark, str(tmp_path)).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert found[i] == (len(ids), sha256(",".join(map(str, ids)).encode()).hexdigest(),
                            sha256(decoded.encode()).hexdigest())
