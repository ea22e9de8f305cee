from __future__ import annotations

import math
import random
import re
import zlib
from hashlib import md5, sha256

import duckdb
import numpy as np
import pytest

from basketlens.llm import queries, tries
from basketlens.llm.oracle import PREFIX_TRIE

SCHEMA = "conv_id long, turn long, role string, text string"


def ordered(rows):
    """The turns (role, text) of each conversation."""
    held = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            held.setdefault(conv, []).append((turn is not None, turn or 0, digest, role, text))
    return {conv: [turn[3:] for turn in sorted(turns)] for conv, turns in held.items()}


def shared_heads(turns):
    rebuilt = {}
    for conv, own in turns.items():
        head = zlib.crc32(str(conv).encode()) % 4
        # As in SQL, the remainder has the sign of the id.
        rebuilt[conv] = turns.get(conv - int(math.fmod(conv, 20)), [])[:head] + own[head:]
    return rebuilt


def nodes_of(turns):
    members, ends, children = {}, {}, {}
    for conv, sequence in turns.items():
        for d in range(len(sequence) + 1):
            prefix = tuple(sequence[:d])
            members.setdefault(prefix, []).append(conv)
            if d:
                children.setdefault(prefix[:-1], set()).add(prefix)
        ends.setdefault(tuple(sequence), []).append(conv)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for prefix, held in members.items():
        words = len(re.findall("[^\x20\x09-\x0d]+", prefix[-1][1])) if prefix else 0
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += prefix not in children
            saved[prefix[:d]] += (len(held) - 1) * words
    return sorted(((min(held), len(prefix), min(members[prefix[:-1]]) if prefix else None,
                    len(held), len(children.get(prefix, ())), leaves[prefix], saved[prefix],
                    sha256(",".join(map(str, sorted(ends.get(prefix, [])))).encode()).hexdigest())
                   for prefix, held in members.items()), key=str)


def found_in(frame):
    return sorted(map(tuple, frame.collect()), key=str)


def conversations(rng, count, longest=9):
    """Conversations that branch off one another at all depths, with repeats, nulls and ties."""
    rows = []
    for conv in range(count):
        texts = [rng.choice(["yes", "no", "a  b c", "", None]) for _ in range(rng.randint(0, 3))]
        if rng.random() < 0.4:
            texts = ["same", "first turns", "here"][:rng.randint(1, 3)] + texts
        elif rng.random() < 0.3:
            texts = ["chain"] * rng.randint(1, longest)
        for turn, text in enumerate(texts):
            rows.append((conv, rng.choice([turn, turn, None]), rng.choice(["user", None]), text))
    return rows + [(None, 1, "user", "lost"), (-7, 0, "user", "below"), (-20, 0, "user", "base")]


def test_parentheses_close_where_they_should(monkeypatch):
    rng = random.Random(7)
    for block in (2, 4, 64):
        monkeypatch.setattr(tries, "EXCESS_BLOCK", block)
        for _ in range(40):
            bits, depth, stack, closes = [], 0, [], {}
            while len(bits) < 150 or depth:
                up = depth == 0 or (len(bits) < 150 and rng.random() < 0.55)
                if up:
                    stack.append(len(bits))
                else:
                    closes[stack.pop()] = len(bits)
                bits.append(1 if up else -1)
                depth += bits[-1]
            opens = np.array(sorted(closes))
            assert tries.find_close(np.array(bits, np.int8), opens).tolist() == [
                closes[i] for i in opens]


def test_sums_of_shards_add_up():
    rng = random.Random(2)
    for _ in range(150):
        depths = [1]
        for _ in range(rng.randint(0, 60)):
            depths.append(rng.randint(1, min(depths[-1] + 1, rng.choice([3, 30]))))
        paths, path = [], ()
        for i, depth in enumerate(depths):
            path = path[:depth - 1] + (i,)
            paths.append(path)
        parents = {path[:-1] for path in paths}
        exits = [rng.choice([0, 0, 2]) for _ in paths]
        childless = [path not in parents and not n for path, n in zip(paths, exits)]
        saved = [rng.randint(0, 9) for _ in paths]
        expected = {path: [sum(c + e for p, c, e in zip(paths, childless, exits)
                               if p[:len(path)] == path),
                           sum(s for p, s in zip(paths, saved) if p[:len(path)] == path)]
                    for path in paths}
        found, at = {path: [0, 0] for path in paths}, 0
        while at < len(paths):
            held = slice(at, at + rng.randint(1, len(paths)))
            sums = tries.shard_sums(*(np.array(x[held]) for x in (depths, childless, exits, saved)))
            names = [paths[at][:d] for d in range(1, depths[at])] + paths[held]
            for name, leaves, kept in zip(names, *sums):
                found[name][0] += leaves
                found[name][1] += kept
            at = held.stop
        assert found == expected


@pytest.mark.parametrize("limits", [{}, {"SHARD_ROWS": 3, "TURN_BLOCK": 2, "SALTS": 2, "PIECE_IDS": 2}])
def test_against_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(tries, name, value)
    rows = conversations(random.Random(11), 150)
    held = spark.createDataFrame([(*row, "?") for row in rows], SCHEMA + ", members string")
    assert found_in(tries.prefix_trie(held)) == nodes_of(ordered(rows))


def test_a_third_of_all_rows_in_one_conversation_and_in_copies(spark, monkeypatch):
    monkeypatch.setattr(tries, "TURN_BLOCK", 64)
    rows = [(1, turn, "user", f"turn {turn % 7}") for turn in range(300)]
    rows += [(2, turn, "user", f"turn {turn % 7}") for turn in range(300)]
    rows += [(conv, 0, "user", "all the same") for conv in range(3, 300)]
    rows += [(301, 0, "user", "again")] * 200
    found = found_in(tries.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(5)))
    assert found == nodes_of(ordered(rows))
    assert len(found) == 1 + 300 + 1 + 200


def test_the_query_against_brute_force_and_sql(spark, tmp_path):
    rows = conversations(random.Random(4), 260)
    path = f"{tmp_path}/conversations.parquet"
    spark.createDataFrame(rows, SCHEMA).write.parquet(path)
    expected = nodes_of(shared_heads(ordered(rows)))
    found = queries.op13_prefix_trie(spark, str(tmp_path))
    assert found_in(found) == expected
    assert any(row[1] == 0 and row[7] != sha256(b"").hexdigest() for row in expected)
    with duckdb.connect() as duck:
        duck.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{path}/*.parquet')")
        assert sorted(duck.execute(PREFIX_TRIE).fetchall(), key=str) == expected


def test_empty_and_lone(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert tries.prefix_trie(empty).count() == 0
    one = tries.prefix_trie(spark.createDataFrame([(5, None, None, None)], SCHEMA))
    assert found_in(one) == nodes_of({5: [("", "")]})
    none, ids = spark.createDataFrame([], "conv_id long, d long, digest string, words long"), [(4,), (9,)]
    assert found_in(tries.trie(none, spark.createDataFrame(ids, "conv_id long"))) == nodes_of(
        {4: [], 9: []})
