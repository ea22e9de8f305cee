from __future__ import annotations

import random

import duckdb
import pytest

from basketlens.llm import quotes
from basketlens.llm.oracle import QUOTATION_LINKS
from basketlens.llm.queries import op9_quotation_links


def run(spark, rows):
    frame = spark.createDataFrame([(*r, 9) for r in rows], "scope long, turn long, text string, parent int")
    return {(r.scope, r.turn): (r.parent, r.root, r.depth, r.body)
            for r in quotes.conversations(frame).collect()}


def test_nested_quotes_link_to_the_message_quoted_last(spark):
    out = run(spark, [
        (1, 1, "Shall we meet?"),
        (1, 2, "> Shall  we MEET?\n\nYes, at noon.\nOr at one."),
        (1, 3, ">> Shall we meet?\n> Yes, at noon.\n> Or at one.\n\nOne it is."),
        (1, 4, "> or at one.\nThat is too late."),
        (1, 5, "> > Shall we meet?\nTwo marks, one of them apart"),
        (1, 6, "> nobody said so\nWho?"), (2, 9, "> Shall we meet?\nother conversation"),
        (1, 7, "first\n> One it is.\nlast")])
    assert out == {
        (1, 1): (None, 1, 0, "Shall we meet?"), (1, 2): (1, 1, 1, "Yes, at noon.\nOr at one."),
        (1, 3): (2, 1, 2, "One it is."), (1, 4): (2, 1, 2, "That is too late."),
        (1, 5): (1, 1, 1, "Two marks, one of them apart"), (1, 6): (None, 6, 0, "Who?"),
        (2, 9): (None, 9, 0, "other conversation"), (1, 7): (3, 1, 3, "first\nlast")}


def test_shared_passages_link_to_the_earliest_and_never_forward(spark):
    out = run(spark, [(1, 1, "> same\nearly"), (1, 2, "same"), (1, 3, "same"), (1, 4, "> same\nlate"),
                      (1, 5, "> early\n> same\nboth")])
    assert [out[1, t][0] for t in range(1, 6)] == [None, None, None, 2, 1]


def test_repeated_turns_link_to_the_holder_that_quotes_the_same(spark, monkeypatch):
    monkeypatch.setattr(quotes, "RANGE", 3)
    texts = ["shall we?", "ok", "and then?", "ok", "thanks", "ok", "thanks", "ok", "bye"]
    turns = spark.createDataFrame([(7, t, x) for t, x in enumerate(texts)],
                                  "conv_id long, turn long, text string")
    out = {r.turn: (r.parent, r.root, r.depth) for r in quotes.conversations(quotes.as_mail(turns)).collect()}
    assert out == {t: (t - 1 if t else None, 0, t) for t in range(len(texts))}


def test_later_passages_and_deeper_levels_are_asked(spark):
    out = run(spark, [(1, 1, "noon"), (1, 2, "one"), (1, 3, "> nobody said so\nwhat\n> one\nyes"),
                      (1, 4, ">> noon\n> nobody said so\nlost between"),
                      (1, 5, ">> one\n> unknown\nx\n> noon\ndirect before deeper"),
                      (1, 6, ">> one\n>\nblank outside")])
    assert [out[1, t][0] for t in range(1, 7)] == [None, None, 2, 1, 1, None]


def test_long_threads(spark):
    rows = [(1, 0, "text 0")] + [(1, t, f"> text {t - 1}\ntext {t}") for t in range(1, 70)]
    out = run(spark, rows)
    assert all(out[1, t][1:3] == (0, t) for t in range(70))


def test_nulls_repeats_and_empty(spark):
    out = run(spark, [(1, 1, None), (1, 2, ""), (1, 3, "a"), (1, 3, "b"), (None, 4, "a"), (1, None, "> a\nx"),
                      (1, 5, ">\n> a\n>"), (1, 6, ">")])
    assert out[1, 1] == (None, 1, 0, "") and out[1, 3] == (None, 3, 0, "a")
    assert out[None, 4][0] is None and out[1, None][:3] == (None, None, 0)
    assert out[1, 5] == (3, 3, 1, "") and out[1, 6][0] is None
    assert run(spark, []) == {}


def test_turns_as_mail_and_back_in_reply_order(spark):
    turns = spark.createDataFrame([(7, t, f"line {t}\nmore {t}") for t in range(4)],
                                  "conv_id long, turn long, text string")
    mail = {r.turn: r.text for r in quotes.as_mail(turns).collect()}
    assert mail[2] == ">> line 0\n>> more 0\n> line 1\n> more 1\nline 2\nmore 2"
    out = quotes.reply_ordered(quotes.as_mail(turns)).collect()
    assert [(r.turn, r.parent, r.depth, r.body) for r in out] == [
        (t, t - 1 if t else None, t, f"line {t}\nmore {t}") for t in range(4)]


@pytest.mark.parametrize("text, levels", [("> a\n>> b\n> > c\nd >", [1, 2, 2, 0]), ("", [0])])
def test_levels(spark, text, levels):
    row = quotes.parsed_lines(spark.createDataFrame([(text,)], "text string")).first()
    assert [x.level for x in row.lines] == levels


def test_query_and_statement_agree_on_repeats_quotes_and_nulls(spark, tmp_path):
    rng, parts = random.Random(5), [
        "ok", "OK  ok", "thanks", "and then?", "yes\nno", "", "\n", ">", "> ok", ">> thanks\n> ok\nfine",
        "a\n\n> ok\n\nb", "  ok", "a\r\nb", "ok\n", "\n\nlast", "> \n>> ok\nblank outside", None]
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(parts), 1)
            for c in range(60) for t in range(rng.choice([0, 1, 5, 17])) if rng.random() < 0.95]
    rows += [(1, 2, "zed", "again", 2), (2, 0, "bot", None, 2), (None, 3, "user", "ok", 1),
             (None, 3, "bot", "> ok\nfine", 1), (None, None, None, None, 1), (4, None, "user", "ok", 1),
             (4, None, "user", "ok", 1)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, parent int")
    frame.write.parquet(str(tmp_path / "conversations.parquet"))
    found = [tuple(r[c] for c in sorted(r.asDict())) for r in op9_quotation_links(spark, str(tmp_path)).collect()]
    duck = duckdb.connect()
    duck.execute("CREATE VIEW conversations AS SELECT * FROM read_parquet(?)".replace(
        "?", f"'{tmp_path}/conversations.parquet/*.parquet'"))
    result = duck.execute(QUOTATION_LINKS)
    names = [d[0] for d in result.description]
    wanted = [tuple(row[names.index(c)] for c in sorted(names)) for row in result.fetchall()]
    assert len(found) == len(wanted) > 250
    assert sorted(found, key=repr) == sorted(wanted, key=repr)
    assert len({r[names.index("turn")] for r in wanted}) > 5 and any(r[sorted(names).index("depth")] > 3 for r in wanted)


def test_rows_without_a_whole_key_stay_roots_of_their_own(spark):
    rows = [(None, 1, "a", "x"), (None, 1, "b", "y"), (3, None, "> a\nc", "z"), (3, None, "> a\nc", "z")]
    frame = spark.createDataFrame(rows, "scope long, turn long, text string, role string")
    out = sorted(((r.scope, r.turn, r.parent, r.root, r.depth, r.body, r.role) for r in
                  quotes.conversations(frame, ["role"]).collect()), key=repr)
    assert out == [(3, None, None, None, 0, "c", "z")] * 2 + [
        (None, 1, None, 1, 0, "a", "x"), (None, 1, None, 1, 0, "b", "y")]
