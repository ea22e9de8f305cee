"""Chat formatting by quotation linking.

Messages quote earlier ones with leading ``>`` marks, nested to any depth.  Quoted lines next
to one another are a passage.  Every level of every passage is normalised (marks off, white
space collapsed, lower case), hashed and asked for; the messages' own passages, whole and line
by line, are the index.  A message replies to the holder of the outermost level of its first
passage, else of its next passages, else of deeper levels; at each, to that of the whole or
else of the longest known line.  Of several holders, one that itself quotes what the message
quotes one level deeper is meant, and of those the last before the message; where no holder
agrees or nothing deeper is quoted, the earliest.  Replies are ordered by thread and depth,
and the quoted lines are taken out of the text.

The index keeps, of asked hashes, one row per scope and hash (a map-side combined minimum)
and the agreeing holders; the last of those before a message is found in ranges of turns, so
a passage that very many messages share or quote never meets all its holders.  Depths
come from pointer doubling, in as many rounds as the logarithm of the longest thread.

Defined results: a null text has no lines and no quotes; a message without a link, or
whose quote is only found in itself or later, is a root of depth 0; blank passages
are not indexed, and one of blank outermost level asks nothing; rows of one scope and turn are
one message, that of the least text (nulls first) and of the least value of each carried
column; every row with a null scope or turn is a root of its own, which quotes and holds nothing
for others; columns that are not carried are ignored, and carried ones may not bear
the names of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.store import stored

#: Turns of one range, in which holders and asking messages are put in order.
RANGE = 1_024
MARKS = r"^(?:>[\x20\x09]?)+"


def normalised(text: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " ")))


def _level(line: Column) -> Column:
    return F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", ""))


def parsed_lines(messages: DataFrame) -> DataFrame:
    """One array per message of its lines: level and line without its marks."""
    line = lambda x: F.struct(_level(x).alias("level"),
                              F.regexp_replace(x, MARKS, "").alias("line"))
    return messages.withColumn("lines", F.transform(
        F.split(F.coalesce("text", F.lit("")), "\n"), line))


def _own_text(lines: Column) -> Column:
    """Level 0 lines; blank lines at both ends go with the quotes they stood by."""
    own = F.array_join(F.transform(F.filter(lines, lambda x: x["level"] == 0),
                                   lambda x: x["line"]), "\n")
    return F.regexp_replace(own, r"^\n+|\n+\z", "")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _levels(passage: Column) -> Column:
    """Per level of a passage, outermost first, its lines without marks."""
    return F.transform(F.array_sort(F.array_distinct(F.transform(passage, lambda x: x["level"]))),
                       lambda level: F.transform(F.filter(passage, lambda x: x["level"] == level),
                                                 lambda x: x["line"]))


def _passages(lines: Column) -> Column:
    """The levels of every passage that quotes something on its outermost level."""
    def between(lines: Column) -> Column:
        plain = F.filter(F.transform(lines, lambda x, i: F.when(x["level"] == 0, i + 1)),
                         lambda x: x.isNotNull())
        return F.filter(F.zip_with(
            F.concat(F.array(F.lit(0)), plain), F.concat(plain, F.array(F.size(lines) + 1)),
            lambda a, b: F.slice(lines, a + 1, b - a - 1)), lambda x: F.size(x) > 0)
    return F.filter(F.transform(_let(lines, between), _levels),
                    lambda x: normalised(F.array_join(x[0], "\n")) != "")


def _latest(asked: DataFrame, holders: DataFrame, key: list[str]) -> DataFrame:
    """The last holder of the key before each turn that asks, by ranges of turns."""
    both = (asked.select(*key, "turn", F.lit(0).alias("holds")).distinct()
            .unionByName(holders.select(*key, "turn", F.lit(1).alias("holds")).distinct())
            .withColumn("range", F.floor(F.col("turn") / RANGE)))
    held = F.when(F.col("holds") == 1, F.col("turn"))
    up_to = Window.unboundedPreceding
    ranges = (both.groupBy(*key, "range").agg(F.max(held).alias("last"))
              .withColumn("before", F.max("last").over(
                  Window.partitionBy(*key).orderBy("range").rowsBetween(up_to, -1))))
    # A turn that asks comes before itself as a holder.
    inside = both.withColumn("inside", F.max(held).over(
        Window.partitionBy(*key, "range").orderBy("turn", "holds").rowsBetween(up_to, 0)))
    return (inside.where("holds = 0").join(ranges, [*key, "range"])
            .select(*key, "turn", F.coalesce("inside", "before").alias("latest"))
            .where("latest IS NOT NULL"))


def _single(rows: DataFrame, key: list[str], carried: Sequence[str]) -> DataFrame:
    """One row per message: key, text and the carried columns; rows without a whole key stay."""
    named = F.col(key[0]).isNotNull() & F.col(key[1]).isNotNull()
    least = F.min(F.struct(F.col("text").isNotNull(), F.col("text"))).getField("text")
    return (rows.where(named).groupBy(*key)
            .agg(least.alias("text"), *[F.min(name).alias(name) for name in carried])
            .unionByName(rows.where(~named).select(*key, "text", *carried)))


def link(messages: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Each message with its own text and the turn it replies to (null for none).

    ``messages`` has scope, turn and text; returns scope, turn, body, parent and the carried
    columns.
    """
    split = stored(parsed_lines(_single(messages, ["scope", "turn"], carried).select(
        "scope", "turn", "text", F.struct(F.lit(0), *carried).alias("carried"))).select(
        "scope", "turn", "carried", _own_text(F.col("lines")).alias("body"),
        _passages(F.col("lines")).alias("quoted")))
    whole = split.where("scope IS NOT NULL AND turn IS NOT NULL")
    hashed = lambda lines: F.md5(normalised(F.array_join(lines, "\n")))
    levels = (whole.select("scope", "turn", F.posexplode("quoted").alias("passage", "levels"))
              .select("scope", "turn", "passage", F.posexplode(F.transform(
                  "levels", lambda x, i: F.struct(x.alias("lines"), hashed(
                      F.get("levels", i + 1)).alias("context")))).alias("level", "q")))
    asked = stored(levels.select("scope", "turn", "passage", "level", "q.context", F.explode(F.array_distinct(
        F.concat(F.array(F.struct(F.lit(1).alias("whole"),
                                  normalised(F.array_join("q.lines", "\n")).alias("text"))),
                 F.transform("q.lines", lambda x: F.struct(F.lit(0).alias("whole"),
                                                           normalised(x).alias("text")))))).alias("a"))
        .where("a.text <> ''")
        .select("scope", "turn", "context", F.struct(
            (-F.col("level")).alias("level"), (-F.col("passage")).alias("passage"), "a.whole",
            F.length("a.text").alias("size")).alias("place"), F.md5("a.text").alias("hash")))
    # Whole passages and lines share one index; md5 of the normalised text is the key.
    own = whole.select("scope", "turn", F.explode(F.array_distinct(F.concat(
        F.array(normalised(F.col("body"))),
        F.transform(F.split("body", "\n"), normalised)))).alias("passage"), F.array_distinct(
            F.transform("quoted", lambda x: hashed(x[0]))).alias("contexts"))
    held = (own.where("passage <> ''").select("scope", F.md5("passage").alias("hash"), "turn", "contexts")
            .join(asked.select("scope", "hash").distinct(), ["scope", "hash"], "left_semi"))
    key = ["scope", "hash", "context"]
    latest = _latest(asked.where("context IS NOT NULL"),
                     held.select("scope", "hash", "turn", F.explode("contexts").alias("context")), key)
    index = held.groupBy("scope", "hash").agg(F.min("turn").alias("holder"))
    found = (asked.join(index, ["scope", "hash"]).where("holder < turn")
             .join(latest, [*key, "turn"], "left")
             .groupBy("scope", "turn")
             .agg(F.max(F.struct("place", F.col("latest").isNotNull().alias("agrees"),
                                 (-F.coalesce("latest", "holder")).alias("earliest"))).alias("best")))
    parent = F.lit(None).cast(messages.schema["turn"].dataType)
    return (whole.join(found.select("scope", "turn", (-F.col("best.earliest")).alias("parent")),
                       ["scope", "turn"], "left")
            .unionByName(split.where("scope IS NULL OR turn IS NULL").withColumn("parent", parent))
            .select("scope", "turn", "body", "parent", *[
                F.col("carried").getField(name).alias(name) for name in carried]))


def threads(links: DataFrame) -> DataFrame:
    """scope, turn, root and depth of every message, by doubling the pointers to ancestors."""
    state = stored(links.select("scope", "turn", F.col("parent").alias("up"),
                                F.coalesce("parent", "turn").alias("root"),
                                F.when(F.col("parent").isNull(), 0).otherwise(1).cast("long").alias("depth")))
    while not state.where("up IS NOT NULL").isEmpty():
        above = state.select(F.col("scope").alias("s"), F.col("turn").alias("t"), F.col("up").alias("next"),
                             F.col("root").alias("top"), F.col("depth").alias("more"))
        open_ = (state.where("up IS NOT NULL")
                 .join(above, (F.col("scope") == F.col("s")) & (F.col("up") == F.col("t")))
                 .select("scope", "turn", F.col("next").alias("up"), F.col("top").alias("root"),
                         (F.col("depth") + F.col("more")).alias("depth")))
        state = stored(state.where("up IS NULL").unionByName(open_))
    return state.select("scope", "turn", "root", "depth")


def conversations(messages: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Messages without quotes, with parent, root, depth and the carried columns.

    Sorted by scope, root, depth and turn they are the conversations in reply order;
    ``reply_ordered`` does so across tasks.
    """
    linked = stored(link(messages, carried))
    whole = linked.where("scope IS NOT NULL AND turn IS NOT NULL")
    alone = linked.where("scope IS NULL OR turn IS NULL")
    return (whole.join(threads(whole), ["scope", "turn"])
            .unionByName(alone.withColumns({"root": F.col("turn"), "depth": F.lit(0).cast("long")}))
            .select("scope", "turn", "parent", "root", "depth", "body", *carried))


def reply_ordered(messages: DataFrame) -> DataFrame:
    """The conversations as a sorted table; the sort deals ranges, so a long one is split."""
    return conversations(messages).orderBy("scope", "root", "depth", "turn")


def as_mail(turns: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """Chat turns as replies that quote the turn before, and within it the turn before that.

    ``turns`` has conv_id, turn and text; returns scope, turn, text and the carried columns.
    A turn repeated in its conversation counts with its least text and values; one without
    a conversation or turn quotes nothing.
    """
    single = _single(turns, ["conv_id", "turn"], carried)
    before = lambda steps, name: single.where("conv_id IS NOT NULL AND turn IS NOT NULL").select(
        "conv_id", (F.col("turn") + steps).alias("turn"), F.col("text").alias(name))
    quoted = lambda text, mark: F.concat(F.lit(mark), F.replace(
        F.col(text), F.lit("\n"), F.lit("\n" + mark)))
    return (single.join(before(1, "text_before"), ["conv_id", "turn"], "left")
            .join(before(2, "text_earlier"), ["conv_id", "turn"], "left")
            .select(F.col("conv_id").alias("scope"), "turn", F.concat_ws(
                "\n", quoted("text_earlier", ">> "), quoted("text_before", "> "),
                F.col("text")).alias("text"), *carried))
