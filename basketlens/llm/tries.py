"""Prefix trie of conversations, by balanced parentheses per shard.

A node is a distinct sequence of first turns (role, text); every conversation that starts
with it is a member.

1. Order.  Turns are ordered over ranges of (conversation, turn) and numbered by sums of the
   ranges before, so that a conversation of any length is spread over tasks.  Each prefix is
   known by a 128-bit exclusive-or of hashes of its turns and their places, which is summed up
   over blocks of turns in the same way.
2. Nodes.  Members are counted by salted, map-side combined sums.  The smallest member names
   its node at each depth, and the parent is what it visits one turn earlier.
3. Chains.  Nodes of one member need no trie.  The others fall into chains of equal members,
   known by (smallest member, number of members); a conversation meets at most as many chains
   as the square root of twice the table's rows, as members grow fewer along it.
4. Shards.  Chains in order of their paths are dealt to shards by range.  A shard writes its
   part of the trie, with the path down to its first chain, as balanced parentheses; a tree of
   block minima of their excess finds the close of every chain, the rank of leaf pairs counts
   childless chains, and cumulative sums give children of one member and savings.
5. Merge.  Chains on the first and last path of a shard occur in several shards; as every
   chain is weighed in the one shard that holds its row, their parts simply add up.

Conversations that end at a node are digested in numerical order from joined pieces that are
made in ranges; a digest of very many conversations reads its pieces as a stream in one task.

Defined results: rows without a conversation are left out; a null role or text is empty;
null turns come first; turns of equal number are ordered by a digest of role and text, and
repeated rows are turns of their own; an empty table has no nodes, not even the root; other
columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketlens.llm.store import stored

WORD = r"([^\x20\x09-\x0D]+)"
#: Parts in which the members of a node are counted.
SALTS = 64
#: Turns of a conversation that are summed up by one task.
TURN_BLOCK = 1 << 16
#: Conversations named by one piece of a node's list.
PIECE_IDS = 512
SHARD_ROWS = 1 << 18
EXCESS_BLOCK = 64


def ordered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, part, pos, digest, words), and (conv_id, part, n) of all parts.

    ``part`` is the range that holds the turn, ``pos`` counts from 1 and n is the number of
    turns of the whole conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    ranged = stored(
        conversations.where(F.col("conv_id").isNotNull()).select(
            F.col("conv_id").cast("long").alias("conv_id"), "turn",
            F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)).alias("digest"),
            F.size(F.regexp_extract_all(text, F.lit(WORD), 1)).cast("long").alias("words"))
        .groupBy("conv_id", "turn", "digest")
        .agg(F.max("words").alias("words"), F.count(F.lit(1)).alias("copies"))
        .repartitionByRange("conv_id", "turn", "digest")
        .withColumn("part", F.spark_partition_id()))
    parts = ranged.groupBy("conv_id", "part").agg(F.sum("copies").alias("held"))
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = stored(parts.select(
        "conv_id", "part", F.sum("held").over(whole).alias("n"),
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before")))
    within = Window.partitionBy("conv_id", "part").orderBy(
        F.asc_nulls_first("turn"), "digest").rowsBetween(Window.unboundedPreceding, 0)
    numbered = ranged.withColumn("upto", F.sum("copies").over(within)).join(
        parts, ["conv_id", "part"])
    last = F.col("before") + F.col("upto")
    turns = stored(numbered.select(
        "conv_id", "part", F.explode(F.sequence(last - F.col("copies") + 1, last)).alias("pos"),
        "digest", "words"))
    return turns, parts.select("conv_id", "part", "n")


def _visits(turns: DataFrame) -> DataFrame:
    """(conv_id, d, one, two, words, upto, n): each prefix of each sequence of turns.

    ``turns`` holds (conv_id, d, digest, words) with d from 1 on; ``upto`` sums the words of
    the prefix and n is the number of turns.
    """
    hashed = turns.select(
        "conv_id", "d", "words", F.floor(F.col("d") / TURN_BLOCK).alias("block"),
        F.xxhash64("digest", "d").alias("one"), F.xxhash64(F.lit(1), "d", "digest").alias("two"))
    block = Window.partitionBy("conv_id", "block").orderBy("d").rowsBetween(
        Window.unboundedPreceding, 0)
    whole = Window.partitionBy("conv_id")
    earlier = whole.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = hashed.groupBy("conv_id", "block").agg(
        F.bit_xor("one").alias("one"), F.bit_xor("two").alias("two"),
        F.sum("words").alias("words"), F.count(F.lit(1)).alias("n"))
    nothing = F.lit(0).cast("long")
    blocks = blocks.select(
        "conv_id", "block", F.sum("n").over(whole).alias("n"),
        *[F.coalesce(total(name).over(earlier), nothing).alias(f"{name}_before")
          for name, total in (("one", F.bit_xor), ("two", F.bit_xor), ("words", F.sum))])
    return hashed.select(
        "conv_id", "d", "block", "words", F.sum("words").over(block).alias("upto"),
        *[F.bit_xor(name).over(block).alias(name) for name in ("one", "two")]
    ).join(blocks, ["conv_id", "block"]).select(
        "conv_id", "d", F.col("one").bitwiseXOR(F.col("one_before")).alias("one"),
        F.col("two").bitwiseXOR(F.col("two_before")).alias("two"), "words",
        (F.col("upto") + F.col("words_before")).alias("upto"), "n")


def _with_members(visits: DataFrame) -> DataFrame:
    """``visits`` with the members and the smallest member (rep) of the node visited."""
    key = ["d", "one", "two"]
    salted = visits.withColumn("salt", F.pmod(F.xxhash64("conv_id"), F.lit(SALTS)).cast("int"))
    partial = stored(salted.groupBy(*key, "salt").agg(
        F.count(F.lit(1)).alias("held"), F.min("conv_id").alias("least")))
    nodes = partial.groupBy(*key).agg(F.sum("held").alias("members"), F.min("least").alias("rep"))
    named = partial.select(*key, "salt").join(nodes, key)
    return salted.join(named, [*key, "salt"]).drop("one", "two", "salt")


def find_close(bits: np.ndarray, opens: np.ndarray) -> np.ndarray:
    """The place of the close of each open parenthesis, by block minima of the excess."""
    excess = np.cumsum(bits, dtype=np.int64)
    target = excess[opens] - 1
    blocks = -(-len(bits) // EXCESS_BLOCK)
    size = 1 << max(blocks - 1, 0).bit_length()
    padded = np.full(size * EXCESS_BLOCK, np.iinfo(np.int64).max)
    padded[:len(bits)] = excess
    minima = [padded.reshape(size, EXCESS_BLOCK).min(axis=1)]
    while len(minima[-1]) > 1:
        minima.append(minima[-1].reshape(-1, 2).min(axis=1))

    found = np.full(len(opens), -1)
    on, at = np.arange(len(opens)), opens + 1
    while len(on):  # within the block of the open
        done = (at % EXCESS_BLOCK != 0) & (at < len(bits))
        on, at = on[done], at[done]
        hit = padded[at] <= target[on]
        found[on[hit]] = at[hit]
        on, at = on[~hit], at[~hit] + 1

    on = np.flatnonzero(found < 0)
    node, level = opens[on] // EXCESS_BLOCK, np.full(len(on), -1)
    for height in range(len(minima) - 1):  # up to the first subtree that goes low enough
        climbing = level < 0
        right = climbing & (node % 2 == 0)
        right[right] = minima[height][node[right] + 1] <= target[on[right]]
        node, level = np.where(right, node + 1, node), np.where(right, height, level)
        node = np.where(climbing & ~right, node // 2, node)
    for height in range(len(minima) - 2, -1, -1):  # down to its first such block
        below = level > height
        left = node[below] * 2
        node[below] = left + (minima[height][left] > target[on[below]])
    at = node * EXCESS_BLOCK
    while len(on):
        hit = padded[at] <= target[on]
        found[on[hit]] = at[hit]
        on, at = on[~hit], at[~hit] + 1
    return found


def shard_sums(depths: np.ndarray, childless: np.ndarray, exits: np.ndarray, saved: np.ndarray
               ) -> tuple[np.ndarray, np.ndarray]:
    """Leaves and savings below the path to the first row, then below each row.

    Rows are nodes in preorder with their depths, from 1; every node that a path names after
    the first row has a row before.  The first ``depths[0] - 1`` results are of that path.
    """
    above = int(depths[0]) - 1
    closes = np.append(0, depths[:-1] - depths[1:] + 1)
    opens = np.append(np.arange(above), above + np.arange(len(depths)) + np.cumsum(closes))
    bits = np.full(int(opens[-1] + 1 + depths[-1]), -1, np.int8)
    bits[opens] = 1
    close = find_close(bits, opens)
    pairs = np.flatnonzero((bits[:-1] == 1) & (bits[1:] == -1))
    # A pair is no leaf if all its children have one member or lie in a later shard.
    owner = np.searchsorted(opens, pairs) - above
    unreal = pairs[~childless[owner]]
    leaves = np.searchsorted(pairs, close) - np.searchsorted(pairs, opens)
    leaves -= np.searchsorted(unreal, close) - np.searchsorted(unreal, opens)
    first = np.maximum(np.arange(len(opens)) - above, 0)
    last = np.searchsorted(opens, close) - above
    sums = [np.append(0, np.cumsum(weights)) for weights in (exits, saved)]
    return leaves + sums[0][last] - sums[0][first], sums[1][last] - sums[1][first]


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parts of the sums of every chain that a shard of consecutive rows knows."""
    waiting: list[pa.RecordBatch] = []

    def flush() -> pa.RecordBatch:
        table = pa.Table.from_batches(waiting).combine_chunks()
        waiting.clear()
        paths = table.column("path")
        depths = paths.combine_chunks().value_lengths().to_numpy().astype(np.int64)
        leaves, saved = shard_sums(depths, *(
            table.column(name).to_numpy() for name in ("childless", "exits", "saved")))
        above = paths[0].as_py()[:-1]
        return pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.array([step[key] for step in above], pa.int64()),
                               table.column(name).combine_chunks()])
             for key, name in (("rep", "rep"), ("fewer", "fewer"))]
            + [pa.array(leaves), pa.array(saved)], names=["rep", "fewer", "leaves", "saved"])

    for batch in batches:
        for begin in range(0, batch.num_rows, SHARD_ROWS):
            waiting.append(batch.slice(begin, SHARD_ROWS))
            if sum(part.num_rows for part in waiting) >= SHARD_ROWS:
                yield flush()
    if sum(part.num_rows for part in waiting):
        yield flush()


def _chain_sums(visits: DataFrame, nodes: DataFrame) -> DataFrame:
    """(rep, members, low, high, upto_low, leaves, saved) of each chain of shared nodes."""
    shared = nodes.where("members > 1").groupBy("rep", "members").agg(
        F.min("d").alias("low"), F.max("d").alias("high"),
        F.min(F.col("upto") - F.col("words")).alias("upto_low"), F.max("upto").alias("upto_high"),
        F.max_by("children", "d").alias("children"))
    exits = nodes.where("members = 1 AND parent_members > 1 AND d > 1").groupBy(
        F.col("parent_rep").alias("rep"), F.col("parent_members").alias("members")).agg(
        F.count(F.lit(1)).alias("exits"))
    chains = stored(shared.join(exits, ["rep", "members"], "left").select(
        "rep", "members", "low", "high", "upto_low", (F.col("children") == 0).alias("childless"),
        F.coalesce("exits", F.lit(0)).cast("long").alias("exits"),
        ((F.col("members") - 1) * (F.col("upto_high") - F.col("upto_low"))).alias("saved")))
    steps = visits.where("members > 1").select(
        "conv_id", F.struct((-F.col("members")).alias("fewer"), "rep").alias("step")).distinct()
    paths = steps.join(chains.select(F.col("rep").alias("conv_id")).distinct(), "conv_id").groupBy(
        F.col("conv_id").alias("rep")).agg(F.array_sort(F.collect_list("step")).alias("steps"))
    placed = stored(chains.join(paths, "rep").select(
        F.filter("steps", lambda step: step["fewer"] <= -F.col("members")).alias("path"),
        "rep", (-F.col("members")).alias("fewer"), "childless", "exits", "saved"))
    parts = placed.repartitionByRange("path").sortWithinPartitions("path").mapInArrow(
        _shards, "rep long, fewer long, leaves long, saved long")
    sums = parts.groupBy("rep", (-F.col("fewer")).alias("members")).agg(
        F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    return chains.select("rep", "members", "low", "high", "upto_low").join(sums, ["rep", "members"])


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Joined lists of consecutive conversations of a node, of bounded length."""
    for batch in batches:
        rep, d, conv = (column.to_numpy() for column in batch.columns)
        change = np.append(True, (rep[1:] != rep[:-1]) | (d[1:] != d[:-1]))
        starts = np.flatnonzero(change)
        cuts = np.concatenate([np.arange(a, b, PIECE_IDS) for a, b in zip(
            starts, np.append(starts[1:], len(rep)))]) if len(rep) else starts
        names = list(map(str, conv.tolist()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(rep[cuts]), pa.array(d[cuts]), pa.array(conv[cuts]),
             pa.array([",".join(names[a:b]) for a, b in zip(cuts, np.append(cuts[1:], len(rep)))],
                      pa.string())], names=["rep", "d", "first", "names"])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest per node from its pieces, which come in order."""
    node, state = None, None

    def closed(nodes: list, hashes: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([n[0] for n in nodes], pa.int64()), pa.array([n[1] for n in nodes], pa.int64()),
             pa.array(hashes, pa.string())], names=["rep", "d", "ends_sha256"])

    for batch in batches:
        nodes, hashes = [], []
        for rep, d, names in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                                 batch.column(3).to_pylist()):
            if (rep, d) == node:
                state.update(b",")
            else:
                if node:
                    nodes.append(node)
                    hashes.append(state.hexdigest())
                node, state = (rep, d), hashlib.sha256()
            state.update(names.encode())
        yield closed(nodes, hashes)
    if node:
        yield closed([node], [state.hexdigest()])


def _end_digests(ends: DataFrame) -> DataFrame:
    """(rep, d, ends_sha256) of nodes at which conversations (rep, d, conv_id) end."""
    pieces = stored(
        ends.select("rep", "d", "conv_id").repartitionByRange("rep", "d", "conv_id")
        .sortWithinPartitions("rep", "d", "conv_id")
        .mapInArrow(_pieces, "rep long, d long, first long, names string"))
    return (pieces.repartition("rep", "d").sortWithinPartitions("rep", "d", "first")
            .mapInArrow(_digests, "rep long, d long, ends_sha256 string"))


def _row(rep: Column, parent: Column, leaves: Column, saved: Column) -> list[Column]:
    return [rep.alias("conv_id"), F.col("d").cast("long").alias("depth"),
            parent.cast("long").alias("parent_conv_id"), F.col("members").alias("n_convs"),
            F.col("children").alias("n_children"), leaves.cast("long").alias("n_leaves"),
            saved.cast("long").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")]


def trie(turns: DataFrame, conversations: DataFrame) -> DataFrame:
    """The nodes of all ``conversations`` (conv_id) and their ``turns`` (conv_id, d, digest, words).

    Turns count from 1 without gaps; a conversation without turns ends at the root.
    """
    conversations = stored(conversations.select(F.col("conv_id").cast("long")).distinct())
    visits = stored(_with_members(_visits(turns)))
    whole = conversations.agg(F.count(F.lit(1)).alias("members"), F.min("conv_id").alias("rep"))
    earlier = visits.select(F.col("conv_id").alias("rep"), (F.col("d") + 1).alias("d"),
                            F.col("rep").alias("parent_rep"),
                            F.col("members").alias("parent_members"))
    own = visits.where(F.col("conv_id") == F.col("rep")).drop("conv_id").join(
        earlier, ["rep", "d"], "left")
    own = stored(own)
    children = own.where("d > 1").groupBy(F.col("parent_rep").alias("rep"),
                                          (F.col("d") - 1).alias("d")).agg(
        F.count(F.lit(1)).alias("children"))
    nodes = stored(own.join(children, ["rep", "d"], "left").withColumn(
        "children", F.coalesce("children", F.lit(0)).cast("long")))

    chains = _chain_sums(visits, nodes).withColumn("block", F.explode(F.sequence(
        F.floor(F.col("low") / TURN_BLOCK), F.floor(F.col("high") / TURN_BLOCK))))
    root = whole.select(F.struct("rep", "members")).scalar()
    lone = visits.where("d = n").select("conv_id").distinct()
    ends = visits.where("d = n").select("rep", "d", "conv_id").unionByName(
        conversations.join(lone, "conv_id", "left_anti").select(
            root["rep"].alias("rep"), F.lit(0).cast("long").alias("d"), "conv_id"))
    digests = stored(_end_digests(ends))

    placed = nodes.withColumn("block", F.floor(F.col("d") / TURN_BLOCK)).join(
        chains, ["rep", "members", "block"], "left").join(digests, ["rep", "d"], "left")
    lower = (F.col("members") - 1) * (F.col("upto") - F.col("words") - F.col("upto_low"))
    alone = F.col("members") == 1
    below = placed.select(*_row(
        F.col("rep"), F.when(F.col("d") == 1, root["rep"]).otherwise(F.col("parent_rep")),
        F.when(alone, 1).otherwise(F.col("leaves")),
        F.when(alone, 0).otherwise(F.col("saved") - lower)))
    totals = nodes.agg(
        F.count_if(F.col("d") == 1).alias("children"),
        F.greatest(F.count_if(F.col("children") == 0), F.lit(1)).alias("leaves"),
        F.coalesce(F.sum((F.col("members") - 1) * F.col("words")), F.lit(0)).alias("saved"))
    top = whole.where("members > 0").select(
        "*", F.lit(0).cast("long").alias("d"), *[
            totals.select(name).scalar().alias(name) for name in ("children", "leaves", "saved")]
    ).join(digests.where("d = 0"), ["rep", "d"], "left").select(
        *_row(F.col("rep"), F.lit(None), F.col("leaves"), F.col("saved")))
    return top.unionByName(below)


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of a table of conversations (conv_id, turn, role, text).

    Returns conv_id (smallest member), depth, parent_conv_id, n_convs (members), n_children,
    n_leaves (childless nodes of the subtree), saved_tokens (words that members after the first
    share, over the subtree) and ends_sha256 (digest of the members that end at the node).
    """
    turns, parts = ordered(conversations)
    return trie(turns.select("conv_id", F.col("pos").alias("d"), "digest", "words"),
                parts.select("conv_id"))


def with_shared_heads(conversations: DataFrame, group: int, head: Column
                      ) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, d, digest, words) and ids of conversations whose first turns are shared.

    The first ``head`` turns, 0 to 3 as an expression of conv_id, of each conversation are
    replaced by as many first turns (or all there are) of conversation conv_id - conv_id % group.
    """
    turns, parts = ordered(conversations)
    base = (F.col("conv_id") - F.col("conv_id") % group)
    sizes = parts.select("conv_id", "n").distinct()
    plan = stored(sizes.select(
        "conv_id", base.alias("base"), head.cast("long").alias("head")).join(
        sizes.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n")), "base", "left")
        .withColumn("taken", F.least("head", F.coalesce("base_n", F.lit(0)))))
    heads = turns.where((F.col("pos") <= 3) & (F.col("conv_id") == base)).select(
        F.col("conv_id").alias("base"), F.col("pos").alias("d"), "digest", "words")
    shared = plan.join(heads, "base").where(F.col("d") <= F.col("taken"))
    # A long conversation meets its plan in the parts that hold its turns.
    own = turns.join(parts.join(plan, "conv_id").select("conv_id", "part", "head", "taken"),
                     ["conv_id", "part"]).where(F.col("pos") > F.col("head"))
    rebuilt = shared.select("conv_id", "d", "digest", "words").unionByName(own.select(
        "conv_id", (F.col("pos") - F.col("head") + F.col("taken")).alias("d"), "digest", "words"))
    return stored(rebuilt), plan.select("conv_id")
