"""N-gram Jaccard join by MinHash LSH in bands, verified exactly.

1. Sign.  One pass tokenizes whole texts, takes word shingles, a 128-bit digest of the
   shingle set and, per tree, the hash of a prefix of its MinHash values.  The length
   is the longest, of at most ``DEPTH``, at which the chance that a pair at the threshold
   shares a prefix in some tree reaches the target recall; no tries are built.
2. Group.  Equal sets become one representative with a count, by map-side combining.
   Representatives under the same trie node are tied to the node's least member (a star,
   never all pairs); connected components of the stars are the candidate groups.
3. Verify.  Candidate groups go to tasks in blocks of bounded rows and bytes; each pair of
   blocks is compared exactly through a sparse-to-dense incidence product.  A task emits
   one row per member: its number of linked documents and its root within the task.
4. Classes.  Groups of one block are final; roots of larger groups are joined by connected
   components again.

The number of rows emitted grows with documents, not with pairs, though every pair of
distinct texts inside a candidate group is compared.

Defined results: words are runs of letters, digits and non-ASCII characters, A-Z lowered;
a text of fewer words than a shingle is one shingle; a text without words (or null) links
to nothing and is a class of its own; repeated rows are copies of one another; other
columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketlens.llm.components import components
from basketlens.llm.store import free_name, stored
from basketlens.llm.words import ALPHANUMERIC, mixed, shingles, slices, word_hashes

SHINGLE_WORDS = 5
SIMILARITY = 0.8
TREES = 32
DEPTH = 8
TARGET_RECALL = 0.9999
BLOCK_ROWS = 512
BLOCK_BYTES = 4 << 20
_SEEDS = np.random.default_rng(77).integers(1, 2**31, TREES * DEPTH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_TREE = np.random.default_rng(78).integers(1, 2**63, DEPTH, dtype=np.uint64) | np.uint64(1)


def prefix_length(trees: int, depth: int, similarity: float, recall: float) -> int:
    """The longest trie prefix, at most ``depth``, that meets the recall at the threshold."""
    length = depth
    while length > 1 and 1 - (1 - similarity ** length) ** trees < recall:
        length -= 1
    return length


def minhashes(grams: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """``count`` MinHash values of each row; every row has a shingle."""
    values = np.empty((len(bounds) - 1, count), np.uint32)
    folded = (grams ^ (grams >> np.uint64(32))).astype(np.uint32)
    for i in range(count):
        hashed = folded * _SEEDS[i]
        hashed ^= hashed >> np.uint32(15)
        hashed *= np.uint32(0x2C1B3C6D)
        values[:, i] = np.minimum.reduceat(hashed, bounds[:-1])
    return values


def prefix_keys(values: np.ndarray, length: int) -> np.ndarray:
    """Per row and tree, a hash of the tree's number and its first ``length`` values."""
    rows, trees = len(values), values.shape[1] // length
    wide = values.reshape(rows, trees, length).astype(np.uint64)
    total = (wide * _TREE[:length]).sum(axis=2, dtype=np.uint64)
    return mixed(total + np.arange(trees, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def set_digests(grams: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles per row, as offsets into the returned sorted shingles."""
    rows = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    order = np.lexsort((grams, rows))
    grams, rows = grams[order], rows[order]
    fresh = np.ones(len(grams), bool)
    fresh[1:] = (grams[1:] != grams[:-1]) | (rows[1:] != rows[:-1])
    grams, rows = grams[fresh], rows[fresh]
    return grams, np.searchsorted(rows, np.arange(len(bounds)))


_SIGNED = pa.schema([("node", pa.string()), ("doc_id", pa.int64()), ("set_one", pa.int64()),
                     ("set_two", pa.int64()), ("n_bytes", pa.int64()),
                     ("keys", pa.list_(pa.int64()))])


def _sign(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        node, doc_id = batch.column(0), batch.column(1)
        for first, last, data, offsets in slices(batch.column(2)):
            words, _, _, bounds = word_hashes(data, offsets, ALPHANUMERIC)
            grams, at = shingles(words, bounds, SHINGLE_WORDS)
            full = np.flatnonzero(np.diff(at))
            starts = np.append(at[full], len(grams))
            count = len(full)
            one, two = np.zeros((2, last - first), np.uint64)
            keys = np.zeros((0, TREES), np.uint64)
            if count:
                distinct, own = set_digests(grams, starts)
                one[full] = np.add.reduceat(mixed(distinct, seed=3), own[:-1])
                two[full] = np.add.reduceat(mixed(distinct, seed=4), own[:-1])
                keys = prefix_keys(minhashes(grams, starts, TREES * length), length)
            held = np.zeros(last - first + 1, np.int32)
            held[full + 1] = TREES
            yield pa.RecordBatch.from_arrays([
                node.slice(first, last - first), doc_id.slice(first, last - first),
                pa.array(one.view(np.int64)), pa.array(two.view(np.int64)),
                pa.array(np.diff(offsets)),
                pa.ListArray.from_arrays(pa.array(np.cumsum(held, dtype=np.int32)),
                                         pa.array(keys.ravel().view(np.int64)))],
                schema=_SIGNED)


def _roots(linked: np.ndarray) -> np.ndarray:
    """Least index reachable from each, for a symmetric boolean matrix."""
    labels = np.arange(len(linked))
    while True:
        near = np.where(linked, labels[None, :], len(labels)).min(axis=1, initial=len(labels))
        fresh = np.minimum(labels, near)
        fresh = np.minimum(fresh, fresh[fresh])
        if (fresh == labels).all():
            return labels
        labels = fresh


def similarities(texts: pa.Array, width: int = 4096) -> np.ndarray:
    """Exact Jaccard similarities of all pairs of a block's shingle sets."""
    parts, sizes = [], []
    for _, _, data, offsets in slices(texts):
        words, _, _, bounds = word_hashes(data, offsets, ALPHANUMERIC)
        grams, own = set_digests(*shingles(words, bounds, SHINGLE_WORDS))
        parts.append(grams)
        sizes.append(np.diff(own))
    grams, sizes = np.concatenate(parts), np.concatenate(sizes)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    _, column, counts = np.unique(grams, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    keep = shared[column]
    rows, column = rows[keep], number[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    common = np.zeros((len(sizes), len(sizes)), np.float32)
    total = int(shared.sum())
    for low in range(0, total, width):
        a, b = np.searchsorted(column, [low, low + width])
        held = np.zeros((len(sizes), min(width, total - low)), np.float32)
        held[rows[a:b], column[a:b] - low] = 1
        common += held @ held.T
    common = common.astype(np.float64)
    return common / np.maximum(sizes[:, None] + sizes[None, :] - common, 1)


_VERIFIED = pa.schema([("node", pa.string()), ("root", pa.string()), ("links", pa.int64())])


def _verify(table: pa.Table, similarity: float) -> pa.Table:
    """Links between the members of two blocks, or within one."""
    _, own = np.unique(table.column("node").to_numpy(), return_index=True)
    if len(own) < table.num_rows:  # rows that are repeated in the table of documents
        table = table.take(pa.array(np.sort(own)))
    nodes = table.column("node").combine_chunks()
    block = table.column("block").to_numpy()
    low, high = table.column("low")[0].as_py(), table.column("high")[0].as_py()
    linked = similarities(table.column("text").combine_chunks()) >= similarity
    np.fill_diagonal(linked, False)
    if low != high:
        linked &= block[:, None] != block[None, :]
    links = linked @ table.column("copies").to_numpy()
    return pa.Table.from_arrays([nodes, nodes.take(pa.array(_roots(linked))), pa.array(links)],
                                schema=_VERIFIED)


def _node() -> Column:
    """Key of a document: its id and a hash of its text."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                       F.hex(F.xxhash64("text")))


def near_classes(documents: DataFrame, similarity: float = SIMILARITY,
                 recall: float = TARGET_RECALL) -> DataFrame:
    """One row per document: its class, its group of equal texts and its number of links.

    Returns doc_id, class_id (least doc_id of the connected component of links), copy_id
    (least doc_id of the documents with the same shingles) and n_links (documents at or
    above ``similarity``, copies counted).
    """
    return _classed(documents, similarity, recall).drop("node", "component")


def _classed(documents: DataFrame, similarity: float, recall: float = TARGET_RECALL) -> DataFrame:
    """``near_classes`` with the key of the document and the least key of its class's sets."""
    length = prefix_length(TREES, DEPTH, similarity, recall)
    keyed = documents.select(
        _node().alias("node"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = stored(keyed.mapInArrow(
        lambda batches: _sign(batches, length),
        "node string, doc_id long, set_one long, set_two long, n_bytes long, keys array<long>"))
    worded = signed.where(F.size("keys") > 0)
    sets = stored(worded.groupBy("set_one", "set_two").agg(
        F.min("node").alias("node"), F.min("doc_id").alias("copy_id"),
        F.count(F.lit(1)).alias("copies"), F.max("n_bytes").alias("n_bytes"),
        F.first("keys").alias("keys")))

    under = sets.select("node", F.explode("keys").alias("key"))
    shared = (under.groupBy("key").agg(F.min("node").alias("least"), F.max("node").alias("last"))
              .where(F.col("least") < F.col("last")).select("key", "least"))
    stars = (under.join(shared, "key").where(F.col("node") != F.col("least"))
             .select(F.col("node").alias("one"), F.col("least").alias("two")).distinct())
    groups = components(stars)

    members = groups.join(sets.drop("keys"), "node")
    sized = stored(members.groupBy("component").agg(
        F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(BLOCK_ROWS),
                          F.sum("n_bytes") / F.lit(BLOCK_BYTES))).cast("int").alias("blocks")))
    placed = (members.join(sized, "component")
              .select("node", "component", "copies", "blocks",
                      F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int").alias("block")))
    texts = placed.join(keyed.select("node", "text"), "node")
    tasks = (texts.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .withColumn("low", F.least("block", "other"))
             .withColumn("high", F.greatest("block", "other")))
    verified = stored(
        tasks.select("component", "low", "high", "node", "text", "copies", "block")
        .groupBy("component", "low", "high")
        .applyInArrow(lambda found: _verify(found, similarity),
                      "node string, root string, links long"))
    links = verified.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(verified.where(F.col("node") != F.col("root"))
                        .select(F.col("node").alias("one"), F.col("root").alias("two")).distinct())
    of_set = (sets.select("set_one", "set_two", "node", "copy_id", "copies")
              .join(joined, "node", "left").join(links, "node", "left")
              .withColumn("component", F.coalesce("component", "node")))
    least = of_set.groupBy("component").agg(F.min("copy_id").alias("class_id"))
    of_set = of_set.join(least, "component").select(
        "set_one", "set_two", "component", "class_id", "copy_id",
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    named = worded.select("node", "doc_id", "set_one", "set_two").join(of_set, ["set_one", "set_two"])
    alone = signed.where(F.size("keys") == 0).select(
        "node", F.col("node").alias("component"), "doc_id", F.col("doc_id").alias("class_id"), F.col("doc_id").alias("copy_id"),
        F.lit(0).cast("long").alias("n_links"))
    return named.select("node", "component", "doc_id", "class_id", "copy_id", "n_links").unionByName(alone)


def one_of_each(documents: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """``documents`` with one row of each class: that of the least doc_id, nulls last.

    Of several texts under that doc_id, or without any, the least key decides; equal rows
    become one.
    """
    kept = (_classed(documents, similarity).groupBy("component")
            .agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "node")).alias("least"))
            .select(F.col("least.node").alias("node")))
    name = free_name(documents, "kept_node")
    return (documents.withColumn(name, _node()).join(
        kept.withColumnRenamed("node", name), name, "left_semi")
            .dropDuplicates(["doc_id", "text"]).drop(name))
