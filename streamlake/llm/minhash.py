"""Near-duplicate documents by circulant MinHash with exact verification.

A shingle's 64-bit hash gives its place under a first permutation of a 2**32 universe; a
second permutation, shifted circularly by k, gives the k-th signature coordinate, so two
permutations make the whole signature. Signatures are banded, candidates compared on their
full shingle sets, and components of the confirmed links found by label propagation.

No pair list of a group is made. Documents with equal sets are one node. In a band's bucket
every node is compared with one hub, the node that shares most buckets with others: of a
text and its edited copies, that is the text. Where buckets still hold several components,
their nodes are compared across components in blocks, inside the tasks. So a link can be
lost only where its two nodes share no bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from streamlake.llm.bits import bit_table, maybe_in
from streamlake.llm.files import staged
from streamlake.llm.tasks import released
from streamlake.llm.words import byte_table, hash_words, shingles, word_groups

SHINGLE_WORDS = 5
SIMILARITY = (75, 100)  # intersection * 100 >= union * 75
# Two sets of similarity 0.75 share no bucket with probability (1 - 0.75**5)**40 = 2e-5.
BANDS, ROWS = 40, 5
WHITE_SPACE = b" \t\n\x0b\x0c\r"

BLOCK = 256  # nodes on each side of a block comparison
_COLUMNS = 8192  # shingles of a block handled together
_BLOCK = 50  # coordinates computed together
# Odd multipliers of the second permutation and the step of its shifts.
_PI_1, _PI_2, _PI_3 = np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35), np.uint32(0x9E3779B1)
_STEP = 0x3C6EF35F


def signature(places: np.ndarray, size: int) -> np.ndarray:
    """``size`` MinHash coordinates of places (uint32) under the first permutation.

    Coordinate k is the minimum of pi(place + k * step) modulo 2**32; every step of pi is
    invertible, so pi is a permutation and the shift a rotation of its argument.
    """
    out = np.empty(size, np.uint32)
    places = places * _PI_1
    for k in range(0, size, _BLOCK):
        n = min(_BLOCK, size - k)
        shifts = (np.arange(k, k + n, dtype=np.uint64) * np.uint64(_STEP)).astype(np.uint32) * _PI_1
        x = places[None, :] + shifts[:, None]
        x ^= x >> np.uint32(15)
        x *= _PI_2
        x ^= x >> np.uint32(13)
        x *= _PI_3
        out[k : k + n] = x.min(axis=1)
    return out


def band_keys(places: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, distinct between bands."""
    rows = signature(places, BANDS * ROWS).reshape(BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for r in range(ROWS):
        key = (key ^ rows[:, r]) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def _sets(column: pa.Array) -> Iterator[np.ndarray]:
    table = byte_table(WHITE_SPACE)
    for _, _, words in word_groups(column, table):
        yield from shingles(hash_words(words), words.first, SHINGLE_WORDS)


SKETCH = "doc_id long, text_hash long, n_shingles long, digest binary, keys array<long>"


def sketches(docs: DataFrame) -> DataFrame:
    """doc_id, hash of the text, n_shingles, digest of the whole set and its band keys (both null
    without shingles)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, digests, keys = [], [], []
            for found in _sets(batch.column("text")):
                sizes.append(len(found))
                digests.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                keys.append(band_keys((found >> np.uint64(32)).astype(np.uint32)) if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.select(["doc_id", "text_hash"]).columns, pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "text_hash", "n_shingles", "digest", "keys"],
            )

    own = [F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text"]
    return docs.select(*own).mapInArrow(released(run), SKETCH)


def shingle_sets(docs: DataFrame) -> DataFrame:
    """``(node, text)`` to node, n and the sorted shingle set as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_sets(batch.column("text")))
            sizes, sets = pa.array(map(len, found), pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("node"), sizes, sets], names=["node", "n", "shingles"])

    return docs.select("node", "text").mapInArrow(released(run), "node long, n long, shingles binary")


def linked(pairs: DataFrame) -> DataFrame:
    """(a, b) of the rows (a, b, set_a, set_b) whose sets reach the similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least, most = SIMILARITY
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                x, y = (np.frombuffer(s.as_buffer(), np.uint64) for s in (x, y))
                both = len(x) + len(y)
                common = both - len(np.union1d(x, y))
                keep.append(most * common >= least * (both - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.mapInArrow(released(run), "a long, b long")


def node_sets(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, n, shingles) of the documents named by ``nodes``, as a written table.

    A bit table keeps the texts of other documents out of the shuffle.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("node"), "text")
    wanted = maybe_in(texts, "node", bit_table(nodes, "node")).join(nodes.hint("merge"), "node")
    return staged(shingle_sets(wanted), "shingle-sets")


def verify(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Confirmed (a, b) among the candidate ``pairs`` of nodes."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    hubs = pairs.select("b").distinct()
    # Merge joins at every size: the sides that carry sets are never sent to all tasks.
    one = left.join(pairs.hint("merge"), "a")
    both = one.join(right.join(hubs, "b", "left_semi").hint("merge"), "b")
    return linked(both.select("a", "b", "set_a", "set_b"))


def components(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b).

    Each round every node takes the smallest label among itself and its neighbours, then
    the label of that label, which halves long chains; labels only shrink and the loop
    ends when none changed. Each round is a written table.
    """
    edges = staged(links.union(links.select("b", "a")).distinct(), "links")
    labels = staged(nodes.select("node", F.col("node").alias("component")), "labels")
    while True:
        best = (
            edges.join(labels, edges["b"] == labels["node"])
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("offered"))
        )
        hooked = labels.join(best, "node", "left").select(
            "node", "component", F.least("component", F.coalesce("offered", "component")).alias("next")
        )
        hooked = staged(hooked, "hooked")
        jumps = hooked.filter(F.col("next") != F.col("node")).select("node", "next")
        roots = hooked.select(F.col("node").alias("next"), F.col("next").alias("far"))
        moved = jumps.join(roots, "next").select("node", "far")
        now = F.coalesce("far", "next")
        after = hooked.join(moved, "node", "left").select(
            "node", now.alias("component"), (now != F.col("component")).alias("changed")
        )
        after = staged(after, "labels")
        labels = after.select("node", "component")
        if after.filter("changed").isEmpty():
            return labels


def _open(members: DataFrame) -> DataFrame:
    """The rows of ``members`` in buckets that hold more than one component."""
    ends = members.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y"))
    return members.join(ends.filter("x < y").select("key"), "key")


def _buckets(entries: DataFrame) -> DataFrame:
    """(key, node, size) of the buckets with several nodes, as a written table."""
    ends = entries.groupBy("key").agg(F.min("node").alias("x"), F.max("node").alias("y"))
    keys = bit_table(ends.filter("x < y").select("key"), "key")
    near = maybe_in(entries, "key", keys)
    sizes = near.groupBy("key").agg(F.count(F.lit(1)).alias("size")).filter("size > 1")
    return staged(near.join(sizes, "key"), "buckets")


def _hubs(members: DataFrame) -> DataFrame:
    """(key, b): the node of each bucket that shares most buckets with others."""
    scores = members.groupBy("node").agg(F.sum("size").alias("score"))
    best = F.max(F.struct("score", (-F.col("node")).alias("first"))).alias("top")
    ranked = members.join(scores, "node").groupBy("key").agg(best)
    return ranked.select("key", (-F.col("top.first")).alias("b"))


def _star_pairs(members: DataFrame) -> DataFrame:
    """(a, b): each node with the hub of its buckets."""
    found = members.select("key", F.col("node").alias("a")).join(_hubs(members), "key").filter("a <> b")
    return staged(found.select("a", "b").distinct(), "pairs")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the common parts of all sets of one side with all of the other."""
    values, places = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owners = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in (*left, *right)])
    counts = np.zeros((len(left), len(right)), np.float32)
    order = np.argsort(places, kind="stable")
    places, owners = places[order], owners[order]
    for begin in range(0, len(values), _COLUMNS):
        part = slice(*np.searchsorted(places, (begin, begin + _COLUMNS)))
        table = np.zeros((len(left) + len(right), _COLUMNS), np.float32)
        table[owners[part], places[part] - begin] = 1
        counts += table[: len(left)] @ table[len(left) :].T
    return counts.astype(np.int64)


def _linked_in_block(block: pa.Table) -> pa.Table:
    """Links between the odd nodes and the nodes of one block, of different components."""
    sides = []
    for odd in (True, False):
        rows = block.filter(pa.compute.equal(block["odd"], odd)).to_pydict()
        sides.append((rows["node"], np.array(rows["component"]), [np.frombuffer(s, np.uint64) for s in rows["shingles"]]))
    (a, of_a, left), (b, of_b, right) = sides
    if not a or not b:
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    common = common_counts(left, right)
    both = np.array([len(s) for s in left])[:, None] + np.array([len(s) for s in right])[None, :] - common
    least, most = SIMILARITY
    i, j = np.nonzero((most * common >= least * both) & (of_a[:, None] != of_b[None, :]))
    return pa.table({"a": pa.array(np.array(a, np.int64)[i]), "b": pa.array(np.array(b, np.int64)[j])})


def links_across(members: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed (a, b) between different components within a bucket; ``members`` has the
    component of each node.

    Buckets are pooled by the component of their hub. Nodes of other components are the odd
    ones of the pool; they are compared with all nodes of it, in blocks of bounded size on
    both sides, so a pool of any size is spread over tasks and only links leave them.
    """
    left = staged(_open(members), "open")
    hubs = _hubs(left).join(left.select("key", F.col("node").alias("b"), F.col("component").alias("pool")), ["key", "b"])
    pooled = staged(left.join(hubs.select("key", "pool"), "key").select("pool", "node", "component").distinct(), "pools")
    sizes = pooled.groupBy("pool").agg(
        F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"),
        F.ceil(F.count_if(F.col("component") != F.col("pool")) / BLOCK).alias("odd_blocks"),
    )
    known = pooled.join(sizes.filter("odd_blocks > 0"), "pool")
    lot = F.xxhash64("node")
    mine, odd_mine = F.pmod(lot, F.col("blocks")), F.pmod(lot, F.col("odd_blocks"))

    def every(n: str) -> Column:
        return F.sequence(F.lit(0).cast("long"), F.col(n) - 1)

    columns = ["pool", "node", "component"]
    as_node = known.select(*columns, mine.alias("block"), F.explode(every("odd_blocks")).alias("odd_block"), F.lit(False).alias("odd"))
    as_odd = known.filter(F.col("component") != F.col("pool")).select(
        *columns, F.explode(every("blocks")).alias("block"), odd_mine.alias("odd_block"), F.lit(True).alias("odd")
    )
    filled = sets.select("node", "shingles").join(as_node.unionByName(as_odd).hint("merge"), "node")
    return filled.groupBy("pool", "block", "odd_block").applyInArrow(_linked_in_block, "a long, b long")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept, text_hash for every row of ``(doc_id, text)``.

    Null, empty and wordless texts have no shingles and are linked with nothing: their
    component is their own id. Equal sets are always linked. Rows that repeat a doc_id with
    one text share their result; with different texts their links are pooled. Rows with a
    null doc_id get a null component and are kept. Other columns are ignored.
    """
    found = staged(sketches(docs), "sketches")
    sets_of = (
        found.filter(F.col("digest").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.min_by("keys", "doc_id").alias("keys"))
    )
    nodes = staged(sets_of, "nodes")
    members = _buckets(nodes.select("node", F.explode("keys").alias("key")))
    several = staged(members.select("node").distinct(), "bucket-nodes")
    sets = node_sets(docs, several)
    pairs = _star_pairs(members)
    links = staged(verify(sets, pairs), "links")
    labels = components(several, links)
    across = staged(links_across(members.join(labels, "node"), sets), "links")
    if not across.isEmpty():
        labels = components(several, links.union(across))

    of_node = nodes.select("digest", "node").join(labels, "node", "left")
    of_digest = of_node.select("digest", F.coalesce("component", "node").alias("component"))
    whole = F.coalesce("component", "doc_id")
    return found.drop("keys").join(of_digest, "digest", "left").select(
        "doc_id",
        "n_shingles",
        whole.alias("component_id"),
        F.coalesce(F.col("doc_id") == whole, F.lit(True)).alias("kept"),
        "text_hash",
    )
