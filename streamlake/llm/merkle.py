"""Merkle manifest of a dataset, as a tree that keeps SHA-256 midstates.

Rows are leaves. The leaves of a source, in order, are hashed in runs of three up to one
subroot, and the subroots in the order of their sources up to one root. A parent keeps a
copy of the hash state before each child slot, so replacing a child resumes there: only
the replacement and the siblings to its right are hashed again.

Work is cut into chunks of ``CHUNK`` neighbouring nodes, whole subtrees that one task
hashes; their tops are the nodes of the next round. On the way down each chunk gets the
siblings of its own path, one row per chunk, and folds all its nodes. So a source of any
size is spread over tasks, and nothing of the leaves reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from streamlake.llm.files import staged
from streamlake.llm.numbering import numbered

FANOUT = 3
CHUNK = FANOUT**7  # nodes of a task's group, a power of the fan-out

NODES = "tree long, n long, pos long, digest string"
PATHS = "tree long, pos long, subroot string, root string, lefts array<string>, rights array<string>"


def leaf_text(values: Sequence[Column]) -> Column:
    """What a leaf hashes: each value as its UTF-8 byte count, ``:`` and itself; null as ``-``."""
    texts = [v.cast("string") for v in values]
    return F.concat(*[F.when(t.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def leaf_hash(values: Sequence[Column]) -> Column:
    return F.sha2(leaf_text(values), 256)


class Slot(NamedTuple):
    """A child's place below its parent: the state before it and its siblings' digests."""

    before: hashlib._Hash
    left: bytes
    right: bytes

    @classmethod
    def after(cls, left: bytes, right: bytes) -> Slot:
        return cls(hashlib.sha256(left), left, right)

    def fold(self, replacement: bytes) -> bytes:
        """The parent's digest with another child in this slot."""
        state = self.before.copy()
        state.update(replacement + self.right)
        return state.hexdigest().encode()


class Parent:
    """A node over a run of children; keeps the state before each of them."""

    def __init__(self, children: Sequence[bytes]):
        state = hashlib.sha256()
        self.slots = []
        for k, child in enumerate(children):
            self.slots.append(Slot(state.copy(), b"".join(children[:k]), b"".join(children[k + 1 :])))
            state.update(child)
        self.digest = state.hexdigest().encode()


def levels_of(n: int, chunk: int) -> int:
    """Levels that a chunk of a tree of ``n`` nodes is hashed up: until the tree, or a whole
    chunk, has one node left."""
    levels = 0
    while FANOUT**levels < min(n, chunk):
        levels += 1
    return levels


class Subtree:
    """The parents of neighbouring nodes, level by level."""

    def __init__(self, digests: Sequence[bytes], levels: int):
        self.levels: list[list[Parent]] = []
        for _ in range(levels):
            parents = [Parent(digests[k : k + FANOUT]) for k in range(0, len(digests), FANOUT)]
            self.levels.append(parents)
            digests = [p.digest for p in parents]
        (self.top,) = digests

    def path(self, at: int) -> Iterator[Slot]:
        """The slots from a node to the top."""
        for parents in self.levels:
            at, slot = divmod(at, FANOUT)
            yield parents[at].slots[slot]


def _subtree(group: pa.Table, chunk: int) -> tuple[pa.Table, Subtree]:
    """The group in order, and its subtree."""
    ordered = group.sort_by("pos")
    digests = [d.encode() for d in ordered["digest"].to_pylist()]
    return ordered, Subtree(digests, levels_of(group["n"][0].as_py(), chunk))


def _chunked(nodes: DataFrame, chunk: int) -> DataFrame:
    return nodes.withColumn("chunk", F.floor(F.col("pos") / chunk))


def _up(nodes: DataFrame, chunk: int) -> DataFrame:
    """The tops of all chunks, the nodes of the next round."""

    def top(key: tuple, group: pa.Table) -> pa.Table:
        tree, pos = (k.as_py() for k in key)
        n = -(-group["n"][0].as_py() // chunk)
        row = {"tree": tree, "n": n, "pos": pos, "digest": _subtree(group, chunk)[1].top.decode()}
        return pa.Table.from_pylist([row], schema=kinds)

    kinds = pa.schema([(c, pa.string() if c == "digest" else pa.int64()) for c in ("tree", "n", "pos", "digest")])
    return _chunked(nodes, chunk).groupBy("tree", "chunk").applyInArrow(top, NODES)


def _rounds(nodes: DataFrame, largest: int, chunk: int) -> list[DataFrame]:
    """The nodes of each round, the last with one node per tree; log(n) / log(chunk) rounds."""
    out = [nodes]
    while largest > 1:
        out.append(staged(_up(out[-1], chunk), "merkle-nodes"))
        largest = -(-largest // chunk)
    return out


def _with_paths(nodes: DataFrame, above: DataFrame, work, schema: str | StructType, chunk: int) -> DataFrame:
    """``work(ordered, subtree, path)`` for each chunk; ``above`` has one path per chunk."""

    def run(key: tuple, group: pa.Table, path: pa.Table) -> pa.Table:
        return work(*_subtree(group, chunk), path.to_pylist()[0])

    chunks = above.withColumnRenamed("pos", "chunk").groupBy("tree", "chunk")
    return _chunked(nodes, chunk).groupBy("tree", "chunk").cogroup(chunks).applyInArrow(run, schema)


def _extended(ordered: pa.Table, subtree: Subtree, path: dict) -> pa.Table:
    """The path of each node of a chunk: its slots in the chunk, then the chunk's own."""
    rows = []
    for at, (tree, pos) in enumerate(zip(ordered["tree"].to_pylist(), ordered["pos"].to_pylist())):
        slots = list(subtree.path(at))
        lefts = [s.left.decode() for s in slots] + path["lefts"]
        rights = [s.right.decode() for s in slots] + path["rights"]
        rows.append({**path, "tree": tree, "pos": pos, "lefts": lefts, "rights": rights})
    return pa.Table.from_pylist([{k: r[k] for k in _PATH_KINDS.names} for r in rows], schema=_PATH_KINDS)


_PATH_KINDS = pa.schema(
    [("tree", pa.int64()), ("pos", pa.int64()), ("subroot", pa.string()), ("root", pa.string())]
    + [(c, pa.list_(pa.string())) for c in ("lefts", "rights")]
)


def _paths_down(rounds: list[DataFrame], top: DataFrame, chunk: int) -> DataFrame:
    """From the paths of the last round's nodes to those of the chunks of the first round."""
    paths = top
    for nodes in reversed(rounds[1:-1]):
        paths = staged(_with_paths(nodes, paths, _extended, PATHS, chunk), "merkle-paths")
    return paths


class Manifest(NamedTuple):
    """The tree: ``rounds`` of nodes of all sources, ``sources`` of subroots, and ``root``.

    The first round has the columns of the leaves. ``root`` is None for an empty table.
    """

    rounds: list[DataFrame]
    sources: list[DataFrame]
    root: str | None
    chunk: int


def build(leaves: DataFrame, order: Sequence[str] = ("doc_id",), chunk: int = CHUNK) -> Manifest:
    """The tree over ``leaves``, which have ``source``, the columns of ``order`` and ``digest``.

    Sources go in the order of their UTF-8 bytes, leaves by ``order`` and then ``digest``,
    null first in both; equal rows are leaves of their own. Other columns are carried in the
    first round; ``tree``, ``n``, ``pos`` and ``chunk`` are taken. ``chunk`` is a power of three
    and changes no digest.
    """
    rows, groups = numbered(leaves, "source", [*order, "digest"])
    trees, forest = numbered(groups.withColumn("forest", F.lit(0)), "forest", ["first"])
    trees = staged(trees.select(F.col("source").alias("_source"), F.col("pos").alias("tree"), "n"), "merkle-trees")
    nodes = staged(rows.join(trees, rows["source"].eqNullSafe(trees["_source"])).drop("_source"), "merkle-leaves")
    size = trees.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("largest")).first()
    if not size["trees"]:
        return Manifest([nodes], [], None, chunk)
    rounds = _rounds(nodes, size["largest"], chunk)
    tops = rounds[-1].select(F.lit(0).cast("long").alias("tree"), F.lit(size["trees"]).alias("n"), F.col("tree").alias("pos"), "digest")
    sources = _rounds(tops, size["trees"], chunk)
    return Manifest(rounds, sources, sources[-1].first()["digest"], chunk)


def prove(manifest: Manifest, replacement: str) -> DataFrame:
    """The leaves with subroot, root, proof_sha256 and folded_root.

    ``proof_sha256`` is the hash of the siblings from the leaf to the root, left to right on
    each level; ``folded_root`` the root with the digest in column ``replacement`` in the
    leaf's place. Both come from the retained states of the leaf's own path only.
    """
    leaves = manifest.rounds[0]
    drop = ("tree", "n", "pos", "chunk")
    own = [f for f in leaves.schema if f.name not in drop]
    added = ("subroot", "root", "proof_sha256", "folded_root")
    schema = leaves.select(*[f.name for f in own]).schema
    for name in added:
        schema = schema.add(name, "string")
    if manifest.root is None:
        return leaves.sparkSession.createDataFrame([], schema)

    def fold(ordered: pa.Table, subtree: Subtree, path: dict) -> pa.Table:
        above = [Slot.after(left.encode(), right.encode()) for left, right in zip(path["lefts"], path["rights"])]
        rest = b"".join(s.left + s.right for s in above)
        proofs, folded = [], []
        for at, digest in enumerate(ordered[replacement].to_pylist()):
            siblings = hashlib.sha256()
            node = digest.encode()
            for slot in subtree.path(at):
                siblings.update(slot.left + slot.right)
                node = slot.fold(node)
            for slot in above:
                node = slot.fold(node)
            siblings.update(rest)
            proofs.append(siblings.hexdigest())
            folded.append(node.decode())
        out = ordered.select([f.name for f in own])
        for name, values in zip(added, ([path["subroot"]] * len(proofs), [path["root"]] * len(proofs), proofs, folded)):
            out = out.append_column(name, pa.array(values, pa.string()))
        return out

    none = F.array().cast("array<string>")
    root = F.lit(manifest.root)
    forest = manifest.sources[-1].select("tree", "pos", root.alias("subroot"), root.alias("root"), none.alias("lefts"), none.alias("rights"))
    if len(manifest.sources) > 1:
        forest = _paths_down(manifest.sources, forest, manifest.chunk)
        forest = staged(_with_paths(manifest.sources[0], forest, _extended, PATHS, manifest.chunk), "merkle-paths")
    subroots = manifest.rounds[-1].select("tree", F.col("digest").alias("_top"))
    paths = forest.drop("tree", "subroot").withColumnRenamed("pos", "tree").join(subroots, "tree")
    paths = paths.select("tree", F.lit(0).cast("long").alias("pos"), F.col("_top").alias("subroot"), "root", "lefts", "rights")
    return _with_paths(leaves, _paths_down(manifest.rounds, paths, manifest.chunk), fold, schema, manifest.chunk)


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def document_leaves(docs: DataFrame, tampered: Column) -> DataFrame:
    """doc_id, source, the leaf ``digest`` of ``FIELDS``, and ``tampered_digest`` of the same with
    ``tampered`` as the text. Other columns are ignored."""
    names = [F.col(c) for c in FIELDS]
    return docs.select("doc_id", "source", leaf_hash(names).alias("digest"), leaf_hash([*names[:-1], tampered]).alias("tampered_digest"))
