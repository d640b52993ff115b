"""Merkle manifest against a tree hashed plainly, level by level."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from streamlake.llm import merkle, numbering, queries

from .conftest import ODD

DOC = "doc_id long, text string, lang string, source string, n_chars long, tree string, pos long, digest string, n int"


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text) -> str:
    values = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return h("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def levels(nodes: list[str]) -> list[list[str]]:
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k : k + 3])) for k in range(0, len(out[-1]), 3)])
    return out


def climb(tree: list[list[str]], at: int, node: str) -> tuple[str, list[str]]:
    """(folded top, siblings) of a changed node."""
    siblings = []
    for level in tree[:-1]:
        first = at // 3 * 3
        run = level[first : first + 3]
        siblings += run[: at - first] + run[at - first + 1 :]
        run[at - first] = node
        node, at = h("".join(run)), at // 3
    return node, siblings


def expected(rows) -> list[tuple]:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of (doc_id, text, lang, source, n_chars)."""
    by_source = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        even = doc_id is not None and zlib.crc32(str(doc_id).encode()) % 2 == 0
        changed = text.replace("\n", "") if even and text is not None else text
        both = [leaf(doc_id, source, lang, n_chars, t) for t in (text, changed)]
        by_source[source].append((doc_id is not None, doc_id or 0, *both, doc_id))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = [levels([r[2] for r in sorted(by_source[s])]) for s in names]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, (name, tree) in enumerate(zip(names, trees)):
        for at, (*_, original, changed, doc_id) in enumerate(sorted(by_source[name], key=lambda r: r[:4])):
            subroot, inner = climb(tree, at, changed)
            root, outer = climb(top, k, subroot)
            out.append((doc_id, original, tree[-1][0], top[-1][0], h("".join(inner + outer)), root, root == top[-1][0]))
    return sorted(out, key=str)


def found(spark, rows, chunk):
    docs = spark.createDataFrame([(*r, "t", 1, "d", 2) for r in rows], DOC)
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    changed = F.when(chosen, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    proved = merkle.prove(merkle.build(merkle.document_leaves(docs, changed), chunk=chunk), "tampered_digest")
    columns = ["doc_id", "digest", "subroot", "root", "proof_sha256", "folded_root"]
    return sorted(((*r, r[-1] == r[3]) for r in proved.select(*columns).collect()), key=str)


ROWS = [(d, t, "en" if n % 3 else None, f"s{n % 4}" if n % 5 else None, n) for n, (d, t) in enumerate(ODD)]
ROWS += [(1000 + n, f"text\n{n}" if n % 7 else "same\n", "de", "hot", None) for n in range(40)]
ROWS += [(5, "One.", "x", "Ä", 1), (5, "One.", "x", "Z", 1), (5, "One.", "x", "", 1), (6, "repeated", "x", "hot", 1), (6, "repeated", "x", "hot", 1)]


@pytest.mark.parametrize("chunk", [3, 9, merkle.CHUNK])
def test_proofs_equal_a_plain_tree(spark, chunk):
    assert found(spark, ROWS, chunk) == expected(ROWS)


def test_one_leaf_is_its_own_root(spark):
    rows = [(4, "a\nb", "en", None, 3)]
    (row,) = found(spark, rows, merkle.CHUNK)
    assert [row] == expected(rows) and row[1] == row[2] == row[3] and row[4] == h("")


def test_no_documents(spark):
    assert found(spark, [], merkle.CHUNK) == []


def test_a_fold_hashes_the_replacement_and_the_right_siblings_only():
    children = [h(x).encode() for x in "abc"]
    parent = merkle.Parent(children)
    for k, slot in enumerate(parent.slots):
        assert slot.before.hexdigest() == hashlib.sha256(b"".join(children[:k])).hexdigest()
        changed = [*children[:k], h("x").encode(), *children[k + 1 :]]
        assert slot.fold(h("x").encode()) == hashlib.sha256(b"".join(changed)).hexdigest().encode()
        assert slot.fold(children[k]) == parent.digest  # the kept state is not used up


def test_places_of_a_hot_group_of_equal_rows(spark):
    rows = spark.createDataFrame([("a", 1)] * 500 + [(None, 2)] * 3 + [("b", k) for k in range(7)], "g string, v int").repartition(4)
    placed, groups = numbering.numbered(rows, "g", ["v"])
    by_group = defaultdict(list)
    for r in placed.collect():
        by_group[r["g"]].append((r["pos"], r["v"]))
    assert {g: sorted(p for p, _ in x) for g, x in by_group.items()} == {"a": list(range(500)), None: [0, 1, 2], "b": list(range(7))}
    assert sorted(by_group["b"]) == [(k, k) for k in range(7)]
    assert [r["g"] for r in groups.orderBy("first").collect()] == [None, "a", "b"]


def test_query_on_the_whole_table(spark, sf_dir):
    rows = queries.op12_merkle(spark, sf_dir).collect()
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    assert sorted(map(tuple, rows), key=str) == expected([tuple(r) for r in docs.collect()])
