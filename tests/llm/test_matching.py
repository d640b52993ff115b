"""Line dedup, near-duplicates, decontamination, sharding: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from streamlake.llm import decontaminate, line_dedup, minhash, queries, sharding

from .conftest import ODD, VOCABULARY, words

SF_DIR = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=str)


# ---------------------------------------------------------------- lines


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def dedup_by_hand(rows):
    first: dict[str, tuple] = {}
    order = sorted({r[:2] for r in rows if r[1] is not None}, key=lambda r: (r[0] is not None, r[0] or 0))
    for doc_id, text in order:
        for n, line in enumerate(text.split("\n")):
            if line.strip(" \t\x0b\x0c\r"):
                first.setdefault(line, (doc_id, text, n))
    kept, near = [], set()
    for line in first:
        if len(line) >= line_dedup.MIN_FUZZY_CHARS:
            if any(one_edit(line, other) for other in kept):
                near.add(line)
            kept.append(line)
    out = []
    for doc_id, text, *_ in rows:
        lines = [] if text is None else text.split("\n")
        real = [x for x in lines if x.strip(" \t\x0b\x0c\r")]
        rest = [x for n, x in enumerate(lines) if x not in real or first[x] == (doc_id, text, n) and x not in near]
        left = sum(x in real for x in rest)
        joined = None if text is None else "" if real and not left else "\n".join(rest)
        out.append((doc_id, len(real), len(real) - left, joined))
    return sorted(out, key=str)


def test_lines_against_brute_force(spark, documents):
    pick = random.Random(5)
    base = [" ".join(words(6, n)) for n in range(12)]
    rows = [*ODD, (20, "The quick brown fox jumps"), (21, "The quick brown fix jumps\nThe quick brown fox jump"),
            (22, "xThe quick brown fox jumps"), (23, "😀 The quick brown fox jumps"), (24, "The quick brown fox jumps.."),
            (25, "abcd\nabce")]
    for n in range(30, 60):
        lines = []
        for _ in range(4):
            line = pick.choice(base)
            at = pick.randrange(len(line))
            lines.append(pick.choice([line, line[:at] + line[at + 1 :], line[:at] + "z" + line[at:], line[:at] + "ö" + line[at + 1 :]]))
        rows.append((n, "\n".join(lines)))
    found = line_dedup.dedup_lines(documents(rows))
    assert rows_of(found, "doc_id", "n_lines", "n_removed", "text") == dedup_by_hand(rows)
    assert set(found.columns) > {"lang", "note", "n_chars"}


@pytest.mark.parametrize("least", [1, 9])
def test_short_lines_against_brute_force(spark, documents, monkeypatch, least):
    monkeypatch.setattr(line_dedup, "MIN_FUZZY_CHARS", least)  # of dedup_by_hand
    short = ["a", "b", "ab", "It, and.", "It and.", "xyz", "", "é", "fifteen letters", "sixteen  letters", "fifteen lettersx"]
    pick = random.Random(7)
    rows = [*ODD, *[(100 + n, "\n".join(pick.choices(short, k=3))) for n in range(12)]]
    rows += [(200 + n, "".join(pick.choices("pqr", k=pick.randrange(1, 12)))) for n in range(60)]
    found = line_dedup.dedup_lines(documents(rows), least)
    assert rows_of(found, "doc_id", "n_lines", "n_removed", "text") == dedup_by_hand(rows)


def test_no_lines(spark, documents):
    assert line_dedup.dedup_lines(documents([])).count() == 0


# ---------------------------------------------------------------- near duplicates


def shingles_by_hand(text):
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", (text or "").translate(LOWER)) if w]
    if len(found) < 5:
        return {tuple(found)} if found else set()
    return {tuple(found[i : i + 5]) for i in range(len(found) - 4)}


def components_by_hand(rows):
    sets = {doc_id: shingles_by_hand(text) for doc_id, text, *_ in rows}
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return sorted(((d, len(sets[d]), root(d), root(d) == d) for d in sets), key=str)


def edited(base, edits, seed):
    pick, out = random.Random(seed), list(base)
    for _ in range(edits):
        out[pick.randrange(len(out))] = pick.choice(VOCABULARY)
    return " ".join(out)


def test_near_duplicates_against_brute_force(spark, documents, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)  # so that pools of this size take several blocks
    base, passage = words(120, 3), words(60, 4)
    rows = [r for r in ODD if r[0] is not None]
    rows += [(100 + n, edited(base, n % 9, n)) for n in range(60)]  # similarities around the limit
    rows += [(200 + n, " ".join([*passage, *words(60, 500 + n)])) for n in range(40)]  # share half
    rows += [(300 + n, " ".join(base)) for n in range(10)]
    found = minhash.near_duplicates(documents(rows))
    got = sorted(set(rows_of(found, "doc_id", "n_shingles", "component_id", "kept")), key=str)
    assert got == components_by_hand(rows)
    assert found.count() == len(rows)


def test_nul_belongs_to_words(spark, documents):
    base = words(40, 6)
    rows = [(1, "a\0b c"), (2, "a b c"), (3, "\0"), (4, "x\0\0 \0y z \0 v w"), (5, "x \0y z v w"), (6, "a\0B c"),
            (7, " ".join(base)), (8, " ".join([*base[:20], "\0", *base[20:]])), (9, "\0".join(base))]
    found = minhash.near_duplicates(documents(rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id", "kept") == components_by_hand(rows)


def test_near_duplicates_of_the_table(spark):
    rows = [tuple(r) for r in queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()]
    assert rows_of(queries.op8_minhash(spark, SF_DIR), "doc_id", "n_shingles", "component_id", "kept") == components_by_hand(rows)


def test_ids_that_are_null_stay_and_no_rows_are_fine(spark, documents):
    found = minhash.near_duplicates(documents([(None, "a b c d e f"), (None, "a b c d e f"), (3, "a b c d e f")]))
    assert rows_of(found, "doc_id", "component_id", "kept") == [(3, 3, True), (None, 3, True), (None, 3, True)]
    assert minhash.near_duplicates(documents([])).count() == 0


# ---------------------------------------------------------------- decontamination

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def hits_by_hand(docs, items):
    windows = {}
    for item, text in items:
        found = WORDS.findall((text or "").translate(LOWER))
        length = min(10, len(found))
        for i in range(len(found) - length + 1 if length else 0):
            windows.setdefault(tuple(found[i : i + length]), set()).add(item)
    out = []
    for doc_id, text, *_ in docs:
        found = WORDS.findall((text or "").translate(LOWER))
        hit, named = set(), set()
        for length in {len(w) for w in windows}:
            for i in range(len(found) - length + 1):
                if tuple(found[i : i + length]) in windows:
                    hit.update(range(i, i + length))
                    named |= {str(n) for n in windows[tuple(found[i : i + length])] if n is not None}
        out.append((doc_id, len(found), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


@pytest.mark.parametrize("block_bytes", [decontaminate.BLOCK_BYTES, 200])
def test_hits_against_brute_force(spark, documents, block_bytes, monkeypatch):
    long_, short = words(40, 8), ["Zebra", "crossing"]
    items = [(1, " ".join(long_)), (2, ", ".join(short)), (3, None), (4, "!?"), (None, " ".join(words(12, 9))), (10, " ".join(long_[5:25]))]
    docs = [*ODD, (50, " ".join(long_)), (51, " ".join(words(9, 1) + long_[3:14] + ["x"] + long_[20:31])), (52, "zebra-CROSSING zebra"),
            (53, " ".join(long_[:9])), (54, "crossing"), (55, " ".join(words(12, 9))), (56, " ".join(long_[:5] + long_[:15] * 2))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(documents(docs), benchmark, block_bytes)
    monkeypatch.setattr(decontaminate, "find_contamination", lambda *_: found)
    monkeypatch.setattr(queries, "table", lambda *_: None)
    got = rows_of(queries.op3_decontamination(spark, ""), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert got == hits_by_hand(docs, items)

    clean = decontaminate.remove_spans(found)
    assert clean.columns == documents([]).columns
    left = dict(rows_of(clean.filter("doc_id >= 50"), "doc_id", "text"))
    assert left[50] == "" and left[54] == "crossing" and left[52] == " zebra" and left[53] == " ".join(long_[:9])


def test_no_benchmark_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    found = decontaminate.find_contamination(documents(ODD), none)
    assert found.filter("size(spans) > 0 or size(items) > 0").count() == 0
    some = spark.createDataFrame([(1, "x y")], "item_id long, text string")
    assert decontaminate.find_contamination(documents([]), some).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=12), min_size=1, max_size=6), st.lists(st.integers(1, 3), min_size=1, max_size=4))
def test_the_index_counts_and_locates(runs, window):
    import numpy as np

    text = np.array([x for run in runs for x in [*run, 0]], np.int32)
    index = decontaminate.FMIndex(text)
    low, high = index.search(np.array([window]))
    found = sorted(index.locate(np.arange(int(low[0]), int(high[0]))).tolist())
    assert found == [i for i in range(len(text)) if text[i : i + len(window)].tolist() == window]


# ---------------------------------------------------------------- shards


def test_shards_are_even_and_groups_stay_together(spark, documents):
    rows = ODD + [(100 + n, f"copy {n % 40}") for n in range(120)] + [(300 + n, "hot") for n in range(90)] + [(500 + n, f"own {n}") for n in range(90)]
    found = sharding.shard_documents(documents(rows), 7).collect()
    assert len(found) == len(rows)
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 7 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    texts = dict(rows)
    for r in found:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
    places = {}
    for r in found:
        places.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    assert sum(len(p) > 1 for text, p in places.items() if text and text.startswith("copy")) <= 6  # one per border
    assert len(places["hot"]) <= 4  # of 90 rows, shards hold about 44


def test_fewer_documents_than_shards(spark, documents):
    found = sharding.shard_documents(documents([(1, "a"), (2, None)]), 5).collect()
    assert sorted((r["slot"], r["shard"] < 5) for r in found) == [(0, True), (0, True)]
    assert sharding.shard_documents(documents([]), 5).count() == 0


def _cut_groups(found, texts) -> int:
    places = {}
    for r in found:
        places.setdefault(texts[r["doc_id"]], set()).add(r["shard"])
    return sum(len(p) > 1 for p in places.values())


def test_rounds_bring_groups_together(spark, documents):
    rows = [(n, f"copy {n % 60}") for n in range(240)] + [(1000 + n, f"own {n}") for n in range(160)]
    cut = [_cut_groups(sharding.shard_documents(documents(rows), 6, rounds).collect(), dict(rows)) for rounds in (0, 1, 16)]
    assert cut[0] >= 40 and cut[1] < cut[0] and cut[2] <= 3


def test_even_shards_by_brute_force(spark):
    """Labels over and under the even count, also shards without any: the surplus moves, no more."""
    import random

    draw = random.Random(4)
    for shards, n_labelled, n in ((5, 90, 130), (4, 40, 40), (3, 0, 8), (6, 3, 4)):
        labels = [(k, draw.choice([0, 0, 0, shards - 1]), draw.randint(0, 9)) for k in range(n_labelled)]
        nodes = spark.createDataFrame([(k,) for k in range(n)], "node long").repartition(3)
        found = sharding.even_shards(nodes, spark.createDataFrame(labels, "node long, shard int, group long"), shards).collect()
        placed = {r["node"]: r["shard"] for r in found}
        assert sorted(placed) == list(range(n))
        targets = [n // shards + (s < n % shards) for s in range(shards)]
        for s in range(shards):
            assert sorted(r["slot"] for r in found if r["shard"] == s) == list(range(targets[s]))
            own = sorted((group, node) for node, shard, group in labels if shard == s)
            stayed = {node for _, node in own[: targets[s]]}  # in the order of groups, up to the even count
            assert stayed <= {node for node, shard in placed.items() if shard == s}
            assert sum(placed[node] == s for _, node in own) <= targets[s]


def test_grants_keep_to_the_room():
    import random

    draw = random.Random(2)
    for _ in range(200):
        flows = {(a, b): draw.randint(1, 50) for a in range(5) for b in range(5) if a != b and draw.random() < 0.6}
        rooms = [draw.randint(0, 40) for _ in range(5)]
        shares = sharding._shares(flows, rooms)
        assert all(0 <= x <= 1 for x in shares.values())
        for s in range(5):
            come = sum(shares[p] * n for p, n in flows.items() if p[1] == s)
            swapped = sum(min(n, flows.get((p[1], p[0]), 0)) for p, n in flows.items() if p[1] == s)
            assert come <= swapped + rooms[s] + 1e-9


def test_large_hubs_are_split(spark):
    """A hub of most documents becomes parts of a shard's size, and several links per node count."""
    nodes = spark.range(400).withColumnRenamed("id", "node")
    links = nodes.selectExpr("node", "1L AS hub").filter("node < 300").union(nodes.selectExpr("node", "node % 7 + 10 AS hub").filter("node >= 300"))
    links = links.union(nodes.selectExpr("node", "99L AS hub").filter("node % 50 = 0"))
    labels = sharding.propagate(nodes, links, 4).collect()
    assert sorted(r["node"] for r in labels) == list(range(400))
    placed = {}
    for r in labels:
        placed.setdefault(r["group"], set()).add(r["shard"])
    assert sum(len(p) > 1 for p in placed.values()) <= 3


def test_own_columns_pass_through_line_dedup_and_quality(spark):
    """Names that the operators use inside, or add, in any case."""
    from streamlake.llm import quality_rules

    names = ["doc_id", "text", "_hash", "_doc", "_removed", "_lines", "N_LINES", "_words", "_windows", "_cutoffs", "a.b", "lang", "Kept"]
    row = (1, "same line of words\nsame line of words", *"abcdefghi", "en", "x")
    docs = spark.createDataFrame([row], ", ".join(f"`{n}` {'long' if n == 'doc_id' else 'string'}" for n in names))
    found = line_dedup.dedup_lines(docs)
    own = [n for n in names if n != "N_LINES"]
    assert found.columns == [*own, "n_lines", "n_removed"]
    got = found.first()
    assert got["text"] == "same line of words" and (got["n_lines"], got["n_removed"], got["a.b"]) == (2, 1, "i")
    counted = quality_rules.count_rules(docs)
    assert counted.columns == [*own, *quality_rules.COUNTS, "n_lines"] and counted.first()["_words"] == "f"
    cutoffs = spark.createDataFrame([("en", {"symbols_per_word": 1.0})], "stratum string, cutoffs map<string,double>")
    decided = quality_rules.decide(counted, cutoffs)
    assert decided.columns == [*[n for n in counted.columns if n != "Kept"], "base_failed", "broken", "certified", "kept"]
    assert (decided.first()["_cutoffs"], decided.first()["certified"]) == ("h", True)
