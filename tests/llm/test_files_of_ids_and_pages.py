"""Token records, packing and WARC archives: exact round trips."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from streamlake.llm import ids, packing, queries, records, warc

from .conftest import ODD, words

BYTE, WORD = queries.tokenizer_file("byte_bpe_50k.json"), queries.tokenizer_file("word_bpe_49k.json")


def library(path):
    tokenizer = Tokenizer.from_file(path)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces_give_the_library_ids(path):
    texts = [t for _, t in ODD] + [
        "WORD!! word*** it's they'll 12three 4½ x²",
        "two  spaces\n\nand blank lines ",
        " leading\ttab\r\nÉTÉ İstanbul ΣΟΦΟΣ ǅ é",
        "a\x00b . , ' ''s 's\n's",
        "\n",
        " ",
        "hello <|endoftext|> world",
        "a<|startoftext|><|endoftext|>b <|ENDOFTEXT|>",
        "!!! ??? (x) [y].",
    ]
    expected = library(path)
    found = ids.TextEncoder(path).encode([*texts, *texts], 7)
    for text, got in zip([*texts, *texts], found):
        assert got.tolist() == [*expected(text), 7]


def test_special_strings_as_text():
    (got,) = ids.TextEncoder(BYTE, special_as_text=True).encode(["x <|endoftext|>"], 7)
    assert 50256 not in got.tolist()


def test_the_cache_has_a_bound(monkeypatch):
    monkeypatch.setattr(ids, "CACHE_PIECES", 50)
    encode, expected = ids.TextEncoder(BYTE), library(BYTE)
    texts = [" ".join(words(200, seed)) + " " + "x" * 300 for seed in range(3)]
    assert [a.tolist() for a in encode.encode(texts, 2)] == [[*expected(t), 2] for t in texts]
    assert max(map(len, encode._cache)) <= ids.CACHED_CHARS


def test_words_of_letters_take_the_short_way(monkeypatch):
    """ASCII, other letters, and words of fewer and of more ids than are packed in one go."""
    texts = ["plain words Here", "über straße ñandú plain", "x" * 40 + " " + "qxzj" * 60 + " " + "ß" * 90 + " éa,", "日本 語"]
    encode, expected = ids.TextEncoder(BYTE), library(BYTE)
    whole = [[*expected(t), 2] for t in texts]
    monkeypatch.setattr(encode, "_encode", lambda _: pytest.fail("the library got a word"))
    encode._cache[","] = encode._bytes(expected(","))
    letters = encode._letters
    translated = []
    encode._letters = type("Counted", (dict,), {"__getitem__": lambda d, k: translated.append(k) or dict.__getitem__(d, k)})(letters)
    (got,) = encode.encode(texts[:1], 2)
    assert got.tolist() == whole[0]
    assert set(translated) <= {0x20}  # no letter by letter translation of ASCII words
    assert [a.tolist() for a in encode.encode(texts, 2)] == whole


def test_records_round_trip(spark, documents, tmp_path):
    manifest = records.write_records(documents(ODD), str(tmp_path), BYTE, end_id=2)
    got = records.read_records(manifest).collect()
    expected, start, encode = [], 0, library(BYTE)
    for doc_id, text in sorted(ODD, key=lambda r: (r[0] is not None, r[0] or 0)):
        found = np.array([*encode(text), 2], "<u4")
        expected.append((doc_id, start, len(found), zlib.crc32(found.tobytes())))
        start += len(found)
    assert sorted((tuple(r)[:4] for r in got), key=lambda r: r[1]) == expected

    for row in got:  # by the index, in any order
        doc_id, found = records.read_record(row["path"], records.read_index(row["path"])[row["record"]])
        assert (doc_id, len(found)) == (row["doc_id"], row["n_tokens"])


def test_a_damaged_record_raises(spark, documents, tmp_path):
    manifest = records.write_records(documents([(1, "some text")]), str(tmp_path), BYTE, end_id=2)
    path = manifest.first()["path"]
    data = bytearray(open(path, "rb").read())
    data[-6] ^= 1
    open(path, "wb").write(bytes(data))
    with open(path, "rb") as f, pytest.raises(ValueError, match="checksum"):
        records.read_frame(f)


def test_no_documents_no_records(spark, documents, tmp_path):
    manifest = records.write_records(documents([]), str(tmp_path), BYTE, end_id=2)
    assert records.read_records(manifest).count() == 0


def test_packed_pieces_cover_every_document(spark, documents):
    rows = ODD + [(100 + n, " ".join(words(n * 7 % 900 + 1, n))) for n in range(300)]
    pieces = packing.pack(documents(rows).coalesce(2), WORD, end_id=1).collect()
    encode = library(WORD)
    texts = {}
    for doc_id, text in rows:
        texts.setdefault(doc_id, []).append(np.array([*encode(text), 1], "<u4"))
    by_doc = {}
    for p in pieces:
        by_doc.setdefault(p["doc_id"], []).append(p)
    for doc_id, found in by_doc.items():
        copies = texts[doc_id]
        assert sum(p["length"] for p in found) == sum(map(len, copies))
        assert all(p["ids"] == copies[0][p["start"] : p["start"] + p["length"]].tobytes() for p in found)
    windows = {}
    for p in pieces:
        windows.setdefault(p["sequence_id"], []).append(p)
    assert set(by_doc) == set(texts)
    not_full = 0
    for window in windows.values():
        window.sort(key=lambda p: p["offset"])
        ends = np.cumsum([p["length"] for p in window])
        assert [p["offset"] for p in window] == [0, *ends[:-1]]
        assert ends[-1] <= window[0]["tier"] and len({p["tier"] for p in window}) == 1
        not_full += ends[-1] < window[0]["tier"]
    assert not_full <= 2  # one per partition
    steps = {}
    for window in windows.values():
        steps.setdefault(window[0]["step_group"], []).append(window[0]["tier"])
    assert all(len(set(tiers)) == 1 and sum(tiers) <= packing.STEP_TOKENS for tiers in steps.values())


def test_archives_round_trip(spark, tmp_path):
    big, other = "<p>" + "x" * 200, "<p>é" * 60
    rows = [(3, "u3", big, 1), (1, "u 1\n%", big, 2), (2, None, big, 3), (4, "u4", "tiny", 4), (5, "u5", "tiny", 5),
            (6, "u6", None, 6), (7, "u7", "", 7), (None, "n", big, 8), (8, "u8", other, 9), (8, "u8", other, 9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload long")
    manifest = warc.write_warc(pages, str(tmp_path))
    found = warc.read_warc(manifest)
    got = sorted((tuple(r)[:6] for r in found.collect()), key=str)
    expected = []
    for page, url, html, _ in rows:
        payload = (html or "").encode()
        original = 1 if html == big and page in (2, 3) else None
        kind = "response" if original is None else "revisit"
        expected.append((page, url, kind, original, len(payload), hashlib.sha256(payload).hexdigest()))
    assert got == sorted(expected, key=str)
    whole = {r["page_id"]: bytes(r["payload"]) for r in warc.resolve_payloads(found).collect()}
    assert whole[3] == whole[2] == whole[1] == big.encode()

    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert warc.read_warc(warc.write_warc(empty, str(tmp_path / "none"))).count() == 0


def test_archives_have_the_mandatory_headers(spark, tmp_path):
    """Each record has type, id, date and length; responses and revisits a target, a revisit its original's."""
    import gzip

    big = "<p>" + "x" * 200
    rows = [(1, "http://a/1", big), (2, "http://b/ü", big), (3, None, big), (4, "http://a/4", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    (path,) = [r["path"] for r in warc.write_warc(pages, str(tmp_path), date="2026-01-02T03:04:05Z").collect()]
    members = warc.MemberReader(open(path, "rb"))
    records = []
    while (record := members.next()) is not None:
        records.append(warc.parse_record(record))
    assert gzip.open(path).read().startswith(b"WARC/1.1\r\nWARC-Type: warcinfo\r\n")
    for headers, content in records:
        assert {"WARC-Type", "WARC-Record-ID", "WARC-Date", "Content-Length", "Content-Type"} <= set(headers)
        assert headers["WARC-Date"] == "2026-01-02T03:04:05Z" and headers["WARC-Record-ID"].startswith("<urn:uuid:")
        assert int(headers["Content-Length"]) == len(content)
    info, *pages_written = records
    assert info[0]["WARC-Filename"] == path.rsplit("/", 1)[1] and info[0]["Content-Type"] == "application/warc-fields"
    by_page = {int(h["X-Page-ID"]): (h, c) for h, c in pages_written}
    assert [by_page[n][0]["WARC-Type"] for n in (1, 2, 3, 4)] == ["response", "revisit", "revisit", "response"]
    assert all(h["WARC-Target-URI"] for h, _ in pages_written)
    first = by_page[1][0]
    for n in (2, 3):
        headers, content = by_page[n]
        assert headers["WARC-Refers-To"] == first["WARC-Record-ID"] and content == b""
        assert headers["WARC-Refers-To-Target-URI"] == first["WARC-Target-URI"]
        assert headers["WARC-Refers-To-Date"] == first["WARC-Date"] and headers["WARC-Profile"] == warc._SAME_PAYLOAD
    head, _, body = by_page[1][1].partition(b"\r\n\r\n")
    assert head.startswith(b"HTTP/1.1 200 OK\r\n") and body == big.encode()
    assert len({h["WARC-Record-ID"] for h, _ in records}) == len(records)


def test_rests_keep_no_document_alive():
    """Of long documents only the rests are held: their ids are arrays of their own."""
    packer = packing.TierPacker()
    for n in range(60):
        for _, window in packer.add(n, np.full(200_000 + n, n, "<u2")):
            assert sum(p.length for p in window) <= packing.TIERS[-1]
    held = [entry[-1] for pool in packer._pools.values() for entry in pool]
    assert sum(p.ids.nbytes for p in held) == 2 * sum(p.length for p in held) <= 2 * packing.POOL_TOKENS
    assert all(p.ids.base is None and p.doc_tokens == 200_000 + p.doc_id for p in held)


def test_padding_is_bounded_by_one_window():
    """Of a partition, all windows but the last few are full, so the padding is less than the longest tier."""
    packer, draw = packing.TierPacker(), np.random.default_rng(3)
    sizes = draw.integers(1, 5000, 3000)
    windows = [w for n, size in enumerate(sizes) for w in packer.add(n, np.zeros(size, "<u2"))] + list(packer.finish())
    padding = sum(tier - sum(p.length for p in window) for tier, window in windows)
    assert sum(p.length for _, window in windows for p in window) == sizes.sum()
    assert padding < packing.TIERS[-1]
