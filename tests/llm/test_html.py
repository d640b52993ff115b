"""Tags and main text of odd pages: cut off, badly quoted, deeply nested; scan and names apart."""

from __future__ import annotations

import random
import re
import time
from html.parser import HTMLParser

import pytest

from streamlake.llm import html, queries

from .conftest import words

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def pages(spark):
    return [r["html"] for r in queries.table(spark, "/root/testdata/sf0.01", "pages").limit(50).collect()]


def test_a_page_cut_off_inside_a_tag_takes_one_pass():
    begin = time.perf_counter()
    for page in ("<p " + 'a="x" ' * 100_000, '<p a="' * 50_000, "<p a='" * 50_000 + '="', "<" * 50_000, "<script " * 20_000,
                 "<div class=ad>" * 20_000 + "x" + "</div>" * 20_000, "<div>" * 20_000 + "</span>" * 20_000, "<!--" * 20_000):
        html.main_text(page, {})
    assert time.perf_counter() - begin < 10


def test_every_cut_of_the_pages_gives_no_markup(pages):
    """A cut page gives the words before the cut; a tag that is cut off leaves nothing."""
    begin, parsed = time.perf_counter(), 0
    for seed, page in enumerate(pages):
        full = "".join(p.text for p in html.parts_of(page) if p.kind == "word")
        for cut in random.Random(seed).sample(range(len(page)), 60):
            found = "".join(p.text for p in html.parts_of(page[:cut]) if p.kind == "word")
            open_reference = re.search(r"&[#\w]*$", page[:cut])
            found = found[: len(found) - len(open_reference[0])] if open_reference and found.endswith(open_reference[0]) else found
            assert full.startswith(re.sub("</?$", "", found))  # a lone opening bracket is text
            parsed += 1
    assert parsed >= 3000 and time.perf_counter() - begin < 60


class _Texts(HTMLParser):
    def __init__(self):
        super().__init__()
        self.texts, self.tags = [], []

    def handle_data(self, data):
        self.texts.append(data)

    def handle_starttag(self, tag, attrs):
        self.tags.append(tag)

    handle_startendtag = handle_starttag


def test_tags_as_the_library_parser_sees_them():
    """Random attributes, also with angle brackets, quotes and equals signs in odd places."""
    draw = random.Random(1)
    for _ in range(400):
        pieces = []
        for _ in range(draw.randint(1, 6)):
            value = "".join(draw.choices("ab >=<'/", k=draw.randint(0, 6)))
            attribute = draw.choice([f'k="{value}"', "k", "k=v", f"k = \"{value}\"", 'data-x="a>b"', "k='a>\"b'"])
            pieces.append(f"<{draw.choice(['div', 'span', 'p', 'img'])} {attribute}>word ")
        page = "".join(pieces)
        parser = _Texts()
        parser.feed(page)
        parser.close()
        parts = html.parts_of(page)
        assert "".join(p.text for p in parts if p.kind == "word") == "".join(parser.texts), page
        assert [p.name for p in parts if p.kind == "open"] == parser.tags, page


def test_quoted_brackets_and_embedded_text_stay_whole():
    prose = " ".join(words(30, 2))
    page = f'<article><p>{prose} <img alt="x > y" src=q> Let <math><mi>x</mi></math> be <svg><text>real</text></svg> {prose}</p></article>'
    assert html.main_text(page, {}) == f"{prose} Let x be real {prose}"
    assert html.main_text('<p title="class=ad">kept</p>', {}) == "kept"


def _brute_region(parts, dropped, weights):
    """The best run by all sums; the same scores, found without the scan."""
    scores = []
    for part, out in zip(parts, dropped):
        weight = weights.get(html.feature(part), html.score(html.feature(part)))
        scores.append(0.0 if out else weight * part.words if part.kind == "word" else weight)
    sums = [0.0]
    for s in scores:
        sums.append(sums[-1] + s)
    best, where = 0.0, (0, 0)
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            if sums[j] - sums[i] > best + 1e-9:
                best, where = sums[j] - sums[i], (i, j)
    return best, where


def _random_page(draw, marked):
    def block(depth):
        kind = draw.choice(["p", "p", "ul", "aside", "div class='ad'", "div class='x'", "nav"])
        name = kind.split()[0]
        inner = " ".join(draw.choices("ka lo mi ne".split(), k=draw.randint(1, 12)))
        if name == "ul":
            inner = "".join(f"<li><a href=x>{w}</a>" for w in inner.split())
        elif depth and draw.random() < 0.4:
            inner += block(depth - 1)
        return f"<{kind}>{inner}</{name}>"

    body = "".join(block(2) for _ in range(draw.randint(2, 6)))
    middle = "".join(block(1) for _ in range(draw.randint(1, 3)))
    return f"<body>{body}<article><h1>Head line</h1>{middle}</article>{body}</body>" if marked else f"<body>{body}</body>"


@pytest.mark.parametrize("marked", [True, False])
def test_the_scan_finds_the_best_sum(marked):
    draw = random.Random(7)
    for _ in range(120):
        parts = html.parts_of(_random_page(draw, marked))
        dropped = html.dropped_parts(parts)
        best, _ = _brute_region(parts, dropped, {})
        scores = []
        for part, out in zip(parts, dropped):
            weight = html.score(html.feature(part))
            scores.append(0.0 if out else weight * part.words if part.kind == "word" else weight)
        begin, end = html.best_region(scores)
        assert sum(scores[begin:end]) == pytest.approx(best)


def _inside(parts, begin):
    """End of the element that opens at ``begin``; None without an end tag. By counting."""
    level = 0
    for i in range(begin, len(parts)):
        if parts[i].name == parts[begin].name and parts[i].kind in ("open", "close"):
            level += 1 if parts[i].kind == "open" else -1
            if not level:
                return i
    return None


@pytest.mark.parametrize("marked", [True, False])
def test_names_drop_whole_elements(marked):
    """Every element on its own: dropped by role or name, unless it holds the main element,
    its headline or most words."""
    draw = random.Random(8)
    for _ in range(120):
        parts = html.parts_of(_random_page(draw, marked))
        region = html.labelled_region(parts)
        first, last = region or (0, len(parts))
        must = [first - 1] + [i for i in range(first, last) if parts[i].name == "h1" and parts[i].kind == "open"][:1] if region else []
        total = sum(p.words for p in parts[first:last])
        expected = [False] * len(parts)
        for i, part in enumerate(parts):
            end = _inside(parts, i) if part.kind == "open" else None
            named = part.named and part.name == "div"
            if end is None or not (named or part.name in html.DROPPED) or any(i < k < end for k in must):
                continue
            if sum(p.words for k, p in enumerate(parts[i : end + 1], i) if first <= k < last) <= html.NAME_COST * total:
                expected[i : end + 1] = [True] * (end + 1 - i)
        assert html.dropped_parts(parts) == expected


def test_scan_and_names_each_do_their_part():
    """What only the scan leaves out, and what only the names do."""
    prose = "".join(f"<p>{' '.join(words(30, n))}</p>" for n in range(4))
    links = "<ul>" + "".join(f"<li><a href=x>{w}</a></li>" for w in words(20, 9)) + "</ul>"
    aside = f"<aside><p>{' '.join(words(15, 5))}</p></aside>"
    text = "\n".join(" ".join(words(30, n)) for n in range(4))
    page = f"<body>{links}<div>{prose}{aside}{prose}</div>{links}</body>"
    assert html.main_text(page, {}) == f"{text}\n{text}"
    parts = html.parts_of(page)
    no_names = [False] * len(parts)
    _, (begin, end) = _brute_region(parts, no_names, {})
    scanned = "".join(p.text for p in parts[begin:end] if p.kind == "word")
    assert " ".join(words(15, 5)) in scanned and words(20, 9)[0] + words(20, 9)[1] not in scanned  # the scan alone keeps the aside
    left = "".join(p.text for p, out in zip(parts, html.dropped_parts(parts)) if p.kind == "word" and not out)
    assert words(20, 9)[0] + words(20, 9)[1] in left  # the names alone keep the links


def test_clashing_columns(spark):
    rows = spark.createDataFrame([(1, "u", "<p>some words</p>", "own", 2)], "page_id long, url string, html string, Text string, N int")
    found = html.extract(rows, {})
    assert found.columns == ["page_id", "url", "html", "N", "text"] and found.first()["text"] == "some words"
