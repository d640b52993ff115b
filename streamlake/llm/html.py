"""Main text of HTML pages by a maximum-scoring subsequence.

A page is a sequence of words and tags. A word scores the learned probability that words of
its context belong to the main text, a tag the negative of what its kind costs outside it;
the contiguous run of the highest sum is the main region, found in one linear scan. The
weights come from pages whose markup names the region, one ``article`` or ``main`` element.
Menus, forms, adverts and the like inside the region are left out by name, unless they hold
the main element, its headline or most of its words.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape
from itertools import accumulate
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from streamlake.llm.tasks import released

TAG_COST = 4.0  # in words, of a tag never seen inside a main region
PRIOR_WEIGHT = 4  # observations that the role of an element counts for
NAME_COST = 0.5  # what a name counts against its element, as a share of the words of the main element or page

# HTML element names by role.
RAW = "script style noscript template textarea title iframe".split()  # not shown as text
VOID = "area base br col embed hr img input link meta param source track wbr".split()
BLOCKS = (
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search "
    "section select summary table tbody td tfoot th thead tr ul"
).split()
CLOSED_BY_LIKE = "p li dt dd tr td th option".split()
PROSE = " p h1 h2 h3 h4 h5 h6 blockquote pre b i em br".split(" ")  # the first is no element at all
LISTS = "ul ol li dl dt dd table tr td figure figcaption section div body html".split()
MAIN = ("article", "main")
DROPPED = "nav header footer aside form button select dialog menu search".split()
# Whole classes, ids and roles that name what is not main text.
DROPPED_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising banner breadcrumb breadcrumbs comment comments consent cookie "
    "cookies copyright disqus footer header login masthead menu modal nav navbar navigation newsletter notice notices "
    "pagination popup promo promoted related reply replies share sharing sidebar signup social sponsor sponsored "
    "subscribe toolbar widget".split()
)

_BLOCKS, _VOID, _LIKE = frozenset(BLOCKS), frozenset(VOID), frozenset(CLOSED_BY_LIKE)
# A quote counts after an equals sign only, and only where it is closed. No two alternatives start
# alike and nothing is given back, so a page takes one pass, also one that is cut off inside a tag.
_ATTRIBUTES = r"""(?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|["'=])*+"""
_PARTS = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{'|'.join(RAW)})(?=[\s/>]){_ATTRIBUTES}>.*?(?:</(?P=raw)\s*+>|\Z)"
    r"|<[!?][^>]*+(?:>|\Z)"
    rf"|<(?P<close>/?)(?P<name>[a-z][^\s/>]*+)(?P<attributes>{_ATTRIBUTES})(?:>|\Z)"
    r"|(?P<text>[^<]++|<)",
    re.IGNORECASE | re.DOTALL,
)
_ATTRIBUTE = re.compile(r"""([^\s=>"'/]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?""")


class Part(NamedTuple):
    kind: str  # "word" run, "open" or "close"
    name: str  # context of the words, or name of the tag
    text: str = ""
    words: int = 0
    named: bool = False  # the tag has a class, id or role of DROPPED_NAMES


def _is_named(attributes: str) -> bool:
    for name, *values in _ATTRIBUTE.findall(attributes):
        if name.lower() in ("class", "id", "role") and not DROPPED_NAMES.isdisjoint("".join(values).lower().split()):
            return True
    return False


def parts_of(html: str) -> list[Part]:
    """Tags and text runs in page order. The context of a run is the innermost open block
    element, or ``a`` inside a link; missing end tags are implied as browsers do. A tag that the
    end of the page cuts off is a tag."""
    out: list[Part] = []
    open_: list[str] = []
    depth: Counter = Counter()  # of each name in open_
    links = 0
    for found in _PARTS.finditer(html):
        text = found["text"]
        if text is not None:
            text = unescape(text)
            out.append(Part("word", "a" if links else open_[-1] if open_ else "", text, len(text.split())))
            continue
        if found["name"] is None:
            if found["raw"]:
                out.append(Part("open", found["raw"].lower()))
            continue
        name = found["name"].lower()
        if found["close"]:
            out.append(Part("close", name))
            if name == "a":
                links = 0
            while depth[name]:
                last = open_.pop()
                depth[last] -= 1
                if last == name:
                    break
            continue
        out.append(Part("open", name, named=_is_named(found["attributes"])))
        if name == "a":
            links = 1
        elif name in _BLOCKS and name not in _VOID:
            links = 0
            if name in _LIKE and open_ and open_[-1] == name or open_ and open_[-1] == "p":
                depth[open_.pop()] -= 1
            open_.append(name)
            depth[name] += 1
    return out


def dropped_parts(parts: list[Part]) -> list[bool]:
    """Which parts lie in an element that is no main text, or are one that shows no text. An
    element without an end tag does not drop what follows it.

    Names count for block elements only. Whatever an element is called, it stays if it holds
    the ``article`` or ``main`` (the first, of several), that one's first ``h1``, or more than
    ``NAME_COST`` of the words in it (of the page, where none is marked). The root, the body
    and the main elements themselves always stay.
    """
    region = labelled_region(parts)
    first, last = region or (0, len(parts))
    kept = [first - 1] if region else []
    for name in () if region else reversed(MAIN):
        kept = kept or [i for i, p in enumerate(parts) if p.kind == "open" and p.name == name][:1]
    if region:
        kept += [i for i in range(first, last) if parts[i].kind == "open" and parts[i].name == "h1"][:1]
    words = [0, *accumulate(p.words if first <= i < last else 0 for i, p in enumerate(parts))]
    waiting: dict[str, list[int]] = {}
    borders = [0] * (len(parts) + 1)  # dropped elements that begin here less those that end before
    for i, part in enumerate(parts):
        if part.kind == "open" and part.name not in _VOID:
            waiting.setdefault(part.name, []).append(i)
        elif part.kind == "close" and waiting.get(part.name):
            begin = waiting[part.name].pop()
            named = parts[begin].named and part.name in _BLOCKS and part.name not in ("html", "body", *MAIN)
            if not (named or part.name in DROPPED) or any(begin < k < i for k in kept):
                continue
            if words[i + 1] - words[begin] <= NAME_COST * words[-1]:
                borders[begin] += 1
                borders[i + 1] -= 1
    return [n > 0 or p.kind == "open" and p.name in RAW for n, p in zip(accumulate(borders), parts)]


def labelled_region(parts: list[Part]) -> tuple[int, int] | None:
    """Part range inside the page's only ``article`` (else ``main``) element."""
    for name in MAIN:
        begins = [i for i, p in enumerate(parts) if p.kind == "open" and p.name == name]
        ends = [i for i, p in enumerate(parts) if p.kind == "close" and p.name == name]
        if len(begins) == len(ends) == 1 and begins[0] < ends[0]:
            return begins[0] + 1, ends[0]
    return None


def feature(part: Part) -> str:
    known = part.name in _BLOCKS or part.name in _VOID or part.name in RAW or part.name in ("", "a", "b", "i", "em")
    return f"{part.kind} {part.name if known else 'other'}"


def learn(pages: DataFrame) -> dict[str, float]:
    """Score per feature, from all pages with a labelled region.

    Tasks send one count per feature; the number of features is bounded by the element
    names. A word's score is its chance to be inside, a tag's is minus its cost outside.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside: Counter = Counter()
        seen: Counter = Counter()
        for batch in batches:
            for html in batch.column("html"):
                parts = parts_of(html.as_py() or "")
                region = labelled_region(parts)
                if region is None:
                    continue
                dropped = dropped_parts(parts)
                for i, part in enumerate(parts):
                    weight = part.words if part.kind == "word" else 1
                    # The named element itself marks the region and is no evidence.
                    if weight and part.name not in MAIN:
                        seen[feature(part)] += weight
                        if region[0] <= i < region[1] and not dropped[i]:
                            inside[feature(part)] += weight
        rows = [{"feature": f, "inside": inside[f], "seen": n} for f, n in seen.items()]
        yield pa.RecordBatch.from_pylist(rows, schema=kinds)

    kinds = pa.schema([("feature", pa.string()), ("inside", pa.int64()), ("seen", pa.int64())])
    counts = pages.select("html").mapInArrow(released(count), "feature string, inside long, seen long")
    totals = counts.groupBy("feature").agg(F.sum("inside").alias("inside"), F.sum("seen").alias("seen")).collect()
    return {r["feature"]: score(r["feature"], r["inside"], r["seen"]) for r in totals}


def score(name: str, inside: int = 0, seen: int = 0) -> float:
    """From counts, smoothed by what the element's role suggests: prose or inline, list or other."""
    kind, _, element = name.partition(" ")
    inline = element != "a" and element not in _BLOCKS and element not in RAW
    prior = 0.95 if element in PROSE or inline else 0.5 if element in LISTS else 0.1
    chance = (inside + PRIOR_WEIGHT * prior) / (seen + PRIOR_WEIGHT)
    return chance if kind == "word" else -TAG_COST * (1 - chance)


def best_region(scores: list[float]) -> tuple[int, int]:
    """The contiguous range of the highest sum, the first one between equals; one scan."""
    best, region = 0.0, (0, 0)
    total, begin = 0.0, 0
    for i, s in enumerate(scores):
        if total <= 0:
            total, begin = 0.0, i
        total += s
        if total > best:
            best, region = total, (begin, i + 1)
    return region


def main_text(html: str | None, weights: dict[str, float]) -> str:
    """Blocks of the main region, white space squeezed, joined by line feeds."""
    parts = parts_of(html or "")
    dropped = dropped_parts(parts)
    scores = []
    for part, out in zip(parts, dropped):
        name = feature(part)
        weight = weights.get(name, score(name))
        scores.append(0.0 if out else weight * part.words if part.kind == "word" else weight)
    begin, end = best_region(scores)
    blocks, run = [], []
    for i in range(begin, end):
        part = parts[i]
        if part.kind == "word":
            if not dropped[i]:
                run.append(part.text)
        elif part.name == "br":
            run.append(" ")
        elif part.name in _BLOCKS:
            blocks.append(run)
            run = []
    blocks.append(run)
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def extract(pages: DataFrame, weights: dict[str, float]) -> DataFrame:
    """Adds ``text`` to ``pages``: the main text of ``html``, whole.

    Null or empty html, and pages without words, give an empty text. A column ``text`` of
    the input, in any case, is replaced; all other columns stay. Each page is handled alone, so repeated
    rows give repeated results.
    """
    own = [c for c in pages.columns if c.lower() != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([main_text(h.as_py(), weights) for h in batch.column("html")], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.select(own).columns, texts], names=[*own, "text"])

    return pages.select(*own).mapInArrow(released(run), pages.select(*own).schema.add("text", "string"))
