"""Quality rules, HTML extraction, language, and the pipeline as a whole."""

from __future__ import annotations

import math
import re
from collections import Counter
from html import unescape

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from streamlake.llm import html, language, line_dedup, queries
from streamlake.llm import quality_rules as rules
from streamlake.llm.files import staged

from .conftest import ODD, words
from .test_matching import LOWER, WORDS, components_by_hand, dedup_by_hand

SF_DIR = "/root/testdata/sf0.001"


def counts_by_hand(text):
    text = text or ""
    found = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines = [x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")]
    seen = Counter(tuple(found[i : i + 3]) for i in range(len(found) - 2))
    repeated = {j for i in range(len(found) - 2) if seen[tuple(found[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    return (len(found), sum(map(len, found)), sum(c in rules.SYMBOLS for c in text), len(lines) - len(set(lines)), len(repeated))


def test_counts_against_brute_force(spark, documents):
    rows = [*ODD, (20, "a b c a b c d"), (21, "x y z\nx y z\n#*$%&|<> q"), (22, " ".join(words(400, 2) * 2))]
    found = rules.count_rules(documents(rows)).select("doc_id", *rules.COUNTS).collect()
    assert sorted(map(tuple, found), key=str) == sorted(((d, *counts_by_hand(t)) for d, t in rows), key=str)


def test_the_binomial_tail_is_exact(spark):
    cases = [(0, 10, 0.2), (1, 10, 0.2), (3, 500, 0.01), (40, 10_000, 0.01), (9, 10, 0.2), (0, 0, 0.2)]
    for k, n, p in cases:
        got = spark.range(1).select(rules.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p)).first()[0]
        exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert got == pytest.approx(exact if k < n * p else 1.0, rel=1e-9)


def test_cutoffs_lose_no_more_good_documents_than_allowed(spark, documents):
    good = [(n, " ".join(words(80, n))) for n in range(1500)]
    bad = [(2000 + n, " ".join(f"{w}###" for w in words(80, n))) for n in range(200)]
    few = [(3000 + n, " ".join(f"{w}###" for w in words(80, n)), None) for n in range(20)]
    docs = documents([*good, *bad, *few, *ODD])
    counted = rules.count_rules(docs)
    labels = spark.createDataFrame(
        [(d, 1, 0) for d, _ in good] + [(d, 0, 0) for d, *_ in bad + few] + [(None, 1, 0), (5000, None, 0)],
        "doc_id long, quality int, toxic int",
    )
    cutoffs = rules.calibrate(counted, labels)
    assert {r["stratum"] for r in cutoffs.collect() if r["cutoffs"]} == {"en"}  # the null stratum has no good documents
    kept = {r["doc_id"] for r in rules.decide(counted, cutoffs).filter("kept").collect()}
    assert kept.isdisjoint(d for d, _ in bad) and kept >= {d for d, *_ in few}
    assert len([d for d, _ in good if d not in kept]) <= rules.MAX_FALSE_REJECTION * len(good)

    nothing = rules.calibrate(counted, labels.limit(0))
    assert nothing.count() == 0
    assert rules.decide(counted.limit(0), nothing).count() == 0


def test_every_stratum_is_certified_on_its_own(spark, documents):
    """The rules share the allowance; strata with few labels get no cutoff, and say so."""
    noisy = "{}###".format
    sizes = {"en": (1500, 60), "de": (300, 40), "es": (70, 20), "fr": (70, 20), "xx": (0, 20)}
    rows, labels = [], []
    for lang, (n_good, n_bad) in sizes.items():
        for n in range(n_good + n_bad):
            text = words(80, n)
            rows.append((len(rows), " ".join(text if n < n_good else map(noisy, text)), lang))
            labels.append((rows[-1][0], int(n < n_good), 0))
    # Good documents of one stratum have long words: only that rule stops there.
    for n in range(2000):
        rows.append((len(rows), " ".join(w * 4 for w in words(80, n)) if n < 1900 else " ".join(map(noisy, words(80, n))), "zz"))
        labels.append((rows[-1][0], int(n < 1900), 0))
    counted = staged(rules.count_rules(documents(rows)), "counted")
    cutoffs = rules.calibrate(counted, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {r["stratum"]: r["cutoffs"] for r in cutoffs.collect()}
    assert set(found) == {"en", "de", "zz"} and all(found.values())
    decided = {r["doc_id"]: r for r in rules.decide(counted, cutoffs).collect()}
    for (d, _, lang), (_, good, _) in zip(rows, labels):
        certified = lang in found
        assert (decided[d]["kept"], decided[d]["certified"]) == (good == 1 or not certified, certified), (d, lang)


def test_cutoffs_by_brute_force(spark, documents):
    """Steps, exact tails and choice written out for one stratum and both routes."""
    import random

    draw = random.Random(5)
    rows, labels = [], []
    for n in range(700):
        good = n < 500
        noise = draw.random() < (0.01 if good else 0.8)
        text = " ".join(w + ("##" if noise and k % 2 else "") for k, w in enumerate(words(60 + draw.randint(0, 60), n)))
        rows.append((n, text, "en"))
        labels.append((n, int(good), 0))
    counted = staged(rules.count_rules(documents(rows)), "counted")
    cutoffs = rules.calibrate(counted, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    found = {r["stratum"]: r["cutoffs"] for r in cutoffs.collect()}

    def tail(k, n, p):
        return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1)) if k < n * p else 1.0

    steps = {}  # per document and rule: the first cutoff that rejects it
    for row in counted.collect():
        n_words, chars, symbols, dup, rep, n_lines = (row[c] for c in (*rules.COUNTS, "n_lines"))
        if n_words < 50 or 100 * rep > 50 * n_words:
            continue
        ratio = {"symbols_per_word": symbols / n_words, "word_length_high": chars / n_words, "word_length_low": -chars / n_words,
                 "duplicate_lines": dup / max(n_lines, 1), "repeated_words": rep / n_words}
        steps[row["doc_id"]] = {r: sum(ratio[r] <= c for c in rules._cutoffs(r)) for r in rules.RULES}
    good = {d for d, q, _ in labels if q == 1 and d in steps}
    bad = {d for d, q, _ in labels if q == 0 and d in steps}
    alpha, share = rules.ERROR_LEVEL, rules.MAX_FALSE_REJECTION

    def rejected(cut, ids):  # cut: rule -> step
        return sum(any(steps[d][r] <= s for r, s in cut.items()) for d in ids)

    reached = {}
    for k, (rule, step) in enumerate(rules.PATH):
        cut = {**reached, rule: step}
        if tail(rejected(cut, good), len(good), share) > rules.JOINT_LEVEL * alpha:
            break
        reached = cut
    sound = {}
    for rule, values in rules.RULES.items():
        for step in range(len(values)):
            level = (1 - rules.JOINT_LEVEL) * alpha / len(rules.RULES)
            if tail(rejected({rule: step}, good), len(good), share / len(rules.RULES)) > level:
                break
            sound[rule] = step
    best = []
    for route, limits in ((1, reached), (0, sound)):
        chosen, gain = {}, 0
        for rule, last in limits.items():
            worth = [(rejected({rule: s}, bad) - rules.COST * rejected({rule: s}, good), -s) for s in range(last + 1)]
            if worth and max(worth)[0] > 0:
                gain += max(worth)[0]
                chosen[rule] = rules._cutoffs(rule)[-max(worth)[1]]
        if chosen:
            best.append((gain, route, chosen))
    assert found["en"] == max(best)[2]


def test_language_on_held_out_documents(spark, documents):
    found = queries.op9_language(spark, "/root/testdata/sf0.01").filter("held_out")
    truth = queries.table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang").filter("lang is not null")
    right = found.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.95
    models = {"a": b"ka ba ka ba lo ba", "b": b"xi yo xi yo zu yo"}
    got = {r["doc_id"]: tuple(r)[-3:] for r in language.predict(documents(ODD), models).collect()}
    assert got[1] == got[2] == got[3] == ("und", 0.0, True)
    assert all(0 <= score <= 1 for _, score, _ in got.values())
    assert {r["lang_pred"] for r in language.predict(documents(ODD), {}).collect()} == {"und"}
    assert language.train(documents([]), F.col("doc_id")) == {}


def test_the_language_is_the_smallest_compression():
    """Every block compressed with every dictionary, written out."""
    import random

    import zstandard

    draw = random.Random(9)
    letters = {"aa": "aeiouklmn", "bb": "aeiouprst", "cc": "xyzwvqao"}
    known_words = {lang: ["".join(draw.choices(x, k=draw.randint(3, 9))) for _ in range(300)] for lang, x in letters.items()}

    def text(lang, n):
        return " ".join(draw.choices(known_words[lang], k=n))

    dictionaries = {lang: language.plain(text(lang, 3000)) for lang in letters}
    model = language.Classifier(dictionaries)
    params = zstandard.ZstdCompressionParameters.from_level(
        language.LEVEL, write_content_size=False, write_checksum=False, write_dict_id=False
    )
    for lang in letters:
        for n in (3, 40, 3000):
            sample = text(lang, n).upper() + " 123!"
            data, sizes = language.plain(sample), {}
            for other, content in dictionaries.items():
                known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                blocks = [data[k : k + language.BLOCK_BYTES] for k in range(0, len(data), language.BLOCK_BYTES)]
                sizes[other] = sum(len(zstandard.ZstdCompressor(dict_data=known, compression_params=params).compress(b)) for b in blocks)
            best, second = sorted(sizes.items(), key=lambda x: (x[1], x[0]))[:2]
            assert model.classify(sample) == (best[0], pytest.approx(1 - best[1] / second[1]))
            assert n < 40 or best[0] == lang


def test_the_sample_is_drawn_before_it_is_ranked(spark, documents, monkeypatch):
    monkeypatch.setattr(language, "SAMPLE_DOCS", 20)
    rows = [(n, f"text {n}", "en" if n % 50 else "de") for n in range(4000)] + [(None, "no id", "en")] * 30
    found = language.sample_texts(documents(rows), F.xxhash64("doc_id"))
    counts = {r["lang"]: r["count"] for r in found.groupBy("lang").count().collect()}
    assert counts == {"en": 20, "de": 20}
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window") < plan.index("_share")  # the draw lies below the rank


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style></head><body><header>Top</header>
<div id="main-menu"><a href=x>Home</a></div><article><h1>Title &amp; more</h1><p>First   block<p>Second <b>bold</b>
text<br>after<script>var a = "<p>no</p>"</script><form><p>Your name</form><div class="reader comments"><p>Nice one</div>
<p>Last &eacute;</article><!-- c --><footer>End</footer></body></html>"""


def test_main_text(spark):
    weights = {}
    for name in ("p", "h1", "b", "br"):
        weights |= {f"word {name}": 1.0, f"open {name}": 0.0, f"close {name}": 0.0}
    expected = "Title & more\nFirst block\nSecond bold text after\nLast é"
    assert html.main_text(PAGE, weights) == html.main_text(PAGE, {}) == expected
    assert html.main_text("plain &lt;text&gt;\n here", {}) == "plain <text> here"
    for nothing in (None, "", "<", "<p", "<div></div>", "<!-- x", "<script>x"):
        assert html.main_text(nothing, {}).strip("<p") == ""

    rows = [(n, f"u{n}", PAGE, "x") for n in range(3)] + [(9, None, None, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = html.extract(pages, html.learn(pages)).collect()
    assert sorted(r["text"] for r in got) == ["", expected, expected, expected]
    assert html.learn(pages.limit(0)) == {} and html.extract(pages.limit(0), {}).count() == 0


def test_names_drop_no_main_text(spark):
    """Names of wrappers, parts of names and inline elements leave the main text whole."""
    text = "\n".join(" ".join(words(40, n)) for n in range(4))
    prose = "".join(f"<p>{x}</p>" for x in text.split("\n"))
    whole = "A headline\n" + text
    for wrapper in ("<div class='page has-sidebar'>{}</div>", "<div class=no-sidebar>{}</div>", "<form id=menu>{}</form>",
                    "<div class='with-banner widget'>{}</div>", "<div class=comments>{}</div>"):
        page = wrapper.format(f"<article><h1>A headline</h1>{prose}</article>")
        assert html.main_text(f"<body>{page}<footer>End</footer></body>", {}) == whole, wrapper
        unmarked = wrapper.format(f"<h1>A headline</h1>{prose}")
        assert html.main_text(f"<body>{unmarked}<footer>End</footer></body>", {}) == whole, wrapper
    weights = {f"{kind} {name}": 0.0 for kind in ("open", "close") for name in ("div", "section", "other", "header")}
    weights |= {f"word {name}": 1.0 for name in ("div", "section", "other", "header")}
    for inside in (f"<div class='entry-header'><h1>A headline</h1></div>{prose}", f"<header><h1>A headline</h1></header>{prose}",
                   f"<h1>A headline</h1><section id='related-work'>{prose[: prose.index('</p>') + 4]}</section>{prose[prose.index('</p>') + 4 :]}",
                   f"<h1>A <span class='comment'>headline</span></h1>{prose}"):
        assert html.main_text(f"<body><nav>x</nav><article>{inside}</article></body>", weights) == whole, inside
    # What is no main text still goes.
    extra = "<div class='x related'><p>Other page</p></div><aside>Aside</aside><form>Field</form>"
    assert html.main_text(f"<article><h1>A headline</h1>{extra}{prose}{extra}</article>", {}) == whole
    assert html.main_text(f"<article><h1>A headline</h1>{prose}</article><div class=comments>{prose * 3}</div>", {}) == whole


def test_a_best_region_by_brute_force():
    import random

    for seed in range(200):
        scores = [random.Random(seed * 100 + i).randint(-5, 5) for i in range(12)]
        begin, end = html.best_region(scores)
        best = max(sum(scores[i:j]) for i in range(12) for j in range(i, 13))
        assert sum(scores[begin:end]) == best


def test_articles_of_the_table_are_extracted(spark):
    got = {r["page_id"]: r for r in queries.op7_html(spark, SF_DIR).collect()}
    for page in queries.table(spark, SF_DIR, "pages").collect():
        inside = re.search(r"<article>(.*?)</article>", page["html"], re.DOTALL)[1]
        blocks = (re.sub(r"</?b>", "", x).replace("<br>", " ") for x in re.split(r"</?(?:p|h1)>", inside))
        expected = "\n".join(x for x in (" ".join(unescape(b).split()) for b in blocks) if x)
        assert (got[page["page_id"]]["text"], got[page["page_id"]]["n_chars"]) == (expected, len(expected))


def test_the_pipeline_keeps_whole_documents(spark, documents, tmp_path):
    base = queries.table(spark, SF_DIR, "documents")
    odd = [(None if d is None else d + 1_000_000, text) for d, text in ODD]
    docs = base.unionByName(documents(odd).drop("note"))
    before = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, before, SF_DIR).write.parquet(str(tmp_path / str(n)))
        after = spark.read.parquet(str(tmp_path / str(n)))
        if name != "packing":
            assert after.columns == docs.columns
            assert after.join(before, "doc_id", "left_anti").filter("doc_id is not null").count() == 0
        if name == "quality rules":
            passed = {r["doc_id"] for r in before.collect() if not (c := counts_by_hand(r["text"]))[0] < 50 and not 100 * c[4] > 50 * c[0]}
            assert {r["doc_id"] for r in after.collect()} <= passed
        if name == "line dedup":
            lines = after.select(F.explode(F.split("text", "\n")).alias("x")).filter("trim(x) <> ''")
            assert lines.count() == lines.distinct().count()
            assert line_dedup.dedup_lines(after).filter("n_removed > 0").count() == 0
        if name == "decontamination":
            from streamlake.llm.decontaminate import find_contamination

            items = queries.table(spark, SF_DIR, "benchmark")
            assert find_contamination(before, items).filter("size(spans) > 0").count() > 0
            assert find_contamination(after, items).filter("size(spans) > 0").count() == 0
        before = after
    tokens = before.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m"))
    assert tokens.filter("n <> m").count() == 0


def test_every_stage_takes_an_empty_table(spark, documents):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, documents([]).drop("note"), SF_DIR).count() == 0


def test_own_columns_pass_through_the_stages(spark, documents):
    names = ["n_words", "n_lines", "n_removed", "spans", "items", "kept", "broken", "base_failed", "text_hash", "_hash", "N_DUP_LINES"]
    docs = documents([(n, " ".join(words(80, n)) + "\nline of its own " + str(n)) for n in range(4)])
    docs = docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id")) for c in names})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, SF_DIR)
        assert found.columns == docs.columns
        rows = found.collect()
        assert len(rows) == 4 and all(r[c] == f"{c}{r['doc_id']}" for r in rows for c in names)


def kept_by_hand(rows, labels):
    """Ids past the base rules and the path's cutoffs, for strata that have labels for their own."""
    names = list(rules.RULES)
    steps, langs, passed = {}, {}, set()
    for doc_id, text, lang in rows:
        n, chars, symbols, dup, repeated = counts_by_hand(text)
        if n < 50 or 100 * repeated > 50 * n:
            continue
        n_lines = len([x for x in text.split("\n") if x.strip(" \t\x0b\x0c\r")])
        ratios = (symbols / n, chars / n, -chars / n, dup / n_lines, repeated / n)
        passed.add(doc_id)
        langs[doc_id] = lang
        steps[doc_id] = {r: sum(x <= (-c if r == "word_length_low" else c) for c in rules.RULES[r]) for r, x in zip(names, ratios)}
    path = sorted(((i + 1) / len(rules.RULES[r]), k, r, i) for k, r in enumerate(names) for i in range(len(rules.RULES[r])))
    strata = set(langs.values())
    for lang in strata:
        good = [d for d in passed if langs[d] == lang and labels.get(d) == 1]
        bad = [d for d in passed if langs[d] == lang and labels.get(d) == 0]
        reached: dict[str, int] = {}
        for _, _, r, i in path:
            lost = sum(any(steps[d][x] <= k for x, k in {**reached, r: i}.items()) for d in good)
            n = len(good)
            tail = sum(math.comb(n, k) * 0.05**k * 0.95 ** (n - k) for k in range(lost + 1))
            if lost >= 0.05 * n or tail > 0.8 * 0.05 / len(strata):
                break
            reached[r] = i
        for r, limit in reached.items():
            gains = [(sum(steps[d][r] <= k for d in bad) - 10 * sum(steps[d][r] <= k for d in good), -k) for k in range(limit + 1)]
            gain, k = max(gains)
            if gain > 0:
                passed -= {d for d in steps if langs[d] == lang and steps[d][r] <= -k}
    return passed


def cleaned_by_hand(text, items):
    lower = text.translate(LOWER)
    found = list(WORDS.finditer(lower))
    hit = set()
    for item in items:
        inside = WORDS.findall(item.translate(LOWER))
        n = min(10, len(inside))
        windows = {tuple(inside[i : i + n]) for i in range(len(inside) - n + 1)}
        for i in range(len(found) - n + 1):
            if tuple(w[0] for w in found[i : i + n]) in windows:
                hit.update(range(i, i + n))
    gone = {c for i in hit for c in range(found[i].start(), found[i + 1].start() if i + 1 in hit else found[i].end())}
    return "".join(c for k, c in enumerate(text) if k not in gone)


def test_each_stage_against_brute_force(spark, documents, tmp_path):
    passage = " ".join(words(14, 77))
    rows, labels = [], {}
    for lang, start in (("en", 1000), ("de", 3000)):
        for n in range(150):
            rows.append((start + n, " ".join(words(70, start + n)), lang))
            labels[start + n] = 1
        for n in range(150, 190):
            rows.append((start + n, " ".join(f"{w}##" if k % 3 else w for k, w in enumerate(words(70, start + n))), lang))
            labels[start + n] = 0
    for n in range(12):  # without labels: noisy, copies, near copies, shared lines, passages
        rows.append((5000 + n, " ".join(f"{w}##" for w in words(70, n)), "en"))
        rows.append((5100 + n, " ".join([*words(90, 5100)[: 90 - n % 3], str(n)]), "de"))
        rows.append((5200 + n, " ".join(words(60, 5200 + n)) + "\nA line that all of these share" + "." * (n % 2), "en"))
        rows.append((5300 + n, " ".join([*words(60, 5300 + n), passage, *words(20, 5400 + n)]), "de"))
    tables = {"labels": ([(d, q, 0) for d, q in labels.items()], "doc_id long, quality int, toxic int"), "benchmark": ([(1, passage)], "item_id long, text string")}
    for name, (data, schema) in tables.items():
        spark.createDataFrame(data, schema).coalesce(1).write.parquet(str(tmp_path / f"{name}.parquet"))
    docs = documents(rows).drop("note")
    by_id, sizes = {d: (t, x) for d, t, x in rows}, [len(rows)]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES[:-1]):
        path = str(tmp_path / str(k))
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        now = [(d, t, x) for d, (t, x) in sorted(by_id.items())]
        if name == "quality rules":
            keep = kept_by_hand(now, labels)
            by_id = {d: v for d, v in by_id.items() if d in keep}
        elif name == "line dedup":
            by_id = {d: (t, by_id[d][1]) for d, n, gone, t in dedup_by_hand(now) if gone == 0 or gone < n}
        elif name == "near duplicates":
            by_id = {d: by_id[d] for d, _, _, first in components_by_hand(now) if first}
        else:
            by_id = {d: (cleaned_by_hand(t, [passage]), x) for d, (t, x) in by_id.items()}
        got = sorted((r["doc_id"], r["text"], r["lang"], r["n_chars"]) for r in docs.collect())
        assert got == sorted((d, t, x, len(t)) for d, (t, x) in by_id.items()), name
        sizes.append(len(got))
    assert sizes[1] < sizes[0] - 80 and sizes[3] < sizes[2]  # cutoffs are certified, near copies go

    import numpy as np
    import public_tokenizers
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
    for d, (t, _) in by_id.items():
        own = sorted((p["start"], p["length"], bytes(p["ids"])) for p in pieces if p["doc_id"] == d)
        ends = [0, *(start + length for start, length, _ in own)]
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 1], "<u4")
        assert [start for start, *_ in own] == ends[:-1] and b"".join(x for *_, x in own) == ids.tobytes()
