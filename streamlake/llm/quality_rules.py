"""Quality rules with risk-controlled thresholds, in DataFrame functions.

Each rule rejects documents beyond a cutoff of one ratio. For every stratum the cutoffs come
from labelled documents. One fixed path tightens all rules in turn, from lenient to strict;
an exact binomial test shows step by step that the rules together reject fewer good documents
than the allowed share, and stops at the first failure, so a path needs no correction of its
own. Cutoffs more lenient than a certified step reject a subset of what it rejects, so per
rule the most useful one up to there is taken, or none. A small part of the error level goes
to a second route for strata where one rule would stop the path of all: each rule on its own,
with the allowed share and that part divided by the rules. The error level is divided over
the strata that have labels enough to pass a test; the others get no cutoff, so what is
promised holds for each stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from streamlake.llm.columns import aside
from streamlake.llm.files import staged

MAX_FALSE_REJECTION = 0.05  # share of good documents that a stratum may lose
ERROR_LEVEL = 0.05  # chance that any stratum loses more
JOINT_LEVEL = 0.8  # part of the error level for the path of all rules; the rest is for the rules alone
COST = 10  # good documents weigh so many bad ones when a cutoff is chosen
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words

WHITE_SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _steps(first: float, last: float, n: int) -> list[float]:
    return [round(first + (last - first) * k / (n - 1), 4) for k in range(n)]


# Rule: its ratio's cutoffs from lenient to strict. Rules ending in "_low" reject below them.
RULES = {
    "symbols_per_word": _steps(3.0, 0.5, 11) + _steps(0.45, 0.05, 9),
    "word_length_high": _steps(14.0, 6.0, 17),
    "word_length_low": _steps(1.0, 4.4, 18),
    "duplicate_lines": _steps(0.95, 0.3, 14),
    "repeated_words": _steps(0.5, 0.1, 9),
}

# All cutoffs as (rule, index), the order in which they are tightened: each rule evenly over the path.
PATH = sorted(((r, i) for r in RULES for i in range(len(RULES[r]))), key=lambda x: (x[1] + 1) / len(RULES[x[0]]))
JOINT = "all"  # the path, where it is counted like a rule


def _once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns behind a generator: a later expression then reads their value, where a
    plain projection would be merged and evaluated again at every use."""
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    own = [c for c in df.columns if c not in columns]
    return df.select(*own, F.inline(F.array(row)))


def count_rules(docs: DataFrame) -> DataFrame:
    """Adds the ``COUNTS`` and n_lines to ``docs``; null text counts as empty.

    Words are runs of other characters than white space, repeated words those in a
    three-word window that occurs twice or more in the text. Windows are compared by
    64-bit hash within their document. Everything is computed in the row, without a
    shuffle; columns of these names, in any case, are replaced, and all others stay.
    """
    out, back = aside(docs, ("text",), (*COUNTS, "n_lines"))
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(WHITE_SPACE)) != "")
    out = _once(out, _words=F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), ""), _lines=lines)
    out = _once(out, _hashes=F.transform("_words", lambda w: F.xxhash64(w)))
    window = F.transform("_hashes", lambda h, i: F.xxhash64(h, F.get("_hashes", i + 1), F.get("_hashes", i + 2)))
    n = F.size("_words")
    out = _once(out, _windows=F.slice(window, F.lit(1), F.greatest(n - 2, F.lit(0))))
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    in_order = F.array_sort(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    out = _once(out, _sorted=F.when(repeats, in_order))

    def at(i: Column) -> Column:
        return F.get("_sorted", i)["h"]

    twice = F.filter("_sorted", lambda s, i: (s["h"] == at(i - 1)) | (s["h"] == at(i + 1)))
    covered = F.flatten(F.transform(twice, lambda s: F.array(s["i"], s["i"] + 1, s["i"] + 2)))
    symbols = F.char_length(text) - F.char_length(F.regexp_replace(text, f"[{SYMBOLS}]", ""))
    counts = {
        "n_words": n,
        "word_chars": F.char_length(F.array_join("_words", "")),
        "n_symbols": symbols,
        "n_dup_lines": F.size("_lines") - F.size(F.array_distinct("_lines")),
        "n_repeat_words": F.when(F.col("_sorted").isNull(), 0).otherwise(F.size(F.array_distinct(covered))),
        "n_lines": F.size("_lines"),
    }
    return back(_once(out, **{name: c.cast("long") for name, c in counts.items()}))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def _ratios() -> dict[str, Column]:
    """Per rule the ratio that is compared, larger being worse."""
    words = F.greatest(F.col("n_words"), F.lit(1))
    length = F.col("word_chars") / words
    return {
        "symbols_per_word": F.col("n_symbols") / words,
        "word_length_high": length,
        "word_length_low": -length,
        "duplicate_lines": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
        "repeated_words": F.col("n_repeat_words") / words,
    }


def _cutoffs(rule: str) -> list[float]:
    return [-c if rule.endswith("_low") else c for c in RULES[rule]]


def _keeping(ratio: Column, cutoffs: list[float]) -> Column:
    """How many cutoffs keep the document; they are the first of the list, which grows strict."""
    return F.size(F.filter(F.array(*map(F.lit, cutoffs)), lambda c: ratio <= c))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) of a binomial (n, p), summed exactly in logarithms. Where k is not below its
    mean the value 1 stands for the large tail."""
    odds = math.log(p / (1 - p))
    first = n * math.log(1 - p)
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(sum_: Column, i: Column) -> Column:
        term = sum_["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(sum_["total"], term), F.least(sum_["total"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k.cast("long"))).otherwise(F.array().cast("array<long>"))
    tail = F.aggregate(steps, start, add, lambda s: F.exp(s["total"]))
    return F.when(k < n * p, tail).otherwise(1.0)


def labels_needed(level: float, max_false_rejection: float = MAX_FALSE_REJECTION) -> int:
    """Good labels with which a cutoff that loses none of them passes the test on the path."""
    return math.ceil(math.log(JOINT_LEVEL * level) / math.log(1 - max_false_rejection))


def _on_path(steps: dict[str, Column]) -> Column:
    """First step of ``PATH`` that rejects the document, from its step in every rule."""
    at = {x: F.lit(k) for k, x in enumerate(PATH)}
    end = F.lit(len(PATH))
    return F.least(*[F.get(F.array(*[at[r, i] for i in range(len(RULES[r]))], end), n) for r, n in steps.items()])


def calibrate(
    counted: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    max_false_rejection: float = MAX_FALSE_REJECTION,
    error_level: float = ERROR_LEVEL,
) -> DataFrame:
    """(stratum, cutoffs): per certified stratum a map from rule to its certified cutoff.

    ``counted`` has doc_id, the stratum and the columns of ``count_rules``; ``labels`` has
    doc_id and quality (1 good, 0 bad). Documents that fail the base rules are left out, as
    no cutoff decides on them. A document with several labels is good only if all say so;
    null labels and ids are ignored, a null stratum is one of its own. All labelled
    documents count; what moves is one row per stratum, rule and step.

    A stratum with fewer good labels than ``labels_needed`` could not pass with any cutoff; it
    is not tested, takes no part of the error level, and the base rules alone decide there.
    The number of labels alone says which these are. The map of a stratum that was tested is
    empty where no cutoff passes or catches enough.
    """
    judged = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .groupBy("doc_id")
        .agg((F.min("quality") == 1).alias("good"))
    )
    held = counted.filter(~base_failed()).select("doc_id", F.col(stratum).alias("stratum"), *COUNTS, "n_lines")
    steps = {rule: _keeping(ratio, _cutoffs(rule)) for rule, ratio in _ratios().items()}
    placed = _once(held.join(judged, "doc_id").select("stratum", "good", *COUNTS, "n_lines"), **steps)
    own = {rule: F.col(rule) for rule in RULES}
    first = [F.struct(F.lit(rule).alias("rule"), n.alias("step")) for rule, n in (own | {JOINT: _on_path(own)}).items()]
    spread = placed.select("stratum", "good", F.inline(F.array(*first)))
    hits = spread.groupBy("stratum", "rule", "step").agg(
        F.count_if("good").alias("good"), F.count_if(~F.col("good")).alias("bad")
    )
    # One row more per rule and step, so that steps without a document are tested too.
    lengths = {rule: len(cutoffs) for rule, cutoffs in RULES.items()} | {JOINT: len(PATH)}
    every = [
        F.struct(F.lit(rule).alias("rule"), F.lit(step).alias("step")) for rule, n in lengths.items() for step in range(n + 1)
    ]
    grid = hits.select("stratum").distinct().select("stratum", F.inline(F.array(*every)))
    zero = F.lit(0).cast("long")
    filled = hits.unionByName(grid.withColumns({"good": zero, "bad": zero}))
    filled = filled.groupBy("stratum", "rule", "step").agg(F.sum("good").alias("good"), F.sum("bad").alias("bad"))
    filled = staged(filled, "rule-steps")

    # The error level is divided over the strata that can pass a test at all, by their labels alone.
    sizes = filled.filter(F.col("rule") == JOINT).groupBy("stratum").agg(F.sum("good").alias("n_good")).filter("n_good > 0")
    n_strata = sizes.count()
    needed = labels_needed(error_level / max(1, n_strata), max_false_rejection)
    large = sizes.filter(F.col("n_good") >= needed)
    level = error_level / max(1, large.count())
    counts = filled.withColumnRenamed("stratum", "_stratum").join(large, F.col("_stratum").eqNullSafe(F.col("stratum")))

    rows = W.partitionBy("stratum", "rule")
    upto = rows.orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    tested = counts.select(
        "stratum",
        "rule",
        "step",
        F.sum("good").over(upto).alias("lost"),
        F.sum("bad").over(upto).alias("caught"),
        "n_good",
    )
    alone = binomial_tail(F.col("lost"), F.col("n_good"), max_false_rejection / len(RULES)) <= (
        (1 - JOINT_LEVEL) * level / len(RULES)
    )
    joint = binomial_tail(F.col("lost"), F.col("n_good"), max_false_rejection) <= JOINT_LEVEL * level
    passed = F.when(F.col("rule") == JOINT, joint).otherwise(alone)
    sound = tested.withColumn("sound", passed).withColumn("sound", F.bool_and("sound").over(upto))
    # Per rule the cutoffs that the path has reached at its last sound step.
    last = F.max(F.when((F.col("rule") == JOINT) & F.col("sound"), F.col("step"))).over(W.partitionBy("stratum"))
    at = {x: k for k, x in enumerate(PATH)}
    places = F.create_map(*[x for r in RULES for x in (F.lit(r), F.array(*[F.lit(at[r, i]) for i in range(len(RULES[r]))]))])
    reached = F.coalesce(F.get(places[F.col("rule")], F.col("step")) <= last, F.lit(False))
    routes = F.array_compact(F.array(F.when(reached, F.lit(1)), F.when(F.col("sound"), F.lit(0))))
    gain = (F.col("caught") - COST * F.col("lost")).alias("gain")
    best = (
        sound.withColumn("routes", routes)
        .filter(F.col("rule") != JOINT)
        .withColumn("joint", F.explode("routes"))
        .groupBy("stratum", "joint", "rule")
        .agg(F.max(F.struct(gain, (-F.col("step")).alias("lenient"))).alias("best"))
        .filter("best.gain > 0")
        .groupBy("stratum", "joint")
        .agg(F.sum("best.gain").alias("gain"), F.collect_list(F.struct("rule", (-F.col("best.lenient")).alias("step"))).alias("chosen"))
        .groupBy("stratum")
        .agg(F.max_by("chosen", F.struct("gain", "joint")).alias("chosen"))
        .select("stratum", F.inline("chosen"))
    )
    lists = F.create_map(*[x for r in RULES for x in (F.lit(r), F.array(*map(F.lit, _cutoffs(r))))])
    chosen = best.select("stratum", "rule", F.get(lists[F.col("rule")], F.col("step")).alias("cutoff"))
    given = chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))
    none = F.create_map().cast("map<string,double>")
    of_given = given.withColumnRenamed("stratum", "_stratum")
    joined = large.join(of_given, F.col("stratum").eqNullSafe(F.col("_stratum")), "left")
    return joined.select("stratum", F.coalesce("cutoffs", none).alias("cutoffs"))


def decide(counted: DataFrame, cutoffs: DataFrame, stratum: str = "lang") -> DataFrame:
    """Adds base_failed, broken (the rules that reject the document), certified and kept.

    ``certified`` says whether the stratum has labels enough for cutoffs of its own; without,
    the base rules alone decide. Documents without words fail the base rules.
    """
    counted, back = aside(counted, (*COUNTS, "n_lines", stratum), ("base_failed", "broken", "certified", "kept"))
    by = cutoffs.select(F.col("stratum").alias("_stratum"), F.col("cutoffs").alias("_cutoffs"))
    joined = counted.join(by, F.col(stratum).eqNullSafe(F.col("_stratum")), "left")
    broken = [F.when(ratio > F.col("_cutoffs")[rule], F.lit(rule)) for rule, ratio in _ratios().items()]
    judged = joined.withColumns(
        {
            "base_failed": base_failed(),
            "broken": F.array_compact(F.array(*broken)),
            "certified": F.col("_cutoffs").isNotNull(),
        }
    )
    return back(judged.withColumn("kept", ~F.col("base_failed") & (F.size("broken") == 0)))
