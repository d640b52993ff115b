"""Line deduplication across documents by a deletion-neighbourhood join, in DataFrame functions.

A line goes when an equal line, or one within an edit distance of 1, comes earlier in the
order of doc_id and line number. All variants of a line with one character deleted are
hashed, next to the line itself:

* two lines that differ by a replaced character share the variant and the deleted place;
  all lines of such a group differ in that place only, so each is compared with the
  earliest of its group;
* a line that equals another line's variant is that line with a character left out.

A hash of each variant comes from two running sums over the characters, so a line of n
characters costs n steps. As that would be a row per character of the corpus, lines without
a partner are told apart first, by the same idea on blocks: lines within one edit agree
outside one of their b blocks, so a line that shares none of its block-deleted variants with
another line has no partner. The first, widest level leaves its answer in a bit table of
fixed size, so no text is shuffled for lines that drop out there.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from streamlake.llm.bits import bit_table, maybe_in
from streamlake.llm.columns import aside
from streamlake.llm.files import staged

MIN_FUZZY_CHARS = 16  # shorter lines are compared for equality; one edit changes too much of them
FIRST_BLOCKS = 2
NEXT_BLOCKS = (8, 32)

_BLANK = " \t\x0b\x0c\r"
_LINE = ["h1", "h2"]


def _doc_lines(docs: DataFrame) -> DataFrame:
    """One row per line that is not blank: its hash, text and place (doc_id, text hash, line)."""
    lines = docs.filter(F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.split("text", "\n")).alias("number", "line"),
    )
    return lines.filter(F.btrim("line", F.lit(_BLANK)) != "").select(
        F.xxhash64("line").alias("h1"),
        F.xxhash64(F.lit(1), "line").alias("h2"),
        F.struct("doc_id", "text_hash", "number").alias("place"),
        "line",
    )


def block_keys(line: Column, blocks: int) -> Column:
    """Hashes of the line with one of its blocks deleted.

    Blocks are laid out for the line's own length and for one less, so that a line finds
    partners that are as long or one character longer. Equal keys need equal layouts.
    """
    length = F.char_length(line)

    def without(layout: Column, block: Column) -> Column:
        head = F.floor(layout * block / blocks).cast("int")
        tail = (layout - F.floor(layout * (block + 1) / blocks)).cast("int")
        return F.xxhash64(
            F.lit(blocks), layout, block, F.substring(line, F.lit(1), head), F.substring(line, length - tail + 1, tail)
        )

    if blocks <= FIRST_BLOCKS:  # few enough to be written out, which compiles
        return F.array(*[without(n, F.lit(b)) for n in (length, length - 1) for b in range(blocks)])
    numbers = F.array(*[F.lit(b) for b in range(blocks)])
    layouts = F.array(length, length - 1)
    return F.flatten(F.transform(layouts, lambda n: F.transform(numbers, lambda b: without(n, b))))


def _shared(entries: DataFrame) -> DataFrame:
    """Keys that two different lines have. Combined in every task, so a key may be hot."""
    ends = entries.groupBy("key").agg(F.min("h1").alias("x"), F.max("h1").alias("y"))
    return ends.filter("x < y").select("key")


def _first_level(lines: DataFrame, min_fuzzy_chars: int = MIN_FUZZY_CHARS) -> DataFrame:
    """(h1, h2, line, place) of the lines that may have a partner, each once."""
    longer = lines.filter(F.char_length("line") >= min_fuzzy_chars)
    shared = _shared(longer.select("h1", F.explode(block_keys(F.col("line"), FIRST_BLOCKS)).alias("key")))
    bits = bit_table(shared, "key")
    keyed = longer.select("*", F.explode(block_keys(F.col("line"), FIRST_BLOCKS)).alias("key"))
    hits = maybe_in(keyed, "key", bits)
    return hits.groupBy(*_LINE).agg(F.min_by("line", "place").alias("line"), F.min("place").alias("place"))


def _next_level(lines: DataFrame, blocks: int) -> DataFrame:
    entries = staged(lines.select(*_LINE, F.explode(block_keys(F.col("line"), blocks)).alias("key")), "line-blocks")
    found = entries.join(_shared(entries), "key").select(*_LINE).distinct()
    return lines.join(found, _LINE)


def variants(lines: DataFrame) -> DataFrame:
    """(h1, h2, place, length, at, v1, v2): per line one row for each deleted character, and
    one with ``at`` -1 for the line itself.

    A text's hash is the sum over its characters of a hash of character and position;
    deleting moves the later ones by one place, so two running sums give all variants.
    """
    chars = lines.select(
        *_LINE, "place", F.char_length("line").alias("length"), F.posexplode(F.split("line", "")).alias("at", "char")
    )

    def point(seed: int, at: Column) -> Column:
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), "char", at), 27)  # 37 bits, so sums stay in range

    line = W.partitionBy(*_LINE)
    upto = line.orderBy("at").rowsBetween(W.unboundedPreceding, 0)
    sums = {}
    for v, seed in (("v1", 1), ("v2", 2)):
        here, moved = point(seed, F.col("at")), point(seed, F.col("at") - 1)
        sums[v] = F.sum(here).over(upto) - here + F.sum(moved).over(line) - F.sum(moved).over(upto)
        sums[f"{v}_whole"] = F.sum(here).over(line)
    known = chars.select(*_LINE, "place", "length", "at", *[c.alias(n) for n, c in sums.items()])
    own = F.struct(F.lit(-1).alias("at"), F.col("v1_whole").alias("v1"), F.col("v2_whole").alias("v2"))
    deleted = F.struct("at", "v1", "v2")
    both = F.when(F.col("at") == 0, F.array(own, deleted)).otherwise(F.array(deleted))
    return known.select(*_LINE, "place", "length", F.inline(both))


def near_lines(lines: DataFrame) -> DataFrame:
    """(h1, h2) of the lines that have an earlier line within one edit; ``lines`` as in
    ``_first_level``."""
    found = staged(variants(lines), "line-variants")
    me = F.struct("place", *_LINE)
    # A replaced character: same place deleted, same rest.
    replaced = found.filter("at >= 0")
    rest = ["v1", "v2", "at", "length"]
    hubs = replaced.groupBy(*rest).agg(F.min(me).alias("early"), F.max(me).alias("last")).filter("early <> last")
    pairs = replaced.join(hubs.drop("last"), rest).select("early", me.alias("late")).filter("early <> late")
    # A character left out: the shorter line is the longer one's variant.
    shorter = found.filter("at = -1").select("v1", "v2", F.col("length").alias("rest"), me.alias("short"))
    longer = replaced.select("v1", "v2", (F.col("length") - 1).alias("rest"), me.alias("long"))
    left_out = shorter.join(longer, ["v1", "v2", "rest"]).select(
        F.least("short", "long").alias("early"), F.greatest("short", "long").alias("late")
    )
    pairs = pairs.union(left_out).distinct()
    texts = lines.select(*_LINE, "line")
    for side in ("early", "late"):
        names = {c: f"{side}_{c}" for c in texts.columns}
        named = texts.withColumnsRenamed(names)
        same = [F.col(f"{side}.{c}") == F.col(f"{side}_{c}") for c in _LINE]
        pairs = pairs.join(named, same[0] & same[1])
    close = F.levenshtein("early_line", "late_line", 1).between(0, 1)  # -1 beyond the bound
    return pairs.filter(close).select(F.col("late.h1").alias("h1"), F.col("late.h2").alias("h2")).distinct()


def removed_lines(docs: DataFrame, min_fuzzy_chars: int = MIN_FUZZY_CHARS) -> DataFrame:
    """(doc_id, text_hash, removed): the numbers of the lines to remove, per document."""
    lines = _doc_lines(docs)
    some = staged(_first_level(lines, min_fuzzy_chars), "line-candidates")
    for blocks in NEXT_BLOCKS:
        some = staged(_next_level(some, blocks), "line-candidates")
    near = staged(near_lines(some).withColumn("near", F.lit(True)), "near-lines")

    places = lines.select(*_LINE, "place")
    groups = places.groupBy(*_LINE).agg(F.min("place").alias("first"), F.max("place").alias("last"))
    repeated = groups.filter("first < last").select(*_LINE, "first")
    decided = staged(repeated.join(near, _LINE, "full").select(*_LINE, "first", "near"), "line-decisions")
    gone = places.join(decided, _LINE).filter(F.col("near") | (F.col("place") != F.col("first")))
    by_doc = gone.select("place.*").distinct().groupBy("doc_id", "text_hash")
    return by_doc.agg(F.collect_list("number").alias("removed"))


def dedup_lines(docs: DataFrame, min_fuzzy_chars: int = MIN_FUZZY_CHARS) -> DataFrame:
    """``docs`` with repeated and nearly repeated lines removed from ``text``, and n_lines and
    n_removed counted over lines that are not blank.

    The first occurrence by (doc_id, line number) stays; a null doc_id comes first. A near
    line is removed wherever it occurs, also when the earlier line that it resembles is
    itself removed. Lines under ``min_fuzzy_chars`` go only where they are equal to an earlier
    one; with 1 every line is compared with all others, whatever its length. Blank lines stay, but a text left without any other line becomes
    empty. Null text stays null with counts 0. Rows that repeat a doc_id and text count as
    one document and keep the same lines. All columns stay, whatever their names; n_lines and
    n_removed, in any case, are replaced. Lines of a document are collected again per document only, in number.
    """
    docs, back = aside(docs, ("doc_id", "text"), ("n_lines", "n_removed"))
    removed = removed_lines(docs, min_fuzzy_chars).select(
        F.col("doc_id").alias("_doc"), F.col("text_hash").alias("_hash"), F.col("removed").alias("_removed")
    )
    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (F.xxhash64("text") == F.col("_hash"))
    joined = docs.join(removed, same, "left")
    # Behind generators, so that the lines are cut and counted once per row.
    lines = F.split("text", "\n")
    split = joined.select("*", F.inline(F.array(F.struct(lines.alias("_lines")))))
    written = F.size(F.filter("_lines", lambda x: F.btrim(x, F.lit(_BLANK)) != ""))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(written).cast("long").alias("n_lines")
    n_removed = F.when(F.col("_removed").isNull(), 0).otherwise(F.size("_removed")).cast("long").alias("n_removed")
    counted = split.select("*", F.inline(F.array(F.struct(n_lines, n_removed))))
    kept = F.array_except(F.sequence(F.lit(0), F.size("_lines") - 1), F.col("_removed"))
    rest = F.array_join(F.transform(kept, lambda i: F.get("_lines", i)), "\n")
    text = F.when(F.col("n_removed") == 0, F.col("text")).when(F.col("n_removed") == F.col("n_lines"), "").otherwise(rest)
    return back(counted.withColumn("text", text))
