"""Small column expressions shared by the operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Textual shapes of the contract formats.
FORMAT_PATTERNS = {
    "uuid": r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$",
    "date-time": r"^\d{4}-\d{2}-\d{2}[Tt]\d{2}:\d{2}:\d{2}(\.\d+)?([Zz]|[+-]\d{2}:\d{2})$",
    "date": r"^\d{4}-\d{2}-\d{2}$",
}

DATED = r"^\s*\d{4}-\d{1,2}-\d{1,2}([Tt ]|\s*$)"
DECIMAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"


def is_blank(col: Column) -> Column:
    """Null, empty or spaces only (a tab is content). Never null itself."""
    return col.isNull() | (F.trim(col.cast("string")) == "")


def utc_timestamp(col: Column) -> Column:
    """Parse an ISO timestamp to an instant; null when it does not parse or names no full date
    (a time alone would be read as of today). Needs a UTC session."""
    return F.when(col.cast("string").rlike(DATED), F.try_to_timestamp(col))


def decimal_number(col: Column) -> Column:
    """Decimal text or a number to double; null for anything else, also for forms such as
    ``12d`` or ``0x1p3`` that a cast would take."""
    return F.when(col.cast("string").rlike(DECIMAL), col.try_cast("double"))


def whole_number(col: Column) -> Column:
    """Decimal text or a number to int, fraction cut off; null when it is neither."""
    return decimal_number(col).try_cast("int")


def surrogate_key(col: Column) -> Column:
    """Lower-case hex SHA-256 of the natural key."""
    return F.sha2(col, 256)


def matches_format(col: Column, fmt: str) -> Column:
    """True when the text has the shape of the format and names a real date or instant."""
    shape = col.rlike(FORMAT_PATTERNS[fmt])
    if fmt == "date-time":
        return shape & F.try_to_timestamp(col).isNotNull()
    if fmt == "date":
        return shape & F.try_to_date(col).isNotNull()
    return shape


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def decode_form_url(col: Column) -> Column:
    """URL-decode where ``+`` is a space and a stray ``%`` stays as it is."""
    return F.url_decode(F.regexp_replace(col, "%(?![0-9A-Fa-f]{2})", "%25"))


_JSON_STRING = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'


def _json_object_pattern(depth: int) -> str:
    """A regex for one JSON object with up to ``depth`` levels inside it.

    Strings are consumed whole, so braces inside them do not count, and every quantifier is
    possessive, so matching is linear.
    """
    pattern = rf'\{{[^"{{}}]*+(?:{_JSON_STRING}[^"{{}}]*+)*+\}}'
    for _ in range(depth):
        pattern = rf'\{{[^"{{}}]*+(?:(?:{_JSON_STRING}|{pattern})[^"{{}}]*+)*+\}}'
    return pattern


# A line as whole objects, strings, braces that belong to no such object, and the text between.
# Deeper objects come as their braces; the depth only decides how many passes a line takes.
_DEPTH, _PASSES = 16, 8
_JSON_TOKENS = rf'{_json_object_pattern(_DEPTH)}|{_JSON_STRING}|[{{}}]|[^"{{}}]++|"'

# Noncharacters that stand for braces and quotes of an object that is recognised, and for its
# two ends; the last one escapes those that a line has itself.
_OPEN, _CLOSE, _QUOTE, _BEGIN, _END, _ESCAPE = map(chr, range(0xFDD0, 0xFDD6))
_OWN = [_ESCAPE, _OPEN, _CLOSE, _QUOTE, _BEGIN, _END]
_RECOGNISED = f"{_BEGIN}([^{_BEGIN}{_END}]*+){_END}"


def _once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _escaped(line: Column) -> Column:
    """The line with its own noncharacters as pairs, so that none of the above is in it."""
    out = line
    for n, c in enumerate(_OWN):
        out = F.replace(out, F.lit(c), F.lit(f"{_ESCAPE}{n}"))
    return F.when(line.rlike(f"[{''.join(_OWN)}]"), out).otherwise(line)


def _unescaped(text: Column) -> Column:
    plain = F.translate(text, _OPEN + _CLOSE + _QUOTE + _BEGIN + _END, '{}"')
    out = plain
    for n, c in reversed(list(enumerate(_OWN))):
        out = F.replace(out, F.lit(f"{_ESCAPE}{n}"), F.lit(c))
    return F.when(F.contains(plain, F.lit(_ESCAPE)), out).otherwise(plain)


def _recognise(line: Column) -> Column:
    """Objects up to ``_DEPTH`` levels deep become plain text between two ends, so that the next
    pass sees those around them."""
    def placed(token: Column) -> Column:
        inner = F.translate(token, '{}"' + _BEGIN + _END, _OPEN + _CLOSE + _QUOTE)
        return F.when(token.startswith("{") & (token != "{"), F.concat(F.lit(_BEGIN), inner, F.lit(_END))).otherwise(token)

    return F.array_join(F.transform(F.regexp_extract_all(line, F.lit(_JSON_TOKENS), F.lit(0)), placed), "")


# Where one object may end and the next one begin, and what Spark's JSON functions may take for
# a string besides text in double quotes.
_JUNCTION = r"(?<=\})\s*+(?=\{)"
_SINGLE_QUOTED = r"[\[{,:]\s*+'"


def _whole_objects(line: Column) -> Column:
    """The pieces of a line between its junctions, if each is one JSON object; else null.

    The JSON functions read to the end of the first value only. A piece that goes on after its
    first object can end the array or the outer object around it early, but not both.
    """

    def whole(piece: Column) -> Column:
        in_array = F.json_array_length(F.concat(F.lit("["), piece, F.lit("]")))
        in_object = F.json_object_keys(F.concat(F.lit('{"":'), piece, F.lit("}")))
        return (in_array == 1) & (F.size(in_object) == 1)

    usual = line.startswith("{") & line.endswith("}") & ~line.rlike(_SINGLE_QUOTED)
    return F.when(usual, _once(F.split(line, _JUNCTION), lambda pieces: F.when(F.forall(pieces, whole), pieces)))


def split_json_objects(line: Column) -> Column:
    """A line of objects written one after another -> array with one text per object.

    Objects may nest to any depth. A line of nothing but JSON objects is cut between them; any
    other is gone over once per ``_DEPTH`` levels, each time in one pass. A brace that is never
    closed hides no object. An array of objects counts as its elements. Text that belongs to no
    complete object (a cut-off record, garbage) becomes one more element, so nothing on the
    line is lost.
    """

    def step(state: Column, _: Column) -> Column:
        again = _once(
            _recognise(state["line"]),
            lambda new: F.struct(new.alias("line"), ((new == state["line"]) | ~F.contains(new, F.lit("{"))).alias("done")),
        )
        return F.when(state["done"], state).otherwise(again)

    def parts(found: Column) -> Column:
        objects = F.transform(F.regexp_extract_all(found, F.lit(_RECOGNISED), F.lit(1)), _unescaped)
        rest = F.trim(F.regexp_replace(found, _RECOGNISED, " "))
        nothing = F.array().cast("array<string>")
        return _once(
            rest,
            lambda r: F.concat(objects, F.when(r.rlike(r"^[\[\],\s]*$"), nothing).otherwise(F.array(_unescaped(r)))),
        )

    def more(state: Column) -> Column:
        braces = F.char_length(line) - F.char_length(F.replace(line, F.lit("{"), F.lit("")))
        passes = F.sequence(F.lit(0), F.floor(braces / _DEPTH).cast("int"))  # as many as there can be levels
        return F.when(state["done"], state["line"]).otherwise(F.aggregate(passes, state, step, lambda s: s["line"]))

    start = F.struct(_escaped(line).alias("line"), F.lit(False).alias("done"))
    few = F.aggregate(F.sequence(F.lit(1), F.lit(_PASSES)), start, step)  # a pass without work still copies the line
    several = _once(_once(few, more), parts)
    # One brace of each kind, around everything else: the usual line needs no tokens.
    inner = F.substring(line, F.lit(2), F.char_length(line) - 2)
    flat = line.startswith("{") & line.endswith("}") & ~F.contains(inner, F.lit("{")) & ~F.contains(inner, F.lit("}"))
    return F.when(flat, F.array(line)).otherwise(F.coalesce(_whole_objects(line), several))
