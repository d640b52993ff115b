"""Column expressions against plain Python."""

from __future__ import annotations

import json
from urllib.parse import unquote_plus

import pytest
from pyspark.sql import functions as F

from streamlake.functions.expressions import (
    decode_form_url,
    is_blank,
    matches_format,
    split_json_objects,
    utc_timestamp,
    whole_number,
)


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in df.select("i", expr(F.col("v"))).orderBy("i").collect()]


def test_split_json_objects(spark):
    a = json.dumps({"s": 'tricky }{ \\" and "quotes"', "n": 1})
    b = json.dumps({"o": {"deep": {"deeper": 1}}, "s": "x\\"})
    lines = [a, a + b, f"{a} {b}\t{a}", "", f"{a}{{\"cut", "garbage", f"[{a},{b}]", "{}{}", f"  {a}"]
    got = column(spark, lines, split_json_objects)
    assert got[0] == [a]
    assert got[1] == [a, b]
    assert got[2] == [a, b, a]
    assert got[4] == [a, '{"cut']
    assert got[5] == ["garbage"]
    assert got[6] == [a, b]
    assert got[7] == ["{}", "{}"]
    assert [x.strip() for x in got[8]] == [a]


def test_split_json_objects_on_a_long_line(spark):
    objects = [json.dumps({"i": i, "s": "}{" * (i % 5) + '"' * (i % 3)}) for i in range(20000)]
    long_string = json.dumps({"s": '\\"{' * 100000})
    got = column(spark, ["".join(objects) + long_string + long_string], split_json_objects)[0]
    assert got == objects + [long_string, long_string]


@pytest.mark.parametrize("key", ["a+b", "a%3Db", "a%2Bb%20c", "100%", "%zz%3D", "caf%C3%A9", "%", "a%2", ""])
def test_decode_form_url_equals_unquote_plus(spark, key):
    assert column(spark, [key], decode_form_url) == [unquote_plus(key)]


def test_is_blank_counts_spaces_only(spark):
    assert column(spark, [None, "", "  ", "\t", "x"], is_blank) == [True, True, True, False, False]


def test_whole_number(spark):
    values = ["246", "1.5", "-2.9", "abc", "", None, "9e99", "NaN", " 7 ", "12d", "0x1p3", ".5", "1e2"]
    assert column(spark, values, whole_number) == [246, 1, -2, None, None, None, None, None, 7, None, None, 0, 100]


def test_a_time_needs_a_date(spark):
    values = ["10:00:00", "T08:15", "2026", "soon", "2025-03-04", "2025-03-04T21:47:09Z"]
    found = column(spark, values, utc_timestamp)
    assert [v is None for v in found] == [True, True, True, True, False, False]


@pytest.mark.parametrize("depth", [1, 4, 5, 16, 17, 18, 40, 60])
def test_objects_of_any_depth(spark, depth):
    deep = '{"a":' * depth + "1" + "}" * depth
    flat = json.dumps({"s": "}{", "n": depth})
    lines = [deep + flat + deep, f"junk {deep}", f"{flat}junk{deep}", f"{deep} {{cut {flat}", f"}}{deep}"]
    got = column(spark, lines, split_json_objects)
    assert got[0] == [deep, flat, deep]
    assert got[1] == [deep, "junk"]
    assert got[2] == [flat, deep, "junk"]
    assert got[3][:2] == [deep, flat] and got[3][2].split() == ["{cut"]
    assert got[4] == [deep, "}"]


def test_deep_objects_take_linear_time(spark):
    """20,000 objects on a line, 25 levels deep."""
    import time

    def seconds(n):
        objects = ['{"a":' * 25 + f'"{k}}}{{"' + "}" * 25 for k in range(n)]
        begin = time.perf_counter()
        assert column(spark, ["".join(objects)], split_json_objects) == [objects]
        return time.perf_counter() - begin

    seconds(100)
    few, many = seconds(5_000), seconds(20_000)
    assert many < 30 and many < 8 * few + 1


def test_the_time_of_deep_objects_follows_their_length(spark):
    """The same text as many objects of 80 levels or as a tenth of them with 800."""
    import time

    def seconds(depth, n):
        line = ('{"a":' * depth + "1" + "}" * depth) * n
        begin = time.perf_counter()
        assert column(spark, [line] * 4, lambda c: F.size(split_json_objects(c))) == [n] * 4
        return time.perf_counter() - begin

    seconds(80, 10)
    shallow, deep = seconds(80, 2_000), seconds(800, 200)
    assert deep < 3 * shallow + 1


ODD_PIECES = ("{", "}", "[", "]", ",", '"', "'", ":", " ", "\\", '{"a":1}', '{"a":{"b":[{}]}}', '"}{"', "1", "\t")


def test_lines_of_odd_pieces_are_split_as_by_passes(spark, monkeypatch):
    """Early ends of arrays and objects, junctions inside strings, single quotes, and what a draw gives."""
    import random

    from streamlake.functions import expressions

    draw = random.Random(5)
    lines = ['{"a":"x}{y"}{"b":1}', '{"a":"x}{y"},{"b":1}', '{"a":{}}],[{"b":{}}', '{"a":{}}]{"b":{}}', '{"a":{}}}{"b":{}}',
             '{}],[{}]]x{}{"a":{}}', '{"a":{}},"b":{"c":1}', "{'a{':{}}", "{'a}{b':1}{}", '{"a":\'{\'}{}', '{"a":{"b":1}},', "{}{}" * 3,
             '{"a":{}} \t{"a":{"b":"it\'s"}}', '{"a":{},"a":{}}{"a":01}', '{"\\u007b":{"a":"\\"}{"}}{}', '{"a":' * 1200 + "1" + "}" * 1200 + "{}", None]
    lines += ["".join(draw.choices(ODD_PIECES, k=draw.randint(1, 9))) for _ in range(1500)]
    lines += ["{" + "".join(draw.choices(ODD_PIECES, k=draw.randint(1, 9))) + "}" for _ in range(1500)]
    lines += ['{"k":' + "".join(draw.choices(ODD_PIECES, k=draw.randint(1, 4))) + "}{}" for _ in range(1500)]
    found = column(spark, lines, split_json_objects)
    cut = column(spark, lines, lambda c: expressions._whole_objects(c).isNotNull())
    monkeypatch.setattr(expressions, "_whole_objects", lambda line: F.lit(None).cast("array<string>"))
    assert found == column(spark, lines, split_json_objects)
    assert 20 < sum(cut) < len(lines) / 2


def test_own_noncharacters_stay(spark):
    odd = "".join(map(chr, range(0xFDD0, 0xFDD7))) + "0\ufdd55"
    deep = '{"a":' * 20 + json.dumps(odd, ensure_ascii=False) + "}" * 20
    lines = [deep + "{}" + deep, "{}" + odd, odd]
    assert column(spark, lines, split_json_objects) == [[deep, "{}", deep], ["{}", odd], [odd]]


def test_formats(spark):
    uuids = ["7b1d5a90-0e3f-4c62-8a17-c4d2e9f01b55", "7B1D5A90-0E3F-4C62-8A17-C4D2E9F01B55", "7b1d5a900e3f4c628a17c4d2e9f01b55", "x"]
    assert column(spark, uuids, lambda c: matches_format(c, "uuid")) == [True, True, False, False]
    times = ["2026-07-10T08:15:00Z", "2026-07-10T08:15:00.25+08:00", "2026-07-10 08:15:00Z", "2026-07-10T08:15:00", "2026-13-10T08:15:00Z", "2026-07-10"]
    assert column(spark, times, lambda c: matches_format(c, "date-time")) == [True, True, False, False, False, False]
    dates = ["2026-07-10", "2026-02-30", "2026-7-1", "20260710"]
    assert column(spark, dates, lambda c: matches_format(c, "date")) == [True, False, False, False]
