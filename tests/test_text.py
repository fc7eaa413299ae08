"""Text helpers: JavaScript trim and length rules, lines, tokens, hashes."""

import hashlib
import math

import pytest

from turnmeter.functions import text as tx


def applied(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}").coalesce(1)
    return [r.v for r in df.select("i", expr.alias("v")).orderBy("i").collect()]


def test_trim_removes_what_javascript_calls_white_space(spark):
    blank = "\t\n\x0b\x0c\r \xa0       　﻿"
    kept = ["\x85", "​", "\x1c", "᠎"]
    got = applied(spark, tx.js_trim("t"), [b + "reed " + "bed" + b for b in blank] + [k + "x" + k for k in kept])
    assert got == ["reed bed"] * len(blank) + [k + "x" + k for k in kept]


def test_utf16_length(spark):
    values = ["", "fern", "ø", "\U0001F33F", "\U0001F33F\U0001F33Fz", "퟿"]
    assert applied(spark, tx.utf16_len("t"), values) == [len(v.encode("utf-16-le")) // 2 for v in values]


def test_lines_are_trimmed_and_blank_ones_dropped(spark):
    assert applied(spark, tx.to_lines("t"), ["\n\n", " moss\n\t\n lichen \r\nfern"]) == [[], ["moss", "lichen", "fern"]]


def test_hash_is_sha256_of_utf8(spark):
    values = ["", "mire", "étang \U0001F33F"]
    assert applied(spark, tx.content_hash("t"), values) == [hashlib.sha256(v.encode()).hexdigest() for v in values]


def test_system_parts_are_joined_by_a_blank_line(spark):
    assert applied(spark, tx.join_system("t"), [["bog", "fen", "carr"], ["one"], []], "array<string>") == [
        "bog\n\nfen\n\ncarr", "one", ""]


@pytest.mark.parametrize("text, want", [
    ("see \"reed warbler\" or 'marsh' now", {"reed warbler", "marsh", "warbler"}),
    ("pond/lily-pad.yaml and a.md", {"pond/lily-pad.yaml"}),
    ("sedge sedges sedges_9 9sedges", {"sedges", "sedges_9"}),
    ("\"abc\" 'de' q.go", set()),
    ("østuary7 übermoor", {"stuary7", "bermoor"}),  # \b knows ASCII word characters only
    ("willow willow \"willow\"", {"willow"}),
])
def test_tokens(spark, text, want):
    [got] = applied(spark, tx.extract_tokens("t"), [text])
    assert set(got) == want and len(got) == len(want)


def test_response_text_joins_the_text_parts(spark):
    parts = [[("text", "alder"), ("tool", "no"), ("text", None), ("text", "birch")], [("text", "ash")], []]
    got = applied(spark, tx.response_text("t"), parts, "array<struct<type:string,text:string>>")
    assert got == ["alder\n\nbirch", "ash", ""]


def test_rounding_is_half_up(spark):
    values = [0.5, 1.5, -0.5, -1.5, 7.49, -7.51]
    assert applied(spark, tx.js_round("t"), values, "double") == [math.floor(v + 0.5) for v in values]


def test_file_read_tools(spark):
    names = ["read", "cat", "serena_read_file", "view", "open"]
    others = ["reads", "cat ", "file", "", "grep", "re-open"]
    got = applied(spark, tx.is_file_read_tool("t"), names + [n.upper() for n in names] + others)
    assert got == [True] * 10 + [False] * 6
