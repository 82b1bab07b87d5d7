"""Text transforms and detectors on literal cases."""

import hashlib
import html
import itertools
import re

import pytest
from pyspark.sql import functions as F

from corpusloom.functions import detect as dt
from corpusloom.functions import fixed_values as fx
from corpusloom.functions import hashing as hs
from corpusloom.functions import text as tx
from corpusloom.functions.entities import decode_entities


def run(spark, texts, expression):
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "i int, t string")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("t"))).collect()]


def test_space_characters_are_those_of_str_isspace():
    assert set(fx.SPACE_CHARS) == {chr(c) for c in range(0x110000) if chr(c).isspace()}


def test_strip_space(spark):
    texts = [" \x1c a b　\n", "", " \t\x85 ", "x"]
    assert run(spark, texts, tx.strip_space) == [t.strip() for t in texts]


def test_normalize(spark):
    cases = {
        "a​b﻿c": "abc",
        "a\xa0b": "a b",
        "a\x00b\x07\x0bc\x7fd": "a b c d",
        "a \t\t b": "a b",
        "a\n\n\n\n\nb\n\nc": "a\n\nb\n\nc",
        "　 a\r\nb  ": "a\r\nb",
        " \x1f ": "",
    }
    out = run(spark, list(cases), tx.normalize_text)
    assert out == list(cases.values())
    assert run(spark, out, tx.normalize_text) == out


ENTITIES = [
    "&amp;lt; &ampfoo &notit; &notin; &#169;&#xE9; &#128; &#0; &#x110000; &#55296 &#1;",
    "&bogus; & x &copy2 &#99999999999999999999; &#x; &; &amp&copy &#65534; &#xfdd0",
    "&frac12; &NotEqualTilde; &#13;a &#00065; &amp", "no reference", "", "&&&", "&#x41&#66;",
    "&Aacute &aacute; &unknownname; &lt;b&gt; 100&percnt; &nbsp;|&ensp;|",
]


def test_decode_entities_equals_the_html5_rules(spark):
    assert run(spark, ENTITIES, decode_entities) == [html.unescape(t) for t in ENTITIES]


def test_html(spark):
    flags = {
        "<b>x</b>": True, "a < b > c": False, "<br/>": False, "<!DOCTYPE html>": False,
        "x &copy; y": True, "x &#169; y": True, "x &#xA9; y": False, "<SCRIPT src=1": True,
        "&amp no semicolon": False, "<a\nhref='x'>": True, "<1>": False,
    }
    assert run(spark, list(flags), dt.has_html) == list(flags.values())
    stripped = {
        "<p>a<SCRIPT x>\nvar a;</script>b</p>": "a b",
        "a<!-- c\n<b> -->d": "a d",
        "<br/>x<!DOCTYPE html>": "<br/>x<!DOCTYPE html>",
        "&lt;b&gt;bold": "<b>bold",
        "a\n\n b\t<i>c</i>": "a b c",
        "<style>p{}</style >x": "p{} x",
    }
    assert run(spark, list(stripped), tx.strip_html) == list(stripped.values())


def test_lines_split_like_splitlines(spark):
    texts = ["a\r\nb\x0bc\x0cd\x1ce\x85f g h\n\n i ", "", "\n\n", "a\x1f\nb"]
    want = [[x.strip() for x in t.splitlines() if x.strip()] for t in texts]
    assert run(spark, texts, tx.text_lines) == want


WEAK = {
    "def f(x):": 1, "  return x": 1, "returns x": 0, "function go (": 1, "#include <stdio.h>": 1,
    "fn main(": 1, "public void main(": 1, "public main(": 0, "plain text": 0, "x def f(": 0,
}
STRONG = {
    "```": 1, "a <code>b": 1, "----": 1, "---": 0, "x();": 1, "a } b": 1, "let x": 1,
    "élet x": 0, "letter": 0, "x a = 1": 1, "x a == 1": 0, "from here on": 1,
    "away from here": 0, "the #include": 0, "a#include b": 1, "def f (x)": 1, "plain words": 0,
    "class": 1, "first_class": 0, "importance": 0, "import os": 1, "a =": 0,
}


@pytest.mark.parametrize(
    "cases, fraction", [(WEAK, dt.code_fraction), (STRONG, dt.code_fraction_strong)]
)
def test_code_lines(spark, cases, fraction):
    assert run(spark, list(cases), fraction) == [float(v) for v in cases.values()]


def test_code_fraction_threshold(spark):
    exact = "{\n}\n" + "words here\n" * 3
    above = "{\n}\n" + "words here\n" * 2
    assert run(spark, [exact, above, "", " \n "], dt.code_fraction_strong) == [0.4, 0.5, 0.0, 0.0]
    assert run(spark, [exact, above], dt.is_code_document) == [False, True]


def test_pii(spark):
    cases = {
        "mail a.b+c@x-y.org now": ["email"], "a@b": [], "a@b.c": [], "tel 030-1234567": ["phone"],
        "1234567": [], "x1234567890": [], "x+49 30 1234567": ["phone"],
        "4111 1111 1111 1111": ["phone", "credit_card"], "4111.1111.1111.1111": [],
        "12345678901234567890": ["phone"], "١٢٣٤٥٦٧٨٩": ["phone"],
        "@@@@" * 50: [],
    }
    assert run(spark, list(cases), dt.pii_labels) == list(cases.values())


def test_length_and_ascii(spark):
    texts = ["a" * 199, "a" * 200, "\U0001f600" * 200, "a" * 50_000, "a" * 50_001]
    assert run(spark, texts, dt.length_ok) == [False, True, True, True, False]
    assert run(spark, texts, dt.has_non_ascii) == [False, False, True, False, False]


def test_simhash_pieces(spark):
    texts = ["One, two; THREE", "", "...", "a b c d e f g h i"]
    words = [["one", "two", "three"], [], [], list("abcdefghi")]
    assert run(spark, texts, tx.simhash_tokens) == words
    chunks = run(spark, texts, lambda c: tx.token_chunks(tx.simhash_tokens(c)))
    assert chunks == [["one two three"], [], [], ["a b c d e f g h", "i"]]
    want = [int.from_bytes(hashlib.md5(t.encode()).digest()[8:], "big", signed=True) for t in texts]
    assert run(spark, texts, hs.low_md5) == want
    assert run(spark, texts, hs.doc_hash) == [hashlib.sha256(t.encode()).hexdigest() for t in texts]


def test_strong_code_lines_are_those_of_one_pattern(spark):
    """Fence markers, the strong patterns and keywords that no word character touches, as one alternation."""
    word, first = f"[{fx.WORD_CLASS}]", [re.escape(m) for m in fx.FENCE_MARKERS] + fx.STRONG_CODE
    plain = [w for w in fx.CODE_KEYWORDS if not w.startswith("#")]
    every = "|".join([*first, rf"(?<!{word})(?:{'|'.join(plain)})(?!{word})", rf"(?<={word})(?:#include)(?!{word})"])
    parts = ["class", "x", " ", "_", "#include", "a#include <x>", "new", "é", "1", "\U0001d400", ";", "{", " a b =c", "==", "```", "--", "def f(", "import z", "let"]
    lines = [("".join(p).strip(),) for p in itertools.product(parts, repeat=3) if "".join(p).strip()]
    df = spark.createDataFrame(lines, "line string")
    got = df.select("line", (dt.code_fraction_strong(F.col("line")) > 0).alias("a"), F.rlike("line", F.lit(every)).alias("b"))
    assert got.filter("a != b").collect() == []
    # One test for all would try every keyword at every place of a line.
    assert "(?<!" not in dt._KEYWORD_INSIDE and len(dt._AT_START) < len(every)
