"""The reference's parse/encode cases and rounding edges."""

import re

import pytest
from pyspark.sql import functions as F

from veilspark.functions.headers import encode_header, parse_header
from veilspark.functions.text import extract_body, tokens, unicode_word_count
from veilspark.operators.release import rounded_release


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize("js,expect", [
    ('{"body": "a line"}', "a line"),
    ('{"id": 1}', ""),
    ('{"body": null}', ""),
    ('{"body": 5}', ""),
    ('{"body": {"t": "x"}}', ""),
    ('not json', ""),
    ('{"body": "first", "body": "last"}', "last"),
    ('[1, 2]', ""),
])
def test_extract_body(spark, js, expect):
    assert _one(spark, extract_body(F.lit(js))) == expect


def test_tokens_ascii_word_split(spark):
    got = _one(spark, tokens(F.lit("Hello, wörld!  It's  A_b 42 ÉTÉ")))
    # \W is ASCII: accented letters split words; case folded; order and repeats kept
    assert got == ["hello", "w", "rld", "it", "s", "a_b", "42", "t"]
    assert _one(spark, tokens(F.lit(None).cast("string"))) == []


def test_unicode_word_count_matches_python(spark):
    texts = ["Héllo wörld_1 ÉTÉ", "", "a-b c.d", "日本語 テキスト", "x²y"]
    rx = re.compile(r"\b\w+\b", re.UNICODE)
    for t in texts:
        assert _one(spark, unicode_word_count(F.lit(t))) == len(rx.findall(t)), t
    assert _one(spark, unicode_word_count(F.lit(None).cast("string"))) == 0


# header parse cases (FIXTURES.md §1)
@pytest.mark.parametrize("js,check", [
    ('{"key": "val\\u00fce", "newline": "line1\\nline2"}', lambda h: h["attrs"] == {"key": "valüe", "newline": "line1\nline2"}),
    ('{"a": 1, "b": "hello"}', lambda h: h["attrs"] == {"a": "1", "b": "hello"}),
    ('{ "a" : 123 , "b" : "test" }', lambda h: h["attrs"] == {"a": "123", "b": "test"}),
    ('{"boolTrue": true, "boolFalse": false, "nullVal": null, "intVal": 42, "doubleVal": 3.14}',
     lambda h: h["attrs"]["boolTrue"] == "true" and h["attrs"]["nullVal"] is None and h["attrs"]["intVal"] == "42"
     and h["attrs"]["doubleVal"] == "3.14"),
    ('{"str": "\\t\\n\\\\\\""}', lambda h: h["attrs"] == {"str": '\t\n\\"'}),
    ('{"unicode": "\\u00e9"}', lambda h: h["attrs"] == {"unicode": "é"}),
])
def test_header_parse_cases(spark, js, check):
    h = _one(spark, parse_header(F.lit(js))).asDict()
    assert check(h)


def test_header_reserved_fields(spark):
    h = _one(spark, parse_header(F.lit('{"source":"s","destination":"d","producer_id":"p","seq":"17","user_id":9}')))
    assert (h["source"], h["destination"], h["producer_id"], h["seq"], h["user_id"]) == ("s", "d", "p", 17, 9)
    assert h["attrs"] == {"user_id": "9"}
    assert _one(spark, parse_header(F.lit('{"seq":"x1"}')))["seq"] is None
    assert _one(spark, parse_header(F.lit(""))) is None


def test_header_encode_sorted_compact_with_escapes(spark):
    got = _one(spark, encode_header({"z": F.lit("line1\nline2\t\"q\""), "a": F.lit(None).cast("string"),
                                     "m": F.lit(5).cast("long"), "u": F.lit("é")}))
    assert got == '{"a":null,"m":5,"u":"é","z":"line1\\nline2\\t\\"q\\""}'
    back = _one(spark, parse_header(F.lit(got)))
    assert back["attrs"]["z"] == 'line1\nline2\t"q"'
    assert _one(spark, encode_header({})) == ""


def test_rounding_edges(spark):
    df = spark.createDataFrame([(-0.5,), (-0.51,), (0.4,), (2.5,), (-1.5,)], "noisy double")
    got = sorted((r["noisy"], r["released"]) for r in rounded_release(df).collect())
    assert got == [(-0.5, 0), (0.4, 0), (2.5, 3)]
