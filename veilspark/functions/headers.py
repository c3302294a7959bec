"""Record headers (the authenticated associated data): parse (P3), encode (P4),
envelope shape (P6), and the stage graph they route through.

A header is a flat JSON object with the reserved keys ``source``,
``destination``, ``producer_id`` and ``seq``; every other key is an attribute
(``user_id`` for instance).  Parsing is Spark's JSON reader: ``seq`` is read as
text and cast, so a number or numeric text both give a long, anything else
null; an empty or null header gives nulls throughout.  A header that breaks off
or goes wrong midway gives the pairs before that point.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

RESERVED = ("source", "destination", "producer_id", "seq")
NONCE_BYTES = 12

# The stage graph of the word-count application
# (label, enum name) in pipeline order, and each stage's single downstream.
COMPONENTS = (
    ("_DATASET", "DATASET"),
    ("_MAPPER", "MAPPER"),
    ("random-joke-spout", "RANDOM_JOKE_SPOUT"),
    ("sentence-split", "SENTENCE_SPLIT"),
    ("user-contribution-bounding", "USER_CONTRIBUTION_BOUNDING"),
    ("word-count", "WORD_COUNT"),
    ("histogram-global", "HISTOGRAM_GLOBAL"),
)
DOWNSTREAM = {
    "random-joke-spout": ("sentence-split",),
    "sentence-split": ("user-contribution-bounding",),
    "user-contribution-bounding": ("word-count",),
    "word-count": ("histogram-global",),
    "histogram-global": (),
}
# stage -> (expected source or None, expected destination) checked on its input
EXPECTED_INPUT = {
    "_MAPPER": ("_DATASET", "_MAPPER"),
    "sentence-split": ("random-joke-spout", "sentence-split"),
    "user-contribution-bounding": ("sentence-split", "user-contribution-bounding"),
    "word-count": ("user-contribution-bounding", "word-count"),
    "histogram-global": ("word-count", "histogram-global"),
}

_HEADER_SCHEMA = "source string, destination string, producer_id string, seq string"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# A JSON string, a value without nesting, and a run of pairs; possessive, so no text makes them search back.
_TEXT = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
_NUMBER = r"-?+(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?+(?:[eE][+-]?+[0-9]++)?+"
_PAIR = rf"\s*+{_TEXT}\s*+:\s*+(?:{_TEXT}|(?:true|false|null|{_NUMBER})(?=\s*+(?:[,}}]|$)))\s*+"
_WHOLE_PAIRS = rf"^\s*+\{{({_PAIR}(?:,{_PAIR})*+)"


def _header_map(header) -> Column:
    h = _col(header)
    blank = h.isNull() | (F.length(h) == F.lit(0))
    # Of a header that is no whole JSON object, the longest beginning that is a list of pairs.
    pairs = F.regexp_extract(h, _WHOLE_PAIRS, 1)
    begun = F.when(pairs != "", F.from_json(F.concat(F.lit("{"), pairs, F.lit("}")), "map<string,string>"))
    whole = F.coalesce(F.from_json(h, "map<string,string>"), begun)
    return F.when(blank, F.lit(None).cast("map<string,string>")).otherwise(whole)


def _whole_number(m: Column, header, key: str) -> Column:
    """A header's number: JSON numbers lose their fraction; text must be digits alone, with a sign at most."""
    v = m[key]
    as_text = _col(header).rlike(f'"{key}"\\s*:\\s*"')
    number = F.coalesce(v.try_cast("long"), v.try_cast("double").try_cast("long"))
    return F.when(as_text, F.when(v.rlike("^[+-]?[0-9]+$"), v.try_cast("long"))).otherwise(number)


def _fields_from_map(m: Column, header) -> Column:
    out = F.struct(
        m["source"].alias("source"),
        m["destination"].alias("destination"),
        m["producer_id"].alias("producer_id"),
        _whole_number(m, header, "seq").alias("seq"),
        F.map_filter(m, lambda k, v: ~k.isin(*RESERVED)).alias("attrs"),
        _whole_number(m, header, "user_id").alias("user_id"),
    )
    return F.when(m.isNull(), F.lit(None).cast(HEADER_TYPE)).otherwise(out)


def parse_header(header) -> Column:
    """struct<source, destination, producer_id, seq long, attrs map<string,string>, user_id long>.

    One JSON parse into ``map<string,string>`` (a repeated key keeps its last
    value; numbers arrive as their text), then plain map lookups.  Empty and
    null headers, and those without a whole pair, give null.  Prefer ``with_header`` on a
    DataFrame: it keeps the parse in its own projection so it runs once per row.
    """
    return _fields_from_map(_header_map(header), header)


def with_header(df: DataFrame, header: str = "header", name: str = "h") -> DataFrame:
    """Add the parsed header struct ``name`` (see ``parse_header``), parsing each header once."""
    m = "__header_map"
    return df.withColumn(m, _header_map(header)).withColumn(name, _fields_from_map(F.col(m), header)).drop(m)


HEADER_TYPE = ("struct<source:string,destination:string,producer_id:string,seq:bigint,"
               "attrs:map<string,string>,user_id:bigint>")


def encode_header(fields: Mapping[str, Column]) -> Column:
    """Canonical header JSON: keys sorted, compact, nulls written; no fields -> ''.

    ``fields`` maps header keys to columns (attributes plus ``source`` and
    ``destination`` as wanted).  Sorting happens at plan time; the JSON text
    is built by ``to_json`` inside the JVM.
    """
    if not fields:
        return F.lit("")
    items = sorted(fields.items())
    return F.to_json(F.struct(*[c.alias(k) for k, c in items]), {"ignoreNullFields": "false"})


def update_header(header, fields: Mapping[str, Column]) -> Column:
    """P4 over a header read at run time: its attributes with ``fields`` set, as canonical JSON.

    Attributes keep their JSON values and types; none is added but ``fields``.
    """
    old = F.try_parse_json(_col(header)).try_cast("map<string,variant>")
    old = F.coalesce(old, F.create_map().cast("map<string,variant>"))
    set_ = F.create_map(*[x for k, c in fields.items() for x in (F.lit(k), c.cast("variant"))])
    merged = F.map_concat(F.map_filter(old, lambda k, v: ~k.isin(*fields)), set_)
    items = F.array_sort(F.transform(F.map_entries(merged), lambda e: F.struct(
        e["key"].alias("k"), F.concat(F.to_json(e["key"].cast("variant")), F.lit(":"), F.coalesce(F.to_json(e["value"]), F.lit("null"))).alias("j"))))
    return F.concat(F.lit("{"), F.array_join(F.transform(items, lambda e: e["j"]), ","), F.lit("}"))


def envelope_reason(nonce, ciphertext, header) -> Column:
    """Null when the envelope is well formed, else a reason code."""
    n, c, h = _col(nonce), _col(ciphertext), _col(header)
    return (
        F.when(h.isNull(), F.lit("missing_header"))
        .when(n.isNull(), F.lit("missing_nonce"))
        .when(c.isNull(), F.lit("missing_ciphertext"))
        .when(F.octet_length(n) != F.lit(NONCE_BYTES), F.lit("bad_nonce_length"))
        .when(F.octet_length(c) == F.lit(0), F.lit("empty_ciphertext"))
    )
