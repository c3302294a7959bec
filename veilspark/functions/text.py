"""Text functions: body extraction (P1), tokenizing (P2), Unicode word counts.

All are Column expressions evaluated inside the JVM (whole-stage codegen where
Spark has it), so they run wherever the rows already are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The patterns that define a "word" in each unit.
# Token unit: split on runs of ASCII non-word characters (Java/RE2 \W), so
# accented letters separate tokens.
TOKEN_SPLIT_PATTERN = r"\W+"
# Estimation unit: maximal runs of Unicode letters, digits and underscore
# (the same runs as Python's \b\w+\b on str).
UNICODE_WORD_PATTERN = r"[\p{L}\p{N}_]+"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def extract_body(json_text, field: str = "body") -> Column:
    """``field`` of a JSON object if it is a string, else ``''``.

    Missing, null, numeric, nested, non-object and unparsable inputs all give
    ``''``.  The value is parsed as VARIANT so a repeated key resolves to its
    last occurrence and numbers are not turned into text.
    """
    v = F.from_json(_col(json_text), f"`{field}` variant", {"mode": "PERMISSIVE"})[field]
    return F.when(F.schema_of_variant(v) == F.lit("STRING"), v.cast("string")).otherwise(F.lit(""))


def tokens(text) -> Column:
    """array<string>: ASCII-word tokens, lower-cased and trimmed, empties dropped.

    Order and duplicates are kept; null text gives an empty array.
    """
    parts = F.split(F.coalesce(_col(text), F.lit("")), TOKEN_SPLIT_PATTERN)
    lowered = F.transform(parts, lambda x: F.trim(F.lower(x)))
    return F.filter(lowered, lambda x: x != F.lit(""))


def tokenize(df: DataFrame, text: str = "text", keep: list[str] | None = None,
             word: str = "word", pos: str = "pos") -> DataFrame:
    """One row per token: ``keep`` columns, ``pos`` (0-based) and ``word``.

    ``keep`` carries the user and arrival columns through (user propagation,
    P5); the text column itself is dropped right after splitting.  Same
    tokens as ``tokens()``, computed without higher-order functions so the
    lower-casing stays in whole-stage codegen: runs of ``\\W`` merge, so an
    empty piece can only come from a leading or trailing delimiter; a leading
    one shifts every position by one.
    """
    keep = list(keep or [c for c in df.columns if c != text])
    body = F.coalesce(F.col(text), F.lit(""))
    lead = F.when(body.rlike(r"^\W"), F.lit(1)).otherwise(F.lit(0))
    pieces = df.select(*keep, lead.alias("__lead"), F.posexplode(F.split(body, TOKEN_SPLIT_PATTERN)).alias("__p", "__w"))
    return pieces.filter(F.col("__w") != F.lit("")).select(
        *keep, (F.col("__p") - F.col("__lead")).cast("long").alias(pos), F.lower(F.col("__w")).alias(word)
    )


def unicode_word_count(text) -> Column:
    """Number of Unicode word runs in ``text``; null counts as 0 (a long)."""
    return F.regexp_count(F.coalesce(_col(text), F.lit("")), F.lit(UNICODE_WORD_PATTERN)).cast("long")
