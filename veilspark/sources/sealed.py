"""Sealed-record scan (S1) and sink.

At rest a sealed record is ``{header: json-string, nonce: base64, ciphertext:
base64}``.  The sink writes JSON Lines (one object per line; a single giant
JSON array does not split across tasks).  The scan reads JSON Lines or a JSON
array (``multi_line=True``); entries without a header are skipped, a nonce or
ciphertext that is not base64 text fails the job (``to_binary`` raises).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.sources.arrays import read_array


def write_sealed(df: DataFrame, path: str, extra_cols: list[str] | None = None, mode: str = "errorifexists") -> None:
    """Write (header, nonce, ciphertext [, extra]) as JSON Lines with base64 binaries."""
    cols = [
        F.col("header"),
        F.base64("nonce").alias("nonce"),
        F.base64("ciphertext").alias("ciphertext"),
    ] + [F.col(c) for c in (extra_cols or [])]
    df.select(*cols).write.mode(mode).option("ignoreNullFields", "false").json(path)


def read_sealed(spark: SparkSession, path: str, multi_line: bool = False, extra_schema: str = "",
                strict: bool = False) -> DataFrame:
    """(header string, nonce binary, ciphertext binary [, extra]) of every entry with a header.

    A header that is no text counts as empty; a nonce or ciphertext that is no
    text is an error.  ``strict`` (array form only) reads each array by byte ranges
    in many tasks (``veilspark.sources.arrays``) and fails unless every file's top level is
    one; Spark's reader alone takes a file whole in one task and a lone object as one record.
    """
    # As VARIANT, so that a value's JSON type is known: text, or something that a plain string column would turn into text.
    schema = "header variant, nonce variant, ciphertext variant" + (", " + extra_schema if extra_schema else "")
    if strict and multi_line:
        fields = [f.split(None, 1) for f in schema.split(", ")]
        record = read_array(spark, path).select(F.parse_json("text").alias("r"))
        raw = record.select(*[F.variant_get("r", f"$.{name}", kind).alias(name) for name, kind in fields])
    else:
        raw = spark.read.schema(schema).option("multiLine", str(bool(multi_line)).lower()).option("mode", "FAILFAST").json(path)
    extras = [f.split()[0] for f in extra_schema.split(",") if f.strip()] if extra_schema else []
    kind = F.schema_of_variant("header")

    def text(name):
        k = F.schema_of_variant(name)
        wrong = F.raise_error(F.concat(F.lit(f"{name} must be text, is "), k)).cast("string")
        return F.when(k == "STRING", F.col(name).cast("string")).when(k != "VOID", wrong)

    return raw.filter(F.col("header").isNotNull() & (kind != "VOID")).select(
        F.when(kind == "STRING", F.col("header").cast("string")).otherwise(F.lit("")).alias("header"),
        F.to_binary(text("nonce"), F.lit("base64")).alias("nonce"),
        F.to_binary(text("ciphertext"), F.lit("base64")).alias("ciphertext"),
        *extras,
    )
