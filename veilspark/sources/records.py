"""Plain-record scan (S2) and sink.

Records are JSON objects ``{id, category, rating, body[, user_id]}``, either
one per line or as one JSON array.  ``strict`` (array form) reads an array by byte
ranges (``veilspark.sources.arrays``) and fails unless every file's top level is one.
``read_records_variant`` keeps each record
as a VARIANT so that key presence survives (needed by ``prep.clean_records``);
``read_records`` gives typed columns directly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.sources.arrays import read_array

RECORD_SCHEMA = "id long, category string, rating double, body string, user_id long"


def read_records(spark: SparkSession, path: str, multi_line: bool = False, strict: bool = False) -> DataFrame:
    """Typed records."""
    if strict and multi_line:
        return read_array(spark, path).select(F.from_json("text", RECORD_SCHEMA, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    return spark.read.schema(RECORD_SCHEMA).option("multiLine", str(bool(multi_line)).lower()).json(path)


def read_records_variant(spark: SparkSession, path: str, multi_line: bool = False, name: str = "record", strict: bool = False) -> DataFrame:
    """One VARIANT column per record (key presence preserved)."""
    if strict and multi_line:
        return read_array(spark, path).select(F.parse_json("text").alias(name))
    return (
        spark.read.option("singleVariantColumn", name)
        .option("multiLine", str(bool(multi_line)).lower())
        .json(path)
    )


def write_records(df: DataFrame, path: str, fmt: str = "json", mode: str = "errorifexists") -> None:
    """Write cleaned/tagged records as JSON Lines (nulls kept) or parquet."""
    w = df.write.mode(mode)
    if fmt == "json":
        w.option("ignoreNullFields", "false").json(path)
    elif fmt == "parquet":
        w.parquet(path)
    else:
        raise ValueError("fmt must be 'json' or 'parquet'")
