"""Stand-in inputs built from the driver tables (see FIXTURES.md §3).

These only give rows in the shape a job expects (who the user is, what the
arrival order is, which column is the key); the jobs themselves live in
``veilspark.operators`` and work on any data of that shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.text import tokenize
from veilspark.session import table

# The anchor day for trigger ids (days since the Unix epoch).
EPOCH_DATE = "1970-01-01"


def conversation_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations → one row per token; user = conv_id; arrival = (conv_id, turn, pos)."""
    conv = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("user_id"), "turn", "text"
    )
    return tokenize(conv, "text", keep=["user_id", "turn"])


CONVERSATION_ORDER = ["turn", "pos"]


def day_trigger(ts_col: str = "ts"):
    """Trigger id = day of the timestamp, as days since the Unix epoch."""
    return F.datediff(F.to_date(F.col(ts_col)), F.lit(EPOCH_DATE).cast("date")).cast("long")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with ``trigger_id`` (day of ``ts``); arrival = (ts, event_id); key = event_type."""
    return table(spark, sf_dir, "events").withColumn("trigger_id", day_trigger("ts"))


EVENT_ORDER = ["ts", "event_id"]


# ------------------------------------------------------------------ headers

BOUNDING_STAGE = "user-contribution-bounding"
SPLIT_STAGE = "sentence-split"


def event_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with a ``header`` JSON: producer = event_type, seq = event_id, user = user_id.

    Defects planted by ``event_id % 7``: 1 wrong destination, 2 no producer_id,
    3 seq as numeric text, 4 seq as non-numeric text, 5 no source, 6 empty header.
    """
    from veilspark.functions.headers import encode_header

    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    src, dst = F.lit(SPLIT_STAGE), F.lit(BOUNDING_STAGE)
    prod, seq, user = F.col("event_type"), F.col("event_id"), F.col("user_id")
    full = {"source": src, "destination": dst, "producer_id": prod, "seq": seq, "user_id": user}

    def without(k):
        return {a: b for a, b in full.items() if a != k}

    m = F.col("event_id") % 7
    header = (
        F.when(m == 1, encode_header({**full, "destination": F.lit("word-count")}))
        .when(m == 2, encode_header(without("producer_id")))
        .when(m == 3, encode_header({**full, "seq": seq.cast("string")}))
        .when(m == 4, encode_header({**full, "seq": F.concat(F.lit("x"), seq.cast("string"))}))
        .when(m == 5, encode_header(without("source")))
        .when(m == 6, F.lit(""))
        .otherwise(encode_header(full))
    )
    return ev.withColumn("header", header).withColumn("stage", dst)


# ------------------------------------------------------------------ records

def doc_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as records (id, category=source, rating=n_chars % 5, body=text) in a VARIANT ``record``.

    body is blanked where doc_id % 13 = 0, rating is absent where doc_id % 17 = 0
    and category is JSON null where doc_id % 19 = 0 (present, so kept).
    """
    d = table(spark, sf_dir, "documents")
    body = F.when(F.col("doc_id") % 13 == 0, F.lit("")).otherwise(F.col("text"))
    cat = F.when(F.col("doc_id") % 19 == 0, F.lit(None).cast("string")).otherwise(F.col("source"))
    with_rating = F.struct(F.col("doc_id").alias("id"), cat.alias("category"),
                           (F.col("n_chars") % 5).cast("double").alias("rating"), body.alias("body"))
    no_rating = F.struct(F.col("doc_id").alias("id"), cat.alias("category"), body.alias("body"))
    rec = F.when(F.col("doc_id") % 17 == 0, F.to_variant_object(no_rating)).otherwise(F.to_variant_object(with_rating))
    return d.select("doc_id", rec.alias("record"))


FIXTURE_KEY_HEX = "000102030405060708090a0b0c0d0e0f101112131415161718191a1b1c1d1e1f"  # test-only key
