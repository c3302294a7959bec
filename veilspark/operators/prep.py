"""Dataset preparation.

D1  clean: drop records missing any required key, or whose body is null or
    blank.  Key *presence* is read from the VARIANT form of the record, so a
    key holding JSON null is present (kept) while an absent key drops the row.
D2  dense ids 0..n-1 in input order (distributed, see ``scan.global_row_number``).
D3  weighted user assignment: each of ``num_users`` users gets a lognormal
    weight drawn from a keyed hash; each record draws a keyed uniform and lands
    on the user whose cumulative weight range holds it.
D4  require a user id (see ``calibration.user_totals``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.noise import std_gaussian
from veilspark.operators.scan import global_row_number, global_running_sum
from veilspark.session import materialize

# The keys a record must carry, and the blank-body rule
REQUIRED_KEYS = ("body", "category", "id", "rating")
BLANK_PATTERN = r"^[\s\p{Z}\x1c-\x1f\x85]*$"
WEIGHT_SCALE = 1_000_000  # integer resolution of the lognormal weights


def has_key(record: Column, key: str) -> Column:
    """True when the VARIANT object ``record`` has ``key`` (even if its value is JSON null)."""
    return F.variant_get(record, f"$.{key}", "variant").isNotNull()


def clean_records(df: DataFrame, record: str = "record", required: Sequence[str] = REQUIRED_KEYS) -> DataFrame:
    """D1 over a VARIANT column: typed (id, category, rating, body, user_id) of the valid records.

    All fields and presence flags are extracted in one projection, then
    filtered.  A record that is not a JSON object is an error (the reference
    aborts).
    """
    r = F.col(record)
    others = [c for c in df.columns if c != record]
    flags = [has_key(r, k).alias(f"__has_{k}") for k in required]
    extracted = df.select(
        *others,
        F.schema_of_variant(r).startswith("OBJECT").alias("__obj"),
        *flags,
        F.try_variant_get(r, "$.id", "long").alias("id"),
        F.try_variant_get(r, "$.category", "string").alias("category"),
        F.try_variant_get(r, "$.rating", "double").alias("rating"),
        F.try_variant_get(r, "$.body", "string").alias("body"),
        F.try_variant_get(r, "$.user_id", "long").alias("user_id"),
    )
    checked = extracted.withColumn(
        "__obj", F.when(F.col("__obj"), F.lit(True)).otherwise(F.raise_error(F.lit("record is not a JSON object")))
    )
    keep = F.col("__obj") & F.col("body").isNotNull() & ~F.col("body").rlike(BLANK_PATTERN)
    for k in required:
        keep = keep & F.col(f"__has_{k}")
    out = checked.filter(keep)
    return out.select(*others, "id", "category", "rating", "body", "user_id")


def dense_ids(df: DataFrame, order_by: Sequence, name: str = "id") -> DataFrame:
    """replace/add ``name`` with 0..n-1 following ``order_by``.

    The rows are written once before they are counted, ranged and numbered, so ``df`` is computed once.
    """
    rows = materialize(df.drop(name) if name in df.columns else df, "numbered")
    out = global_row_number(rows, order_by, name="__rn")
    return out.withColumn(name, F.col("__rn") - F.lit(1)).drop("__rn")


def keyed_uniform(total: int, *parts: Column) -> Column:
    """A number from 0 to ``total`` - 1 drawn by 120 bits of a hash of ``parts``.

    Whatever the total (below 2^63), no number is likelier than another by more than one in 2^57.
    """
    h = F.sha2(F.concat_ws("|", *parts), 256)
    high, low = (F.conv(F.substring(h, at, 15), 16, 10).cast("decimal(19,0)") for at in (1, 16))
    drawn = (high * F.lit(1 << 60).cast("decimal(19,0)")).cast("decimal(38,0)") + low
    return (drawn.cast("decimal(38,0)") % F.lit(int(total)).cast("decimal(19,0)")).cast("long")


def user_weights(spark: SparkSession, num_users: int, seed: str) -> DataFrame:
    """(user_id, weight, lo, hi): integer lognormal(0, 1) weights and their cumulative ranges.

    The cumulative sum is a blocked running sum, so no single task holds all users.
    """
    users = spark.range(1, num_users + 1).select(F.col("id").alias("user_id"))
    z = std_gaussian(F.sha2(F.concat_ws("|", F.lit(seed), F.lit("weight"), F.col("user_id").cast("string")), 256))
    w = users.withColumn("weight", F.floor(F.exp(z) * F.lit(WEIGHT_SCALE)).cast("long"))
    cum = global_running_sum(w, ["user_id"], "weight", "hi")
    return cum.withColumn("hi", F.col("hi").cast("long")).withColumn("lo", F.col("hi") - F.col("weight"))


def assign_weighted_users(df: DataFrame, record_id: str, num_users: int, seed: str,
                          name: str = "user_id") -> DataFrame:
    """D3: one weighted draw per record, reproducible from ``seed`` and the record id.

    The weight table is cut into buckets of the cumulative axis so the lookup
    is an equi-join on the bucket plus a range filter; the bucketed table has
    at most num_users + 4 x num_users rows, and Spark chooses the join by its size.
    """
    spark = df.sparkSession
    weights = user_weights(spark, num_users, seed)
    total = weights.agg(F.max("hi")).first()[0]
    n_buckets = 4 * num_users
    width = max(1, -(-int(total) // n_buckets))
    buckets = weights.select(
        F.col("user_id").alias("__user"), "lo", "hi",
        F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor((F.col("hi") - 1) / width))).alias("__bucket"),
    ).filter(F.col("hi") > F.col("lo"))
    draw = keyed_uniform(int(total), F.lit(seed), F.lit("record"), F.col(record_id).cast("string"))
    recs = df.withColumn("__x", draw).withColumn("__bucket", F.floor(F.col("__x") / width))
    joined = recs.join(buckets, "__bucket").filter((F.col("__x") >= F.col("lo")) & (F.col("__x") < F.col("hi")))
    return joined.drop("__bucket", "__x", "lo", "hi", name).withColumnRenamed("__user", name)
