"""Sampling with replacement from a loaded table (S3), batch and paced stream.

Draw ``k`` picks index ``pmod(h(seed, k), n)`` of the table's dense ids, with
``h`` the first 48 bits of SHA-256 - a pure function, so a re-run draws the
same rows.  Draws are joined to the table on the dense id: an equi-join both
sides of which scale with the data, planned by Spark (shuffle or broadcast
as the measured sizes dictate under AQE).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.operators.prep import dense_ids
from veilspark.session import work_path


def draw_index(seed: str, draw: Column, n: int) -> Column:
    h = F.sha2(F.concat_ws("|", F.lit(seed), draw.cast("string")), 256)
    return F.pmod(F.conv(F.substring(h, 1, 12), 16, 10).cast("long"), F.lit(int(n)))


def sample_with_replacement(table: DataFrame, order_by: Sequence, n_draws: int, seed: str) -> DataFrame:
    """Batch twin: ``n_draws`` uniform draws with replacement; adds ``draw`` (0-based)."""
    indexed = dense_ids(table, order_by, "__idx")
    n = indexed.count()
    if n == 0:
        raise ValueError("cannot sample from an empty table")
    spark = table.sparkSession
    draws = spark.range(n_draws).select(F.col("id").alias("draw")).withColumn("__idx", draw_index(seed, F.col("draw"), n))
    return draws.join(indexed, "__idx").drop("__idx")


def paced_sample_stream(spark: SparkSession, table: DataFrame, order_by: Sequence, seed: str,
                        rows_per_second: int = 4) -> DataFrame:
    """Streaming twin: a rate source paces the draws (4 rows/s by default).

    Stream-static equi-join of each draw to the indexed table.  The index is
    written once to the shared work folder and read back, so every micro-batch
    joins the same snapshot instead of recomputing the numbering.
    """
    path = work_path(spark, "sample-index")
    dense_ids(table, order_by, "__idx").write.parquet(path)
    indexed = spark.read.parquet(path)
    n = indexed.count()
    if n == 0:
        raise ValueError("cannot sample from an empty table")
    ticks = spark.readStream.format("rate").option("rowsPerSecond", int(rows_per_second)).load()
    draws = ticks.select(F.col("value").alias("draw"), "timestamp").withColumn(
        "__idx", draw_index(seed, F.col("draw"), n)
    )
    return draws.join(indexed, "__idx").drop("__idx")
