"""Counting stages (A1-A4).

A1  partial counts: key -> count per flush bucket (the map-side half).
A2  merged counts: partials summed per (trigger, key).
A3  trigger index: 0-based rank of the *non-empty* triggers; empty ones do
    not advance the index.
A4  prefix sum per key over trigger indices (the noise-free tree query).

A1 and A2 are plain ``groupBy`` aggregations: Catalyst adds the partial
(map-side) hash aggregate itself, so a hot key is pre-reduced in every task
before the exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilspark.operators.scan import dense_index


def epoch_seconds(ts_col: str):
    """Whole seconds since 1970-01-01 00:00 of a TIMESTAMP_NTZ (or TIMESTAMP) column.

    Built from calendar fields, so it does not depend on the session time zone.
    """
    c = F.col(ts_col)
    days = F.datediff(F.to_date(c), F.lit("1970-01-01").cast("date")).cast("long")
    return days * F.lit(86400) + F.hour(c) * F.lit(3600) + F.minute(c) * F.lit(60) + F.second(c)


def flush_bucket(ts_col: str, seconds: int):
    """Fixed processing-time-like bucket of a timestamp column (batch twin of a flush tick)."""
    return F.floor(epoch_seconds(ts_col) / F.lit(int(seconds))).cast("long")


def partial_counts(df: DataFrame, key: str, bucket: str, cnt: str = "cnt") -> DataFrame:
    """A1: (bucket, key, cnt) — one row per key seen in a bucket."""
    return df.groupBy(bucket, key).agg(F.count(F.lit(1)).alias(cnt))


def merged_counts(partials: DataFrame, key: str, trigger: str, cnt: str = "cnt") -> DataFrame:
    """A2: sum the partial counts of each key within its trigger."""
    return partials.groupBy(trigger, key).agg(F.sum(cnt).cast("long").alias(cnt))


def trigger_index(df: DataFrame, trigger: str = "trigger_id", name: str = "i", cnt: str | None = "cnt") -> DataFrame:
    """A3: (trigger, i) with i = 0, 1, ... over the distinct non-empty triggers.

    With per-trigger counts, "non-empty" is ``cnt > 0``.  The index is written in
    a job of its own, so give it counts that are written already
    (``veilspark.session.materialize``), else that job computes them again.
    """
    src = df.filter(F.col(cnt) > F.lit(0)) if cnt and cnt in df.columns else df
    return dense_index(src, trigger, name)


def with_trigger_index(counts: DataFrame, triggers: DataFrame, trigger: str = "trigger_id",
                       name: str = "i", horizon: int | None = None) -> DataFrame:
    """Attach the trigger index to per-trigger counts.

    With a horizon T only indices < T are kept on the trigger side; that side
    then has at most T rows (a proven bound) and is broadcast.
    """
    t = triggers.select(trigger, name)
    if horizon is not None:
        t = F.broadcast(t.filter(F.col(name) < F.lit(int(horizon))))
        return counts.join(t, trigger, "inner")
    return counts.join(t, trigger, "inner")


def prefix_sum(counts: DataFrame, key: str, index: str = "i", cnt: str = "cnt", name: str = "prefix") -> DataFrame:
    """A4: running sum of ``cnt`` per key in index order.

    Each key has at most one row per trigger (bounded by the horizon), so the
    window partitions stay small however skewed the raw data was.
    """
    w = Window.partitionBy(key).orderBy(index).rowsBetween(Window.unboundedPreceding, 0)
    return counts.withColumn(name, F.sum(cnt).over(w))
