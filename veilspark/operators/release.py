"""Release stages: rounding (P8), order (T1), latest value (T2), full snapshots.

P8  ``Math.round`` semantics (half toward +inf) = ``floor(x + 0.5)``; values
    that round below zero are left out, zero is kept.  Spark's ``round`` is
    half away from zero (-0.5 -> -1) and is therefore not used.
T1  order by the *unrounded* noisy value descending, then key ascending; the
    1-based position is stored as ``rank`` over the rows that survive P8.
T2  each key keeps its last release until it is seen again.
T3  the snapshot after every trigger, carrying unseen keys forward.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspark.operators.scan import global_row_number
from veilspark.session import materialize


def round_half_up(x) -> Column:
    c = F.col(x) if isinstance(x, str) else x
    return F.floor(c + F.lit(0.5)).cast("long")


def rounded_release(df: DataFrame, noisy: str = "noisy", name: str = "released") -> DataFrame:
    """Add the rounded count and drop rows that round below zero."""
    return df.withColumn(name, round_half_up(noisy)).filter(F.col(name) >= F.lit(0))


def latest_per_key(releases: DataFrame, key: str, index: str = "i",
                   cols: tuple[str, ...] = ("noisy",)) -> DataFrame:
    """Per key, the values of its release at the largest index (the noisy one alone by default).

    ``max_by`` is an aggregate with a partial phase, so a key's many
    releases are reduced before the exchange.
    """
    return releases.groupBy(key).agg(
        F.max(index).alias(index), *[F.max_by(c, index).alias(c) for c in cols]
    )


def ordered_release(latest: DataFrame, key: str, noisy: str = "noisy", rank: str = "rank") -> DataFrame:
    """T1 + P8: rounded counts with their position in release order.

    The global position comes from a range-partitioned sort with a broadcast
    per-block offset table, not from a single-partition window.  The releases
    are written first, so they are computed once and not for each pass over them:
    give no exact count among ``latest``'s columns.
    """
    kept = materialize(rounded_release(latest, noisy, "released"), "releases")
    return global_row_number(kept, [F.col(noisy).desc(), F.col(key).asc()], name=rank)


def snapshot_series(releases: DataFrame, key: str, n_triggers: int, index: str = "i",
                    noisy: str = "noisy") -> DataFrame:
    """For every trigger t < n_triggers, every key's latest release at or before t.

    Each release is valid on [i, next i of the key); the range is exploded
    with ``sequence`` so no words x triggers grid and no join is built.
    Releases at or beyond ``n_triggers`` are in no snapshot.  Keys whose value rounds below zero at t are left out of that snapshot.
    """
    w = Window.partitionBy(key).orderBy(index)
    valid = releases.filter(F.col(index) < F.lit(int(n_triggers)))
    valid = valid.withColumn("__next", F.coalesce(F.lead(index).over(w), F.lit(int(n_triggers))))
    exploded = valid.select(
        key, F.col(index).alias("release_i"), noisy,
        F.explode(F.sequence(F.col(index), F.col("__next") - F.lit(1))).alias("t"),
    ).withColumn("t", F.col("t").cast("long"))
    return rounded_release(exploded, noisy, "released")
