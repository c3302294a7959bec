"""Contribution bounding.

B1  keep the first C contributions of each user over the whole input, in
    arrival order; later ones are dropped.
B2  contributions without a user id are always kept (event-level for them).
B3  event-level mode skips bounding altogether.
B4  clamp each contribution's value to [-L_m, L_m] before it is summed.

Plan shape of B1: ``row_number() over (partition by user order by arrival)
<= C`` with the predicate left bare, so Catalyst plans a WindowGroupLimit.  Its
partial half runs before the exchange and keeps at most C rows per user per
input partition, so even a user owning a third of all rows ships only
C x (map partitions) rows to the task that finishes the window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspark.operators.scan import keyed_row_number
from veilspark.params import PrivacyParams


def _orders(order_by: Sequence) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def _group_limit_threshold(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))


def bound_contributions(df: DataFrame, user: str, order_by: Sequence, max_contributions: int,
                        rank_col: str | None = None) -> DataFrame:
    """Keep the first ``max_contributions`` rows of each user in arrival order.

    ``order_by`` must be a total order within a user (end it with a unique
    tie-breaker); the result is then deterministic, so task retries reproduce
    it exactly.  Rows with a null user are kept (B2): each is a group of its
    own, so one read serves both kinds and the WindowGroupLimit rewrite stays.

    Spark plans the map-side partial limit only for limits up to
    ``spark.sql.optimizer.windowGroupLimitThreshold``; above it, the rank comes
    from the blocked, skew-safe ``keyed_row_number`` instead of one window
    partition per user.
    """
    if max_contributions < 1:
        raise ValueError("max_contributions must be at least 1")
    rn = "__rn"
    alone = "__alone"
    grouped = df.withColumn(alone, F.when(F.col(user).isNull(), F.monotonically_increasing_id()))
    if max_contributions <= _group_limit_threshold(df):
        w = Window.partitionBy(user, alone).orderBy(*_orders(order_by))
        ranked = grouped.withColumn(rn, F.row_number().over(w))
    else:
        # Null users have no order to keep; the carry join of the blocked scan needs keys that are there.
        keys = grouped.withColumn("__user", F.coalesce(F.col(user).cast("string"), F.lit("")))
        keys = keys.withColumn(alone, F.coalesce(alone, F.lit(-1).cast("long")))
        ranked = keyed_row_number(keys, ["__user", alone], order_by, rn).drop("__user")
    kept = ranked.filter(F.col(rn) <= F.lit(max_contributions))
    if rank_col:
        kept = kept.withColumn(rank_col, F.when(F.col(user).isNotNull(), F.col(rn)).cast("long"))
    return kept.drop(rn, alone)


def apply_privacy_level(df: DataFrame, params: PrivacyParams, user: str, order_by: Sequence) -> DataFrame:
    """User-level mode bounds contributions; event-level mode passes rows through."""
    if params.user_level:
        return bound_contributions(df, user, order_by, params.max_contributions)
    return df


def clamp(value, limit: float) -> Column:
    """Clamp a numeric contribution to [-limit, limit] (null stays null)."""
    c = F.col(value) if isinstance(value, str) else value
    return F.greatest(F.least(c, F.lit(float(limit))), F.lit(-float(limit)))
