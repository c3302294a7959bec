"""The private histogram as one composed plan (U4) and its named pieces.

``private_histogram`` wires B3/B1 -> A1/A2 -> A3 -> A5 -> T2 -> T1/P8:
bound each user's contributions, count keys per trigger, index the non-empty
triggers, add keyed tree noise to every running count, keep each key's latest
release and order it.  Every stage is a DataFrame transformation, so the
chain up to the counts is one logical plan that Catalyst optimises end to end and
that runs once; the only exchanges over the raw rows are by user (bounding, pre-limited per map task)
and by (trigger, key) (partial + final aggregation).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.operators.bounding import apply_privacy_level
from veilspark.operators.counts import trigger_index, with_trigger_index
from veilspark.operators.dp import dp_prefix_sums
from veilspark.operators.release import latest_per_key, ordered_release, snapshot_series
from veilspark.params import PrivacyParams
from veilspark.session import materialize


@dataclass
class HistogramResult:
    counts: DataFrame      # (trigger, key, cnt) after bounding, written once; exact
    triggers: DataFrame    # (trigger, i) over all non-empty triggers
    exact: DataFrame       # (key, i, cnt, prefix) for i < T: for debugging, never to be released
    releases: DataFrame    # (key, i, noisy) for i < T
    latest: DataFrame      # (key, i, noisy)
    ordered: DataFrame     # (key, i, noisy, released, rank)
    key: str               # name of the key column
    horizon: int           # T

    def cut(self) -> DataFrame:
        """How much lies beyond the horizon and is in no release: ``cut_triggers``, ``cut_cnt``."""
        late = self.triggers.filter(F.col("i") >= F.lit(self.horizon))
        trigger = late.columns[0]
        return self.counts.join(late, trigger).agg(
            F.count_distinct(trigger).alias("cut_triggers"), F.coalesce(F.sum("cnt"), F.lit(0)).cast("long").alias("cut_cnt"))

    def snapshots(self) -> DataFrame:
        """T3 over the indexed triggers below the horizon (one small scalar action)."""
        n = self.releases.agg(F.max("i")).first()[0]
        n = 0 if n is None else int(n) + 1
        return snapshot_series(self.releases, self.key, n)


def count_per_trigger(df: DataFrame, key: str, trigger: str) -> DataFrame:
    """(trigger, key, cnt): per-trigger key counts (partial aggregation is Catalyst's)."""
    return df.groupBy(trigger, key).agg(F.count(F.lit(1)).cast("long").alias("cnt"))


def private_histogram(df: DataFrame, key: str, trigger: str, user: str, order_by: Sequence,
                      params: PrivacyParams, secret: bytes | str, stream_id: str,
                      sigma: float | None = None) -> HistogramResult:
    bounded = apply_privacy_level(df, params, user, order_by)
    # Written once: the index, the running counts and the ranks all read these few rows, not the raw table again.
    counts = materialize(count_per_trigger(bounded, key, trigger), "trigger-counts")
    triggers = trigger_index(counts, trigger, "i")
    indexed = with_trigger_index(counts, triggers, trigger, "i", horizon=params.horizon)
    noisy = dp_prefix_sums(indexed.select(key, "i", "cnt"), key, params, secret, stream_id, sigma=sigma, trigger=trigger)
    releases = noisy.select(key, "i", "noisy")
    latest = latest_per_key(releases, key)
    ordered = ordered_release(latest, key)
    return HistogramResult(counts, triggers, noisy.drop("noisy"), releases, latest, ordered, key, params.horizon)
