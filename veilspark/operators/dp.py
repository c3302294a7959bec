"""Differentially private running counts (A5) and the horizon.

``dp_prefix_sums`` takes per-(key, trigger index) counts and releases, for
every key seen at index i, ``S_i + noise(key, i)`` where S_i is the key's
running total and the noise is the keyed tree noise of
``veilspark.functions.noise``.  No tree is stored: the noise is recomputed
from the secret, so there is no state to lose or to checkpoint.

A key first seen at a late index uses that global index (its earlier leaves
hold only noise), exactly as a per-key tree created late would.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.functions.noise import hmac_pads, prefix_noise, release_scope
from veilspark.operators.counts import prefix_sum
from veilspark.params import PrivacyParams
from veilspark.session import with_secrets


def dp_prefix_sums(counts: DataFrame, key: str, params: PrivacyParams, secret: bytes | str, stream_id: str,
                   index: str = "i", cnt: str = "cnt", sigma: float | None = None,
                   trigger: str = "trigger_id") -> DataFrame:
    """(key, i, cnt) -> adds ``prefix`` (S_i) and ``noisy`` (S_i + noise).

    ``prefix`` is the exact count: drop it before anything is released or
    written.  The noise is bound to ``release_scope``: stream, trigger definition
    (``trigger`` names it) and parameters.  Rows with ``i >= horizon`` are dropped here (A6); use ``horizon_split``
    to report them.  ``sigma`` defaults to the calibrated value of ``params``.
    """
    kept = counts.filter(F.col(index) < F.lit(int(params.horizon)))
    return with_tree_noise(prefix_sum(kept, key, index, cnt, "prefix"), key, index, "prefix", params, secret, stream_id, sigma, trigger)


def with_tree_noise(totals: DataFrame, key: str, index: str, total: str, params: PrivacyParams, secret: bytes | str,
                    stream_id: str, sigma: float | None = None, trigger: str = "trigger_id") -> DataFrame:
    """Adds ``noisy``: a key's running ``total`` at trigger ``index`` plus the keyed tree noise of that index."""
    sig = params.sigma if sigma is None else float(sigma)
    ipad, opad = map(bytes.fromhex, hmac_pads(secret))
    with_pads = with_secrets(totals, __ipad=ipad, __opad=opad)
    pads = F.col("__ipad"), F.col("__opad")
    noise = prefix_noise(F.col(key), F.col(index), params.horizon, sig, release_scope(stream_id, params, sig, trigger), pads)
    return with_pads.withColumn("noisy", F.col(total).cast("double") + noise).drop("__ipad", "__opad")


def horizon_split(counts: DataFrame, key: str, horizon: int, index: str = "i", cnt: str = "cnt") -> DataFrame:
    """A6 report: per key, counts inside the horizon and counts silently cut."""
    inside = F.col(index) < F.lit(int(horizon))
    return counts.groupBy(key).agg(
        F.sum(F.when(inside, F.col(cnt)).otherwise(F.lit(0))).cast("long").alias("kept_cnt"),
        F.sum(F.when(inside, F.lit(0)).otherwise(F.col(cnt))).cast("long").alias("cut_cnt"),
        F.max(F.when(inside, F.col(index))).cast("long").alias("last_i"),
        F.count(F.when(~inside, F.lit(1))).cast("long").alias("cut_triggers"),
    )
