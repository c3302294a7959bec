"""Noise calibration and choosing the contribution bound.

A7  (epsilon, delta) -> rho-zCDP by Newton steps, sigma of the tree noise
    sigma = sqrt(ln T * L^2 / (2 rho)), L = C * L_m; swept over a grid of
    (C, epsilon) together with the share of contributions each C drops.
A8  per-user totals (Unicode word counts); a missing user is an error.
A9  exact percentile with linear interpolation at (n - 1) p.
A10 summary: records, users, min, max, mean.

The conversions follow the zCDP literature (Bun & Steinke 2016; Canonne,
Kamath & Steinke 2020): for rho-zCDP and a Renyi order a > 1,
delta(a) = exp((a - 1)(a rho - eps) + a log(1 - 1/a)) / (a - 1), minimised over
a; rho is the largest value whose delta stays within the target.

Both searches are Newton's method on concave, increasing functions, started on
the low side, from where every step stays on it:

* in x = a - 1, the derivative of log delta(a) is
  (2a - 1) rho - eps + log(1 - 1/a), whose own derivative is 2 rho + 1 / (a (a - 1));
* in rho, min over a of log delta(a; rho) is a minimum of lines, with
  slope a (a - 1) at the best a.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.functions.noise import tree_height
from veilspark.operators.scan import global_row_number, global_running_sum
from veilspark.params import PrivacyParams
from veilspark.session import materialize

_STEPS = 200  # far above what Newton's method takes; every element stops on its own


def _climb(start: np.ndarray, step) -> np.ndarray:
    """Adds ``step(x)`` to each element while that still increases it."""
    x, moving = start, np.ones(len(start), bool)
    for _ in range(_STEPS):
        new = x + step(x)
        moving &= new > x
        if not moving.any():
            break
        x = np.where(moving, new, x)
    return x


def _log_delta(rho: np.ndarray, eps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log delta at the best Renyi order, that order less one), for rho > 0."""
    def slope(x):
        return (2.0 * x + 1.0) * rho - eps - np.log1p(1.0 / x)

    # At a = (eps / rho + 1) / 2 only the logarithm is left of the slope, and near a = 1 it outweighs the rest.
    x = np.where(eps > rho, (eps / rho - 1.0) / 2.0, np.exp(-(3.0 * rho + 1.0)))
    x = _climb(x, lambda x: -slope(x) / (2.0 * rho + 1.0 / (x * (x + 1.0))))
    return x * ((x + 1.0) * rho - eps) - (x + 1.0) * np.log1p(1.0 / x) - np.log(x), x


def cdp_rho_array(eps: Sequence[float], delta: Sequence[float]) -> np.ndarray:
    """Largest rho per (eps, delta) pair whose converted delta stays within the target."""
    eps = np.asarray(eps, dtype=float)
    delta = np.asarray(delta, dtype=float)
    if np.any(eps < 0) or np.any(delta <= 0):
        raise ValueError("epsilon must be non-negative and delta must be positive")
    target = np.log(np.where(delta < 1.0, delta, 0.5))
    # The plain conversion eps = rho + 2 sqrt(rho log(1 / delta)) gives a rho that is never too large.
    rho = np.maximum((np.sqrt(eps - target) - np.sqrt(-target)) ** 2, delta * delta / 16.0)
    for _ in range(_STEPS):
        over = _log_delta(rho, eps)[0] > target
        if not over.any():
            break
        rho = np.where(over, rho / 2.0, rho)

    def step(rho):
        log_delta, x = _log_delta(rho, eps)
        return (target - log_delta) / (x * (x + 1.0))

    return np.where(delta >= 1.0, 0.0, _climb(rho, step))


@functools.lru_cache(maxsize=256)
def cdp_rho(eps: float, delta: float) -> float:
    return float(cdp_rho_array([eps], [delta])[0])


def tree_sigma(rho: float, horizon: float, l1: float) -> float:
    return math.sqrt(math.log(horizon) * l1 * l1 / (2.0 * rho))


# ---------------------------------------------------------------- A8-A10

def user_totals(records: DataFrame, user: str, count_col) -> DataFrame:
    """(user, n, records): n = sum of ``count_col``; a null user raises."""
    checked = records.withColumn(
        user,
        F.when(F.col(user).isNull(), F.raise_error(F.lit("record is missing user_id"))).otherwise(F.col(user)),
    )
    return checked.groupBy(user).agg(
        F.sum(count_col).cast("long").alias("n"), F.count(F.lit(1)).cast("long").alias("records")
    )


def exact_percentile(values: DataFrame, col: str, p: float) -> DataFrame:
    """One row ``(p, value)``; NaN for no rows.

    Linear interpolation between the values at sorted positions floor(k)
    and ceil(k), k = (n - 1) p.  Equal values are counted first (partial sums
    on the map side, so ties never meet as rows); a running sum over the
    distinct values in order finds the two positions.  The input is read once.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("percentile must be within [0, 1]")
    spark = values.sparkSession
    v = values.select(F.col(col).cast("double").alias("v")).filter(F.col("v").isNotNull())
    sizes = materialize(v.groupBy("v").agg(F.count(F.lit(1)).alias("n")), "percentile")
    n = sizes.agg(F.sum("n")).first()[0] or 0
    if n == 0:
        return spark.range(1).select(F.lit(float(p)).alias("p"), F.lit(float("nan")).alias("value"))
    k = (n - 1) * p
    f, c = math.floor(k), math.ceil(k)
    ranked = global_running_sum(sizes, [F.col("v")], "n", "__upto")
    lo = F.min(F.when(F.col("__upto") > F.lit(f), F.col("v")))
    hi = F.min(F.when(F.col("__upto") > F.lit(c), F.col("v")))
    value = lo if f == c else lo * F.lit(c - k) + hi * F.lit(k - f)
    return ranked.agg(F.lit(float(p)).alias("p"), value.alias("value"))


def contribution_summary(totals: DataFrame, n: str = "n", records: str = "records") -> DataFrame:
    """A10: records, users, total contributions, min, max, mean per user."""
    return totals.agg(
        F.sum(records).cast("long").alias("records"),
        F.count(F.lit(1)).cast("long").alias("users"),
        F.sum(n).cast("long").alias("total"),
        F.min(n).cast("long").alias("min_n"),
        F.max(n).cast("long").alias("max_n"),
        F.avg(n).alias("mean_n"),
    )


def bounding_loss(totals: DataFrame, bounds: Sequence[int], n: str = "n") -> DataFrame:
    """Share of contributions each bound C would drop: sum(max(n - C, 0)) / sum(n).

    One pass: a column per C in a single aggregation, then ``stack`` to rows
    (no join with the grid).
    """
    bounds = [int(b) for b in bounds]
    if not bounds:
        raise ValueError("need at least one bound")
    aggs = [F.sum(n).cast("long").alias("__total"), F.count(F.lit(1)).cast("long").alias("__users")]
    for c in bounds:
        aggs.append(F.sum(F.greatest(F.col(n) - F.lit(c), F.lit(0))).cast("long").alias(f"__d{c}"))
        aggs.append(F.count(F.when(F.col(n) > F.lit(c), F.lit(1))).cast("long").alias(f"__u{c}"))
    wide = totals.agg(*aggs)
    stack = "stack({k}, {rows}) as (max_contributions, dropped, users_over)".format(
        k=len(bounds), rows=", ".join(f"cast({c} as bigint), __d{c}, __u{c}" for c in bounds)
    )
    return wide.selectExpr("__total as total", "__users as users", stack).select(
        "max_contributions", "users", "users_over", "total", "dropped",
        (F.col("dropped") / F.col("total")).alias("loss"),
    )


def bound_error(params: PrivacyParams) -> float:
    """What the variance of one release is, per squared bound C: its noise is a sum over at most height + 1 tree nodes."""
    per_bound = params.with_(max_contributions=1).sigma  # sigma grows in proportion to C
    return (tree_height(params.horizon) + 1) * per_bound**2


def best_bound(totals: DataFrame, params: PrivacyParams, n: str = "n") -> DataFrame:
    """A7 over every bound: the C of least squared bias plus variance, one row
    (max_contributions, users_over, dropped, loss, noise_variance, error).

    The bias of C is what it drops, sum(max(n - C, 0)); the variance is
    ``bound_error`` times C squared.  Users are counted per total; running sums from
    the largest total down give the users above it and their contributions, so between
    two totals the error is a known parabola in C, whose least whole number is
    one of the two around its vertex, or an end.  So every C from 1 is judged,
    with a row for each distinct total and none for each C.  Equal errors: the
    smallest C.  No users, no row.
    """
    noise = bound_error(params)
    sizes = totals.filter(F.col(n) > 0).groupBy(F.col(n).cast("long").alias("v")).agg(F.count(F.lit(1)).alias("users"))
    sizes = materialize(sizes.withColumn("held", F.col("v") * F.col("users")), "contribution-sizes")
    down = [F.col("v").desc()]
    sums = global_running_sum(global_running_sum(sizes, down, "users", "over"), down, "held", "mass")
    # Bounds from the total below (or 1) up to v - 1 are exceeded by the ``over`` users with v or more; v itself by those above it.
    ranked = materialize(global_row_number(sums.select("v", "users", "held", "over", "mass"), ["v"], "place"), "contribution-sums")
    lows = ranked.select((F.col("place") + 1).alias("place"), F.col("v").alias("low"))
    spans = ranked.join(lows, "place", "left").withColumn("low", F.greatest(F.coalesce("low", F.lit(1)), F.lit(1)))
    over, mass = F.col("over").cast("double"), F.col("mass").cast("double")
    vertex = F.floor(mass * over / (over * over + F.lit(noise))).cast("long")
    inside = lambda c: F.least(F.greatest(c, F.col("low")), F.col("v"))
    tried = F.array_distinct(F.array(F.col("low"), inside(vertex), inside(vertex + 1), F.col("v")))
    judged = spans.withColumn("c", F.explode(tried)).withColumn("dropped", F.col("mass") - F.col("c") * F.col("over"))
    error = F.col("dropped").cast("double") * F.col("dropped").cast("double") + F.lit(noise) * F.col("c").cast("double") * F.col("c").cast("double")
    judged = judged.withColumn("error", error)
    # At c = v itself the users with exactly v are not over it, and drop nothing.
    last = F.min(F.struct("error", "c", F.when(F.col("c") == F.col("v"), F.col("over") - F.col("users")).otherwise(F.col("over")).alias("users_over"),
                          "dropped")).alias("b")
    # The running sum at the smallest total is that of all contributions.
    best = judged.groupBy(F.lit(0).alias("one")).agg(last, F.max("mass").alias("total"))
    return best.select(
        F.col("b.c").alias("max_contributions"), F.col("b.users_over").alias("users_over"), F.col("b.dropped").alias("dropped"),
        (F.col("b.dropped") / F.col("total")).alias("loss"), (F.lit(noise) * F.col("b.c") * F.col("b.c")).alias("noise_variance"),
        F.col("b.error").alias("error"))


#: KLL sketches: items kept on the lowest level, and the rank error that goes with them (99 % confidence, as published).
SKETCH_K = 2048
SKETCH_ERROR = 2.296 / SKETCH_K**0.9021


def quantile_sketches(values: DataFrame, col: str, trigger: str, k: int = SKETCH_K) -> DataFrame:
    """A9 for data that keeps coming: (trigger, n, sketch), a KLL sketch of ``col`` for each trigger; nulls don't count.

    Sketches of a few ten kilobytes are stored once per trigger and merged
    (:func:`sketch_percentile`), so a percentile over any set of triggers reads no value again.
    """
    v = F.col(col).cast("double")
    return values.filter(v.isNotNull()).groupBy(trigger).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double(v, F.lit(int(k))).alias("sketch"))


def sketch_percentile(sketches: DataFrame, p: float, k: int = SKETCH_K) -> DataFrame:
    """One row (p, n, value, rank_error) over all given sketches; no row without values.

    ``value`` interpolates linearly, as the exact percentile does, between the
    sketch's values at ranks (n - 1) p rounded down and up; its rank is within ``rank_error`` x n of the exact one's.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("percentile must be within [0, 1]")
    n = sketches.agg(F.sum("n")).first()[0] or 0
    merged = sketches.agg(F.kll_merge_agg_double("sketch", F.lit(int(k))).alias("s"))
    place = max(n - 1, 0) * p
    at = lambda rank: F.kll_sketch_get_quantile_double("s", F.lit(min((rank + 1) / max(n, 1), 1.0)))
    low, high = math.floor(place), math.ceil(place)
    value = at(low) * F.lit(1 - place + low) + at(high) * F.lit(place - low)
    return merged.filter(F.lit(n > 0)).select(F.lit(float(p)).alias("p"), F.lit(n).cast("long").alias("n"), value.alias("value"),
                                              F.lit(2.296 / k**0.9021).alias("rank_error"))


def calibration_sweep(loss: DataFrame, epsilons: Sequence[float], delta: float, horizon: int,
                      per_record_clamp: float = 1.0) -> DataFrame:
    """A7 sweep: every bound C (with its data loss) x every epsilon -> rho, sigma.

    The epsilon list is exploded onto each C row (no join); rho and sigma are
    computed in one vectorised ``mapInPandas`` pass.
    """
    eps_arr = F.array(*[F.lit(float(e)) for e in epsilons])
    grid = loss.select("max_contributions", "loss", F.explode(eps_arr).alias("epsilon")).withColumn(
        "delta", F.lit(float(delta))
    ).withColumn("horizon", F.lit(int(horizon)).cast("long"))

    def solve(batches):
        for pdf in batches:
            if pdf.empty:
                yield pdf.assign(rho=pd.Series(dtype=float), sigma=pd.Series(dtype=float))
                continue
            rho = cdp_rho_array(pdf["epsilon"].to_numpy(), pdf["delta"].to_numpy())
            l1 = pdf["max_contributions"].to_numpy(dtype=float) * float(per_record_clamp)
            sigma = np.sqrt(np.log(pdf["horizon"].to_numpy(dtype=float)) * l1 * l1 / (2.0 * rho))
            yield pdf.assign(rho=rho, sigma=sigma)

    schema = "max_contributions long, loss double, epsilon double, delta double, horizon long, rho double, sigma double"
    return grid.mapInPandas(solve, schema)
