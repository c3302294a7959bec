"""Calibration pins and the percentile / summary helpers."""

import math

import numpy as np
import pytest

from veilspark.operators.calibration import cdp_rho, cdp_rho_array, exact_percentile, tree_sigma
from veilspark.params import PrivacyParams


@pytest.mark.parametrize("eps,rho,sigma", [(10.0, 1.78269562, 53.5807), (1.0, 0.03055660, 409.2557),
                                           (0.1, 0.00043299, 3438.00)])
def test_calibration_pins(eps, rho, sigma):
    r = cdp_rho(eps, 1e-5)
    assert r == pytest.approx(rho, abs=5e-9)
    assert tree_sigma(r, 60, 50.0) == pytest.approx(sigma, abs=5e-3)


def test_oracle_constants_fit_the_conversion():
    """delta(rho) stays within 1e-5 and that of a slightly larger rho does not, by a dense search over the order."""
    from veilspark.plans.oracles import RHO, SIGMA

    x = np.exp(np.linspace(-12, 18, 2_000_001))  # order less one

    def log_delta(rho, eps):
        return (x * ((x + 1) * rho - eps) - (x + 1) * np.log1p(1 / x) - np.log(x)).min()

    for eps, rho in RHO.items():
        assert log_delta(rho * (1 - 1e-9), eps) <= math.log(1e-5) < log_delta(rho * (1 + 1e-6), eps)
    for eps, sigma in SIGMA.items():
        assert sigma == pytest.approx(math.sqrt(math.log(60) * 50**2 / (2 * RHO[eps])), rel=1e-12)


def test_conversion_over_the_whole_range():
    x = np.exp(np.linspace(-18, 28, 400_001))
    for eps in (0.0, 0.01, 0.5, 3.0, 50.0):
        for delta in (1e-9, 1e-3, 0.1, 0.9):
            rho = cdp_rho(eps, delta)
            low, high = ((x * ((x + 1) * r - eps) - (x + 1) * np.log1p(1 / x) - np.log(x)).min()
                         for r in (rho * (1 - 1e-4), rho * (1 + 1e-4)))
            assert low <= math.log(delta) < high


def test_percentile_with_almost_all_values_tied(spark):
    df = spark.range(20_000).selectExpr("if(id % 100 = 0, id, 7) as n")
    vals = [i if i % 100 == 0 else 7 for i in range(20_000)]
    for p in (0.0, 0.5, 0.99, 0.995, 1.0):
        assert exact_percentile(df, "n", p).first()["value"] == pytest.approx(_py_percentile(vals, p))


def test_vectorised_equals_scalar():
    eps = np.array([0.1, 1.0, 10.0, 3.0])
    delta = np.array([1e-5, 1e-6, 1e-5, 1e-3])
    arr = cdp_rho_array(eps, delta)
    for e, d, r in zip(eps, delta, arr):
        assert r == cdp_rho(float(e), float(d))


def test_params_defaults_and_guards():
    p = PrivacyParams()
    assert p.tree_height == 6 and p.num_leaves == 64
    assert p.l1_sensitivity == 50.0
    assert p.sigma == pytest.approx(53.5807, abs=5e-3)
    assert cdp_rho(1.0, 1.0) == 0.0
    with pytest.raises(ValueError):
        PrivacyParams(delta=0.0)
    with pytest.raises(ValueError):
        cdp_rho(-1.0, 1e-5)


def _py_percentile(values, pct):
    if not values:
        return math.nan
    values = sorted(values)
    k = (len(values) - 1) * pct
    f, c = math.floor(k), math.ceil(k)
    if f == c:
        return float(values[int(k)])
    return values[f] * (c - k) + values[c] * (k - f)


@pytest.mark.parametrize("p", [0.0, 0.5, 0.99, 1.0, 0.37])
def test_exact_percentile_matches_interpolation(spark, p):
    import random

    rnd = random.Random(3)
    vals = [rnd.randint(0, 1000) for _ in range(537)]
    df = spark.createDataFrame([(v,) for v in vals], "n long")
    got = exact_percentile(df, "n", p).first()["value"]
    assert got == pytest.approx(_py_percentile(vals, p), abs=1e-9)


def test_percentile_empty_is_nan(spark):
    df = spark.createDataFrame([], "n long")
    assert math.isnan(exact_percentile(df, "n", 0.99).first()["value"])


def test_user_weights_are_lognormal_and_drive_assignment(spark):
    import numpy as np
    from pyspark.sql import functions as F

    from veilspark.operators.prep import WEIGHT_SCALE, assign_weighted_users, user_weights

    w = user_weights(spark, 500, "unit-seed").orderBy("user_id").collect()
    logs = np.log(np.array([r["weight"] for r in w], dtype=float) / WEIGHT_SCALE)
    assert abs(logs.mean()) < 0.15 and abs(logs.std() - 1.0) < 0.15
    assert all(r["hi"] - r["lo"] == r["weight"] for r in w) and w[0]["lo"] == 0
    recs = spark.range(60000).select(F.col("id").alias("rid"))
    got = assign_weighted_users(recs, "rid", 500, "unit-seed").groupBy("user_id").count().collect()
    counts = {r["user_id"]: r["count"] for r in got}
    assert sum(counts.values()) == 60000  # every record drawn exactly once
    weights = np.array([r["weight"] for r in w], dtype=float)
    expected = 60000 * weights / weights.sum()
    observed = np.array([counts.get(r["user_id"], 0) for r in w], dtype=float)
    big = expected > 200
    assert np.all(np.abs(observed[big] - expected[big]) < 6 * np.sqrt(expected[big]))
