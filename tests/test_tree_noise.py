"""A5: keyed tree noise against a sequential heap tree (the reference's own test cases plus noise)."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from models import HeapTree, keyed_gauss
from veilspark.functions.noise import hmac_pads, release_scope
from veilspark.operators.dp import dp_prefix_sums
from veilspark.params import PrivacyParams

SECRET = "test-secret"
STREAM = "unit"


def _spark_releases(spark, rows, horizon, sigma):
    df = spark.createDataFrame(rows, "key string, i long, cnt double")
    params = PrivacyParams(horizon=horizon)
    out = dp_prefix_sums(df, "key", params, SECRET, STREAM, sigma=sigma)
    return {(r["key"], r["i"]): r["noisy"] for r in out.collect()}


@pytest.mark.parametrize("size", [16, 128, 1024, 2048])
def test_sigma_zero_equals_prefix_sums(spark, size):
    rnd = random.Random(42)
    values = [rnd.uniform(-500, 500) for _ in range(size)]
    got = _spark_releases(spark, [("k", i, v) for i, v in enumerate(values)], size, 0.0)
    tree = HeapTree(size, lambda j: 0.0)
    for i, v in enumerate(values):
        tree.add(i, v)
        assert abs(got[("k", i)] - tree.prefix(i)) < 1e-6


def test_boundary_size_two(spark):
    got = _spark_releases(spark, [("k", 0, 1.0), ("k", 1, 2.0)], 2, 0.0)
    assert got[("k", 0)] == pytest.approx(1.0)
    assert got[("k", 1)] == pytest.approx(3.0)


@pytest.mark.parametrize("horizon", [1, 2, 7, 16, 60])
def test_keyed_noise_matches_heap_tree(spark, horizon):
    sigma = 2.5
    rnd = random.Random(7)
    rows = []
    for key in ["a", "bb", "late", "ünï"]:
        start = horizon // 2 if key == "late" else 0
        for i in range(start, horizon):
            if rnd.random() < 0.7:
                rows.append((key, i, float(rnd.randint(0, 9))))
    got = _spark_releases(spark, rows, horizon, sigma)
    params = PrivacyParams(horizon=horizon)
    for key in {r[0] for r in rows}:
        tree = HeapTree(horizon, lambda j, k=key: sigma * keyed_gauss(SECRET, release_scope(STREAM, params, sigma), k, j))
        for _, i, c in sorted(r for r in rows if r[0] == key):
            tree.add(i, c)
            assert abs(got[(key, i)] - tree.prefix(i)) < 1e-6, (key, i)


def test_noise_is_reproducible_and_standard(spark):
    df = spark.range(20000).select(F.col("id").cast("string").alias("key"), F.lit(0).cast("long").alias("i"),
                                   F.lit(0.0).alias("cnt"))
    params = PrivacyParams(horizon=1)
    a = dp_prefix_sums(df, "key", params, SECRET, STREAM, sigma=1.0)
    stats = a.agg(F.avg("noisy").alias("m"), F.stddev("noisy").alias("s")).first()
    assert abs(stats["m"]) < 0.05
    assert abs(stats["s"] - 1.0) < 0.05
    again = dp_prefix_sums(df.repartition(7), "key", params, SECRET, STREAM, sigma=1.0)
    diff = a.join(again.withColumnRenamed("noisy", "n2"), ["key", "i"]).filter(F.col("noisy") != F.col("n2"))
    assert diff.count() == 0
    other = dp_prefix_sums(df, "key", params, "another-secret", STREAM, sigma=1.0)
    same = a.join(other.withColumnRenamed("noisy", "n2"), ["key", "i"]).filter(F.col("noisy") == F.col("n2"))
    assert same.count() == 0


def test_hmac_matches_python(spark):
    import hashlib
    import hmac

    from veilspark.functions.noise import hmac_sha256_hex

    pads = hmac_pads(SECRET)
    got = spark.range(1).select(hmac_sha256_hex(F.lit("hello|x"), pads).alias("h")).first()["h"]
    assert got == hmac.new(SECRET.encode(), b"hello|x", hashlib.sha256).hexdigest()
    long_key = "k" * 100
    got = spark.range(1).select(hmac_sha256_hex(F.lit("m"), hmac_pads(long_key)).alias("h")).first()["h"]
    assert got == hmac.new(long_key.encode(), b"m", hashlib.sha256).hexdigest()


def test_releases_under_other_parameters_draw_other_noise(spark):
    df = spark.createDataFrame([(f"k{j}", 0, float(j)) for j in range(40)], "key string, i long, cnt double")
    draws = []
    for params in (PrivacyParams(), PrivacyParams(epsilon=1.0), PrivacyParams(horizon=61), PrivacyParams(max_contributions=51),
                   PrivacyParams(per_record_clamp=2.0), PrivacyParams(user_level=False)):
        out = dp_prefix_sums(df, "key", params, SECRET, STREAM)
        draws.append([(r["noisy"] - r["prefix"]) / params.sigma for r in out.orderBy("key").collect()])
    other = dp_prefix_sums(df, "key", PrivacyParams(), SECRET, STREAM, trigger="hour")
    draws.append([(r["noisy"] - r["prefix"]) / PrivacyParams().sigma for r in other.orderBy("key").collect()])
    assert len({round(d[0], 9) for d in draws}) == len(draws)
    for i, a in enumerate(draws):
        for b in draws[:i]:
            assert abs(np.corrcoef(a, b)[0, 1]) < 0.6  # no fixed linear map between two releases


def test_secrets_are_redacted_from_plans(spark):
    import contextlib
    import io

    from veilspark.operators.sealing import seal

    df = spark.createDataFrame([("a", 0, 1.0)], "key string, i long, cnt double")
    out = dp_prefix_sums(df, "key", PrivacyParams(horizon=4), "plan-secret", STREAM, sigma=1.0)
    key = "cd" * 32
    sealed = seal(spark.createDataFrame([("x",)], "p string"), F.col("p"), F.lit("{}"), key)
    for frame, secrets in ((out, hmac_pads("plan-secret")), (sealed, (key,))):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            frame.explain("extended")
        assert not any(s in buf.getvalue() for s in secrets)
