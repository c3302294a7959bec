"""Weights against a direct computation, the sample against sorting."""

import math
import random
import re
from binascii import crc32
from collections import Counter

from helpers import SF, documents, empty, odd, odd_rows
from pyspark.sql import functions as F
from veilspark.llm import importance


def direct_grams(text, buckets):
    words = [crc32(t.encode()) for c in (text or "").split() for t in re.findall(r"\w+|[^\w\s]+", c.lower())]
    a, b, top = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 1 << 64
    pairs = [(x * a + y * b) % top >> 20 for x, y in zip(words, words[1:], strict=False)]
    return [(w * a % top >> 20) % buckets for w in words] + [p % buckets for p in pairs]


def test_documents(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0}
    texts = {r.doc_id: r.text for r in docs.collect()}
    raw, target = Counter(), Counter()
    for doc, text in texts.items():
        got = Counter(direct_grams(text, 10_000))
        raw += got
        if doc in good:
            target += got
    n, m = sum(raw.values()) + 10_000, sum(target.values()) + 10_000
    rows = importance.resample(docs, labels).collect()
    for r in rows:
        want = sum(math.log((target[g] + 1) / m * n / (raw[g] + 1)) for g in direct_grams(r.text, 10_000))
        assert math.isclose(r.log_weight, want, rel_tol=1e-9, abs_tol=1e-6)
    kept = [r for r in rows if r.kept]
    keys = sorted((r.gumbel_key for r in rows), reverse=True)
    assert {r.gumbel_key for r in kept} == set(keys[:len(kept)])
    assert sum(r.doc_id in good for r in kept) >= 0.99 * len(good & set(texts))
    bad = {r.doc_id for r in labels.collect() if r.quality == 0} & set(texts)
    assert sum(r.doc_id in bad for r in kept) < 0.3 * len(bad)


def test_keys_and_sample_against_a_direct_computation(spark):
    docs, labels = documents(spark), spark.read.parquet(f"{SF}/labels.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    good = {r.doc_id for r in labels.collect() if r.quality == 1 and r.toxic == 0} & set(texts)
    most, prior = 10_000 << 7, importance.PRIOR
    found = {i: direct_grams(t, most) for i, t in texts.items()}
    raw, target = Counter(g for f in found.values() for g in f), Counter(g for i in good for g in found[i])
    n, m = sum(raw.values()), sum(target.values())
    noise = dict(docs.select("doc_id", importance.gumbel("doc_id", "text")).collect())
    want = {}
    for i, own in found.items():
        times = Counter(own) if i in good else Counter()  # a target's weight is without itself
        left = m - sum(times.values())
        ratios = [math.log((target[g] - times[g] + prior) / (raw[g] * (left / n) + prior)) for g in own]
        want[i] = (sum(min(0, x) for x in ratios) / len(own) if own else 0) * m / len(good) + noise[i]
    rows = importance.resample(docs, labels, k=60, keep=["doc_id"]).collect()
    assert all(math.isclose(r.gumbel_key, want[r.doc_id], rel_tol=1e-9, abs_tol=1e-7) for r in rows)
    assert {r.doc_id for r in rows if r.kept} == set(sorted(want, key=want.get, reverse=True)[:60])


def test_k_is_the_sample_size(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = importance.resample(documents(spark), labels, k=50, keep=["doc_id"]).collect()
    assert sum(r.kept for r in rows) == 50
    assert min(r.gumbel_key for r in rows if r.kept) > max(r.gumbel_key for r in rows if not r.kept)


def test_kth_largest(spark):
    rng = random.Random(4)
    values = [rng.gauss(0, 1) for _ in range(1500)] + [0.25] * 700 + [1e9, -1e9, 1e-300]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    ordered = sorted(values, reverse=True)
    for k in (1, 2, 700, 1200, len(values), 10 * len(values)):
        assert importance.kth_largest(rows, "x", k, bins=7, enough=10) == ordered[min(k, len(values)) - 1]
    assert importance.kth_largest(rows, "x", 0) is None
    assert importance.kth_largest(rows.limit(0), "x", 3) is None


def test_noise_is_gumbel(spark):
    x = sorted(r[0] for r in spark.range(4000).select(importance.gumbel("id")).collect())
    for q in (0.1, 0.5, 0.9):
        assert abs(x[int(q * 4000)] + math.log(-math.log(q))) < 0.12


def test_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0), (4, 1, 0), (5, 1, 0), (5, 1, 0), (9, 0, 0), (None, 1, 0), (99, 1, 0), (8, None, None)],
                                   "doc_id long, quality int, toxic int")
    docs = odd(spark).withColumn("kept", F.lit("old")).withColumn("quality", F.lit("x"))
    rows = importance.resample(docs, labels).collect()
    assert len(rows) == len(odd_rows())
    assert all(r.log_weight == 0 for r in rows if not (r.text or "").strip())
    assert len({(r.gumbel_key, r.kept) for r in rows if r.doc_id == 5}) == 1
    assert all(r.kept for r in importance.resample(docs, labels.limit(0)).collect())
    assert importance.resample(empty(spark), labels).collect() == []


def test_toxic_documents_are_rejected(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = importance.resample(docs, labels, keep=["doc_id"]).join(labels, "doc_id").groupBy("quality", "toxic").agg(
        F.avg(F.col("kept").cast("int")).alias("kept"))
    kept = {(r.quality, r.toxic): r.kept for r in rows.collect()}
    assert kept[1, 0] > 0.95
    assert kept[1, 1] < 0.6
    assert max(kept[0, 0], kept[0, 1]) < 0.05
