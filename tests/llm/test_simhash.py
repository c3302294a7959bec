"""Fingerprints and components against a direct computation."""

import random

import numpy as np
import xxhash

from helpers import documents, empty, odd, odd_rows
from pyspark.sql import functions as F
from veilspark.llm import simhash


def direct(text, shingle):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    parts = [b" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance):
    """Smallest id of each row's component; prints: (id, fingerprint)."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    values = np.array([f for _, f in prints], np.uint64)
    for i in range(len(prints)):
        for j in np.flatnonzero(np.bitwise_count(values ^ values[i]) <= distance):
            root[find(int(j))] = find(i)
    least = {}
    for i, (doc, _) in enumerate(prints):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return [least.get(find(i)) for i in range(len(prints))]


def check(rows, distance):
    prints = [(r.doc_id, int(r.fingerprint, 16)) for r in rows]
    assert [r.component_id for r in rows] == brute_components(prints, distance)


def test_documents(spark):
    rows = simhash.near_duplicates(documents(spark)).collect()
    assert all(int(r.fingerprint, 16) == direct(r.text, 3) for r in rows)
    check(rows, 3)


def near_prints(spark, seed, n=400, groups=6, flips=4):
    rng = random.Random(seed)
    centers = [rng.getrandbits(64) for _ in range(groups)]
    values = set()
    while len(values) < n:
        x = rng.choice(centers)
        for _ in range(rng.randint(0, flips)):
            x ^= 1 << rng.randrange(64)
        values.add(x if rng.random() < 0.8 else rng.getrandbits(64))
    values = sorted(values)
    return values, spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")


def test_links_and_finer_buckets(spark):
    for seed, distance, bucket_rows in ((1, 3, 4096), (2, 3, 20), (3, 2, 15), (4, 1, 4096), (5, 0, 10), (6, 5, 30)):
        values, prints = near_prints(spark, seed)
        links = simhash.links(prints, distance, bucket_rows)
        roots = {r.node & (1 << 64) - 1: r.root for r in simhash.components(links).collect()}
        want = brute_components([(simhash._signed(v), v) for v in values], distance)
        assert [roots.get(v, simhash._signed(v)) for v in values] == want
        # No more links than members of buckets: a tree in each.
        assert links.count() <= len(values) * len(simhash.bucket_masks(distance)) * (distance + 1) ** 2


def test_one_large_group_makes_few_links(spark):
    center = random.Random(9).getrandbits(64)
    values = sorted({center ^ (1 << i) ^ (1 << j) for i in range(64) for j in range(64)})
    prints = spark.createDataFrame([(simhash._signed(v),) for v in values], "fp long")
    links = simhash.links(prints, 3, 100)
    assert links.count() < 40 * len(values)  # all pairs are over 500 a member
    assert simhash.components(links).select("root").distinct().count() == 1


def test_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 400), (7, 7)], "a long, b long")
    roots = {r.node: r.root for r in simhash.components(edges).collect()}
    assert roots == {i: 0 for i in range(201)} | {500: 400, 400: 400}


def test_odd_rows(spark):
    out = simhash.near_duplicates(odd(spark).withColumn("fp", F.lit(1)).withColumn("component_id", F.lit("x")))
    rows = out.collect()
    assert len(rows) == len(odd_rows())
    check(rows, 3)
    assert "fp" in out.columns and all(r.fp == 1 for r in rows)
    blank = [r for r in rows if not (r.text or "").strip()]
    assert {r.fingerprint for r in blank} == {"0" * 16} and {r.component_id for r in blank} == {1}
    chosen = {}
    for r in rows:
        chosen[r.component_id] = chosen.get(r.component_id, 0) + r.representative
    assert set(chosen.values()) == {1}
    assert simhash.near_duplicates(empty(spark)).collect() == []
