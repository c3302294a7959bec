"""Bounded-load placing against placing one row after the other."""

import numpy as np
from pyspark.sql import functions as F

from helpers import documents, empty, odd
from veilspark.llm import sharding


def one_by_one(rows, shards, vnodes, slack):
    """(doc_id, size, crc, shard) of every row, and the bound."""
    arc, home = sharding.ring(shards, vnodes)
    total = sum(r.size for r in rows)
    bound = max(1, -(-int(total * (1 + slack) * 1_000_000) // (shards * 1_000_000)))
    load, is_open, out = [0] * shards, [True] * shards, []
    for r in sorted(rows, key=lambda r: (r.prio, r.doc_id is not None, r.doc_id or 0, r.text_crc32, r.size)):
        at = int(arc[r.cell])
        while not is_open[home[at]]:
            at = (at + 1) % len(home)
        shard = int(home[at])
        out.append((r.doc_id, r.size, r.text_crc32, shard))
        load[shard] += r.size
        if load[shard] >= bound and sum(is_open) > 1:
            is_open[shard] = False
    return sorted(out, key=str), bound


def check(docs, shards, vnodes, slack):
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"))
    rows = rows.withColumns({"cell": F.shiftrightunsigned(F.xxhash64(F.lit("ring"), "doc_id"), 48),
                             "h": F.xxhash64(F.lit("order"), "doc_id", "text_crc32", "size")})
    rows = rows.withColumn("prio", F.shiftleft(32767 - F.floor(512 * F.log2("size")).cast("long"), 48)
                           + F.shiftrightunsigned("h", 16)).collect()
    want, bound = one_by_one(rows, shards, vnodes, slack)
    got = sharding.place(docs, shards, vnodes, slack).collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32, r.shard) for r in got), key=str) == want
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards for r in got)
    return got, bound


def test_documents(spark):
    got, bound = check(documents(spark), 16, 256, 0.002)
    load = np.bincount([r.shard for r in got], [r.size for r in got], 16)
    assert load.max() < bound + max(r.size for r in got)


def test_small_sizes_ties_and_nulls(spark):
    rows = [(None if i % 7 == 0 else i % 40, None if i % 11 == 0 else "x" * (i % 13)) for i in range(700)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    check(docs, 5, 8, 0.0)
    check(docs, 16, 4, 0.1)


def test_finer_buckets_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(i, "x" * (i * 37 % 90)) for i in range(900)], "doc_id long, text string")
    monkeypatch.setattr(sharding.fill, "__defaults__", (sharding.fill.__defaults__[0], 10))
    check(docs, 4, 8, 0.01)


def test_equal_rows_are_divided(spark):
    got, _ = check(spark.createDataFrame([(1, "abc")] * 400, "doc_id long, text string"), 4, 8, 0.01)
    assert {r.shard for r in got} == {0, 1, 2, 3}


def test_rows_stay_home_until_it_is_full(spark):
    docs = spark.createDataFrame([(i, "x" * 20) for i in range(2000)], "doc_id long, text string")
    before = {r.doc_id: r.shard for r in sharding.place(docs, 8, 64, 0.25).collect()}
    after = {r.doc_id: r.shard for r in sharding.place(docs, 9, 64, 0.25).collect()}
    assert sum(after[i] != before[i] for i in before) < 700  # a new shard takes about a ninth


def test_odd_rows(spark):
    check(odd(spark).withColumn("shard", F.lit("x")).withColumn("size", F.lit(0)), 3, 16, 0.0)
    assert sharding.place(empty(spark)).collect() == []
