"""Tries against plain dictionaries: any shard and segment size, hot paths, odd rows; parentheses against a stack."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
from pyspark.sql import functions as F

from helpers import SF
from veilspark.llm import conversation_trie as ct
from veilspark.llm import queries

COLUMNS = "conv_id long, turn long, role string, text string"


def plain(rows: list[tuple]) -> list[tuple]:
    convs = defaultdict(list)
    digest = lambda r, t: hashlib.sha256(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            convs[c].append(((turn is not None, turn or 0), digest(role, text), (role, text)))
    for turns in convs.values():
        turns.sort()
    nodes = defaultdict(lambda: ([], []))  # path: members, ends
    for c in convs:
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        path = tuple(x[2] for x in convs.get(base, [])[:h] + convs[c][h:])
        for d in range(len(path) + 1):
            nodes[path[:d]][0].append(c)
        nodes[path][1].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for path in nodes:
        if path:
            children[path[:-1]] += 1
    for path, (members, _) in nodes.items():
        w = len(re.findall(r"[^\x20\x09-\x0D]+", path[-1][1])) if path else 0
        for d in range(len(path) + 1):
            saved[path[:d]] += (len(members) - 1) * w
            leaves[path[:d]] += path not in children
    sha = lambda ids: hashlib.sha256(",".join(map(str, sorted(ids))).encode()).hexdigest()
    return [(min(m), len(p), min(nodes[p[:-1]][0]) if p else None, len(m), children.get(p, 0), leaves[p], saved[p], sha(e))
            for p, (m, e) in nodes.items()]


def key(r):
    return tuple((x is not None, x if x is not None else 0) for x in r)


def check(conversations, **how):
    rows = [tuple(r) for r in conversations.select("conv_id", "turn", "role", "text").collect()]
    turns, lengths = ct.rebuilt(conversations, 20, F.crc32(F.col("conv_id").cast("string")) % 4, 3)
    got = ct.trie(turns, lengths, **how)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows), key=key)


def test_parentheses_against_a_stack():
    rng = random.Random(5)
    for n in [1, 2, 31, 32, 33, 64, 65, *(rng.randint(1, 3000) for _ in range(30))]:
        bits, depth, left = [], 0, n
        down = rng.random()
        while left or depth:
            if left and (not depth or rng.random() > down):
                bits.append(True)
                left, depth = left - 1, depth + 1
            else:
                bits.append(False)
                depth -= 1
        stack, close = [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        bits = np.array(bits)
        opens = np.flatnonzero(bits)
        assert ct.Parentheses(bits).findclose(opens).tolist() == [close[i] for i in opens.tolist()]


def test_least_of_spans():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 300)
    begin = rng.integers(0, 300, 500)
    stop = begin + 1 + (rng.random(500) * (300 - begin)).astype(int)
    assert ct.RangeMin(values)(begin, stop).tolist() == [values[i:j].min() for i, j in zip(begin, stop, strict=True)]


def invented(rng, conversations: int, longest: int) -> list[tuple]:
    rows = []
    for c in rng.sample(range(-60, 400), conversations):
        start = [("user", "hello there"), ("assistant", "a b c")] * rng.randint(0, 2)  # a beginning that many share
        turns = start + [(rng.choice(("user", None)), rng.choice(("x", "y z", "", None))) for _ in range(rng.randint(0 if start else 1, longest))]
        rows += [(c, i if rng.random() < 0.95 else None, *t) for i, t in enumerate(turns)]
    return rows


def test_shards_and_segments(spark):
    rng = random.Random(6)
    rows = invented(rng, 60, 12)
    hot = [(1000 + i, t, "user", f"w {t}") for i in range(60) for t in range(4)]  # a third of all rows
    df = spark.createDataFrame(rows + hot, COLUMNS).repartition(3)
    for shard_turns, segment in [(10**6, 4096), (7, 3)]:
        check(df, shard_turns=shard_turns, segment=segment)


def test_given_conversations(spark):
    check(spark.read.parquet(f"{SF}/conversations.parquet"))


def test_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (1, 2, "user", ""), (None, 1, "user", "lost"), (20, 1, "a", "x" * 100_000),
            (21, 1, "a", "x" * 100_000), (21, 1, "b", "tie"), (21, 1, "b", "tie"), (-7, 3, "été", "日本 語"), (2**62, 0, "r", "t")]
    df = spark.createDataFrame(rows, COLUMNS).withColumns({c: F.lit(1) for c in ("depth", "k1", "path", "place", "words", "first", "level")})
    check(df, shard_turns=5, segment=2)
    check(spark.createDataFrame([], COLUMNS))
    check(spark.createDataFrame([(c, 0, "u", "t") for c in range(1, 15)], COLUMNS))  # some are left without turns


def test_long_lists_of_ends(spark):
    """A node at which far more conversations end than one text holds, over several ranges."""
    n = 400_000
    ends = spark.range(n).selectExpr("0L AS k1", "0L AS k2", "id + 1000000000000 AS conv_id").unionByName(
        spark.range(3).selectExpr("1L AS k1", "id AS k2", "id AS conv_id"))
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 30_000)
    try:
        got = {(r.k1, r.k2): r.ends_sha256 for r in ct.ends_hash(ends).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert got == {(0, 0): sha(range(10**12, 10**12 + n)), **{(1, i): sha([i]) for i in range(3)}}


def test_sql(spark, tmp_path):
    import duckdb

    rows = invented(random.Random(7), 40, 6)
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/conversations.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert sorted(con.sql(queries.ORACLES["op12_conversation_trie"]).fetchall(), key=key) == sorted(plain(rows), key=key)
