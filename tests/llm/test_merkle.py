"""Manifests against a plain tree, over arities, groups of all sizes and odd rows."""

import hashlib
import zlib

from pyspark.sql import functions as F

from helpers import COLUMNS, documents, empty, odd
from veilspark.llm import merkle, queries


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(*values) -> str:
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def plain_tree(digests: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(root, for each leaf its (before, after) of every level)."""
    paths, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i, p in enumerate(at):
            run = p - p % arity
            paths[i].append(("".join(level[run:p]), "".join(level[p + 1 : run + arity])))
        level = [sha("".join(level[i : i + arity])) for i in range(0, len(level), arity)]
        at = [p // arity for p in at]
    return level[0], paths


def plain(rows: list[tuple], arity: int = 2) -> list[tuple]:
    """What the query returns for rows (doc_id, text, lang, source, n_chars)."""
    null_first = lambda v: (v is not None, v if v is not None else 0)
    groups: dict = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r, leaf_of(r[0], r[3], r[2], r[4], r[1])))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    made = {}
    for g in order:
        groups[g].sort(key=lambda x: (null_first(x[0][0]), x[1]))
        made[g] = plain_tree([x[1] for x in groups[g]], arity)
    if not order:
        return []
    root, above = plain_tree([made[g][0] for g in order], arity)
    out = []
    for g, upper in zip(order, above, strict=True):
        for (r, leaf), path in zip(groups[g], made[g][1], strict=True):
            path = path + upper
            digest = leaf
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[4] is not None:
                digest = leaf_of(r[0], r[3], r[2], r[4] + 1, r[1])
            for before, after in path:
                digest = sha(before + digest + after)
            out.append((r[0], leaf, made[g][0], root, sha("".join(b + a for b, a in path)), digest, digest == root))
    return out


def key(t):
    return tuple((x is not None, x if x is not None else 0) for x in t)


def query(spark, docs, tmp_path) -> list[tuple]:
    docs.write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    return sorted(map(tuple, queries.op13_merkle_manifest(spark, str(tmp_path)).collect()), key=key)


def test_documents(spark, tmp_path):
    docs = documents(spark).select("doc_id", "text", "lang", "source", "n_chars")
    got = query(spark, docs, tmp_path)
    assert got == sorted(plain([tuple(r) for r in docs.collect()]), key=key)
    assert {r[6] for r in got} == {True, False}
    assert all(r[6] != (zlib.crc32(str(r[0]).encode()) % 7 == 0) for r in got)


def test_odd_rows_and_clashing_columns(spark, tmp_path):
    rows = [tuple(r) for r in odd(spark).collect()]
    clash = odd(spark).withColumns({c: F.lit(1) for c in ("pos", "group", "block", "digest", "path", "root", "top", "n", "kept")})
    assert query(spark, clash, tmp_path) == sorted(plain(rows), key=key)
    assert query(spark, empty(spark), tmp_path) == []
    one = spark.createDataFrame([(1, "a", None, None, 2**63 - 1)], COLUMNS)
    assert query(spark, one, tmp_path) == plain([(1, "a", None, None, 2**63 - 1)])


def test_blocks_tiers_and_arities(spark):
    """Groups just under, at and over the size of a block, and repeated ids."""
    sizes = {"a": 1, "b": 2, "c": 9, "d": 27, "e": 28, "f": 255, "g": 256, "h": 257, "i": 1000, None: 82}
    rows = [(i // 2, f"t{g}{i % 50}", g, "s", i) for g, n in sizes.items() for i in range(n)]
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    leaf = merkle.leaf_hash(*[F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")])
    for arity in (2, 3):
        made = merkle.build(df, F.col("lang"), [F.col("doc_id")], leaf, {"doc_id": F.col("doc_id")}, arity)
        got = made.select("doc_id", "leaf", "subroot", "root", merkle.proof_hash(F.col("path")), merkle.fold(F.col("leaf"), F.col("path")))
        want = [(*r[:5], r[3]) for r in plain(rows, arity)]
        assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_sql(spark, tmp_path):
    import duckdb

    rows = [tuple(r) for r in odd(spark).collect()] + [(i, f"x{i}", "fr", None, i) for i in range(100, 140)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    assert sorted(con.sql(queries.ORACLES["op13_merkle_manifest"]).fetchall(), key=key) == sorted(plain(rows), key=key)
