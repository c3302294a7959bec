"""Probabilities against a direct Kneser-Ney computation, held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from helpers import documents, empty, odd, odd_rows
from veilspark.llm import langid

TEXTS = {"aa": ["abc abd abe", "bca, bcd! Abba", "a a a"], "bb": ["xyz zyx yxz", "Xy zy ab", "éé ñ"]}


def symbols(text):
    out = []
    for c in (text or "").lower():
        if c.isalpha():
            out.append(c)
        elif out and out[-1] != " ":
            out.append(" ")
    return out


def direct_model(texts, kinds):
    """A function from (three characters, character) to its probability."""
    counts = {4: Counter()}
    for t in texts:
        s = [" "] * 3 + symbols(t)
        counts[4].update("".join(s[i - 3:i + 1]) for i in range(3, len(s)))
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    discount, context = {}, {}
    for k in counts:
        n1, n2 = (sum(c == x for c in counts[k].values()) for x in (1, 2))
        discount[k] = n1 / (n1 + 2 * n2) if n1 and n2 else 0.5
        context[k] = defaultdict(lambda: [0, 0])
        for g, c in counts[k].items():
            context[k][g[:-1]][0] += c
            context[k][g[:-1]][1] += 1

    def p(k, h, c):
        below = p(k - 1, h[1:], c) if k else 1 / kinds
        if not k or h not in context[k]:
            return below
        total, different = context[k][h]
        d = discount[k]
        n = counts[k][h + c]
        return (max(n - d, 0) if n else 0) / total + d * different / total * below

    return lambda h, c: p(4, h, c)


def test_entropies(spark):
    docs = spark.createDataFrame([(lang, t) for lang, ts in TEXTS.items() for t in ts], "lang string, text string")
    scored, langs = langid.score(docs, langid.entries(langid.count_grams(docs)))
    assert langs == ["aa", "bb"]
    kinds = len({c for ts in TEXTS.values() for t in ts for c in symbols(t)}) + 1
    models = [direct_model(TEXTS[x], kinds) for x in langs]
    probe = docs.select("text").unionByName(spark.createDataFrame([("abba xyz",), ("qqq w",), ("dcab",)], "text string"))
    scored, _ = langid.score(probe, langid.entries(langid.count_grams(docs)), group_entries=1)  # a pass for each language
    for r in scored.collect():
        s = [" "] * 3 + symbols(r.text)
        assert r.n_counted == len(s) - 3
        for got, model in zip(r.entropies, models, strict=True):
            want = -np.mean([math.log(model("".join(s[i - 3:i]), s[i])) for i in range(3, len(s))])
            assert math.isclose(got, want, rel_tol=1e-5)


def test_hash_is_sparks(spark):
    keys = [0, 1, 5, 2**40 + 3, -7, 2**63 - 1]
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    got = [r[0] for r in rows.select(F.shiftrightunsigned(F.xxhash64(F.lit(3).cast("long"), "k"), 64 - langid.HASH_BITS)).collect()]
    assert got == langid._hash(np.array(keys, np.int64).view(np.uint64), 3).tolist()


def test_small_memory_changes_nothing():
    tables = {"a": (np.arange(0, 1 << 24, 7, dtype=np.uint32), np.linspace(-9, -1, len(range(0, 1 << 24, 7))).astype(np.float32))}
    texts = ["the quick brown fox", "", None, "jumps over the lazy dog " * 20]
    assert langid.Models(tables, memory=1).score(texts) == langid.Models(tables).score(texts)
    alone = [langid.Models(tables).score([t])[1][0] for t in texts]
    assert langid.Models(tables).score(texts)[1] == alone


def test_held_out_accuracy(spark):
    docs = documents(spark).withColumn("held_out", F.crc32(F.col("doc_id").cast("string")) % 4 == 2)
    part = "pmod(xxhash64(doc_id), 8) = 0"
    rows = langid.identify(docs, f"not held_out and not {part}", f"not held_out and {part}").filter("held_out").collect()
    assert len(rows) > 30
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_odd_rows(spark):
    learn = documents(spark).unionByName(odd(spark)).withColumn("score", F.lit("old"))
    out = langid.identify(learn, "doc_id >= 0", "doc_id % 5 = 0")
    rows = out.collect()
    assert len(rows) == documents(spark).count() + len(odd_rows())
    for r in rows:
        no_letter = not any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == no_letter and (r.score == 0) == no_letter and (r.cross_entropy is None) == no_letter
    assert langid.identify(empty(spark), "true", "true").collect() == []
    unlearned = langid.identify(odd(spark), "false", "false").collect()
    assert {(r.lang_pred, r.score, r.rejected) for r in unlearned} == {("und", 0.0, False)}


def test_unseen_grams_miss_in_a_full_table():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 1 << 62, 1 << 21).astype(np.uint64)
    table = np.sort(langid._hash(keys, 4)), np.zeros(len(keys), np.float32)
    probe = langid._hash(rng.integers(0, 1 << 62, 200_000).astype(np.uint64), 4)
    assert langid.Models._find(table, probe)[0].sum() == 0
    assert langid.Models._find(table, langid._hash(keys[:1000], 4))[0].all()


def test_parts_of_a_language_add_up(spark):
    docs = spark.createDataFrame([(lang, t) for lang, ts in TEXTS.items() for t in ts], "lang string, text string")
    model = langid.entries(langid.count_grams(docs))
    n = model.filter("lang = 'aa'").count()
    whole, parts = ([r.entropies for r in langid.score(docs, model, group_entries=g)[0].orderBy("lang", "text").collect()]
                    for g in (10 * n, n // 2))
    assert np.allclose(whole, parts, rtol=1e-9)


def test_languages_of_calibration_rows_alone_are_learned(spark):
    texts = [("en", "the quick brown fox and the lazy dog by the river")] * 6 + [("kk", "бұл қазақ тіліндегі мәтін үлгісі ғой")] * 2
    rows = [(i, f"{t} {i}", lang) for i, (lang, t) in enumerate(texts)] + [(100, "қазақ тілі мәтін", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = langid.identify(docs, "lang = 'en'", "lang = 'kk'", keep=["doc_id"]).collect()
    assert {r.doc_id: r.lang_pred for r in out} == {i: lang for i, (lang, _) in enumerate(texts)} | {100: "kk"}
