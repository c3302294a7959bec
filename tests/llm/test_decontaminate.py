"""Leaks against exact and brute-force edit distance search."""

import random

from helpers import SF, documents, empty, odd, odd_rows
from pyspark.sql import functions as F
from veilspark.llm import decontaminate as d


def distance(pattern, text):
    """Least edits between the pattern and any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern):
        now = [i + 1]
        for j, e in enumerate(text):
            now.append(min(row[j] + (c != e), row[j + 1] + 1, now[j] + 1))
        row = now
    return min(row)


def test_hashes_tell_grams_apart():
    text = "hello world this is a test of hashes hello world this"
    for q in (1, 2, 3, 5, 8, 12, 13):
        hashes = d.gram_hashes(d._codes(text), q).tolist()
        grams = [text[i:i + q] for i in range(len(text) - q + 1)]
        assert len(set(zip(grams, hashes, strict=True))) == len(set(grams)) == len(set(hashes))


def test_alignment():
    rng = random.Random(1)
    for _ in range(600):
        pattern = "".join(rng.choice("abc") for _ in range(rng.randint(1, 14)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 20)))
        assert d.align(d._codes(pattern), d._codes(text), -len(pattern), len(text), 99)[0] == distance(pattern, text)


def test_every_pattern_within_its_budget_is_found():
    rng = random.Random(2)
    patterns = d.Patterns([(1, "".join(rng.choice("abcdefgh ") for _ in range(70)))], q=5, window=40, rate=0.1)
    for _ in range(400):
        p = rng.randrange(len(patterns.text))
        changed = list(patterns.text[p])
        for _ in range(rng.randint(0, int(patterns.budget[p]) + 2)):
            at = rng.randrange(len(changed))
            changed[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "x"])
        text = d.normalise("".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 80))) + "".join(changed)
                           + "".join(rng.choice("abcdefgh ") for _ in range(rng.randint(0, 80))))
        want = any(distance(t, text) <= k for t, k in zip(patterns.text, patterns.budget, strict=True))
        assert bool(d.search([text], patterns)[0]) == want, text


def test_documents(spark):
    docs, items = documents(spark), spark.read.parquet(f"{SF}/benchmark.parquet")
    texts = [(r.item_id, d.normalise(r.text)) for r in items.collect()]
    found = 0
    for r in d.find_leaks(docs, items).collect():
        plain = d.normalise(r.text)
        got = {m.item: m for m in r.matches}
        assert {i for i, t in texts if t in plain} <= set(got)
        for m in r.matches:
            item = dict(texts)[m.item]
            parts = [item[at:at + 64] for at in range(max(1, len(item) - 63))]
            assert min(distance(x, plain[max(0, m.start - 10):m.end + 10]) for x in parts) == m.edits
            found += 1
    assert found


def test_edited_passages(spark):
    rng = random.Random(3)
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    hosts = [r.text for r in documents(spark).limit(40).collect()]
    patterns = d.Patterns([(r.item_id, r.text) for r in items], 12, 64, 0.05)
    for _ in range(60):
        item = rng.choice(items)
        changed = list(d.normalise(item.text))
        for _ in range(int(len(changed) * 0.04)):
            changed[rng.randrange(len(changed))] = rng.choice("abcdefgh")
        host = rng.choice(hosts)
        at = rng.randint(0, len(host))
        assert item.item_id in {m[0] for m in d.search([host[:at] + " " + "".join(changed) + " " + host[at:]], patterns)[0]}


def test_blocks_of_the_benchmark_give_the_same(spark):
    docs, items = documents(spark).limit(60), spark.read.parquet(f"{SF}/benchmark.parquet")
    one = {r.doc_id: r.matches for r in d.find_leaks(docs, items).collect()}
    assert one == {r.doc_id: r.matches for r in d.find_leaks(docs, items, block_chars=2000).collect()}


def test_odd_rows(spark):
    items = spark.createDataFrame([(1, None), (None, "x" * 200), (2, "short"), (3, "lorem ipsum dolor sit amet, " * 3), (4, "x" * 100), (4, "x" * 100)],
                                  "item_id long, text string")
    rows = d.find_leaks(odd(spark).withColumn("matches", F.lit(1)), items).collect()
    assert len(rows) == len(odd_rows())
    got = {r.doc_id: [(m.item, m.edits) for m in r.matches] for r in rows if r.matches}
    assert got == {7: [(3, 0)], 10: [(4, 0)]}
    assert d.find_leaks(empty(spark), items).collect() == []
    assert all(not r.matches for r in d.find_leaks(odd(spark), items.limit(0)).collect())


def test_excerpts_of_long_items_are_found():
    """Every verbatim excerpt of window + stride - 1 characters, wherever it begins."""
    rng = random.Random(12)
    item = " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(2, 9))) for _ in range(60))
    patterns = d.Patterns([(5, item)], q=12, window=64, rate=0.05, stride=8)
    around = lambda: " ".join("".join(rng.choice("qrstuvwxyz") for _ in range(5)) for _ in range(30))
    texts = [f"{around()}{item[at:at + 71]}{around()}" for at in range(len(item) - 71)]
    assert all(found and found[0][0] == 5 for found in d.search(texts, patterns))
    assert d.search([around(), item[:40] + around()], patterns) == [[], []]


def test_short_items_are_found_as_words():
    patterns = d.Patterns([(1, "E = mc 2!"), (2, "e=mc2"), (3, "..."), (4, "Yes"), (5, "e-mc 2")], q=12, window=64, rate=0.05)
    found = d.search(["It is E=mc²? e mc 2.", "yesterday", "", None, "Yes", "e MC 2 yes", "xe mc 2"], patterns)
    assert [[m[0] for m in f] for f in found] == [[1, 5], [], [], [], [4], [1, 4, 5], []]
    assert found[4] == [(4, 0, 3, 0)] and found[5][1] == (4, 7, 10, 0)
