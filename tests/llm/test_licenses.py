"""Base places and template blocks against a direct scan."""

import re
import textwrap
from fractions import Fraction

from helpers import documents, empty, odd, odd_rows
from pyspark.sql import functions as F
from veilspark.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def direct(text, threshold=Fraction(4, 5)):
    own, at, base, labels, best, blocks = words(text), [], set(), set(), 0.0, []
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        for k in range(len(own) - len(p) + 1):
            if own[k:k + len(p)] == p:
                at.append(k)
                base.add(label)
    for line, part in enumerate((text or "").split("\n")):
        own_line = words(part)
        for i, (label, template) in enumerate(licenses.TEMPLATES):
            t, reach = set(words(template)), int(len(words(template)) / threshold)
            held = max((len(t.intersection(own_line[k:k + reach])) for k in range(max(1, len(own_line) - reach + 1))), default=0)
            if held >= threshold * len(t):
                labels.add(label)
                blocks.append((line, i))
                best = max(best, held / len(t))
    return (len(own), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | labels)), 1.0 if at else best, sorted(blocks))


def check(docs):
    for r in licenses.scan(docs).collect():
        got = (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score,
               sorted((b.line, b.template) for b in r.blocks))
        assert got == direct(r.text), r.doc_id


def test_documents(spark):
    check(documents(spark))


def test_templates_with_words_left_out(spark):
    rows, n = [], 0
    for _, template in licenses.TEMPLATES:
        own = template.split()
        for drop in range(0, len(own), 2):
            for extra in ("", " and some other words of the line", "\nGNU General Public License mit license MIT License"):
                rows.append((n, " ".join(own[drop // 2:len(own) - drop // 2]).upper() + extra))
                n += 1
    check(spark.createDataFrame(rows, "doc_id long, text string"))


def test_overlapping_and_repeated_places(spark):
    texts = ["cc by cc by", "cc-by", "MIT  License\nmit license.mit license", "the apache\nlicense", "ccby", "cc byte", "écc by"]
    check(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))


def test_odd_rows(spark):
    docs = odd(spark).withColumn("labels", F.lit("old")).withColumn("score", F.lit("x"))
    check(docs)
    assert licenses.scan(docs).count() == len(odd_rows())
    assert licenses.scan(empty(spark)).collect() == []


def test_wrapped_and_commented_notices(spark):
    rows = []
    for prefix in ("", "// ", " * ", "# "):
        for width in (40, 72):
            for i, (label, template) in enumerate(licenses.TEMPLATES):
                lines = textwrap.wrap(template, width)
                text = "\n".join(["Copyright (c) 2020 somebody.", *[prefix + x for x in lines], "int main() { return 0; }"])
                rows.append((len(rows), f"{text}\n{text}", i, label, len(lines)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, template int, label string, n long")
    for r in licenses.scan(docs).collect():
        found = [(b.line, b.containment) for b in r.blocks if b.template == r.template]
        assert len(found) == 2 and r.label in r.labels.split(","), r.text
        if r.n > 2:
            assert found == [(1, 1.0), (r.n + 3, 1.0)], r.text


def test_scattered_words_are_no_run(spark):
    far = " filler" * 60 + "\n"
    text = far.join(licenses.TEMPLATES[3][1].split())
    (row,) = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()
    assert row.blocks == [] and row.labels == ""


def test_words_far_apart_are_no_notice(spark):
    texts = ["the game was released last year and players had to renew a fishing license before going under the bridge",
             " ".join(["released", *["word"] * 2000, "under", *["word"] * 600, "the", "license"]),
             "word " * 500 + "released under the mit license" + " word" * 500]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(docs)
    assert [r.labels for r in licenses.scan(docs).orderBy("doc_id").collect()] == ["", "", "mit"]
