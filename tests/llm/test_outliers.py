"""Counts against a direct computation, estimates against numpy."""

import math
import random
import re
from collections import Counter

import numpy as np

from helpers import documents, empty, odd, odd_rows
from pyspark.sql import functions as F
from veilspark.llm import outliers


def direct_counts(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = {w for w, n in Counter(windows).items() if n > 1}
    covered = {i + j for i, w in enumerate(windows) if w in often for j in range(3)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def check_counts(rows):
    for r in rows:
        want = direct_counts(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, r.doc_id
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (r.base_failed and r.kept)


def test_repeated_windows_and_lines(spark):
    texts = ["a b c a b c", "a a a a", "a b c d a b c x b c d", "x\nx\n\n \nx y\n x", "a b\tc\na b\x0bc", "a b c " * 30 + "d e f",
             "\x85a \xa0b", " x \n x \nx"]
    check_counts(outliers.judge(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
                                group_cols=("doc_id",)).collect())


def numpy_distances(x, share):
    """Scaled squared distances by the same definition, in numpy."""
    least = np.array([v[2] for v in outliers.VECTOR]) ** 2
    p = len(least)

    def factor(cov):
        c = np.zeros((p, p))
        for i in range(p):
            for j in range(i + 1):
                s = max(cov[i, j], least[i]) if i == j else cov[i, j]
                s -= c[i, :j] @ c[j, :j]
                c[i, j] = math.sqrt(max(s, least[i] / 100)) if i == j else s / c[j, j]
        return c

    def at(values, q):
        return np.sort(values)[max(0, math.ceil(q * len(values)) - 1)]

    def d2(center, c):
        return (np.linalg.solve(c, (x - center).T) ** 2).sum(0)

    middle = np.array([at(v, 0.5) for v in x.T])
    mad = np.array([max(1.4826 * at(np.abs(v - m), 0.5), math.sqrt(q)) for v, m, q in zip(x.T, middle, least, strict=True)])
    cut = np.clip(x, middle - 2 * mad, middle + 2 * mad)
    best = None
    for center, c in ((middle, factor(np.diag(mad**2))), (cut.mean(0), factor(np.cov(cut.T, bias=True)))):
        for _ in range(20):
            far = d2(center, c)
            near = x[far <= at(far, share)]
            center, c = near.mean(0), factor(np.cov(near.T, bias=True))
        det = np.log(np.diag(c)).sum()
        if best is None or det < best[0]:
            best = det, d2(center, c)
    return best[1] * min(1.0, outliers.chi_square_quantile(0.5, p) / max(at(best[1], 0.5), 1e-9))


def test_documents(spark):
    rows = outliers.judge(documents(spark), group_cols=("lang",), least_group=30).collect()
    check_counts(rows)
    groups = Counter(r.lang for r in rows if not r.base_failed)
    checked = 0
    for lang, n in groups.items():
        if n < 30:
            continue
        own = [r for r in rows if r.lang == lang and not r.base_failed]
        x = np.array([[math.log(r.n_words), math.log(r.word_chars / r.n_words), math.log(1 + 100 * r.n_symbols / r.n_words),
                       math.log(1 + 100 * r.n_dup_lines / sum(bool(re.search(r"[^\x20\x09-\x0D]", t)) for t in r.text.split("\n"))),
                       math.log(1 + 100 * r.n_repeat_words / r.n_words),
                       math.log(1 + 100 * len(re.findall("[A-Z]", r.text)) / r.word_chars)] for r in own])
        want = numpy_distances(x, 0.75)
        got = np.array([r.distance for r in own])
        assert np.median(np.abs(got - want) / (1 + want)) < 0.1
        limit = outliers.chi_square_quantile(1 - 1e-9, len(outliers.VECTOR))
        assert np.mean((got > limit) == (want > limit)) > 0.97
        assert all(r.kept == (r.distance <= limit) for r in own)
        checked += n
    assert checked > 50


def test_planted_outliers_go_and_others_stay(spark):
    rng, rows = random.Random(5), []
    plain = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(3000)]
    for i in range(260):
        rows.append((i, " ".join(rng.choice(plain) for _ in range(60 + i)).capitalize() + ".", "en", "s"))
    for i in range(260, 270):
        rows.append((i, " ".join(f"$${j * i}## %%{i}** |" for j in range(80)), "en", "s"))
    got = {r.doc_id: r.kept for r in outliers.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(got[i] for i in range(260)) and not any(got[i] for i in range(260, 270))


def test_odd_rows(spark):
    docs = odd(spark).withColumn("kept", F.lit("old")).withColumn("distance", F.lit(1))
    rows = outliers.judge(docs, least_group=2).collect()
    assert len(rows) == len(odd_rows())
    check_counts(rows)
    long = "word%d " * 60 % tuple(range(60))
    few = spark.createDataFrame([(1, long, None, None), (2, long, "en", None), (2, long, "en", None)],
                                "doc_id long, text string, lang string, source string")
    assert [r.kept for r in outliers.judge(few).collect()] == [True] * 3  # too few to judge by more than the base rules
    assert [r.kept for r in outliers.judge(few, least_group=1).collect()] == [True] * 3
    assert outliers.judge(empty(spark)).collect() == []
