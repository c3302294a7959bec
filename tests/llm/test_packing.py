"""Ids against the tokenizers library, neighbours against plain BM25, and pieces that cover every document."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from helpers import documents, empty, odd
from veilspark.llm import packing
from veilspark.llm.queries import WORDS


def library(texts: list[str]) -> list[list[int]]:
    made = Tokenizer.from_file(WORDS).encode_batch(texts, add_special_tokens=False)
    return [e.ids for e in made]


def test_chunks_are_encoded_like_whole_texts():
    rng = random.Random(3)
    letters = "ab CDe'stllre  \n\n\t\r\x1c\x85\xa0 日本éßİΣσǺ̈🙂_-.,,..!%19²½ɐªʰ<|>\x00"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(6000)]
    texts += ["a <|endoftext|> b", "<|endoftext|>.", "a<|startoftext|>b", "It's I'LL don't.", "", " ", "\n", "é.", "ÀÉ, ß.", "İ.", "''S's'T!'t", None]
    ascii_ = "abAB's'tREvel.,!-<|>_09\t\x7f "
    texts += ["".join(rng.choice(ascii_) for _ in range(rng.randint(0, 40))) for _ in range(6000)]
    encoder, got = packing.WordEncoder(WORDS), []
    for at in range(0, len(texts), 500):
        flat, begin = encoder.encode(pa.array([None, "x", *texts[at : at + 500]]).slice(2))
        got += [flat[i:j].tolist() for i, j in zip(begin[:-1], begin[1:], strict=True)]
    assert got == library([t or "" for t in texts])


def test_new_words_are_merged_like_the_library():
    rng = random.Random(8)
    alphabets = ["etaoinshr", "abcdefghijklmnopqrstuvwxyz", "aeéèêàçñüößéionst", "".join(chr(c) for c in range(0xAA, 0x250) if chr(c).isalpha())]
    words = list({"".join(rng.choice(rng.choice(alphabets)) for _ in range(rng.randint(1, 64))) for _ in range(3000)})
    words += ["".join(rng.choice(alphabets[0]) for _ in range(rng.randint(1, 12))) for _ in range(3000)]
    words = [w.lower() for w in words if "İ" not in w]
    ids, size = packing.Merges(WORDS, "</w>").encode([w.encode() for w in words])
    ends = np.cumsum(size)
    assert [ids[j - n : j].tolist() for j, n in zip(ends.tolist(), size.tolist(), strict=True)] == library(words)
    assert [len(x) for x in packing.Merges(WORDS).encode([])] == [0, 0]


def test_windows_hold_the_best_unused_neighbours():
    """Every neighbour has the greatest score that any unused unit has for the seed, by plain BM25."""
    rng = random.Random(4)
    units = [np.array([rng.choice((rng.randrange(40), rng.randrange(40, 300))) for _ in range(rng.randint(1, 60))], "<u2") for _ in range(150)]
    df, mean = Counter(t for u in units for t in set(u.tolist())), sum(map(len, units)) / len(units)
    terms = np.array(sorted(df))
    model = packing.Bm25.of(terms, np.array([df[t] for t in terms.tolist()]), len(units), sum(map(len, units)), 300, "<u2")

    def weight(t, u):
        tf = u.tolist().count(t)
        idf = math.log(1 + (len(units) - df[t] + 0.5) / (df[t] + 0.5)) if df[t] > 1 else 0
        return idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(u) / mean))

    sequences = packing.pack(units, model, 128, 8)
    used, placed, open_ = set(), defaultdict(int), None
    for i, sequence in enumerate(sequences):
        total = sum(p[2] for p in sequence)
        assert total == 128 or total & (total - 1) == 0
        if total < 128:
            break  # what the last window was cut into
        seed = sequence[0][0]
        used.add(seed)
        query = sorted(set(units[seed].tolist()), key=lambda t: (-weight(t, units[seed]), t))[:8]
        score = lambda u: sum(weight(t, units[u]) for t in query)  # noqa: B023, E731
        for unit, begin, n, got in sequence[1:]:
            left = [score(u) for u in range(len(units)) if u not in used]
            assert unit not in used and begin == 0
            assert math.isclose(got or 0, max(left), abs_tol=1e-9) and math.isclose(score(unit), got or 0, abs_tol=1e-9)
            used.add(unit)
        assert open_ is None or seed == open_
        last = sequence[-1]
        open_ = last[0] if last[1] + last[2] < len(units[last[0]]) else None
    covers = sorted((u, b, n) for s in sequences for u, b, n, _ in s)
    for u, b, n in covers:
        assert b == placed[u] and n > 0
        placed[u] += n
    assert [placed[u] for u in range(len(units))] == [len(u) for u in units]


def test_powers_of_two():
    for n in (1, 2, 3, 127, 128, 129, 300):
        parts = packing.powers([(0, 5, n - n // 2, None), (1, 0, n // 2, 1.0)][: 2 if n > 1 else 1], 128)
        sizes = [sum(p[2] for p in part) for part in parts]
        assert sum(sizes) == n and all(s == 128 or s & (s - 1) == 0 and s < 128 for s in sizes)


def check(docs, **how):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    got = packing.pack_documents(docs, WORDS, **how).collect()
    window = how.get("window", 4096)
    ids = [x + [2] for x in library([t or "" for _, t in rows])]
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in got:
        pieces[p.doc_id, p.doc_tokens].append(p)
        sequences[p.sequence_id].append(p)
    for s in sequences.values():
        s.sort(key=lambda p: p.offset)
        ends = np.cumsum([p.length for p in s]).tolist()
        assert [p.offset for p in s] == [0, *ends[:-1]]
        assert ends[-1] <= window and (ends[-1] == window or ends[-1] & (ends[-1] - 1) == 0)
    have = Counter((p.doc_id, p.start, p.length, p.ids_crc32, p.doc_tokens) for p in got)
    assert sum(p.length for p in got) == sum(map(len, ids))
    for (doc, _), x in zip(rows, ids, strict=True):  # rows of one id and length may be told apart only by their ids
        starts = {p.start for p in pieces[doc, len(x)]}
        at = 0
        while at < len(x):
            n = next(p.length for p in pieces[doc, len(x)] if p.start == at and p.ids_crc32 == crc(x[at : at + p.length])
                     and have[doc, at, p.length, p.ids_crc32, len(x)])
            have[doc, at, n, crc(x[at : at + n]), len(x)] -= 1
            at += n
        assert 0 in starts
    assert not +have
    return got


def test_documents(spark):
    check(documents(spark))
    got = check(documents(spark).repartition(3), window=256, shard_ids=5_000)
    assert sum(p.score is not None for p in got) > len(got) / 10


def test_odd_rows(spark):
    check(odd(spark).withColumns({c: F.lit(1) for c in ("ids", "k0", "check", "start")}), shard_ids=100)
    assert packing.pack_documents(empty(spark), WORDS).collect() == []
