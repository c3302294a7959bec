"""Encoding against tiktoken, decoding against the texts."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from helpers import documents, empty, odd, odd_rows
from veilspark.llm import bpe
from veilspark.llm.queries import RANKS, encoded_digests


@pytest.fixture(scope="module")
def ours():
    return bpe.load(RANKS, P.PATTERN)


@pytest.fixture(scope="module")
def theirs(ours):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ours.vocabulary.ranks, special_tokens={})


def ids(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_random_texts(ours, theirs):
    rng = random.Random(1)
    odd_letters = "ab cde'stllre  \n\t\x1c\x1d\x85\xa0 ᠎​9²½日本éß🙂_-.!%AB\x00\r\x0b"
    for letters, n, longest in ((odd_letters, 6000, 30), ("abehinorst", 1500, 60), (" etaoin", 1500, 40)):
        for _ in range(n):
            text = "".join(rng.choice(letters) for _ in range(rng.randint(0, longest)))
            assert ids(ours.encode(text)) == theirs.encode_ordinary(text), repr(text)


def test_long_runs_take_linear_time(ours, theirs):
    for text in ("a" * 3000, "ab" * 2000, " " * 3000, "!" * 3000, "<|endoftext|>"):
        assert ids(ours.encode(text)) == theirs.encode_ordinary(text)
    assert len(ours.encode("ab" * 200_000)) > 0


def test_small_vocabulary_needs_backtracking():
    # Longest first gives "ab" "b"; merging gives "a" "bb", since bb comes first.
    vocabulary = bpe.Vocabulary({b"a": 0, b"b": 1, b"bb": 2, b"ab": 3})
    assert ids(vocabulary.encode_piece("abb")) == [0, 2]


def test_query_matches_tiktoken(spark, theirs):
    docs = documents(spark)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in encoded_digests(docs).collect():
        want = theirs.encode_ordinary(texts[r.doc_id])
        assert r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_rows(spark):
    out = bpe.encode_decode(odd(spark).withColumn("ids", F.lit("old")).withColumn("encoded", F.lit(1)), RANKS, P.PATTERN)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "encoded", "ids", "decoded"]
    rows = out.collect()
    assert sorted((r.text or "").encode() for r in rows) == sorted((x[1] or "").encode() for x in odd_rows())
    assert all(bytes(r.decoded) == (r.text or "").encode() for r in rows)
    assert encoded_digests(empty(spark)).collect() == []
