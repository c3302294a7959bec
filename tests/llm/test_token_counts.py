"""Histogram and suffix sums against the list of lengths."""

import numpy as np
import public_tokenizers as P
import tiktoken

from helpers import documents, empty, odd, odd_rows
from veilspark.llm import token_counts as tc
from veilspark.llm.queries import RANKS


def check(spark, docs, texts):
    lengths = tc.with_lengths(docs, RANKS, P.PATTERN)
    sums = tc.suffix_sums(tc.histogram(lengths)).cache()
    encode = tc.load(RANKS, P.PATTERN).encode_ordinary
    n = np.array([len(encode(t or "")) for t in texts])
    rows = sums.collect()
    assert sorted(r.length for r in rows) == sorted(set(n.tolist()))
    for r in rows:
        assert (r.docs, r.docs_over, r.docs_within) == ((n == r.length).sum(), (n > r.length).sum(), (n <= r.length).sum())
        assert (r.tokens_over, r.kept_tokens) == (n[n > r.length].sum(), np.minimum(n, r.length).sum())
        assert (r.total_docs, r.total_tokens) == (len(n), n.sum())
    limits = [0, 1, 3, 100, 511, 512, 10**7]
    for r in tc.at_limits(sums, limits).collect():
        assert (r.docs_over, r.kept_tokens) == ((n > r.length_limit).sum(), np.minimum(n, r.length_limit).sum())
    shares = [0.1, 0.5, 0.9, 0.99, 1.0]
    want = [int(np.quantile(n, q, method="inverted_cdf")) for q in shares]
    assert [r.length for r in tc.quantiles(sums, shares).collect()] == want


def test_documents(spark):
    docs = documents(spark)
    check(spark, docs, [r.text for r in docs.select("text").collect()])


def test_odd_rows(spark):
    check(spark, odd(spark), [r[1] for r in odd_rows()])
    sums = tc.suffix_sums(tc.histogram(tc.with_lengths(empty(spark), RANKS, P.PATTERN)))
    assert sums.collect() == []
    assert [(r.docs_over, r.kept_tokens) for r in tc.at_limits(sums, [5]).collect()] == [(0, 0)]


def test_encoding_is_the_tokenizers():
    assert isinstance(tc.load(RANKS, P.PATTERN), tiktoken.Encoding)
