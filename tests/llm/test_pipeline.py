"""Stages of the corpus pipeline against brute-force versions on their own inputs."""

import hashlib

import tiktoken

import corpus_pipeline as pipeline
import public_tokenizers as P
from helpers import SF, documents, empty, odd
from test_decontaminate import distance
from test_simhash import brute_components, direct
from veilspark.llm import bpe, decontaminate, outliers
from veilspark.llm.queries import QUERIES, RANKS
from veilspark.session import materialize


def test_stages(spark):
    docs, kept = documents(spark), []
    for i, (_, stage) in enumerate(pipeline.STAGES):
        made = materialize(stage(spark, docs, SF), "test")
        if i < 4:
            assert made.schema == docs.schema
        kept.append((docs.collect(), made.collect()))
        docs = made
    for before, after in kept[:4]:
        assert set(after) <= set(before) and len(set(after)) == len(after)

    verdicts = outliers.judge(documents(spark)).filter("kept").collect()
    assert {r.doc_id for r in kept[0][1]} == {r.doc_id for r in verdicts}

    before, after = kept[2]
    components = brute_components([(r.doc_id, direct(r.text, 3)) for r in before], 3)
    assert sorted(r.doc_id for r in after) == sorted(set(components))

    before, after = kept[3]
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    gone = {r.doc_id for r in before} - {r.doc_id for r in after}
    assert {r.doc_id for r in before if any(t in decontaminate.normalise(r.text) for t in items)} <= gone
    for r in before:
        if r.doc_id in gone:
            plain = decontaminate.normalise(r.text)
            assert min(distance(t[:120], plain) for t in items) <= 6 or min(distance(t[-120:], plain) for t in items) <= 6

    encoding = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.load(RANKS, P.PATTERN).vocabulary.ranks, special_tokens={})
    texts = {r.doc_id: r.text for r in kept[4][0]}
    assert len(kept[4][1]) == len(texts)
    for r in kept[4][1]:
        assert r.n_tokens == len(encoding.encode_ordinary(texts[r.doc_id]))
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_odd_and_empty_documents(spark):
    for name, stage in pipeline.STAGES:
        for docs in (odd(spark), empty(spark)):
            made = stage(spark, docs, SF)
            assert made.count() <= docs.count(), name


def test_queries_are_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert {int(n[2:].split("_")[0]) for n in QUERIES} == set(range(1, 14))
    assert "pipeline" in names and set(QUERIES) <= set(names)
