"""The byte-level encoder remembers enough chunks that a large vocabulary is encoded once."""

from veilspark.llm import bpe


def test_large_vocabulary_is_encoded_once():
    encoder = bpe.Encoder(bpe.Vocabulary({bytes([b]): b for b in range(256)}), r" ?\w+|\s+")
    made = []
    compute = encoder.chunks.compute
    encoder.chunks.compute = lambda c: made.append(c) or compute(c)
    texts = ["x " + " ".join(map(str, range(at, at + 1000))) for at in range(0, 390_000, 1000)]
    first = [encoder.encode(t) for t in texts]
    assert len(made) == 390_000
    assert [encoder.encode(t) for t in texts] == first
    assert len(made) == 390_000
    assert encoder.vocabulary.decode(first[7]).decode() == texts[7]


def test_words_are_held_once_and_no_more_than_asked_for():
    encoder = bpe.Encoder(bpe.Vocabulary({bytes([b]): b for b in range(256)}), r" ?\w+|\s+|[^\w\s]+", 1000)
    for at in range(0, 20_000, 100):
        text = "x " + " ".join(f"{i} {i}," for i in range(at, at + 100))
        assert encoder.vocabulary.decode(encoder.encode(text)).decode() == text
    assert len(encoder.pieces) + len(encoder.pieces.old) < 10
    assert len(encoder.chunks) + len(encoder.chunks.old) <= 2000


def test_pipeline_workers_hold_less():
    import corpus_pipeline
    assert 2 * corpus_pipeline.REMEMBERED <= 400_000
