"""Round trips of the grammar and the written blocks, ids against the tokenizers library."""

import random
import zlib

import numpy as np
import pyarrow as pa
from tokenizers import Tokenizer

from helpers import documents, empty, odd, odd_rows
from veilspark.llm import repair_store as store
from veilspark.llm.queries import TOKENIZER


def tokenizer():
    return Tokenizer.from_file(TOKENIZER)


def test_chunks_are_encoded_like_whole_texts():
    rng = random.Random(1)
    letters = "ab cde'stllre  \n\t\x1c\x1d\x85\xa0 ᠎​9²½日本éß🙂_-.!%AB\x00\r\x0b"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    texts += ["a <|endoftext|> b", " <|endoftext|>", "word " * 300, " lead", "trail ", "two  spaces here"]
    few = "aB.,é \n"
    texts += ["".join(rng.choice(few) for _ in range(rng.randint(0, 25))) for _ in range(6000)]
    texts += ["x <|endoftext|>", "<|endoftext|>\nword.", "<|ENDOFTEXT|> <| a", "one\ntwo. three,\nfour", "\n", "\n\n", "a\n", "\na", "'s\n's 's"]
    encoder, got = store.load(TOKENIZER), []
    for at in range(0, len(texts), 700):
        got += encoder.encode(pa.array([None, *texts[at:at + 700]]).slice(1))
    assert encoder.encode(pa.array([None, "a <|endoftext|> b"]))[1] == np.array([64, 220, 50256, 275], "<u4").tobytes()
    want = tokenizer().encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]


def test_grammar_round_trips():
    rng = random.Random(2)
    for n, kinds in [(0, 1), (1, 1), (2, 1), (500, 1), (501, 1), *((rng.randint(0, 80), rng.randint(1, 5)) for _ in range(300))]:
        ids = np.array([rng.randrange(kinds) for _ in range(n)], np.uint32)
        rules, symbols = store.compress(ids, kinds, least=2)
        lengths = store.expansion_lengths(rules, kinds)
        assert (store.expand(symbols, rules, lengths, kinds) == ids).all()
        for width in (2, 4):
            block = store.Block(kinds, rules.astype(f"<u{width}").tobytes(), lengths.astype("<u4").tobytes(),
                                symbols.astype(f"<u{width}").tobytes(), width)
            a = rng.randint(0, n)
            b = rng.randint(a, n)
            assert (block.span(a, b) == ids[a:b]).all()


def test_frequent_pairs_become_rules():
    ids = np.array([1, 2, 3, 4] * 100, np.uint32)
    rules, symbols = store.compress(ids, 10)
    assert len(symbols) <= 7 and max(store.expansion_lengths(rules, 10)) >= 32


def test_no_frequent_pair_is_left():
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 5000, 300)
    ids = np.concatenate([np.concatenate((passage, rng.integers(0, 50_000, rng.integers(1, 9)))) for _ in range(400)]).astype(np.uint32)
    for least in (2, 8, 16):
        rules, symbols = store.compress(ids, 50_257, least=least)
        pairs = symbols[:-1].astype(np.uint64) << np.uint64(32) | symbols[1:]
        _, counts = np.unique(pairs[symbols[:-1] != symbols[1:]], return_counts=True)
        assert counts.max(initial=0) < least
        lengths = store.expansion_lengths(rules, 50_257)
        assert lengths.max() >= 300 and (store.expand(symbols, rules, lengths, 50_257) == ids).all()


def test_wide_symbols_when_ids_are_large():
    ids = np.array([70_000, 70_001] * 50, np.uint32)
    rules, symbols = store.compress(ids, 80_000)
    lengths = store.expansion_lengths(rules, 80_000)
    assert len(symbols) < 10 and (store.expand(symbols, rules, lengths, 80_000) == ids).all()


def check(spark, docs, block_ids):
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    path = store.write(docs, TOKENIZER, block_ids=block_ids)
    got = sorted(store.read(spark, path).collect(), key=lambda r: r.start)
    want = [e.ids + [store.END_ID] for e in tokenizer().encode_batch([r.text or "" for r in rows], add_special_tokens=False)]
    assert [r.doc_id for r in got] == [r.doc_id for r in rows]
    at = 0
    for r in got:
        assert r.start == at and r.n_tokens == len(r.ids) // 4
        at += r.n_tokens
    key = lambda pair: (pair[0] is not None, pair[0] or 0, pair[1])
    assert sorted(((r.doc_id, zlib.crc32(r.ids)) for r in got), key=key) == sorted(
        ((r.doc_id, zlib.crc32(np.array(w, "<u4").tobytes())) for r, w in zip(rows, want, strict=True)), key=key)
    return path, dict(zip([r.doc_id for r in rows], want, strict=True))


def test_documents_and_single_ones(spark):
    path, want = check(spark, documents(spark), 5_000)
    some = sorted(want)[::17]
    got = store.read(spark, path, some).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got} == {i: want[i] for i in some}


def test_odd_rows(spark):
    check(spark, odd(spark), 2_000_000)
    assert len(odd_rows()) == store.read(spark, store.write(odd(spark), TOKENIZER, block_ids=1)).count()
    assert store.read(spark, store.write(empty(spark), TOKENIZER)).collect() == []


def plain_rounds(ids, base, round_pairs, least):
    """Re-Pair rounds over lists, every pair counted again in each."""
    seq, rules = list(ids), []
    while True:
        counts = {}
        for pair in zip(seq, seq[1:]):  # noqa: B905
            counts[pair] = counts.get(pair, 0) + 1
        begins, ends, taken = set(), set(), {}
        for a, b in sorted((p for p in counts if counts[p] >= least), key=lambda p: (-counts[p], p))[: 2 * round_pairs]:
            if len(taken) < round_pairs and not (a in ends or b in begins or a == b and (a in begins or a in ends)):
                begins.add(a)
                ends.add(b)
                taken[a, b] = base + len(rules) + len(taken)
        if not taken:
            return rules, seq
        out, i = [], 0
        while i < len(seq):
            made = taken.get(tuple(seq[i : i + 2]))
            out.append(seq[i] if made is None else made)
            i += 1 if made is None else 2
        seq, rules = out, [*rules, *taken]


def test_rounds_look_again_only_where_a_pair_may_be_frequent(monkeypatch):
    rng = np.random.default_rng(5)
    for base in (7, 1 << 28):  # pair and place fit in one number, or not
        for _ in range(150):
            ids = rng.integers(0, rng.integers(1, 7), rng.integers(0, 400)).astype(np.uint32) + np.uint32(base - 7)
            pairs, least = int(rng.integers(1, 4)), int(rng.integers(2, 9))
            rules, symbols = store.compress(ids, base, pairs, least)
            assert ([tuple(r) for r in rules.tolist()], symbols.tolist()) == plain_rounds(ids.tolist(), base, pairs, least)
    sorted_, sort = [], np.sort
    monkeypatch.setattr(np, "sort", lambda x: sorted_.append(len(x)) or sort(x))
    passage = rng.integers(0, 50_000, 200)
    ids = np.concatenate([np.concatenate((passage, rng.integers(0, 50_000, 800))) for _ in range(100)]).astype(np.uint32)
    store.compress(ids, 50_257)
    assert len(sorted_) > 3 and sum(sorted_) < 2 * len(ids)


def test_every_word_is_merged_once_and_the_library_has_the_rest(monkeypatch):
    encoder, merged, given = store.Encoder(TOKENIZER), [], []
    merge, ids = encoder.merges.encode_raw, encoder._ids
    monkeypatch.setattr(encoder.merges, "encode_raw", lambda raw, size: merged.append((bytes(raw), size.tolist())) or merge(raw, size))
    monkeypatch.setattr(encoder, "_ids", lambda texts: given.extend(texts) or ids(texts))
    texts = ["abendt abendt. abendt###\nabendt!! Éauxé&&& Éauxé", "x1 abendt,", None, "it's abendt%%% \U0001f642"]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False)]
    assert encoder.encode(pa.array(texts)) == want
    assert merged == [("abendt abendt Éauxé".encode(), [6, 7, 8])]
    assert given == [".", "###", "!!", "&&&", ",", "%%%", "x1", "it's", " \U0001f642", ""]
    # Only the library's chunks are remembered.
    assert sorted(encoder.chunks) == ["\nit's", "\nx1", "\U0001f642"]


def test_letters_and_what_follows_them():
    latin = [chr(c) for c in range(0x80, 0x260) if chr(c).isprintable()]
    tails = [*store.TAIL, "'", "'s", "''", "_a", "\x7f", "\x00", ".'re", "!?", "\u00b7", "\u2026", "1", "#1", "\u0301"]
    texts = [f"{x}{t} a{x}{t}\nb{x}{t}c" for x in latin for t in (".", "'s", "##")] + [f"word{t} \n é{t}\n{t}x {t}\ny{t}" for t in tails]
    texts += ["a" * n + "." for n in range(55, 75)] + ["é" * n + ",\n" + "é" * n for n in range(25, 40)]
    want = [np.array(e.ids, "<u4").tobytes() for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    assert store.load(TOKENIZER).encode(pa.array(texts)) == want


def test_words_of_all_sizes_are_merged_like_the_library(monkeypatch):
    rng = random.Random(6)
    words = [" " * rng.randint(0, 1) + "".join(rng.choice("aetnshrdlé") for _ in range(rng.choice([1, 2, 4, 7, 8, 9, 20, 150]))) for _ in range(3000)]
    words = ["".join(w) for w in dict.fromkeys(words)]
    want = [np.array(e.ids) for e in tokenizer().encode_batch(words, add_special_tokens=False)]
    for together in (1, 37, 1 << 15):  # columns of one size only, or joined by longer words
        monkeypatch.setattr("veilspark.llm.merges.TOGETHER", together)
        some = slice(0, 200 if together == 1 else None)
        ids, size = store.Merges(TOKENIZER).encode([w.encode() for w in words[some]])
        assert size.tolist() == [len(w) for w in want[some]] and (ids == np.concatenate(want[some])).all()
    assert [len(x) for x in store.Merges(TOKENIZER).encode([])] == [0, 0]


def test_rules_are_expanded_together(monkeypatch):
    rng = np.random.default_rng(7)
    ids = np.concatenate([rng.integers(0, 60, 40)] * 200 + [rng.integers(0, 60, 50_000)]).astype(np.uint32)
    rules, symbols = store.compress(ids, 60)
    assert len(rules) > 1000
    calls, spread = [], store.spread
    monkeypatch.setattr(store, "spread", lambda begin, size: calls.append(len(begin)) or spread(begin, size))
    assert (store.expand(symbols, rules, store.expansion_lengths(rules, 60), 60) == ids).all()
    assert len(calls) < 40
