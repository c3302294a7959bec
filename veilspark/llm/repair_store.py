"""Token ids in Re-Pair compressed shards (operator 10).

Documents go in ascending id order over the shards (range partitions); each
shard writes *blocks* of about ``block_ids`` ids.  A block is one row of a
Parquet table in the shared folder, with these fields:

    shard, block   place in the order
    n_ids          ids of the block
    doc_ids        document ids, ascending (null first)
    doc_sizes      ids of each document, its end id included
    base           first nonterminal: symbols below are token ids
    rules          little-endian pairs of symbols; pair r is what nonterminal base + r stands for
    lengths        little-endian unsigned 32-bit expansion length of each nonterminal
    symbols        the block's ids as little-endian symbols
    width          bytes of a symbol in rules and symbols (2 or 4)

Re-Pair: count all neighbouring pairs of symbols, replace frequent ones by new
nonterminals, and again on the shorter sequence.  A round takes the most frequent
pairs that can't overlap each other (no symbol ends one and begins another), so
all their places are replaced at once; pairs of one symbol twice are taken from
the left of each run.  Running sums of the expansion lengths find the symbol that
holds any id, so single documents decode without the rest of their block.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from veilspark.llm.common import Recent, slices
from veilspark.llm.merges import Merges
from veilspark.session import work_path

END_ID = 0
BLOCK = ("shard int, block int, n_ids long, doc_ids array<long>, doc_sizes array<long>, base long, "
         "rules binary, lengths binary, symbols binary, width int")


#: A word of letters as all Unicode versions have them, what may follow it as one piece, and a chunk of both, after a line end or not.
LETTERS = "[A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
TAIL = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
PLAIN = r"\A\n?" + LETTERS + "[" + re.escape(TAIL) + r"]*\z"


def spread(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places ``begin`` to ``begin + size`` of each, one after the other."""
    ends = np.cumsum(size)
    places = np.repeat(begin - ends + size, size)
    places += np.arange(len(places))
    return places


def sizes(texts: pa.Array) -> np.ndarray:
    return pa.compute.binary_length(texts).to_numpy().astype(np.int64)


class Encoder:
    """Texts to ids as the tokenizers library gives them.

    The tokenizer's pattern starts a new piece at a single space before a
    non-space, and a single line end between non-spaces is a piece of its own,
    so the ids of what stands between them don't depend on what is around.  A
    batch looks every distinct chunk up once.  Chunks that are one word of
    letters, with ASCII punctuation other than an apostrophe at most (one piece), are merged
    together, each word once in a batch (``merges``); the library encodes other chunks,
    of which recent ones are remembered, and whole texts that have other
    white space beside a space or line end or may hold an added token's string.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_file(path)
        self.merges = Merges(path)
        self.chunks = Recent(lambda c: self._new([c])[0], 400_000)
        self.tails = Recent(lambda t: self._ids([t])[0], 10_000)
        (self.line,) = self._ids(["\n"])

    def _ids(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in made]

    def _new(self, chunks: list[str]) -> list[bytes | None]:
        """Ids of a space and each chunk, or of a chunk that begins with a line end; None where what stands around could matter."""
        texts = [c[1:] if c[:1] == "\n" else " " + c for c in chunks]
        alone = [t.strip(" ") != "" and not t.lstrip(" ")[0].isspace() and not t[-1].isspace() for t in texts]
        made = iter(self._ids([t for t, a in zip(texts, alone, strict=True) if a]))
        ids = [next(made) if a else None for a in alone]
        return [x if x is None or c[:1] != "\n" else self.line + x for c, x in zip(chunks, ids, strict=True)]

    def _known(self, chunks: list[str]) -> list[bytes | None]:
        memory = self.chunks
        found = list(map(memory.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        ids = list(map(memory.old.get, [chunks[i] for i in missing]))
        made = iter(self._new([chunks[i] for i, x in zip(missing, ids, strict=True) if x is None]))
        ids = [next(made) if x is None else x for x in ids]
        for i, x in zip(missing, ids, strict=True):
            found[i] = x
            if x is not None and len(chunks[i]) <= memory.longest:
                memory[chunks[i]] = x
        memory.trim()
        return found

    def _words(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size): ids of chunks that match ``PLAIN``, and where those of each chunk are."""
        cores = pa.compute.utf8_rtrim(chunks, TAIL)
        tail_size = sizes(chunks) - sizes(cores)
        tailed = np.flatnonzero(tail_size)
        tails = pa.compute.replace_substring_regex(chunks.take(pa.array(tailed)), r"\A\n?" + LETTERS, "").dictionary_encode()
        lined = pa.compute.starts_with(cores, "\n")
        words = pa.compute.if_else(lined, pa.compute.utf8_ltrim(cores, "\n"), pa.compute.binary_join_element_wise(" ", cores, ""))
        words, lined = words.dictionary_encode(), lined.to_numpy(zero_copy_only=False)
        raw = pa.compute.binary_join(pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary), "")[0]
        ids, size = self.merges.encode_raw(np.frombuffer(raw.as_buffer(), np.uint8), sizes(words.dictionary))
        ends = [self.tails[t] for t in tails.dictionary.to_pylist()]
        ids = np.concatenate((ids.astype("<u4"), np.frombuffer(self.line + b"".join(ends), "<u4")))
        # Three parts of each chunk: a line end, the word, what follows it.
        part_begin, part_size = np.zeros((len(chunks), 3), np.int64), np.zeros((len(chunks), 3), np.int64)
        code = words.indices.to_numpy()
        part_begin[:, 0], part_size[:, 0] = size.sum(), lined
        part_begin[:, 1], part_size[:, 1] = (np.cumsum(size) - size)[code], size[code]
        size = np.fromiter(map(len, ends), np.int64, len(ends)) // 4
        code = tails.indices.to_numpy()
        part_begin[tailed, 2], part_size[tailed, 2] = (len(ids) - size.sum() + np.cumsum(size) - size)[code], size[code]
        size = part_size.sum(axis=1)
        return ids[spread(part_begin.reshape(-1), part_size.reshape(-1))], np.cumsum(size) - size, size

    def _distinct(self, chunks: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begin, size, around): ids of distinct chunks, where those of each are, and whether what stands around could matter."""
        plain = pa.compute.match_substring_regex(chunks, PLAIN)
        plain = plain.to_numpy(zero_copy_only=False) & (sizes(chunks) <= 64)
        begin, size, around = np.zeros(len(chunks), np.int64), np.zeros(len(chunks), np.int64), np.zeros(len(chunks), bool)
        ids, begin[plain], size[plain] = self._words(chunks.filter(pa.array(plain)))
        rest = self._known(chunks.filter(pa.array(~plain)).to_pylist())
        around[~plain] = [x is None for x in rest]
        rest = [x or b"" for x in rest]
        size[~plain] = rest_size = np.fromiter(map(len, rest), np.int64, len(rest)) // 4
        begin[~plain] = len(ids) + np.cumsum(rest_size) - rest_size
        return np.concatenate((ids, np.frombuffer(b"".join(rest), "<u4"))), begin, size, around

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; null counts as empty."""
        if not len(texts):
            return []
        texts = texts.fill_null("")
        lines = pa.compute.replace_substring(pa.compute.binary_join_element_wise("\n", texts, ""), "\n", " \n")
        chunks = pa.compute.split_pattern(lines, " ")  # the first is empty, the second begins with a line end
        offsets = chunks.offsets.to_numpy()
        offsets = offsets - offsets[0]
        distinct = chunks.flatten().dictionary_encode()
        code = distinct.indices.to_numpy()
        ids, begin, size, around = self._distinct(distinct.dictionary)
        around = around[code]
        around[offsets[:-1]] = False
        whole = np.add.reduceat(around, offsets[:-1], dtype=np.int64) > 0
        whole |= pa.compute.match_substring(texts, "<|").to_numpy(zero_copy_only=False)
        length = size[code]
        at = np.concatenate(([0], np.cumsum(length)))[offsets]
        flat = ids[spread(begin[code], length)]
        rest = iter(self._ids(texts.filter(pa.array(whole)).to_pylist()))
        return [next(rest) if w else flat[i + 1 : j].tobytes() for w, i, j in zip(whole.tolist(), at[:-1].tolist(), at[1:].tolist(), strict=True)]


@functools.cache
def load(path: str) -> Encoder:
    """The encoder of a tokenizer file; made once per worker."""
    return Encoder(path)


def compress(ids: np.ndarray, base: int, round_pairs: int = 20_000, least: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """(rules, symbols): pairs of symbols that the nonterminals from ``base`` on stand for, and ``ids`` rewritten with them.

    Rounds go on until no pair is found ``least`` times (overlapping places of one symbol twice count once each).
    """
    seq, rules = ids.astype(np.uint32), []
    live = np.arange(max(0, len(seq) - 1))  # places whose pair may be frequent: it was in the last round, or touches a new symbol
    while len(live):
        shift, wide = (base + len(rules)).bit_length(), len(seq).bit_length()
        keys = (seq[:-1] if len(live) == len(seq) - 1 else seq[live]).astype(np.uint64)
        keys <<= np.uint64(shift)
        keys |= seq[1:][live]
        if 2 * shift + wide <= 64:  # pair and place in one number
            keys <<= np.uint64(wide)
            keys |= live.view(np.uint64)
            keys = np.sort(keys)
            place = (keys & np.uint64((1 << wide) - 1)).view(np.int64)
            keys >>= np.uint64(wide)
        else:
            order = np.argsort(keys, kind="stable")
            place, keys = live[order], keys[order]
        cuts = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
        counts = np.diff(cuts, append=len(keys))
        often = counts >= least
        place, pairs, counts = place[np.repeat(often, counts)], keys[cuts[often]], counts[often]
        order = np.argsort(-counts, kind="stable")[: 2 * round_pairs]
        begins, ends, taken, chosen = set(), set(), [], []
        for i, pair in zip(order.tolist(), pairs[order].tolist(), strict=True):
            a, b = pair >> shift, pair & ((1 << shift) - 1)
            if a in ends or b in begins or a == b and (a in begins or a in ends):
                continue
            begins.add(a)
            ends.add(b)
            taken.append((a, b))
            chosen.append(i)
            if len(taken) == round_pairs:
                break
        if not taken:
            break
        symbol = np.zeros(len(pairs), np.uint32)
        symbol[chosen] = base + len(rules) + np.arange(len(taken))
        made = np.zeros(len(seq), np.uint32)
        made[place] = np.repeat(symbol, counts)
        at = np.flatnonzero(made != 0)
        near = np.diff(at) == 1
        if near.any():
            # In a run of one symbol every second place from its first is taken; other pairs can't touch.
            run = np.concatenate(([0], np.cumsum(~near)))
            first = np.concatenate(([0], np.flatnonzero(~near) + 1))
            at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
        seq[at] = made[at]
        # No pair of old symbols gets more frequent, so other places need no second look.
        look = np.zeros(len(seq), bool)
        look[place] = look[at] = look[np.maximum(at - 1, 0)] = True
        stay = np.ones(len(seq), bool)
        stay[at + 1] = False
        seq, look = seq[stay], look[stay]
        live = np.flatnonzero(look[:-1])
        rules += taken
    return np.array(rules, np.uint32).reshape(-1, 2), seq


def expansion_lengths(rules: np.ndarray, base: int) -> np.ndarray:
    lengths: list[int] = []
    for a, b in rules.tolist():
        lengths.append((lengths[a - base] if a >= base else 1) + (lengths[b - base] if b >= base else 1))
    return np.array(lengths, np.uint32)


def expand(symbols: np.ndarray, rules: np.ndarray, lengths: np.ndarray, base: int) -> np.ndarray:
    """The token ids that ``symbols`` stand for."""
    lengths = lengths.astype(np.int64)
    begin, total = np.cumsum(lengths) - lengths, int(lengths.sum())
    # Where each part of a rule stands: in the expansion of its own rule, or by itself after all of them.
    parts = rules.astype(np.int64)
    rule = parts >= base
    part_begin, part_size = total + np.arange(parts.size).reshape(-1, 2), np.ones(parts.shape, np.int64)
    part_begin[rule], part_size[rule] = begin[parts[rule] - base], lengths[parts[rule] - base]
    flat = np.concatenate((np.zeros(total, np.uint32), rules.reshape(-1).astype(np.uint32)))
    needs, done = np.where(rule, parts - base, len(rules)), np.zeros(len(rules) + 1, bool)
    done[-1] = True
    left = np.arange(len(rules))
    while len(left):  # all rules whose parts are written
        ready = done[needs[left]].all(axis=1)
        now, left = left[ready], left[~ready]
        if not len(now):
            raise ValueError("rules stand for one another")
        flat[spread(begin[now], lengths[now])] = flat[spread(part_begin[now].reshape(-1), part_size[now].reshape(-1))]
        done[now] = True
    rule = symbols >= base
    size = np.ones(len(symbols), np.int64)
    size[rule] = lengths[symbols[rule] - base]
    # Terminals come after the flat expansions, one for each place.
    source = np.concatenate((flat[:total], symbols[~rule].astype(np.uint32)))
    first = np.empty(len(symbols), np.int64)
    first[rule] = begin[symbols[rule] - base]
    first[~rule] = total + np.arange(int((~rule).sum()))
    return source[spread(first, size)]


class Block:
    """One block read back."""

    def __init__(self, base: int, rules: bytes, lengths: bytes, symbols: bytes, width: int):
        kind = f"<u{width}"
        self.base = base
        self.rules = np.frombuffer(rules, kind).astype(np.uint32).reshape(-1, 2)
        self.lengths = np.frombuffer(lengths, "<u4")
        self.symbols = np.frombuffer(symbols, kind).astype(np.uint32)

    def all(self) -> np.ndarray:
        return expand(self.symbols, self.rules, self.lengths, self.base)

    @functools.cached_property
    def _ends(self) -> np.ndarray:
        size = np.ones(len(self.symbols), np.int64)
        rule = self.symbols >= self.base
        size[rule] = self.lengths[self.symbols[rule] - self.base]
        return np.cumsum(size)

    def span(self, start: int, stop: int) -> np.ndarray:
        """Ids ``start`` to ``stop`` of the block; expands only the symbols that hold them."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        low, high = np.searchsorted(self._ends, [start, stop - 1], "right")
        before = int(self._ends[low - 1]) if low else 0
        part = expand(self.symbols[low : high + 1], self.rules, self.lengths, self.base)
        return part[start - before : stop - before]


def write(docs: DataFrame, tokenizer_path: str, path: str | None = None, id_col: str = "doc_id", text_col: str = "text",
          block_ids: int = 2_000_000) -> str:
    """Encode every whole text, append :data:`END_ID`, and write the blocks; returns the table's path.

    Null and empty texts have the end id alone.  Rows of one id stay together,
    ordered by a hash of the text and then by place in the input; a repeated
    row is written as often as it is there.  Other columns play no part.  An
    empty table writes an empty one.
    """
    path = path or work_path(docs.sparkSession, "token-blocks")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"),
                       F.xxhash64(text_col).alias("h"), F.monotonically_increasing_id().alias("place"))
    # The hash and the place let ranges cut through an id that many rows have.
    ordered = rows.repartitionByRange("id", "h", "place").sortWithinPartitions("id", "h", "place").select("id", "text")

    def run(batches):
        encoder, shard, block = load(tokenizer_path), TaskContext.get().partitionId(), 0
        base = encoder.tokenizer.get_vocab_size()
        doc_ids, parts, held = [], [], 0

        def row():
            ids = np.frombuffer(b"".join(parts), "<u4")
            rules, symbols = compress(ids, base)
            width = 2 if base + len(rules) <= 1 << 16 else 4
            pack = lambda x: x.astype(f"<u{width}").tobytes()
            return pa.RecordBatch.from_pylist([{
                "shard": shard, "block": block, "n_ids": len(ids), "doc_ids": doc_ids, "doc_sizes": [len(p) // 4 for p in parts],
                "base": base, "rules": pack(rules), "lengths": expansion_lengths(rules, base).astype("<u4").tobytes(),
                "symbols": pack(symbols), "width": width}], schema=schema)

        end = END_ID.to_bytes(4, "little")
        for batch in batches:
            for piece in slices(batch, 1, 8 << 20):
                encoded = encoder.encode(piece.column(1))
                for doc, ids in zip(piece.column(0).to_pylist(), encoded, strict=True):
                    doc_ids.append(doc)
                    parts.append(ids + end)
                    held += len(ids) // 4 + 1
                    if held >= block_ids:
                        yield row()
                        doc_ids, parts, held, block = [], [], 0, block + 1
        if parts:
            yield row()

    schema = pa.schema([("shard", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int64()), ("doc_ids", pa.list_(pa.int64())),
                        ("doc_sizes", pa.list_(pa.int64())), ("base", pa.int64()), ("rules", pa.binary()),
                        ("lengths", pa.binary()), ("symbols", pa.binary()), ("width", pa.int32())])
    ordered.mapInArrow(run, BLOCK).write.parquet(path)
    return path


def starts(blocks: DataFrame) -> DataFrame:
    """``shard``, ``block`` and ``first``, the ids of all blocks before: sums per shard, then within each shard."""
    sizes = blocks.select("shard", "block", "n_ids")
    shards = sizes.groupBy("shard").agg(F.sum("n_ids").alias("n"))
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)  # a row for each shard
    shards = shards.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shard_first"))
    within = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.join(shards, "shard").select(
        "shard", "block", (F.col("shard_first") + F.coalesce(F.sum("n_ids").over(within), F.lit(0))).alias("first"))


def read(spark, path: str, only: list[int] | None = None) -> DataFrame:
    """Per document of the files at ``path``: ``doc_id``, ``start``, ``n_tokens`` and ``ids`` (little-endian u32).

    With ``only``, just these document ids; their blocks alone are read and
    of these just the spans of the documents are expanded.
    """
    blocks = spark.read.schema(BLOCK).parquet(path)
    first = starts(blocks)
    if only is not None:
        blocks = blocks.filter(F.arrays_overlap("doc_ids", F.array(*[F.lit(i).cast("long") for i in only])))
    rows = blocks.join(F.broadcast(first) if first.count() < 100_000 else first, ["shard", "block"])
    rows = rows.select("first", "doc_ids", "doc_sizes", "base", "rules", "lengths", "symbols", "width")
    wanted = None if only is None else set(only)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                first, doc_ids, sizes, *rest = (c[i].as_py() for c in batch.columns)
                block = Block(*rest)
                ends = np.cumsum(sizes)
                every = None if wanted is not None else block.all().astype("<u4")
                for at in range(0, len(doc_ids), 500):
                    out = []
                    for doc, n, stop in zip(doc_ids[at : at + 500], sizes[at : at + 500], ends[at : at + 500].tolist(), strict=True):
                        if wanted is None or doc in wanted:
                            ids = every[stop - n : stop] if every is not None else block.span(stop - n, stop).astype("<u4")
                            out.append({"doc_id": doc, "start": first + stop - n, "n_tokens": n, "ids": ids.tobytes()})
                    if out:
                        yield pa.RecordBatch.from_pylist(out, schema=schema)

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.binary())])
    return rows.mapInArrow(run, T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()),
                                              T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType())]))
