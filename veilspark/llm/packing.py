"""Packing by lexical retrieval (operator 11).

Documents become token ids (written once); windows of ``window`` ids that one
document fills alone need no neighbours.  What is left of each document is a
*unit*, and units are packed shard by shard:

* Terms are token ids.  Document frequencies and the mean length cover all
  documents; the table has at most a row for each id of the vocabulary.
* Documents are range-partitioned by their three heaviest BM25 terms (then id
  and checksum, so that one key or text shared by a third of all rows still
  divides) and cut into shards of about ``shard_ids`` ids.  A task holds one
  shard at a time.
* A shard's inverted index has for each term its units and BM25 weights.  The
  first unused unit is the seed of a window; its ``query_terms`` heaviest terms
  are looked up, and unused units follow by falling score until the window is
  full.  Units that share none of these terms follow in the shard's order.  A
  unit that doesn't fit is cut, and its rest is the next seed.
* A shard's last window is cut at powers of two, which need no padding.
"""

from __future__ import annotations

import functools
import os
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from veilspark.llm.common import Recent, slices
from veilspark.llm.merges import Merges
from veilspark.session import materialize

#: BM25's saturation of repeats and its share of length normalisation.
K1, B = 1.2, 0.75
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "score double")


class WordEncoder:
    """Texts to ids as the tokenizers library gives them, with the ids of recent chunks remembered.

    For byte-level tokenizers that lower-case and whose pieces never cross a
    space or line end: a text's ids are those of its chunks between them, and a
    batch looks every distinct chunk up once, lower-cased if it is ASCII.  New
    chunks that are one word of letters, with a full stop or comma at most (a
    piece of its own), are merged together (``merges``); the library encodes all others.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        self.merges = Merges(path, "</w>")
        self.stops = dict(zip(".,", self._ids([".", ","]), strict=True))
        self.chunks = Recent(lambda c: self._new([c])[0], 500_000)

    def _ids(self, texts: list[str]) -> list[bytes]:
        made = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, self.kind).tobytes() for e in made]

    def _new(self, chunks: list[str]) -> list[bytes]:
        cores = [c[:-1] if c[-1:] in (".", ",") else c for c in chunks]
        # Latin letters lower-case one by one, but for one, and are then in the tokenizer's normal form.
        plain = [c.isalpha() and len(c) <= 64 and (c.isascii() or max(c) < "ɐ" and "İ" not in c) for c in cores]
        cores = [c.lower() if p else c for c, p in zip(cores, plain, strict=True)]
        words = list({c: None for c, p in zip(cores, plain, strict=True) if p})
        ids, size = self.merges.encode([w.encode() for w in words])
        raw, ends = ids.astype(self.kind).tobytes(), np.cumsum(size) * self.kind.itemsize
        made = {w: raw[i:j] for w, i, j in zip(words, [0, *ends[:-1].tolist()], ends.tolist())}  # noqa: B905
        rest = iter(self._ids([c for c, p in zip(chunks, plain, strict=True) if not p]))
        return [next(rest) if not p else made[core] if len(core) == len(c) else made[core] + self.stops[c[-1]]
                for c, core, p in zip(chunks, cores, plain, strict=True)]

    def _known(self, chunks: list[str]) -> list[bytes]:
        """The ids of distinct chunks, from memory or computed together."""
        memory = self.chunks
        found = list(map(memory.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        ids = list(map(memory.old.get, [chunks[i] for i in missing]))
        new = [i for i, x in zip(missing, ids, strict=True) if x is None]
        made = iter(self._new([chunks[i] for i in new]))
        ids = [next(made) if x is None else x for x in ids]
        for i, x in zip(missing, ids, strict=True):
            found[i] = x
            if len(chunks[i]) <= memory.longest:
                memory[chunks[i]] = x
        memory.trim()
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, one after the other; where each text begins, and the end).  Null counts as empty."""
        texts = texts.fill_null("")
        special = pa.compute.match_substring(texts, "<|")  # it may hold an added token's string, which lower-casing could make
        if pa.compute.any(special).as_py():
            others, begin = self._encode(pa.compute.if_else(special, "", texts))
            whole = dict(zip(np.flatnonzero(special.to_numpy(zero_copy_only=False)).tolist(), self._ids(texts.filter(special).to_pylist()), strict=True))
            parts = [np.frombuffer(whole[i], self.kind) if i in whole else others[begin[i] : begin[i + 1]] for i in range(len(texts))]
            return np.concatenate(parts), np.concatenate(([0], np.cumsum([len(p) for p in parts])))
        return self._encode(texts)

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        texts = pa.compute.ascii_lower(pa.compute.replace_substring(texts, "\n", " "))
        chunks = pa.compute.split_pattern(texts, " ")
        distinct = chunks.flatten().dictionary_encode()
        ids = self._known(distinct.dictionary.to_numpy(zero_copy_only=False).tolist())
        joined = np.frombuffer(b"".join(ids), self.kind)
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // self.kind.itemsize
        begin = np.cumsum(size) - size
        code = distinct.indices.to_numpy()
        length = size[code]
        ends = np.concatenate(([0], np.cumsum(length)))
        flat = joined[np.repeat(begin[code] - ends[:-1], length) + np.arange(ends[-1])]
        offsets = chunks.offsets.to_numpy()
        return flat, ends[offsets - offsets[0]]


@functools.cache
def load(path: str) -> WordEncoder:
    """The encoder of a tokenizer file; made once per worker."""
    return WordEncoder(path)


def with_ids(docs: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (with ``end_id`` last) of every whole text; a null text counts as empty.

    Each task adds a row with null ``ids``: ``df`` has, for every id of the
    vocabulary, in how many of the task's documents it is (64-bit integers).
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))

    def run(batches):
        encoder = load(tokenizer_path)
        end, df = np.array([end_id], encoder.kind).tobytes(), np.zeros(encoder.size, np.int64)
        names = ["doc_id", "ids", "df"]
        for batch in batches:
            for part in slices(batch, 1, 4 << 20):
                flat, at = encoder.encode(part.column(1))
                bounds = list(zip(at[:-1].tolist(), at[1:].tolist(), strict=True))
                ids = [flat[i:j].tobytes() + end for i, j in bounds]
                for i, j in bounds:
                    df[counted(flat[i:j])[0]] += 1
                df[end_id] += len(bounds)  # not an id of texts
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(ids, pa.binary()), pa.nulls(len(ids), pa.binary())], names=names)
        yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.binary()), pa.array([df.tobytes()], pa.binary())], names=names)

    return rows.mapInArrow(run, "doc_id long, ids binary, df binary")


def counted(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids, ascending, and how often each occurs."""
    if not len(ids):
        return ids, np.zeros(0, np.int64)
    ordered = np.sort(ids, kind="stable")  # a radix sort for 16-bit ids
    new = np.empty(len(ids), bool)
    new[0] = True
    np.not_equal(ordered[1:], ordered[:-1], out=new[1:])
    first = np.flatnonzero(new)
    n = np.empty(len(first), np.int64)
    np.subtract(first[1:], first[:-1], out=n[:-1])
    n[-1] = len(ids) - first[-1]
    return ordered[first], n


def document_frequencies(encoded: DataFrame, size: int) -> DataFrame:
    """``term`` and ``df``, in how many documents it is: the sums of the tasks' counts."""

    def run(batches):
        df = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column(0):
                df += np.frombuffer(x.as_buffer(), np.int64)
        terms = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(terms), pa.array(df[terms])], names=["term", "df"])

    made = encoded.filter("df IS NOT NULL").select("df").mapInArrow(run, "term long, df long")
    return made.groupBy("term").agg(F.sum("df").alias("df"))


class Bm25:
    """Term weights from the frequencies in all documents."""

    def __init__(self, idf: np.ndarray, mean: float, kind: str):
        self.idf, self.mean, self.kind = idf, mean, kind

    @classmethod
    def of(cls, terms: np.ndarray, df: np.ndarray, documents: int, ids: int, size: int, kind: str) -> Bm25:
        idf = np.zeros(size)
        # A term of one document finds nothing: weight 0.
        idf[terms] = np.where(df > 1, np.log1p((documents - df + 0.5) / (df + 0.5)), 0)
        return cls(idf, ids / max(documents, 1), kind)

    def weights(self, terms: np.ndarray, tf: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return self.idf[terms] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))

    def heaviest(self, ids: np.ndarray, most: int) -> np.ndarray:
        """The ``most`` heaviest terms of a text, falling (ties: smaller id first); fewer if fewer have a weight."""
        terms, tf = counted(ids)
        w = self.weights(terms, tf, len(ids))
        if len(w) > most:
            least = np.partition(w, len(w) - most)[len(w) - most]
            near = np.flatnonzero(w >= least)
            terms, w = terms[near], w[near]
        order = np.argsort(-w, kind="stable")[:most]
        return terms[order[w[order] > 0]]


class Index:
    """The inverted index of a shard's units: for each term its units and their weights."""

    def __init__(self, units: list[np.ndarray], model: Bm25):
        lengths = np.array([len(u) for u in units], np.int64)
        each = [counted(u) for u in units]
        terms, tf = np.concatenate([t for t, _ in each]), np.concatenate([n for _, n in each])
        order = np.argsort(terms, kind="stable")  # by term, then unit
        terms, tf = terms[order], tf[order]
        self.units = np.repeat(np.arange(len(units)), [len(t) for t, _ in each])[order]
        self.weights = model.weights(terms, tf, lengths[self.units])
        self.first = np.flatnonzero(np.append(True, terms[1:] != terms[:-1]))
        self.terms, self.last = terms[self.first], np.append(self.first[1:], len(terms))
        self.model, self.n = model, len(units)

    def scores(self, ids: np.ndarray, query_terms: int) -> np.ndarray:
        """The BM25 score of every unit for the heaviest terms of ``ids``."""
        query = self.model.heaviest(ids, query_terms)
        at = np.minimum(np.searchsorted(self.terms, query), len(self.terms) - 1)
        at = at[self.terms[at] == query]
        if not len(at):
            return np.zeros(self.n)
        spans = [slice(i, j) for i, j in zip(self.first[at].tolist(), self.last[at].tolist(), strict=True)]
        return np.bincount(np.concatenate([self.units[s] for s in spans]), np.concatenate([self.weights[s] for s in spans]), self.n)


def pack(units: list[np.ndarray], model: Bm25, window: int, query_terms: int) -> list[list[tuple[int, int, int, float | None]]]:
    """Sequences of (unit, first id, ids, score): each id of each unit in exactly one, in order."""
    if not units:
        return []
    index, unused, following = Index(units, model), np.ones(len(units), bool), 0
    out, rest = [], None
    while rest is not None or unused.any():
        if rest is None:
            following += int(unused[following:].argmax())
            unit, begin = following, 0
            unused[unit] = False
        else:
            unit, begin = rest
        n = len(units[unit]) - begin
        sequence, filled, rest = [(unit, begin, n, None)], n, None
        if filled < window and unused.any():
            scores = index.scores(units[unit], query_terms)
            near = np.flatnonzero(unused & (scores > 0))
            near = near[np.lexsort((near, -scores[near]))]
            far = (i for i in range(following, len(units)) if unused[i])  # all before are used
            ranked = ((i, s) for part in (zip(near.tolist(), scores[near].tolist(), strict=True), ((i, None) for i in far)) for i, s in part)
            for i, score in ranked:
                unused[i] = False
                n = min(len(units[i]), window - filled)
                sequence.append((i, 0, n, score))
                filled += n
                if n < len(units[i]):
                    rest = i, n
                if filled == window:
                    break
        out.append(sequence)
    return out[:-1] + powers(out[-1], window)


def powers(sequence: list[tuple], window: int) -> list[list[tuple]]:
    """A sequence cut so that each part is full or has a power of two ids."""
    parts, space = [], 0
    left = sum(p[2] for p in sequence)
    for unit, begin, n, score in sequence:
        while n:
            if not space:
                space = min(window, 1 << left.bit_length() - 1)
                left -= space
                parts.append([])
            taken = min(n, space)
            parts[-1].append((unit, begin, taken, score))
            begin, n, space = begin + taken, n - taken, space - taken
    return parts


def pack_documents(docs: DataFrame, tokenizer_path: str, end_id: int = 2, window: int = 4096, shard_ids: int = 2_000_000,
                   query_terms: int = 24, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Pieces of all documents: ``doc_id``, ``start`` (its document's ids before it), ``length``, ``ids_crc32``,
    ``doc_tokens``, ``sequence_id``, ``offset`` and ``score`` (BM25 for the sequence's seed; null for seeds and fillers).

    Null and empty texts have the end id alone; repeated rows and rows
    without id are packed like any other; other columns play no part.  An empty
    table gives an empty one.
    """
    spark = docs.sparkSession
    encoder = load(tokenizer_path)
    size, width = encoder.size, encoder.kind.itemsize
    written = materialize(with_ids(docs, tokenizer_path, end_id, id_col, text_col), "packing-ids")
    counts = document_frequencies(written, size).toArrow()  # at most a row for each id of the vocabulary
    encoded = written.filter("ids IS NOT NULL").select("doc_id", "ids")
    documents, ids = encoded.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("ids")), F.lit(0))).first()
    ids //= width
    model = Bm25.of(counts["term"].to_numpy(), counts["df"].to_numpy(), documents, ids, size, f"<u{width}")
    sent = spark.sparkContext.broadcast((model.idf, model.mean, model.kind))  # 8 bytes for each id of the vocabulary

    def keyed(batches):
        model = Bm25(*sent.value)
        for batch in batches:
            keys = []
            for x in batch.column(1):
                top = model.heaviest(np.frombuffer(x.as_buffer(), model.kind), 3).tolist()
                keys.append(top + [-1] * (3 - len(top)))
            columns = [pa.array([k[i] for k in keys], pa.int32()) for i in range(3)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=["doc_id", "ids", "k0", "k1", "k2"])

    def run(batches):
        model, task = Bm25(*sent.value), TaskContext.get().partitionId() << 40
        made = 0
        held: list[tuple] = []  # (doc_id, start, ids, ids of the document)
        size = 0

        def shard():
            nonlocal made
            rows = []
            for sequence in pack([h[2] for h in held], model, window, query_terms):
                offset = 0
                for unit, begin, n, score in sequence:
                    doc, start, ids, total = held[unit]
                    rows.append(piece(doc, start + begin, ids[begin : begin + n], total, task + made, offset, score))
                    offset += n
                made += 1
            return batch_of(rows)

        for batch in batches:
            rows = []
            for doc, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(raw.as_buffer(), model.kind)
                whole = len(ids) - len(ids) % window
                for at in range(0, whole, window):  # a window that the document fills alone
                    rows.append(piece(doc, at, ids[at : at + window], len(ids), task + made, 0, None))
                    made += 1
                if whole < len(ids):
                    held.append((doc, whole, ids[whole:].copy(), len(ids)))
                    size += len(ids) - whole
                if size >= shard_ids:
                    yield shard()
                    held, size = [], 0
            yield batch_of(rows)
        yield shard()

    partitions = min(20_000, max(1, ids // shard_ids))  # a task with more makes several shards
    rows = encoded.mapInArrow(keyed, "doc_id long, ids binary, k0 int, k1 int, k2 int")
    order = ["k0", "k1", "k2", "doc_id", "check"]
    rows = materialize(rows.withColumn("check", F.crc32("ids")), "packing-keys")  # the ranges are sampled from the keys alone
    rows = rows.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
    return rows.select("doc_id", "ids").mapInArrow(run, PIECES)


def piece(doc: int | None, start: int, ids: np.ndarray, total: int, sequence: int, offset: int, score: float | None) -> tuple:
    return doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), total, sequence, offset, score


_SCHEMA = pa.schema([(x.split()[0], pa.float64() if x.endswith("double") else pa.int64()) for x in PIECES.split(", ")])


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(_SCHEMA)], schema=_SCHEMA)
