"""Byte-level BPE encoding and decoding (operator 6).

A text is split by the tokenizer's pattern and every match (*piece*) is encoded
on its own.  The bytes of a piece are read as Latin-1 characters, so that one
Aho-Corasick pass finds, for every place, the longest vocabulary entry that
starts there.  The encoder goes from left to right, takes the longest entry and
keeps it only if byte-pair merging would leave exactly these two entries side
by side; else it tries the next shorter entry, and when none is left it marks
the place as a dead end and goes one entry back.  A place is given up at most
once, so the work is linear in the piece.

Whether two entries may stand side by side depends on these two alone and is
remembered for each pair: undo the later of the two last merges again and
again; if at some point the two entries that touch have a merge that comes
before the merges undone so far, merging would have joined them.

Pieces repeat, so each worker remembers the ids of recent ones, and above
that of recent space-separated chunks: a single space before a non-space
always starts a new piece, therefore the ids of such a chunk do not depend on
what stands around it.
"""

from __future__ import annotations

import base64
import functools
from array import array

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from veilspark.llm.common import Recent, add_columns


class Vocabulary:
    """Ranks of a tokenizer with what the encoder derives from them."""

    def __init__(self, ranks: dict[bytes, int]):
        if set(ranks.values()) != set(range(len(ranks))):
            raise ValueError("ranks must be 0 to n - 1, each once")
        self.ranks = ranks
        self.entry: list[bytes] = sorted(ranks, key=ranks.get)
        self.size = [len(x) for x in self.entry]
        self.halves = [self._last_merge(x) for x in self.entry]
        self.joined = {(a, b): i for i, (a, b) in enumerate(self.halves) if b >= 0}
        self.words = ahocorasick.Automaton()
        for i, x in enumerate(self.entry):
            if self.halves[i] != (-1, -1):  # else no merge ever makes it
                self.words.add_word(x.decode("latin-1"), (i, len(x)))
        self.words.make_automaton()
        self.shorter = [self._prefix(x) for x in self.entry]
        self.beside = Recent(lambda pair: self._stays(pair >> 32, pair & 0xFFFFFFFF), 200_000, longest=0)

    def _last_merge(self, x: bytes) -> tuple[int, int]:
        """The two entries whose merge makes ``x``; (own id, -1) for a byte, (-1, -1) if merging never makes it."""
        own = self.ranks[x]
        if len(x) == 1:
            return own, -1
        parts = [x[i : i + 1] for i in range(len(x))]
        while len(parts) > 2:
            rank, at = min((self.ranks.get(parts[i] + parts[i + 1], own), i) for i in range(len(parts) - 1))
            if rank >= own:
                return -1, -1
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return self.ranks[parts[0]], self.ranks[parts[1]]

    def _prefix(self, x: bytes) -> int:
        """The longest shorter entry that ``x`` starts with, or -1."""
        for n in range(len(x) - 1, 0, -1):
            i = self.ranks.get(x[:n], -1)
            if i >= 0 and self.halves[i] != (-1, -1):
                return i
        return -1

    def _stays(self, left: int, right: int) -> bool:
        """Does merging leave ``left`` and ``right`` side by side."""
        bound = len(self.entry)  # merges from here on have been undone
        while True:
            if self.joined.get((left, right), bound) < bound:
                return False
            # Undo the later merge of the two; bytes have none.  At the same rank the left one comes first.
            undo_left, undo_right = self.halves[left][1] >= 0, self.halves[right][1] >= 0
            if undo_left and (left > right or not undo_right):
                bound, left = left, self.halves[left][1]
            elif undo_right:
                bound, right = right + 1, self.halves[right][0]
            else:
                return True

    def encode_piece(self, piece: str) -> bytes:
        """Ids of one piece as little-endian unsigned 32-bit integers."""
        raw = piece.encode()
        whole = self.ranks.get(raw)
        if whole is not None:
            return whole.to_bytes(4, "little")
        longest = [0] * len(raw)
        for end, (i, n) in self.words.iter(raw.decode("latin-1")):  # by end: the last one of a start is its longest
            longest[end - n + 1] = i
        size, shorter, beside = self.size, self.shorter, self.beside
        ids, at, dead, take = [], 0, bytearray(len(raw) + 1), longest[0] if raw else -1
        while at < len(raw):
            left = ids[-1] << 32 if ids else -1
            while take >= 0 and (dead[at + size[take]] or left >= 0 and not beside[left | take]):
                take = shorter[take]
            if take >= 0:
                ids.append(take)
                at += size[take]
                take = longest[at] if at < len(raw) else -1
            else:
                dead[at] = 1
                take = ids.pop()
                at -= size[take]
        return array("I", ids).tobytes()

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.entry.__getitem__, array("I", ids)))


class Encoder:
    """Whole texts to ids, with the memory of recent pieces and chunks."""

    def __init__(self, vocabulary: Vocabulary, pattern: str, remembered: int = 400_000):
        self.vocabulary, split = vocabulary, regex.compile(pattern)
        self.pieces = Recent(vocabulary.encode_piece, remembered // 8)
        self.split = split.findall
        self.chunks = Recent(self._chunk, remembered)

    def _pieces(self, text: str) -> bytes:
        return b"".join([self._piece(p) for p in self.split(text)])

    def _piece(self, piece: str) -> bytes:
        """Ids of one piece; a space and a word without white space is what a chunk stands for, and found among the chunks."""
        if piece[:1] == " " and not piece[1:2].isspace():
            known = self.chunks.get(piece[1:]) or self.chunks.old.get(piece[1:])
            if known:
                return known
        return self.pieces[piece]

    def _chunk(self, chunk: str) -> bytes | None:
        """Ids of a space and ``chunk``; None if what stands around could matter."""
        if not chunk or chunk[0].isspace() or chunk[-1].isspace():
            return None
        found = self.split(" " + chunk)
        if len(found) == 1:  # the chunk is remembered, so the piece need not be
            return self.pieces.get(found[0]) or self.vocabulary.encode_piece(found[0])
        return b"".join([self._piece(p) for p in found])

    def encode(self, text: str) -> bytes:
        first, *rest = text.split(" ")
        if rest and not first[-1:].isspace():
            made = [self.chunks[c] for c in rest]
            if None not in made:
                return self._pieces(first) + b"".join(made)
        return self._pieces(text)


@functools.cache
def load(rank_path: str, pattern: str, remembered: int = 400_000) -> Encoder:
    """The encoder of a rank file; made once per worker."""
    with open(rank_path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return Encoder(Vocabulary(ranks), pattern, remembered)


def encode_decode(df: DataFrame, rank_path: str, pattern: str, text_col: str = "text",
                  ids_col: str = "ids", decoded_col: str = "decoded", remembered: int = 400_000) -> DataFrame:
    """``df`` with the ids of each whole text and the bytes that they decode to.

    ``ids_col`` holds little-endian unsigned 32-bit integers, ``decoded_col``
    the decoded bytes (the text's UTF-8).  The rank file must lie at
    ``rank_path`` on every machine.  Null and empty texts give no ids and no
    bytes; repeated rows and all other columns stay as they are; a column that
    has the name of an output is replaced; an empty table gives an empty one.
    A worker keeps the ids of the last ``remembered`` to twice as many chunks
    as long as it lives (about 140 bytes each), which changes no result.
    """

    def start():
        encoder = load(rank_path, pattern, remembered)

        def columns(texts):
            ids = [encoder.encode(t or "") for t in texts]
            return pa.array(ids, pa.binary()), pa.array(map(encoder.vocabulary.decode, ids), pa.binary())

        return columns

    return add_columns(df, text_col, [T.StructField(c, T.BinaryType()) for c in (ids_col, decoded_col)], start)
