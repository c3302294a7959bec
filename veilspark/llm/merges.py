"""Byte-pair merges of many words at once, for the words that a batch of texts has new.

The ranks come from a tokenizer's own file.  Words with the same number of symbols are the
columns of one array; a round merges in each its leftmost pair of least rank, which is what merging
word by word does.  That leaves every column a symbol less, so it joins the words that began
with that number; words without any pair left leave the array.
"""

from __future__ import annotations

import json

import numpy as np

#: Words merged side by side; few enough for their arrays to stay in a processor's cache.
TOGETHER = 1 << 15


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it can be seen, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = (b for b in range(256) if b not in seen)
    return [chr(c) for _, c in sorted([*((b, b) for b in seen), *((b, 256 + i) for i, b in enumerate(rest))])]


class Merges:
    def __init__(self, path: str, suffix: str = ""):
        """``path``: a tokenizer file with byte-level letters; ``suffix`` is what a word's last letter carries."""
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocabulary = model["vocab"]
        pairs = [p.split(" ") if isinstance(p, str) else p for p in model["merges"]]
        letters = byte_letters()
        self.letter = np.array([vocabulary[x] for x in letters], np.int64)
        self.last = np.array([vocabulary[x + suffix] for x in letters], np.int64)
        self.base = max(vocabulary.values()) + 1
        self.none = len(pairs)  # the rank of what never merges
        self.made = np.array([vocabulary[a + b] for a, b in pairs], np.int64)
        self._place(np.array([vocabulary[a] * self.base + vocabulary[b] for a, b in pairs], np.uint64))
        # Of two bytes, the second the last of its word or not.
        self.first = np.stack([self._rank(np.repeat(self.letter, 256), np.tile(x, 256)).reshape(256, 256) for x in (self.letter, self.last)])

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * np.uint64(0x9E3779B97F4A7C15) >> self.shift).astype(np.int64)

    def _place(self, keys: np.ndarray) -> None:
        """A table of pairs and ranks, at least four times as long as their number; a pair whose slot is taken has one of the next."""
        bits = (4 * len(keys)).bit_length()
        self.shift, self.free = np.uint64(64 - bits), np.uint64(self.base * self.base)
        self.pairs = np.full((1 << bits) + len(keys), self.free, np.uint64)
        self.ranks = np.full(len(self.pairs), self.none, np.int64)
        rank, slot = np.arange(len(keys)), self._slot(keys)
        while len(rank):
            open_ = np.flatnonzero(self.pairs[slot] == self.free)
            # Of several pairs for one free slot, the one written last stays.
            self.pairs[slot[open_]], self.ranks[slot[open_]] = keys[rank[open_]], rank[open_]
            left = self.pairs[slot] != keys[rank]
            rank, slot = rank[left], slot[left] + 1

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = (left * self.base + right).astype(np.uint64)
        slot = self._slot(keys)
        found, rank = self.pairs[slot], self.ranks[slot]
        other = np.flatnonzero(found != keys)
        rank[other] = self.none
        other = other[found[other] != self.free]
        while len(other):
            slot[other] += 1
            found = self.pairs[slot[other]]
            hit = found == keys[other]
            rank[other[hit]] = self.ranks[slot[other[hit]]]
            other = other[~hit & (found != self.free)]
        return rank

    def encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, one after the other; how many each has).  No word is empty."""
        return self.encode_raw(np.frombuffer(b"".join(words), np.uint8), np.fromiter(map(len, words), np.int64, len(words)))

    def encode_raw(self, raw: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """:meth:`encode` of words that stand one after the other in ``raw`` and have ``size`` bytes each."""
        begin, count = np.cumsum(size) - size, np.zeros(len(size), np.int64)
        order = np.argsort(size, kind="stable")
        done = []
        for at in range(0, len(order), TOGETHER):
            for words, symbols in self._merged(raw, begin, size, order[at : at + TOGETHER]):
                count[words] = len(symbols)
                done.append((words, symbols))
        begin, ids = np.cumsum(count) - count, np.zeros(int(count.sum()), np.int64)
        for words, symbols in done:
            ids[begin[words] + np.arange(len(symbols))[:, None]] = symbols
        return ids, count

    def _merged(self, raw: np.ndarray, begin: np.ndarray, size: np.ndarray, words: np.ndarray):
        """Pairs (words, symbols): words with as many ids as ``symbols`` has rows, and their ids as its columns.  ``words`` come by size."""
        sizes = size[words]
        longest = int(sizes[-1])
        # Rank and place in one number, so that the least is the leftmost of the least rank.
        wide = longest.bit_length()
        kind = np.int32 if max(self.none + 1 << wide, self.base) < 1 << 31 else np.int64
        none = self.none << wide
        place = np.arange(longest, dtype=kind)[:, None]
        held, symbols, ranks = words[:0], np.zeros((longest, 0), kind), np.zeros((longest - 1, 0), kind)
        for n in range(longest, 0, -1):
            new = words[np.searchsorted(sizes, n) : np.searchsorted(sizes, n, "right")]
            if len(new):
                letters = raw[begin[new] + np.arange(n)[:, None]]
                first = self.letter[letters]
                first[-1] = self.last[letters[-1]]
                rank = self.first[0][letters[:-1], letters[1:]]
                if n > 1:
                    rank[-1] = self.first[1][letters[-2], letters[-1]]
                held = np.concatenate((held, new))
                symbols = np.concatenate((symbols, first.astype(kind)), axis=1)
                ranks = np.concatenate((ranks, (rank << wide).astype(kind)), axis=1)
            if n == 1:
                yield held, symbols
                break
            least = (ranks | place[: n - 1]).min(axis=0)
            over = least >= none
            if over.any():
                yield held[over], symbols[:, over]
                stay = np.flatnonzero(~over)
                held, symbols, ranks, least = held[stay], symbols[:, stay], ranks[:, stay], least[stay]
            at, column, w = (least & ((1 << wide) - 1)).astype(np.int64), np.arange(len(held)), len(held)
            after = place[: n - 1] > at.astype(kind)
            symbols = np.where(after, symbols[1:], symbols[:-1])
            ranks = np.where(after[:-1], ranks[1:], ranks[:-1])
            flat = symbols.reshape(-1)
            here = at * w + column
            flat[here] = self.made[least >> wide]
            for left in (here[at > 0] - w, here[at < n - 2]):
                ranks.reshape(-1)[left] = self._rank(flat[left].astype(np.int64), flat[left + w].astype(np.int64)) << wide
