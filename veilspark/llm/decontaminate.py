"""Benchmark decontamination by q-gram lemma filtering (operator 8).

Texts and benchmark items are lower-cased, and runs of anything but letters and
digits become one space.  An item is searched for as overlapping *patterns* of
``window`` characters, one every ``stride`` (shorter items whole), each with an edit budget k, a share
``rate`` of its length m.  So every verbatim excerpt of ``window + stride - 1``
characters or more (71 by default, about 13 words) holds a whole pattern.  Items of fewer than q characters are
looked for exactly, as whole words.  If a region of a document is within k edits of a
pattern, the two share at least t = m - q + 1 - kq of the pattern's q-grams
(the q-gram lemma), all on at most k + 1 neighbouring diagonals (place in the
document less place in the pattern).  So:

1. hash every q-gram of the text and keep those that some pattern has;
2. drop shared q-grams that lie in no stretch with enough of them;
3. count the rest per pattern and diagonal band (bands are ``step + k`` wide and
   start every ``step`` diagonals, so some band holds any k + 1 in a row);
4. where a band has t or more, align the pattern with that region, computing
   the band's diagonals and k more on either side only, and report it if the
   distance is within the budget.

Every text is searched whole.  Benchmarks are searched in blocks of at most
``block_chars`` characters, whose tables travel with the tasks, one pass each.
"""

from __future__ import annotations

import math
import re

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import add_columns
from veilspark.session import materialize

STEP = 16
_TABLE_BITS = 22
_NOT_WORD = re.compile(r"[\W_]+")
MATCH = T.ArrayType(T.StructType([
    T.StructField("item", T.LongType()), T.StructField("start", T.LongType()),
    T.StructField("end", T.LongType()), T.StructField("edits", T.LongType())]))


def normalise(text: str | None) -> str:
    return _NOT_WORD.sub(" ", (text or "").lower()).strip()


def gram_hashes(codes: np.ndarray, q: int) -> np.ndarray:
    """A 32-bit hash of each q codes in a row, built from hashes of runs of 1, 2, 4, ... codes."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint32)
    runs, size, base = codes * np.uint32(0x9E3779B1) + np.uint32(0x7F4A7C15), 1, 0x85EBCA6B
    done, length = None, 0  # the part of q put together so far
    rest = q
    while True:
        if rest & 1:
            done = runs if done is None else done[: len(done) - size] * np.uint32(pow(base, size, 1 << 32)) + runs[length:]
            length += size
        rest >>= 1
        if not rest:
            break
        runs = runs[:-size] * np.uint32(pow(base, size, 1 << 32)) + runs[size:]
        size *= 2
    done = done[:n]
    return done ^ (done >> np.uint32(15))


class Patterns:
    """The patterns of one benchmark block with the table of their q-grams."""

    def __init__(self, items: list[tuple[int, str]], q: int, window: int, rate: float, stride: int = 8):
        self.q, self.text, self.item = q, [], []
        short: dict[str, set[int]] = {}
        for item, text in items:
            text = normalise(text)
            if len(text) < q:
                if text:
                    short.setdefault(text, set()).add(item)
                continue
            for at in [*range(0, max(1, len(text) - window), stride), max(0, len(text) - window)]:
                self.text.append(text[at : at + window])
                self.item.append(item)
        self.short = ahocorasick.Automaton()
        for text, owners in short.items():
            self.short.add_word(f" {text} ", (len(text), owners))
        self.short.make_automaton()
        seen = sorted({*zip(self.item, self.text, strict=True)}, key=str)
        self.item, self.text = [x for x, _ in seen], [x for _, x in seen]
        length = np.array([len(x) for x in self.text], np.int64)
        # The largest budget up to ``rate`` that leaves a threshold of one or more.
        self.budget = np.minimum((length * rate).astype(np.int64), (length - q) // q)
        self.need = length - q + 1 - self.budget * q
        grams = [gram_hashes(_codes(x), q) for x in self.text]
        hashes = np.concatenate(grams) if grams else np.zeros(0, np.uint32)
        order = np.argsort(hashes, kind="stable")
        self.pattern = np.repeat(np.arange(len(grams)), [len(g) for g in grams])[order]
        self.place = np.concatenate([np.arange(len(g)) for g in grams])[order] if grams else hashes.astype(np.int64)
        self.hashes, self.first, self.count = np.unique(hashes[order], return_index=True, return_counts=True)
        self.table = np.zeros(1 << _TABLE_BITS, bool)
        self.table[self.hashes >> np.uint32(32 - _TABLE_BITS)] = True
        self.least = int(self.need.min()) if len(length) else 1
        self.span = int((length + self.budget).max()) - q + 1 if len(length) else 0

    def shared(self, hashes: np.ndarray) -> np.ndarray:
        """Places of the q-grams that some pattern has and that lie in a stretch with enough of them."""
        at = np.flatnonzero(self.table[hashes >> np.uint32(32 - _TABLE_BITS)])
        found = np.searchsorted(self.hashes, hashes[at])
        found[found == len(self.hashes)] = 0
        at = at[self.hashes[found] == hashes[at]]
        n, t = len(at), self.least
        if n < t:
            return at[:0]
        dense = np.flatnonzero(at[t - 1 :] - at[: n - t + 1] < self.span)
        marks = np.zeros(n + 1, np.int64)
        np.add.at(marks, dense, 1)
        np.add.at(marks, dense + t, -1)
        return at[np.cumsum(marks[:-1]) > 0]

    def candidates(self, hashes: np.ndarray) -> list[tuple[int, int, int]]:
        """(pattern, first diagonal of the band, a place of the text in it) wherever a band has enough shared q-grams."""
        at = self.shared(hashes)
        if not len(at):
            return []
        found = np.searchsorted(self.hashes, hashes[at])
        count = self.count[found]
        place = np.repeat(at, count)
        entry = np.repeat(self.first[found] - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        pattern = self.pattern[entry]
        diagonal = place - self.place[entry] + self.span  # not below zero
        band = diagonal // STEP
        # A band goes on for the budget after its step; budgets over a step reach more than one band back.
        keys, places = [], []
        for back in range(int(self.budget.max()) // STEP + 2):
            inside = diagonal < (band - back) * STEP + STEP + self.budget[pattern]
            inside &= band >= back
            keys.append(pattern[inside] * (1 << 40) + band[inside] - back)
            places.append(place[inside])
        keys, places = np.concatenate(keys), np.concatenate(places)
        order = np.argsort(keys, kind="stable")
        key, first, n = np.unique(keys[order], return_index=True, return_counts=True)
        enough = n >= self.need[key >> 40]
        return [(int(k >> 40), int(k & (1 << 40) - 1) * STEP - self.span, int(places[order[f]]))
                for k, f in zip(key[enough], first[enough], strict=True)]


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def align(pattern: np.ndarray, text: np.ndarray, low: int, high: int, budget: int) -> tuple[int, int] | None:
    """Least edits, up to ``budget``, between ``pattern`` and any part of ``text`` on diagonals ``low`` to ``high``; and its end.

    Column d of a row stands for the text place ``row + low + d``.  A step down
    in the pattern alone moves a diagonal left, one in the text alone right.
    """
    width, far = high - low + 1, len(pattern) + 1
    slope = np.arange(width)
    row = np.where((low + slope >= 0) & (low + slope <= len(text)), 0, far)  # before the pattern, any place is free
    for i, c in enumerate(pattern):
        places = i + low + slope
        ok = (places >= 0) & (places < len(text))
        differs = np.ones(width, np.int64)
        differs[ok] = text[places[ok]] != c
        now = np.where(ok, row + differs, far)
        now[:-1] = np.minimum(now[:-1], row[1:] + 1)
        now[(places + 1 < 0) | (places + 1 > len(text))] = far
        row = np.minimum.accumulate(now - slope) + slope
        if row.min() > budget:
            return None
    best = int(row.argmin())
    return int(row[best]), min(len(text), max(0, len(pattern) + low + best))


def search(texts: list[str | None], patterns: Patterns) -> list[list[tuple[int, int, int, int]]]:
    """For each text its matches (item, start, end, edits), places in the normalised text; one per item, the best."""
    plain = [normalise(t) for t in texts]
    joined = "\0".join(plain)
    starts = np.cumsum([0] + [len(t) + 1 for t in plain])
    codes = _codes(joined)
    best: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
    if len(patterns.short):
        for found, text in zip(best, plain, strict=True):
            for end, (size, items) in patterns.short.iter(f" {text} "):
                found |= {item: (0, end - size - 1, end - 1) for item in items if item not in found}
    for p, diagonal, place in patterns.candidates(gram_hashes(codes, patterns.q)) if patterns.text else ():
        doc = int(np.searchsorted(starts, place, "right")) - 1
        pattern, item, k = patterns.text[p], patterns.item[p], int(patterns.budget[p])
        if item in best[doc] and best[doc][item][0] == 0:
            continue
        begin, end = int(starts[doc]), int(starts[doc + 1]) - 1
        low, high = diagonal - k, diagonal + STEP + 2 * k
        left, right = max(begin, low), min(end, high + len(pattern) + k)
        exact = joined.find(pattern, left, right)
        if exact >= 0:
            found = 0, exact + len(pattern)
        else:
            found = align(_codes(pattern), codes[left:right], low - left, high - left, k)
            found = found and (found[0], found[1] + left)
        if found and found[0] <= k:
            edits, stop = found
            made = edits, max(0, stop - len(pattern) - begin), stop - begin
            best[doc][item] = min(best[doc].get(item, made), made)
    return [sorted((item, a, b, e) for item, (e, a, b) in found.items()) for found in best]


def find_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
               q: int = 12, window: int = 64, rate: float = 0.05, block_chars: int = 4_000_000, name: str = "matches",
               stride: int = 8) -> DataFrame:
    """``docs`` with the array ``name`` of (item, start, end, edits), sorted; empty if the text has no part of the benchmark.

    One entry per item, that of its pattern with the fewest edits.  Null and
    empty texts match nothing; null items and items without letter or digit are not searched for.  Items of equal text each match.  Rows
    stay as they are, repeated ones too; a column called ``name`` is replaced.
    Empty tables give no matches.
    """
    items = benchmark.select(F.col(item_id).cast("long").alias("item"), F.col(item_text).alias("text")).filter(
        "item is not null and text is not null")
    total = items.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    field = T.StructField("__made", MATCH)
    out = docs.withColumn(name, F.array().cast(MATCH))
    for b in range(blocks):
        rows = [(r.item, r.text) for r in items.filter(part == b).collect()]  # block_chars on average

        def start(rows=rows):
            patterns = Patterns(rows, q, window, rate, stride)
            kinds = ("item", "start", "end", "edits")
            return lambda texts: [[[dict(zip(kinds, m, strict=True)) for m in found] for found in search(texts, patterns)]]

        out = add_columns(out, text_col, [field], start, slice_bytes=2 << 20)
        out = out.withColumn(name, F.array_sort(F.concat(name, "__made"))).drop("__made")
        if b + 1 < blocks:
            out = materialize(out, "decontaminate")
    return out
