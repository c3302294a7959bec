"""License scans by exact set-similarity joins (operator 5).

Two kinds of finding:

* *base*: places where the words of a phrase stand consecutively;
* *blocks*: lines, and runs of words across lines, whose set of words has at least ``threshold`` of a template's.

A run has at most the template's words divided by ``threshold``, so a wrapped or
commented notice is found wherever its lines break.  Lines count first: runs that
touch a line with the same template are left out, and of runs that overlap the
one with the most of the template's words counts.

The block join is exact.  A first pass counts in how many documents each word of
the templates occurs; words are ordered from rare to frequent.  If a block has
at least a = ceil(threshold * |T|) words of template T, it has one of T's first
|T| - a + 1 words (prefix filter), enough words at all (length filter), and the
first common word leaves enough words after it on both sides (positional
filter).  Only blocks that pass are compared in full.  Words outside all
templates can't be common and are left out of a block before the filters.
The templates are a fixed list, so they travel with the tasks.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import add_columns

# The phrases of the base scan with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Label and words of common license notices.
TEMPLATES = [
    ("agpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General "
                 "Public License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance "
                   "with the License. You may obtain a copy of the License at"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
            "following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc0-1.0", "To the extent possible under law, the person who associated CC0 with this work has waived all copyright and related "
                "or neighboring rights to this work."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public "
                "License as published by the Free Software Foundation, either version 3 of the License, or any later version."),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
            "provided that the above copyright notice and this permission notice appear in all copies."),
    ("lgpl-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General "
                 "Public License as published by the Free Software Foundation; either version 2.1 of the License, or any later version."),
    ("mit", "Released under the MIT License."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
            "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the "
            "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
                "distributed with this file, You can obtain one at"),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
]

#: Bytes to bytes: A-Z to lower case, ASCII digits, letters and all beyond ASCII as they are, the rest to spaces.
_WORD_BYTES = bytes(c if c >= 128 or chr(c).isdigit() or chr(c).islower() else c + 32 if chr(c).isupper() else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_WORD_BYTES).split()


def places(found: list[bytes], phrases: dict[str, str]) -> list[tuple[int, str]]:
    """(first word, label) wherever the words of a phrase stand consecutively."""
    joined = b" " + b" ".join(found) + b" "
    out = []
    for phrase, label in phrases.items():
        wanted = b" " + phrase.encode() + b" "
        at = joined.find(wanted)
        counted, word = 0, 0
        while at >= 0:
            word += joined.count(b" ", counted, at)
            counted = at
            out.append((word, label))
            at = joined.find(wanted, at + 1)
    return out


class Templates:
    """Templates with the index of their prefixes under a word order."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], threshold: float):
        self.label = [label for label, _ in templates]
        self.words = [frozenset(words(text)) for _, text in templates]
        every = sorted({w for t in self.words for w in t}, key=lambda w: (frequency.get(w, 0), w))
        self.rank = {w: i for i, w in enumerate(every)}
        # Less a billionth, so that a product like 0.8 * 5 that rounds up does not ask for one more.
        self.need = [math.ceil(threshold * len(t) - 1e-9) for t in self.words]
        # Words of a block, in a line or across lines.
        self.reach = [int(len(words(text)) / threshold + 1e-9) for _, text in templates]
        self.prefix: dict[bytes, list[tuple[int, int]]] = {}
        for i, t in enumerate(self.words):
            for at, w in enumerate(sorted(t, key=self.rank.get)[: len(t) - self.need[i] + 1]):
                self.prefix.setdefault(w, []).append((i, at))
        self.first = frozenset(self.prefix)
        self.known = frozenset(self.rank)

    def match(self, block: set[bytes]) -> list[tuple[int, float]]:
        """(template, containment) of every template that the block holds enough of."""
        own = sorted(block & self.known, key=self.rank.get)
        tried, out = set(), []
        for j, w in enumerate(own):
            for i, at in self.prefix.get(w, ()):
                if i in tried:
                    continue
                tried.add(i)  # ``w`` is their first common word
                size = len(self.words[i])
                if len(own) >= self.need[i] and 1 + min(size - at - 1, len(own) - j - 1) >= self.need[i]:
                    common = len(self.words[i].intersection(own))
                    if common >= self.need[i]:
                        out.append((i, common / size))
        return out


    def near(self, found: list[bytes], template: int, share: float) -> float:
        """The largest containment of the template in words of ``found`` that stand as near as its length allows; 0 if too small."""
        if len(found) <= self.reach[template]:
            return share
        return max((s for _, s in self.runs(found, [0] * len(found), template, set())), default=0.0)

    def runs(self, found: list[bytes], lines: list[int], template: int, taken: set[int]) -> list[tuple[int, float]]:
        """(line, containment) of the runs of ``found`` across lines that hold enough of the template.

        ``lines`` is the line of each word; runs that touch a line in ``taken`` don't count.
        """
        wanted, need, reach = self.words[template], self.need[template], self.reach[template]
        at = [i for i, w in enumerate(found) if w in wanted]
        held: Counter = Counter()
        windows, first = [], 0
        for i in at:
            held[found[i]] += 1
            while i - at[first] >= reach or held[found[at[first]]] > 1:
                held[found[at[first]]] -= 1
                if not held[found[at[first]]]:
                    del held[found[at[first]]]
                first += 1
            if len(held) >= need and taken.isdisjoint(range(lines[at[first]], lines[i] + 1)):
                windows.append((at[first], i, len(held)))
        out, done, k = [], -1, 0
        while k < len(windows):
            if windows[k][0] <= done:
                k += 1
                continue
            end, best = windows[k][1], windows[k]
            while k < len(windows) and windows[k][0] <= end:
                if windows[k][2] > best[2]:
                    best = windows[k]
                k += 1
            done = best[1]
            out.append((lines[best[0]], best[2] / len(wanted)))
        return out


def word_frequencies(docs: DataFrame, templates: list[tuple[str, str]], text_col: str = "text") -> dict[bytes, int]:
    """In how many rows each word of the templates occurs."""
    known = frozenset(w for _, text in templates for w in words(text))

    def run(batches):
        counts: Counter = Counter()
        for batch in batches:
            for text in batch.column(0):
                counts.update(known.intersection(words(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
                                         names=["word", "n"])

    rows = docs.select(text_col).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return {bytes(r.word): r.n for r in rows.collect()}  # at most the words of the templates


BLOCKS = T.ArrayType(T.StructType([T.StructField("line", T.LongType()), T.StructField("label", T.StringType()),
                                   T.StructField("template", T.LongType()), T.StructField("containment", T.DoubleType())]))
_FIELDS = [T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()), T.StructField("first_word", T.LongType()),
           T.StructField("last_word", T.LongType()), T.StructField("base_labels", T.StringType()),
           T.StructField("labels", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("blocks", BLOCKS)]


def scan(docs: DataFrame, text_col: str = "text", threshold: float = 0.8, phrases: dict[str, str] | None = None,
         templates: list[tuple[str, str]] | None = None) -> DataFrame:
    """``docs`` with the findings of each whole text.

    ``n_words``; ``n_base`` places of the phrases, the first and last place
    (words from 0, null without one) and ``base_labels``; ``blocks`` (line from
    0, label, template's number, containment) of all lines, and runs of words
    across lines (their first line), with at least ``threshold`` of a template's words; ``labels`` of both kinds; ``score``: 1
    with a base label, else the largest containment, else 0.  Labels are
    distinct, sorted and comma-joined, empty without any.  Null texts count as
    empty; every row gives one row; columns that have the name of an output are
    replaced; an empty table gives an empty one.
    """
    phrases = PHRASES if phrases is None else phrases
    templates = TEMPLATES if templates is None else templates
    frequency = word_frequencies(docs, templates, text_col)

    def start():
        index = Templates(templates, frequency, threshold)

        def one(text):
            found = words(text)
            base = places(found, phrases)
            blocks = []
            if not index.first.isdisjoint(found):
                parts = [words(part) for part in text.split("\n")]
                hits = [(line, i, near) for line, part in enumerate(parts) for i, share in index.match(set(part))
                        if (near := index.near(part, i, share))]
                if len(parts) > 1:
                    ends = list(accumulate(map(len, parts)))
                    lines = None
                    for i, _ in index.match(set(found)):
                        lines = lines or [bisect_right(ends, k) for k in range(len(found))]
                        hits += [(line, i, share) for line, share in index.runs(found, lines, i, {h[0] for h in hits if h[1] == i})]
                blocks = [{"line": line, "label": index.label[i], "template": i, "containment": share}
                          for line, i, share in sorted(hits, key=lambda h: h[:2])]
            at = [p for p, _ in base]
            base_labels = {label for _, label in base}
            score = 1.0 if base else max((b["containment"] for b in blocks), default=0.0)
            return (len(found), len(base), min(at, default=None), max(at, default=None), ",".join(sorted(base_labels)),
                    ",".join(sorted(base_labels | {b["label"] for b in blocks})), score, blocks)

        return lambda texts: list(zip(*map(one, texts), strict=True))

    return add_columns(docs, text_col, _FIELDS, start)
