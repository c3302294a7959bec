"""Bounded streams pass the state as packs of many rows; counts and kept rows stay exact."""

import random
from collections import defaultdict

import pyarrow as pa
from pyspark.sql.types import LongType, StructField

from veilspark.streaming import bounding


class _Map(dict):
    def getValue(self, key):
        return self.get(key)

    def updateValue(self, key, value):
        self[key] = value


def test_packs_keep_first_arrivals_over_batches(monkeypatch):
    monkeypatch.setattr(bounding, "HELD_ROWS", 40)
    rng, limit = random.Random(1), 5
    state, counted, kept, expected = defaultdict(_Map), defaultdict(int), [], []
    for trigger in range(3):
        rows = [{"u": rng.randrange(8), "t": rng.choice([None, *range(10)]), "id": trigger * 1000 + i} for i in range(300)]
        rows = [r | {bounding._BUCKET: r["u"] % 2} for r in rows]
        batches = [pa.RecordBatch.from_pylist(rows[i : i + 30]) for i in range(0, 300, 30)]
        packs = [p for b in bounding._partial_first_arrivals("u", ["t", "id"], limit)(batches) for p in b.to_pylist()]
        assert len(packs) == 2 * 5  # a pack for each group and buffer of 60 rows, not a row for each of 300
        for group in (0, 1):
            processor = bounding._FirstArrivals(limit, StructField("u", LongType()), ["t", "id"])
            processor.seen = state[group]
            out = list(processor.handleInputRows((group,), iter([p for p in packs if p[bounding._BUCKET] == group]), None))
            for b in bounding._unpacked([pa.RecordBatch.from_pylist([r.asDict() for r in out], pa.schema([("pack", pa.binary())]))]):
                assert b.schema.names == ["u", "t", "id"]
                kept += [r["id"] for r in b.to_pylist()]
        for u in range(8):
            mine = sorted((r for r in rows if r["u"] == u), key=lambda r: (r["t"] is not None, r["t"] or 0, r["id"]))
            expected += [r["id"] for r in mine[: max(0, limit - counted[u])]]
            counted[u] += len(mine)
    assert sorted(kept) == sorted(expected)
    assert all(n >= limit for m in state.values() for (n,) in m.values())
