"""Sharding by a consistent-hash ring with bounded loads (operator 1).

Every shard has ``vnodes`` points on a ring of 2^16 cells; a row belongs to the
first point clockwise from the hash of its id (its *arc*), and through it to a
shard, its home.  Rows are placed from large to small (by 1/512 of an octave, then by
a second hash): a row goes to the first shard clockwise that is not full, and a
shard is full once its bytes reach ``(1 + slack)`` times the mean.  So no shard
exceeds that by more than the row that filled it, none falls short of the mean by
more than ``(shards - 1) * slack`` and those rows, and only rows whose home has
filled up move.  Large rows first, since the last ones then even out the loads.

Placing is a sequence, but what it decides is only when each shard fills: at
most once for each.  Bytes per (64 buckets of the order, arc) say in which
bucket the next shard fills; that bucket alone is cut into finer ones until its
rows are few enough to be walked one by one.  The list of fillings then gives
every row its shard by comparing its place in the order with them.
"""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from veilspark.session import materialize

_CELLS = 1 << 16
_BITS = 6  # of the order that a level of buckets takes
KEY = ["prio", "doc_id", "text_crc32", "size"]


def ring(shards: int, vnodes: int) -> tuple[np.ndarray, np.ndarray]:
    """(arc of each cell, home of each arc): points sorted by cell, then shard."""
    points = sorted((xxhash.xxh64_intdigest(f"{s}:{v}") >> 48, s) for s in range(shards) for v in range(vnodes))
    cells = np.array([c for c, _ in points])
    return np.searchsorted(cells, np.arange(_CELLS)) % len(points), np.array([s for _, s in points])


def clockwise(home: np.ndarray, is_open: np.ndarray) -> np.ndarray:
    """For each arc the first open shard from its point on."""
    at = np.flatnonzero(is_open[home])
    return home[at[np.searchsorted(at, np.arange(len(home))) % len(at)]]


class Filling:
    """The state of placing: loads, open shards, and the places in the order at which shards filled up."""

    def __init__(self, shards: int, home: np.ndarray, bound: int):
        self.load = np.zeros(shards, np.int64)
        self.open = np.ones(shards, bool)
        self.home, self.bound = home, bound
        self.maps = [clockwise(home, self.open)]  # arc to shard, one for each stretch between fillings
        self.ends: list[tuple] = []  # the key of the row that filled a shard
        self.splits: list[tuple] = []  # (key, shard, copies) of equal rows that a filling divides

    def fits(self, arc_bytes: np.ndarray) -> bool:
        """Adds the bytes unless some shard would fill up on the way."""
        add = np.bincount(self.maps[-1], arc_bytes, len(self.load)).astype(np.int64)
        if self.open.sum() > 1 and (self.open & (add > 0) & (self.load + add >= self.bound)).any():
            return False
        self.load += add
        return True

    def place(self, key: tuple, size: int, arc: int, copies: int) -> None:
        """One row, or equal rows."""
        parts = []
        while copies:
            shard = int(self.maps[-1][arc])
            last = self.open.sum() == 1
            n = copies if last else min(copies, max(1, -(-(self.bound - int(self.load[shard])) // size)))
            self.load[shard] += n * size
            copies -= n
            parts.append((key, shard, n))
            if not last and self.load[shard] >= self.bound:
                self.open[shard] = False
                self.maps.append(clockwise(self.home, self.open))
                self.ends.append(key)
        if len(parts) > 1:
            self.splits += parts


def _arc_bytes(rows: DataFrame, shift: int, arcs: int) -> dict[int, tuple[np.ndarray, int]]:
    """Per bucket (the order shifted) the bytes of each arc and the number of different rows."""
    got = rows.groupBy(F.shiftright("prio", shift).alias("bucket"), "arc").agg(
        F.sum(F.col("size") * F.col("copies")).alias("bytes"), F.count("*").alias("n")).toArrow()  # 64 buckets at most
    bucket, arc, size, n = (got[c].to_numpy() for c in ("bucket", "arc", "bytes", "n"))
    return {int(b): (np.bincount(arc[bucket == b], size[bucket == b], arcs).astype(np.int64), int(n[bucket == b].sum()))
            for b in np.unique(bucket)}


def fill(rows: DataFrame, state: Filling, shift: int = 64 - _BITS, most_rows: int = 200_000) -> None:
    """Places all ``rows`` (prio, doc_id, text_crc32, size, arc, copies) in order, as far as fillings need it."""
    buckets = _arc_bytes(rows, shift, len(state.home))
    for bucket in sorted(buckets):
        arc_bytes, n = buckets[bucket]
        if state.fits(arc_bytes):
            continue
        inside = rows.filter(F.shiftright("prio", shift) == bucket)
        if n > most_rows and shift >= _BITS:
            fill(inside, state, shift - _BITS, most_rows)
            continue
        got = inside.select(*KEY, "arc", "copies").toArrow().to_pydict()
        for *key, arc, copies in sorted(zip(*got.values(), strict=True), key=lambda r: (r[0], r[1] is not None, r[1] or 0, *r[2:4])):
            state.place(tuple(key), key[-1], arc, copies)


def _key_struct(values: tuple | None = None):
    if values is None:
        return F.struct(*KEY)
    return F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(KEY, values, strict=True)])


def place(docs: DataFrame, shards: int = 16, vnodes: int = 256, slack: float = 0.002, id_col: str = "doc_id",
          text_col: str = "text") -> DataFrame:
    """``doc_id``, ``size``, ``text_crc32``, ``law`` ('bytes'), ``shard``, ``slot``, ``grown_shard`` (null) and ``home_shard``.

    ``size``: UTF-8 bytes of the text plus one; a null text counts as empty.
    ``slot``: place in the shard, from 0 without gaps, in the order of the
    hash.  Null ids share one home and spread from it as it fills.  Equal rows are
    counted once and come back as often as they were; a filling may divide
    them.  Columns besides id and text play no part.  An empty table gives an
    empty one.
    """
    spark = docs.sparkSession
    arc_of_cell, home = ring(shards, vnodes)
    cells = spark.createDataFrame([(c, int(a)) for c, a in enumerate(arc_of_cell)], "cell long, arc int")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    rows = rows.groupBy("doc_id", "size", "text_crc32").agg(F.count("*").alias("copies"))
    rows = rows.withColumns({
        "cell": F.shiftrightunsigned(F.xxhash64(F.lit("ring"), "doc_id"), 48),
        "h": F.xxhash64(F.lit("order"), "doc_id", "text_crc32", "size")})
    octaves = F.floor(512 * F.log2("size")).cast("long")  # under 2^15 for any size
    rows = rows.withColumn("prio", F.shiftleft(F.lit(32767) - octaves, 48) + F.shiftrightunsigned("h", 16))
    rows = materialize(rows.join(F.broadcast(cells), "cell").drop("cell"), "ring-rows")

    total = rows.agg(F.sum(F.col("size") * F.col("copies"))).first()[0] or 0
    state = Filling(shards, home, max(1, -(-int(total * (1 + slack) * 1_000_000) // (shards * 1_000_000))))
    fill(rows, state)

    stretch = sum((F.when(_key_struct() > _key_struct(k), 1).otherwise(0) for k in state.ends), F.lit(0))
    lookup = spark.createDataFrame(
        [(e, a, int(s), int(home[a])) for e, m in enumerate(state.maps) for a, s in enumerate(m)],
        "stretch int, arc int, shard int, home_shard int")  # stretches x points
    placed = rows.withColumn("stretch", stretch.cast("int")).join(F.broadcast(lookup), ["stretch", "arc"])
    if state.splits:
        divided = F.array(*[F.struct(_key_struct(k).alias("k"), F.lit(s).alias("shard"), F.lit(n).cast("long").alias("copies"))
                            for k, s, n in state.splits])
        own = F.filter(divided, lambda x: x["k"].eqNullSafe(_key_struct()))
        whole = F.array(F.struct(_key_struct().alias("k"), "shard", "copies"))
        placed = placed.withColumn("part", F.explode(F.when(F.size(own) > 0, own).otherwise(whole)))
        placed = placed.withColumns({"shard": F.col("part.shard"), "copies": F.col("part.copies")}).drop("part")
    # Places within 4096 ranges of the hash per shard, then the rows before each range.
    placed = placed.withColumn("slice", F.shiftrightunsigned("h", 52))
    before = Window.partitionBy("shard").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed.groupBy("shard", "slice").agg(F.sum("copies").alias("n"))
    offsets = offsets.select("shard", "slice", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    within = Window.partitionBy("shard", "slice").orderBy("h", *KEY[1:]).rowsBetween(Window.unboundedPreceding, -1)
    placed = placed.withColumn("slot", F.coalesce(F.sum("copies").over(within), F.lit(0)))
    placed = placed.join(F.broadcast(offsets), ["shard", "slice"])  # at most shards x 4096 rows
    copy = F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1))
    return placed.withColumn("copy", copy).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("offset") + F.col("slot") + F.col("copy")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "home_shard")
