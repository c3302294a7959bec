"""SimHash near-duplicates with pigeonring filtering (operator 4).

Each text becomes a 64-bit fingerprint: bit ``b`` is set if it is set in over
half the hashes of the text's word shingles.  Two fingerprints link if at most
``distance`` bits differ; documents in one connected component are near
duplicates.

Candidates.  Cut the 64 bits into ``distance + 1`` segments, arranged in a
ring.  If all differences together are at most ``distance``, some segment has
a clockwise chain from it in which, for every length l, the first l segments
together differ in at most ``floor(l * distance / (distance + 1)) = l - 1``
bits (pigeonring principle).  So the first segment is equal and the next one
differs in at most one bit, hence one of its halves is equal.  Fingerprints
that share (segment, its bits, a half of the next, its bits) meet in one
*bucket*; the rest of the chain and the full distance are checked there.

Buckets.  Only distinct fingerprints take part, so exact copies cost one row.
Within a bucket a search from member to member compares each reached member
with those not reached yet and emits only the tree of links it walks: at most
one row per member, whatever the size of the group.  Since a bucket only needs
to report which of its members hang together, no link is lost.  Buckets over
``bucket_rows`` members are cut again by further bits: of the bits outside the
bucket's own, at most ``distance`` differ, so one of ``distance + 1`` parts of
them is equal.

Components come from the links by repeated hooking to the smallest neighbour
and pointer jumping, each round written to the shared folder.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.llm.common import add_columns
from veilspark.session import materialize

SEED = 42


def fingerprint(text: str | None, shingle: int) -> int:
    """Fingerprint of one text: A-Z to lower case, words at ASCII white space, shingles joined by a space."""
    words = (text or "").encode().lower().split()  # on bytes, both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(words) - size + 1].tolist()
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops, strict=True)), np.uint64, len(starts))
    set_bits = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 4096):  # 64 bytes a hash, a slice at a time
        part = hashes[at : at + 4096]
        set_bits += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    over = (2 * set_bits > len(hashes)).astype(np.uint8)
    return int(np.packbits(over, bitorder="little").view(np.uint64)[0])


def with_fingerprints(df: DataFrame, text_col: str = "text", shingle: int = 3, name: str = "fp") -> DataFrame:
    """``df`` with the fingerprint as a (signed) long; null, empty and blank texts give 0."""

    def start():
        def columns(texts):
            prints = np.fromiter((fingerprint(t, shingle) for t in texts), np.uint64, len(texts))
            return [pa.array(prints.view(np.int64))]

        return columns

    return add_columns(df, text_col, [T.StructField(name, T.LongType())], start)


def _segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, number of bits) of each segment, bit 0 the lowest."""
    m = distance + 1
    cuts = [64 * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def _mask(at: int, n: int) -> int:
    return ((1 << n) - 1) << at


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def bucket_masks(distance: int) -> list[int]:
    """The bits that members of a bucket share, one mask per kind of bucket."""
    parts = _segments(distance)
    if distance == 0:
        return [_mask(0, 64)]
    masks = []
    for i, (at, n) in enumerate(parts):
        next_at, next_n = parts[(i + 1) % len(parts)]
        half = next_n // 2
        masks += [_mask(at, n) | _mask(next_at, half), _mask(at, n) | _mask(next_at + half, next_n - half)]
    return masks


def finer_masks(mask: int, distance: int) -> list[int]:
    """``mask`` with one of ``distance + 1`` parts of the bits outside it each."""
    rest = [b for b in range(64) if not mask >> b & 1]
    m = distance + 1
    return [mask | sum(1 << b for b in rest[len(rest) * i // m : len(rest) * (i + 1) // m]) for i in range(m)]


def _keyed(prints: DataFrame, masks: list[int]) -> DataFrame:
    """One row per fingerprint and mask: ``mask`` and the bits under it as ``bits``."""
    keys = F.array(*[F.struct(F.lit(_signed(m)).cast("long").alias("mask"),
                              F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("long")).alias("bits")) for m in masks])
    return prints.select("fp", F.explode(keys).alias("k")).select("fp", "k.mask", "k.bits")


def chain_holds(difference: np.ndarray, distance: int) -> np.ndarray:
    """For each xor of two fingerprints: has some segment a chain within its proportional budgets at every length."""
    parts = _segments(distance)
    counts = np.stack([np.bitwise_count(difference & np.uint64(_mask(a, n))) for a, n in parts]).astype(np.int64)
    m = len(parts)
    found = np.zeros(len(difference), bool)
    for i in range(m):
        total, good = np.zeros(len(difference), np.int64), np.ones(len(difference), bool)
        for length in range(1, m + 1):
            total += counts[(i + length - 1) % m]
            good &= total <= length * distance // m
        found |= good
    return found


def walk(members: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """Links that hold the connected members together: each member reached, with the one that reached it.

    A reached member is compared with all that are not reached yet, a block at
    a time; a pair must pass the chain test before its full distance counts.
    """
    links, left = [], members
    while len(left):
        open_, left = [left[0]], left[1:]
        while open_ and len(left):
            near_to = open_.pop()
            difference = left ^ near_to
            near = np.zeros(len(left), bool)
            # The first test of every chain: one segment without a difference.
            for a, n in _segments(distance):
                near |= (difference & np.uint64(_mask(a, n))) == 0
            some = np.flatnonzero(near)
            some = some[chain_holds(difference[some], distance)]
            some = some[np.bitwise_count(difference[some]) <= distance]
            if len(some):
                reached = left[some]
                links += [(int(near_to), int(x)) for x in reached]
                open_ += list(reached)
                left = np.delete(left, some)
    return links


def _walk_buckets(keyed: DataFrame, distance: int) -> DataFrame:
    """Links within each bucket.  A task holds one bucket at a time; rows of a bucket are next to each other."""
    ordered = keyed.repartition("mask", "bits").sortWithinPartitions("mask", "bits", "fp").select("mask", "bits", "fp")

    def emit(groups):
        links = [x for g in groups if len(g) > 1 for x in walk(g, distance)]
        if links:
            a, b = np.array(links, np.uint64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    def run(batches):
        key, held = None, []  # of the bucket that the last batch may not have ended
        for batch in batches:
            mask, bits, fp = (batch.column(i).to_numpy() for i in range(3))
            fp = fp.view(np.uint64)
            cuts = np.flatnonzero((mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])) + 1
            groups = np.split(fp, cuts)
            if held and key == (mask[0], bits[0]):
                held.append(groups.pop(0))
            if groups:
                done = [np.concatenate(held)] if held else []
                yield from emit([*done, *groups[:-1]])
                held = [groups[-1]]
            key = (mask[-1], bits[-1])
        if held:
            yield from emit([np.concatenate(held)])

    return ordered.mapInArrow(run, "a long, b long")


def links(prints: DataFrame, distance: int = 3, bucket_rows: int = 4096) -> DataFrame:
    """Links ``a``, ``b`` between distinct fingerprints (column ``fp``) that connect all within ``distance`` bits."""
    found = None
    keyed = _keyed(prints, bucket_masks(distance))
    for level in range(3):
        sizes = materialize(keyed.groupBy("mask", "bits").agg(F.count("*").alias("n")).filter("n > 1"), "simhash-buckets")
        large = sizes.filter(F.col("n") > bucket_rows)
        here = keyed.join(sizes.filter(F.col("n") <= bucket_rows) if level < 2 else sizes, ["mask", "bits"], "left_semi")
        made = _walk_buckets(here, distance)
        found = made if found is None else found.unionByName(made)
        if distance == 0 or level == 2 or large.isEmpty():
            break
        kinds = [r[0] for r in large.select("mask").distinct().collect()]  # at most 8, then 32 kinds
        crowded = keyed.join(large, ["mask", "bits"], "left_semi")
        finer = F.create_map(*[x for k in kinds for x in (
            F.lit(k).cast("long"),
            F.array(*[F.lit(_signed(m)).cast("long") for m in finer_masks(k & (1 << 64) - 1, distance)]))])
        keyed = materialize(
            crowded.select("fp", F.explode(finer[F.col("mask")]).alias("mask"))
            .select("fp", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("bits")).distinct(), "simhash-finer")
    return materialize(found.distinct(), "simhash-links")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """``node``, ``root`` for all ends of ``edges`` (a, b): the smallest node of each connected component.

    Every round points each node, and the node it points to, at the smallest
    root seen around it, and then at what that one points to; so paths shorten
    by half at least, and rounds end when nothing moves.
    """
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialize(both.filter("a != b").distinct(), "components-edges")
    now = materialize(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")), "components")
    for _ in range(most_rounds):
        around = (both.join(now.select(F.col("node").alias("b"), F.col("root").alias("seen")), "b")
                  .groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen")))
        offered = now.join(around, "node")
        hooked = (offered.select("node", F.least("root", "seen").alias("root"), F.col("root").alias("was"))
                  .unionByName(offered.select(F.col("root").alias("node"), F.col("seen").alias("root"), F.lit(None).cast("long").alias("was")))
                  .groupBy("node").agg(F.min("root").alias("root"), F.max("was").alias("was")))
        jump = hooked.select(F.col("node").alias("root"), F.col("root").alias("beyond"))
        after = materialize(hooked.join(jump, "root").select("node", "was", F.col("beyond").alias("root")), "components")
        moved = not after.filter("root != was").isEmpty()
        now = after.select("node", "root")
        if not moved:
            return now
    raise RuntimeError(f"components did not settle in {most_rounds} rounds")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, distance: int = 3,
                    keep: list[str] | None = None, bucket_rows: int = 4096) -> DataFrame:
    """The columns ``keep`` of ``df`` (default: all) with ``fingerprint`` (16 hex digits), ``component_id``
    and ``representative``, true for one row of each component: a row with its smallest id.

    ``component_id`` is the smallest id among the rows that links reach from
    the row, itself included; null ids count in no minimum, and a component of
    null ids only has null.  Null, empty and blank texts have fingerprint zero
    and link like any other.  Every row gives one row, repeated ones too.
    Input columns that have the name of an output are replaced.  An empty
    table gives an empty one.
    """
    keep = [c for c in (keep or df.columns) if c.lower() not in ("fingerprint", "component_id", "representative")]
    held = {f"__k{i}": c for i, c in enumerate(dict.fromkeys([*keep]))}
    narrow = df.select(*[F.col(c).alias(k) for k, c in held.items()], F.col(id_col).alias("__id"), F.col(text_col).alias("__text"),
                       F.monotonically_increasing_id().alias("__row"))
    printed = with_fingerprints(narrow, "__text", shingle, "fp").drop("__text")
    printed = materialize(printed, "simhash-prints")
    prints = printed.groupBy("fp").agg(
        F.min("__id").alias("first"), F.min(F.struct(F.col("__id").isNull(), "__id", "__row")).alias("chosen"))
    roots = components(links(prints.select("fp"), distance, bucket_rows))
    prints = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", "chosen", F.coalesce("root", "fp").alias("root"))
    least = prints.groupBy("root").agg(F.min("first").alias("component_id"), F.min("chosen")["__row"].alias("chosen_row"))
    named = prints.join(least, "root").select("fp", "component_id", "chosen_row")
    return printed.join(named, "fp").select(
        *[F.col(k).alias(c) for k, c in held.items()],
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id",
        (F.col("__row") == F.col("chosen_row")).alias("representative"))
