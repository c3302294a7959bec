"""Prefix trie of conversations as balanced parentheses (operator 12).

A conversation is a path of turn symbols (128 bits of a turn and its depth), a
node is known by the XOR of the symbols down to it.  Equal paths are one row
with a count before anything is sorted, so a conversation that a third of all
rows repeat is one path.  Paths are range-sorted, which puts a trie's nodes in
preorder, and cut into *shards* of about ``shard_turns`` turns; a task holds
one shard at a time and writes it as parentheses, one pair for each node:

* findclose, over blocks with their least excess in a tree, gives where each
  node's subtree ends; a node's subtree is a span of preorder;
* rank over the pairs ``()`` counts a span's leaves;
* running sums over preorder of conversation ends and of savings, differences
  of which are a span's members and savings.

Only nodes on a shard's first and last path (its *spines*) can have parts in
other shards.  Shards leave out what a spine node counts for itself; parts of
one node are summed, what it counts for itself is added once, in the shard that
owns it, and runs up that shard's spine as a suffix sum.

Paths of over ``segment`` turns go on in a trie of their own, rooted where the
segment before ends; deeper segments come first and hand their root's totals
up, so a row never has more than ``segment`` turns, however long a conversation.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspark.operators.scan import keyed_row_number
from veilspark.session import materialize

BLOCK = 64
#: Spine rows (about 100 bytes each) up to which their table is broadcast.
FEW_ROWS = 100_000
EMPTY_HASH = hashlib.sha256(b"").hexdigest()

NODES = ("k1 long, k2 long, p1 long, p2 long, depth long, first long, parent_first long, n long, children long, leaves long, "
         "saved long, words long, goes_on boolean, shard long, chain int")


class Parentheses:
    """A balanced sequence (1 opens) with the least excess of each block of 64 and of pairs of blocks, and so on."""

    def __init__(self, bits: np.ndarray):
        self.excess = np.cumsum(2 * bits.astype(np.int64) - 1)
        blocks = -(-len(bits) // BLOCK)
        high = np.iinfo(np.int64).max
        padded = np.full(blocks * BLOCK, high)
        padded[: len(bits)] = self.excess
        level, self.first, least = padded.reshape(-1, BLOCK).min(1), [], []
        at = 0
        while True:
            level = np.append(level, high) if len(level) % 2 else level
            self.first.append(at)
            least.append(level)
            at += len(level)
            if len(level) == 2:
                break
            level = level.reshape(-1, 2).min(1)
        self.least, self.first = np.concatenate(least), np.array(self.first)
        self.padded = padded

    def _scan(self, at: np.ndarray, target: np.ndarray, stop: np.ndarray) -> np.ndarray:
        """First place from ``at`` before ``stop`` with an excess of at most ``target``, else ``stop``."""
        at = at.copy()
        open_ = np.flatnonzero(at < stop)
        while len(open_):
            open_ = open_[self.padded[at[open_]] > target[open_]]
            at[open_] += 1
            open_ = open_[at[open_] < stop[open_]]
        return at

    def findclose(self, opens: np.ndarray) -> np.ndarray:
        """Where each opening parenthesis at ``opens`` is closed: the first place after it with less excess."""
        target = self.excess[opens] - 1
        stop = (opens // BLOCK + 1) * BLOCK
        found = self._scan(opens + 1, target, stop)
        far = np.flatnonzero(found == stop)
        if not len(far):
            return found
        goal, index = target[far], stop[far] // BLOCK
        level = np.zeros(len(far), np.int64)
        climbing = np.arange(len(far))
        while len(climbing):  # to the first span, left to right, that goes low enough
            climbing = climbing[self.least[self.first[level[climbing]] + index[climbing]] > goal[climbing]]
            up = index[climbing] % 2 == 1
            index[climbing] += 1
            index[climbing[up]] //= 2
            level[climbing[up]] += 1
        while (down := np.flatnonzero(level > 0)).size:
            level[down] -= 1
            index[down] *= 2
            index[down] += self.least[self.first[level[down]] + index[down]] > goal[down]
        found[far] = self._scan(index * BLOCK, goal, (index + 1) * BLOCK)
        return found


class RangeMin:
    """Least value of any span, from the least of spans of each power of two."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            last, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, begin: np.ndarray, stop: np.ndarray) -> np.ndarray:
        size = stop - begin
        power = np.frexp(size.astype(float))[1] - 1
        out = np.empty(len(begin), self.levels[0].dtype)
        for p in np.unique(power).tolist():
            at = np.flatnonzero(power == p)
            out[at] = np.minimum(self.levels[p][begin[at]], self.levels[p][stop[at] - 2**p])
        return out


def shard_nodes(roots: np.ndarray, lengths: np.ndarray, symbols: np.ndarray, words: np.ndarray, n: np.ndarray, first: np.ndarray,
                goes_on: np.ndarray, below: np.ndarray) -> dict[str, np.ndarray]:
    """All nodes of sorted distinct paths, preorder; root of path i is ``roots[i]`` (two integers), its symbols follow.

    ``n`` conversations have a path, the least is ``first``.  Where a path
    ``goes_on`` in a deeper segment, ``below`` has that segment's children of
    the root, leaves and savings.  Spine nodes lack what they count for themselves.
    """
    size = lengths + 1
    start = np.cumsum(size) - size
    total, rows = int(size.sum()), len(size)
    row = np.repeat(np.arange(rows), size)
    pos = np.arange(total) - start[row]
    x, w = np.empty((total, 2), np.int64), np.zeros(total, np.int64)
    x[start], x[pos > 0], w[pos > 0] = roots, symbols, words
    # What a path shares with the one before it.
    before = np.maximum(row - 1, 0)
    there = (row > 0) & (pos < size[before])
    same = there.copy()
    at = np.flatnonzero(there)
    same[at] = (x[at] == x[start[before[at]] + pos[at]]).all(1)
    shared = np.minimum(np.minimum.reduceat(np.where(same, total, pos), start), size)
    new = pos >= shared[row]
    depth, w = pos[new], w[new]
    xor = np.bitwise_xor.accumulate(x, axis=0)
    lead = np.zeros((rows, 2), np.int64)
    lead[1:] = xor[start[1:] - 1]
    keys = xor[new] ^ lead[row[new]]
    end = np.cumsum(new)[start + size - 1] - 1  # the node where each path ends

    counts = np.zeros(2 * rows + 2, np.int64)  # closing, opening, closing, ...
    counts[2:-1:2] = size - np.append(shared[1:], 0)
    counts[1:-2:2] = size - shared
    bits = np.repeat(np.arange(len(counts)) % 2 == 1, counts)
    opens = np.flatnonzero(bits)
    closes = Parentheses(bits).findclose(opens)
    nodes = len(opens)
    preorder = np.arange(nodes)
    stop = preorder + (closes - opens + 1) // 2

    place = depth * (nodes + 1) + preorder
    ordered = np.sort(place)
    parent = np.full(nodes, -1)
    inner = np.flatnonzero(depth)
    parent[inner] = ordered[np.searchsorted(ordered, (depth[inner] - 1) * (nodes + 1) + inner) - 1] % (nodes + 1)

    running = lambda values: np.concatenate(([0], np.cumsum(values)))
    span = lambda values: (sums := running(values))[stop] - sums[preorder]
    ends = np.zeros(nodes, np.int64)
    ends[end] = n
    members = span(ends)
    least = np.full(nodes, np.iinfo(np.int64).max)
    least[end] = first
    least = RangeMin(least)(preorder, stop)

    spine = np.zeros(nodes, bool)
    spine[: size[0]] = True
    last = []
    node = int(end[-1])
    while node >= 0:
        last.append(node)
        node = int(parent[node])
    last = np.array(last[::-1])
    spine[last] = True

    pairs = running(bits & ~np.append(bits[1:], True))  # leaf pairs that start before each place
    own = (pairs[closes] - pairs[opens] == 1) & (closes == opens + 1)
    extra = np.where(own & spine, -1, 0)
    on = end[goes_on]
    extra[on] = below[goes_on, 1] - 1
    leaves = pairs[closes] - pairs[opens] + span(extra)
    savings = np.where(spine, 0, (members - 1) * w)
    savings[on] += below[goes_on, 2]
    children = np.bincount(parent[~spine & (depth > 0)], minlength=nodes)
    children[on] += below[goes_on, 0]
    more = np.zeros(nodes, bool)
    more[on] = True
    chain = np.full(nodes, -1)
    chain[last] = 1
    chain[: size[0]] = 0
    above = np.maximum(parent, 0)
    made = {"key": keys, "parent": np.where(parent[:, None] >= 0, keys[above], 0), "depth": depth, "first": least,
            "parent_first": least[above], "known": (parent >= 0) & ~spine[above], "n": members, "children": children, "leaves": leaves,
            "saved": span(savings), "words": w, "goes_on": more, "chain": chain}
    both = last[chain[last] == 0]  # on both spines: the second row of each counts nothing
    if len(both) and not (rows == 1):
        again = {k: v[both].copy() for k, v in made.items()}
        for k in ("n", "children", "leaves", "saved"):
            again[k][:] = 0
        again["chain"][:] = 1
        made = {k: np.concatenate((v, again[k])) for k, v in made.items()}
    return made


def _level(paths: DataFrame, level: int, segment: int, shard_turns: int) -> DataFrame:
    """Nodes of the tries of one segment: ``paths`` has k1, k2, path, words, n, first, goes_on, children, leaves, saved."""

    def run(batches):
        shard = TaskContext.get().partitionId() << 32
        held, turns = [], 0

        def nodes():
            columns = [pa.concat_arrays([b.column(i) for b in held]) for i in range(10)]
            number = lambda i: columns[i].fill_null(0).to_numpy(zero_copy_only=False)
            lengths = pa.compute.binary_length(columns[2]).to_numpy(zero_copy_only=False).astype(np.int64) // 16
            symbols = np.frombuffer(b"".join(columns[2].to_pylist()), ">i8").astype(np.int64).reshape(-1, 2)
            made = shard_nodes(np.stack([number(0), number(1)], 1), lengths, symbols, columns[3].flatten().to_numpy().astype(np.int64),
                               number(4), number(5), columns[6].to_numpy(zero_copy_only=False), np.stack([number(i) for i in (7, 8, 9)], 1))
            unknown = ~made["known"] | ((made["depth"] == 1) & (level > 0))  # a segment's root is a node of the one before
            arrays = [pa.array(made["key"][:, 0]), pa.array(made["key"][:, 1]), pa.array(made["parent"][:, 0]), pa.array(made["parent"][:, 1]),
                      pa.array(made["depth"] + level * segment), pa.array(made["first"]), pa.array(made["parent_first"], mask=unknown),
                      *[pa.array(made[k]) for k in ("n", "children", "leaves", "saved", "words", "goes_on")],
                      pa.array(np.full(len(unknown), shard)), pa.array(made["chain"].astype(np.int32), mask=made["chain"] < 0)]
            return pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in NODES.split(", ")])

        for batch in batches:
            at = 0
            sizes = pa.compute.binary_length(batch.column(2)).to_numpy(zero_copy_only=False) // 16 + 1
            while at < batch.num_rows:
                # At least one row, and rows until the shard is full.
                take = max(1, int(np.searchsorted(np.cumsum(sizes[at:]), shard_turns - turns)))
                held.append(batch.slice(at, take))
                turns += int(sizes[at : at + take].sum())
                at += take
                if turns >= shard_turns or at < batch.num_rows:
                    yield nodes()
                    held, turns, shard = [], 0, shard + 1
        if held:
            yield nodes()

    total = paths.agg(F.sum(F.octet_length("path") / 16 + 1)).first()[0] or 0
    order = ["k1", "k2", "path"]
    ranged = paths.repartitionByRange(max(1, int(total) // shard_turns), *order).sortWithinPartitions(*order)
    names = ["k1", "k2", "path", "words", "n", "first", "goes_on", "children", "leaves", "saved"]
    return ranged.select(*names).mapInArrow(run, NODES)


def _few(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= FEW_ROWS else df


def _merged_spines(spines: DataFrame) -> DataFrame:
    """One row for each node on any spine, with whole counts."""
    key = ["k1", "k2"]
    merged = spines.groupBy(*key).agg(
        *[F.sum(c).alias(c) for c in ("n", "children", "leaves", "saved")], F.min("first").alias("first"), F.max("words").alias("words"),
        F.max("depth").alias("depth"), F.max("p1").alias("p1"), F.max("p2").alias("p2"), F.max("goes_on").alias("goes_on"),
        F.max("parent_first").alias("parent_first"), F.min(F.struct("shard", "chain")).alias("owner"), F.max("is_root").alias("is_root"))
    kids = merged.filter("not is_root").groupBy(F.col("p1").alias("k1"), F.col("p2").alias("k2")).agg(F.count("*").alias("kids"))
    merged = merged.join(kids, key, "left").withColumn("children", F.col("children") + F.coalesce("kids", F.lit(0))).drop("kids")
    merged = merged.withColumns({"own_saved": (F.col("n") - 1) * F.col("words"),
                                 "own_leaf": F.when((F.col("children") == 0) & ~F.col("goes_on"), 1).otherwise(0).cast("long")})
    merged = materialize(merged, "trie-spines")
    own = merged.select(*key, "owner", "own_saved", "own_leaf")
    chains = spines.select(*key, "depth", F.struct("shard", "chain").alias("on")).join(own, key)
    up = Window.partitionBy("on").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)  # a path: segment + 1 rows
    mine = lambda c: F.sum(F.when(F.col("on") == F.col("owner"), F.col(c)).otherwise(0)).over(up)
    sums = chains.withColumns({"add_saved": mine("own_saved"), "add_leaves": mine("own_leaf")})
    sums = sums.groupBy(*key).agg(F.sum("add_saved").alias("add_saved"), F.sum("add_leaves").alias("add_leaves"))
    return merged.join(sums, key).withColumns(
        {"saved": F.col("saved") + F.col("add_saved"), "leaves": F.col("leaves") + F.col("add_leaves")})


def ends_hash(ends: DataFrame) -> DataFrame:
    """``k1``, ``k2``, ``ends_sha256``: the ascending ``conv_id`` of each key, comma-joined.

    Ranges of (key, id) become texts of at most about a MB.  A key whose ids
    lie within one range is hashed there; texts of the others stream through
    one hash for each key, in order, one text in memory at a time.
    """
    rows = ends.count()
    order = ["k1", "k2", "conv_id"]
    ranged = ends.select(*order).repartitionByRange(max(1, rows // 1_000_000), *order).sortWithinPartitions(*order)

    def texts(batches):
        part, key, parts, whole, out = TaskContext.get().partitionId() << 33, None, [], False, []

        def close(complete: bool) -> None:
            nonlocal part, parts, whole
            text = ",".join(parts)
            out.append((*key, part, None, hashlib.sha256(text.encode()).hexdigest()) if complete and whole else (*key, part, text, None))
            part, parts, whole = part + 1, [], complete  # a key that begins after another one begins here

        for batch in batches:
            k1, k2, ids = (c.to_numpy() for c in batch.columns)
            cuts = np.flatnonzero((k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1])) + 1
            for i, j in zip([0, *cuts.tolist()], [*cuts.tolist(), len(ids)], strict=True):
                if (now := (int(k1[i]), int(k2[i]))) != key:
                    if key is not None:
                        close(True)
                    key = now
                for at in range(i, j, 50_000):
                    parts.append(",".join(map(str, ids[at : min(j, at + 50_000)].tolist())))
                    if sum(map(len, parts)) >= 1 << 20:
                        close(False)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)
            out.clear()
        if key is not None:
            close(False)
            yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=schema)

    names = ["k1", "k2", "part", "text", "hash"]
    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("part", pa.int64()), ("text", pa.string()), ("hash", pa.string())])
    made = materialize(ranged.mapInArrow(texts, "k1 long, k2 long, part long, text string, hash string"), "trie-ends")

    def joined(batches):
        key, state, out = None, None, []
        for batch in batches:
            for k1, k2, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (k1, k2) != key:
                    if key is not None:
                        out.append((*key, state.hexdigest()))
                    key, state = (k1, k2), hashlib.sha256(text.encode())
                elif text:
                    state.update(b"," + text.encode())
            yield pa.RecordBatch.from_pylist([dict(zip(("k1", "k2", "ends_sha256"), r, strict=True)) for r in out], schema=hashes)
            out.clear()
        if key is not None:
            yield pa.RecordBatch.from_pylist([{"k1": key[0], "k2": key[1], "ends_sha256": state.hexdigest()}], schema=hashes)

    hashes = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("ends_sha256", pa.string())])
    pieces = made.filter("hash IS NULL").repartition("k1", "k2").sortWithinPartitions("k1", "k2", "part")
    return made.filter("hash IS NOT NULL").select("k1", "k2", F.col("hash").alias("ends_sha256")).unionByName(
        pieces.select("k1", "k2", "text").mapInArrow(joined, "k1 long, k2 long, ends_sha256 string"))


def trie(turns: DataFrame, lengths: DataFrame, segment: int = 4096, shard_turns: int = 500_000) -> DataFrame:
    """The nodes of the prefix trie of sequences.

    ``turns``: conv_id, depth (gapless from 1), digest (string: equal turns, equal digests), words.
    ``lengths``: conv_id and length of every sequence, empty ones too.  Returns conv_id (smallest member),
    depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.  No sequence, no row.
    """
    key = ["k1", "k2"]
    longest = lengths.agg(F.max("length")).first()[0]
    levels = max(1, -(-(longest or 0) // segment))
    symbols = turns.select("conv_id", "depth", F.col("words").cast("int").alias("words"),
                           F.xxhash64("digest", "depth").alias("s1"), F.xxhash64(F.lit("second"), "depth", "digest").alias("s2"))
    hex_ = lambda c: F.lpad(F.hex(c), 16, "0")
    symbols = symbols.withColumns({"level": F.expr(f"(depth - 1) div {segment}"), "symbol": F.concat(hex_("s1"), hex_("s2"))})
    parts = symbols.groupBy("conv_id", "level").agg(
        F.sort_array(F.collect_list(F.struct("depth", "symbol", "words"))).alias("turns"),  # at most ``segment``
        F.bit_xor("s1").alias("x1"), F.bit_xor("s2").alias("x2"))
    parts = parts.select("conv_id", "level", "x1", "x2", F.unhex(F.array_join("turns.symbol", "")).alias("path"),
                         F.col("turns.words").alias("words"))
    if levels > 1:
        parts = materialize(parts, "trie-segments")
        before = Window.partitionBy("conv_id").orderBy("level").rowsBetween(Window.unboundedPreceding, -1)
        sums = parts.select("conv_id", "level", *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"k{i}") for i in (1, 2)],
                            (F.lead("level").over(Window.partitionBy("conv_id").orderBy("level"))).isNotNull().alias("goes_on"))
        parts = parts.join(sums, ["conv_id", "level"])
    else:
        zero = F.lit(0).cast("long")
        parts = parts.withColumns({"k1": zero, "k2": zero, "goes_on": F.lit(False)})
    parts = parts.withColumns({"e1": F.col("k1").bitwiseXOR(F.col("x1")), "e2": F.col("k2").bitwiseXOR(F.col("x2"))}).drop("x1", "x2")
    none = lengths.filter("length = 0").selectExpr(
        "conv_id", "0L AS level", "X'' AS path", "CAST(array() AS array<int>) AS words", "0L AS k1", "0L AS k2", "false AS goes_on", "0L AS e1", "0L AS e2")
    parts = materialize(parts.unionByName(none), "trie-paths")
    distinct = parts.groupBy("level", *key, "path").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("first"), F.first("words").alias("words"),
        F.max("goes_on").alias("goes_on"), F.max("e1").alias("e1"), F.max("e2").alias("e2"))
    distinct = materialize(distinct, "trie-distinct")

    done, finals, below = [], [], None
    for level in range(levels - 1, -1, -1):
        rows = distinct.filter(F.col("level") == level)
        if below is None:
            rows = rows.selectExpr("*", "0L AS children", "0L AS leaves", "0L AS saved")
        else:
            rows = rows.join(below, ["e1", "e2"], "left")
        nodes = materialize(_level(rows, level, segment, shard_turns), "trie-nodes")
        nodes = nodes.withColumn("is_root", F.col("depth") == level * segment)
        merged = materialize(_merged_spines(nodes.filter("chain IS NOT NULL")), "trie-merged")
        finals.append(merged)
        columns = ["k1", "k2", "p1", "p2", "depth", "first", "parent_first", "n", "children", "leaves", "saved", "is_root"]
        every = nodes.filter("chain IS NULL").select(*columns).unionByName(merged.select(*columns))
        done.append(every if level == 0 else every.filter("not is_root"))
        below = every.filter("is_root").select(F.col("k1").alias("e1"), F.col("k2").alias("e2"), "children", "leaves", "saved")

    nodes, spines = done[0], finals[0].filter("not is_root or depth = 0")
    for more, theirs in zip(done[1:], finals[1:], strict=True):
        nodes, spines = nodes.unionByName(more), spines.unionByName(theirs.filter("not is_root or depth = 0"))
    # Parents that a shard alone didn't know: on spines, or the last of a segment.
    parents = spines.select(*key, "first")
    if levels > 1:
        parents = parents.unionByName(nodes.filter((F.col("depth") % segment == 0) & (F.col("depth") > 0)).select(*key, "first")).distinct()
    parents = materialize(parents, "trie-parents").select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("first").alias("their_first"))
    nodes = nodes.join(_few(parents, parents.count()), ["p1", "p2"], "left")
    ends = ends_hash(parts.filter("not goes_on").select(F.col("e1").alias("k1"), F.col("e2").alias("k2"), "conv_id"))
    nodes = nodes.join(ends, key, "left")
    return nodes.select(
        F.col("first").alias("conv_id"), "depth",
        F.when(F.col("depth") > 0, F.coalesce("parent_first", "their_first")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(EMPTY_HASH)).alias("ends_sha256"))


def rebuilt(conversations: DataFrame, family: int, heads: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """(turns, lengths) for :func:`trie` of conversations that start with turns of their family's first one.

    Conversation c starts with the first ``heads`` (0 to ``most``, of conv_id) turns of c - c % family, then its
    own turns after its first ``heads``.  Turns ascend by turn (null first), equal ones by a digest of role and text;
    null roles and texts are empty.  Rows without conv_id belong to no conversation.  Other columns play no part.
    """
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    turns = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.sha2(F.concat(F.octet_length(empty("role")).cast("string"), F.lit(":"), empty("role"), empty("text")), 256).alias("digest"),
        F.regexp_count(empty("text"), F.lit(r"[^\x20\x09-\x0D]+")).alias("words"))
    turns = materialize(turns, "conversation-turns")
    own = materialize(keyed_row_number(turns, ["conv_id"], ["turn", "digest"], "place").drop("turn"), "conversation-places")
    sizes = own.groupBy("conv_id").agg(F.max("place").alias("size"))
    sizes = sizes.withColumns({"heads": heads.cast("long"), "base": F.col("conv_id") - F.col("conv_id") % family})
    theirs = sizes.select(F.col("conv_id").alias("base"), F.col("size").alias("base_size"))
    whole = sizes.join(theirs, "base", "left").withColumn("taken", F.least("heads", F.coalesce("base_size", F.lit(0).cast("long"))))
    whole = materialize(whole.select("conv_id", "base", "heads", "taken",
                                     (F.col("taken") + F.greatest(F.col("size") - F.col("heads"), F.lit(0))).alias("length")), "conversation-sizes")
    first = own.filter(F.col("place") <= most).withColumnRenamed("conv_id", "base")
    inherited = whole.filter("taken > 0").select("conv_id", "base", "taken").join(first, "base").filter("place <= taken")
    rest = own.join(whole.select("conv_id", "heads", "taken"), "conv_id").filter("place > heads")
    columns = ["conv_id", "depth", "digest", "words"]
    made = inherited.withColumn("depth", F.col("place")).select(*columns).unionByName(
        rest.withColumn("depth", F.col("place") - F.col("heads") + F.col("taken")).select(*columns))
    return made, whole.select("conv_id", "length")
