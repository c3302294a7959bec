"""Merkle manifest of a table by lag and lead windows (operator 13).

Leaves are ordered within groups; every ``arity`` consecutive nodes (the last
run: fewer, even one) become the hash of their hex digests, until one is left,
the group's subroot.  The subroots, ordered by group, become the root in the
same way.

One level: node ``pos // arity**level`` of a group stands on the row of its
first leaf.  Lag and lead columns at the fixed offsets ``j * arity**level``,
masked by the node's slot in its run and by the run's length, are its siblings;
rows of first children (slot 0) hash the run into their parent.  Runs never
cross a block of ``arity**levels`` rows, so the windows are over (group, block):
a group with a third of all rows is many small windows, and the levels of a
block share one shuffle.  The tops of the blocks, 256 times fewer rows, are the
nodes of the next tier; each tier is written before it is climbed.

A path is an array of (before, after), the digests of the siblings on either
side, level by level.  Paths come down tier by tier: the block's own levels,
then its top's path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilspark.operators.scan import keyed_row_number
from veilspark.session import materialize

#: Groups whose table is joined by broadcast: a row of a few hundred bytes for each.
FEW_GROUPS = 10_000


def field(value: Column) -> Column:
    """A value as text: ``-`` for null, else its UTF-8 byte count, ``:`` and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """SHA-256 (hex) of the values' texts, one after the other."""
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def _few(df: DataFrame, n: int) -> DataFrame:
    return F.broadcast(df) if n <= FEW_GROUPS else df


def _climb(nodes: DataFrame, arity: int, levels: int, sides: bool) -> DataFrame:
    """``nodes`` (group, pos, n, digest) with ``block``, ``top`` and, if ``sides``, ``side0``..: the siblings of each level's nodes."""
    span = arity**levels
    out = nodes.selectExpr("*", f"pos div {span} AS block", "digest AS top")
    row = "OVER (PARTITION BY `group`, block ORDER BY pos)"
    for level in range(levels):
        step = arity**level
        count, node = f"((n + {step - 1}) div {step})", f"(pos div {step})"  # the group's nodes of this level, this one's place
        slot, stands = f"({node} % {arity})", f"(pos % {step} = 0 AND {count} > 1)"
        length = f"least({arity}, {count} - {node} + {slot})"
        left = ", ".join(f"if({slot} >= {j}, lag(top, {j * step}) {row}, NULL)" for j in range(arity - 1, 0, -1))
        right = ", ".join(f"if({slot} + {j} < {length}, lead(top, {j * step}) {row}, NULL)" for j in range(1, arity))
        parent = f"sha2(concat(top, concat_ws('', {right})), 256)"
        top = f"CASE WHEN {count} <= 1 THEN top WHEN {stands} AND {slot} = 0 THEN {parent} END AS top"
        side = f"if({stands}, named_struct('before', concat_ws('', {left}), 'after', concat_ws('', {right})), NULL) AS side{level}"
        out = out.selectExpr(*[f"`{c}`" for c in out.columns if c != "top"], *[side] * sides, top)
    return out


def _paths(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``nodes`` with ``path``: the siblings of the node that holds each row, for the levels of its block."""
    climbed = _climb(nodes, arity, levels, True)
    to_here = Window.partitionBy("group", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    sides = [F.last(f"side{x}", ignorenulls=True).over(to_here) for x in range(levels)]
    return climbed.select(*nodes.columns, "block", F.array_compact(F.array(*sides)).alias("path"))


def _tree(leaves: DataFrame, arity: int, most: int) -> tuple[DataFrame, DataFrame]:
    """(``leaves`` with ``path``, ``group`` and ``subroot`` of each group); leaves: group, pos, n (``most`` at most), digest and others."""
    tiers, levels = [leaves], 1  # a block has at most 256 rows, or one run
    while arity ** (levels + 1) <= 256 and arity**levels < most:
        levels += 1
    span = arity**levels
    while most > 1:
        climbed = _climb(tiers[-1].select("group", "pos", "n", "digest"), arity, levels, False)
        tops = climbed.filter(F.col("pos") % span == 0).select(
            "group", F.col("block").alias("pos"), F.expr(f"(n + {span - 1}) div {span}").alias("n"), F.col("top").alias("digest"))
        tiers.append(materialize(tops, "merkle-tier"))
        most = -(-most // span)
    roots = tiers.pop().select("group", F.col("digest").alias("subroot"))
    path = None
    for nodes in reversed(tiers):
        with_path = _paths(nodes, arity, levels)
        if path is not None:
            with_path = with_path.join(path, ["group", "block"]).withColumn("path", F.concat("path", "upper")).drop("upper")
        path = with_path.select("group", F.col("pos").alias("block"), F.col("path").alias("upper"))
    if path is None:  # no group has two nodes
        none = F.array().cast("array<struct<before:string,after:string>>")
        return leaves.withColumn("path", none), roots
    return with_path.drop("block"), roots


def build(rows: DataFrame, group: Column, order: list[Column], leaf: Column, keep: dict[str, Column], arity: int = 2) -> DataFrame:
    """``keep``'s columns of every row with ``leaf``, ``subroot``, ``root`` (hex) and ``path``.

    ``group`` is a text (null is a group of its own, the first); rows of a
    group ascend by ``order`` (nulls first), equal ones by their leaf, so that
    repeated rows have equal leaves side by side and each its own path.  A
    lone leaf is its group's subroot and a lone subroot the root, with empty
    paths.  An empty table gives an empty one.  Other columns play no part.
    """
    if arity < 2:
        raise ValueError("a run needs two places")
    by = [f"order{i}" for i in range(len(order))]
    # "" for null, else "=" and the text: never null, in the order null first, then bytewise.
    name = F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))
    leaves = rows.select(name.alias("group"), *[c.alias(n) for c, n in zip(order, by, strict=True)],
                         leaf.alias("digest"), F.struct(*[c.alias(n) for n, c in keep.items()]).alias("kept"))
    leaves = materialize(leaves, "merkle-leaves")  # texts are hashed once
    placed = keyed_row_number(leaves, ["group"], [*by, "digest"], "pos").withColumn("pos", F.col("pos") - 1)
    placed = materialize(placed.select("group", "pos", "digest", "kept"), "merkle-placed")
    sizes = materialize(placed.groupBy("group").agg(F.count("*").alias("n")), "merkle-groups")
    groups, most = sizes.agg(F.count("*"), F.coalesce(F.max("n"), F.lit(0))).first()
    paths, subroots = _tree(placed.join(_few(sizes, groups), "group"), arity, most)

    subroots = materialize(subroots, "merkle-subroots")
    above = subroots.select(F.lit("").alias("group"), F.col("group").alias("of"), F.col("subroot").alias("digest"))
    above = keyed_row_number(above, ["group"], ["of"], "pos").withColumns({"pos": F.col("pos") - 1, "n": F.lit(groups).cast("long")})
    upper, root = _tree(materialize(above, "merkle-above"), arity, groups)
    upper = upper.join(F.broadcast(root.withColumnRenamed("subroot", "root")), "group")  # one row
    upper = upper.select(F.col("of").alias("group"), F.col("digest").alias("subroot"), "root", F.col("path").alias("upper"))
    out = paths.join(_few(upper, groups), "group")
    return out.select("kept.*", F.col("digest").alias("leaf"), "subroot", "root", F.concat("path", "upper").alias("path"))


def proof_hash(path: Column) -> Column:
    """SHA-256 (hex) of the siblings' digests, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda x: F.concat(x["before"], x["after"])), ""), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path lead to."""
    return F.aggregate(path, leaf, lambda digest, x: F.sha2(F.concat(x["before"], digest, x["after"]), 256))
