"""Integrity checks on headers (I1-I8) and the verified stage.

Every check yields a *reason code* column (null = pass) instead of throwing
per row; ``apply_policy`` then either fails the job on the first violation
(``fail``) or splits accepted rows from a quarantine table (``quarantine``).
Both fail closed: a row with a reason never reaches the stage body.

I1  route check against the static routes table (a literal map lookup).
I2  all sealed values of one row agree on (producer_id, seq).
I3  producer_id and seq are required; I6 an exact expected seq.
I4  replay window per producer (size 128): reject negative, too old
    (seq <= max seen - 128) and already seen sequence numbers.
I5  sequence stamps 0, 1, ... per producer in arrival order.
I7  routing-table check: exactly one downstream per stage, known names only.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilspark.functions.headers import COMPONENTS, EXPECTED_INPUT
from veilspark.operators.scan import BLK, keyed_row_number, keyed_running_max_before
from veilspark.params import DEFAULT_REPLAY_WINDOW
from veilspark.session import materialize, work_path

REASON = "reason"


def _first_reason(*reasons: Column) -> Column:
    return F.coalesce(*reasons)


# ------------------------------------------------------------------ I1

def _literal_map(pairs: dict) -> Column:
    items = []
    for k, v in pairs.items():
        items += [F.lit(k), F.lit(v).cast("string")]
    return F.create_map(*items)


def route_check(df: DataFrame, stage: str, source: str, destination: str, name: str = "route_reason",
                routes: Mapping[str, tuple[str | None, str]] = EXPECTED_INPUT) -> DataFrame:
    """Compare header source/destination with the expectations of ``stage``.

    ``routes`` names each stage's expected (source or None for any,
    destination); the default is the example's graph.  A graph is a short
    list written by hand, so the lookup is a literal map in the projection
    (no join, no shuffle); a stage without an entry fails as ``unknown_stage``.
    """
    exp_src_map = _literal_map({k: v[0] for k, v in routes.items()})
    exp_dst_map = _literal_map({k: v[1] for k, v in routes.items()})
    st, src, dst = F.col(stage), F.col(source), F.col(destination)
    known = F.coalesce(F.map_contains_key(exp_dst_map, st), F.lit(False))
    exp_src, exp_dst = F.element_at(exp_src_map, st), F.element_at(exp_dst_map, st)
    reason = (
        F.when(~known, F.lit("unknown_stage"))
        .when(exp_src.isNotNull() & src.isNull(), F.lit("missing_source"))
        .when(exp_src.isNotNull() & (src != exp_src), F.lit("source_mismatch"))
        .when(dst.isNull(), F.lit("missing_destination"))
        .when(dst != exp_dst, F.lit("destination_mismatch"))
    )
    return df.withColumn(name, reason)


# ------------------------------------------------------------------ I2, I3, I6

def agreement_reason(producers: Sequence[Column], seqs: Sequence[Column]) -> Column:
    """Null when every (producer_id, seq) pair equals the first, else a reason."""
    p0, s0 = producers[0], seqs[0]
    bad = F.lit(False)
    for p, s in zip(producers[1:], seqs[1:]):
        bad = bad | ~p.eqNullSafe(p0) | ~s.eqNullSafe(s0)
    return F.when(bad, F.lit("header_mismatch"))


def required_reason(producer: Column, seq: Column, expected_seq: Column | None = None) -> Column:
    """I3 (+ I6 when ``expected_seq`` is given)."""
    r = F.when(producer.isNull(), F.lit("missing_producer")).when(seq.isNull(), F.lit("missing_seq"))
    if expected_seq is not None:
        r = r.when(seq != expected_seq, F.lit("seq_mismatch"))
    return r


# ------------------------------------------------------------------ I4

def replay_filter(df: DataFrame, producer: str, seq: str, order_by: Sequence, window: int = DEFAULT_REPLAY_WINDOW,
                  name: str = "replay_reason", n_blocks: int | None = None) -> DataFrame:
    """I4 over a whole table: exact, order-dependent, skew-safe.

    A row is accepted iff its seq is non-negative, it is the first arrival of
    (producer, seq), and seq > (max seq seen earlier from that producer) -
    window.  Every earlier seq above the current max is accepted by the
    window, so the running max over *all* earlier non-negative seqs is the
    window's max-seen.

    Plan: the running max is a blocked scan (``keyed_running_max_before``:
    range shuffle into pinned blocks, then hash on (producer, block)).  A row
    whose seq is above that max cannot repeat anything, and repeats inside a
    block are caught by a window on (producer, block, seq) on the same
    exchange.  Only *candidates* - in-window rows at or below the max - need
    the cross-block test "is my block the earliest holding (producer, seq)".
    That earliest block is aggregated from the rows whose keys are among the
    candidates' (a semi join that AQE broadcasts when the candidates are
    few), so in-order streams never reshuffle their bulk.  Rows with a null
    producer or seq get ``missing_producer`` / ``missing_seq``.
    """
    valid = df.filter(F.col(producer).isNotNull() & F.col(seq).isNotNull())
    invalid = df.filter(F.col(producer).isNull() | F.col(seq).isNull()).withColumn(
        name, F.when(F.col(producer).isNull(), F.lit("missing_producer")).otherwise(F.lit("missing_seq"))
    )
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order_by]
    first_in_block = F.row_number().over(Window.partitionBy(producer, BLK, seq).orderBy(*order_cols)) == F.lit(1)
    scanned = keyed_running_max_before(
        valid, [producer], order_by, F.when(F.col(seq) >= 0, F.col(seq)), name="__prev_max", n=n_blocks,
        extra_local={"__first_in_blk": first_in_block},
    )
    s, prev = F.col(seq), F.col("__prev_max")
    negative = s < 0
    stale = prev.isNotNull() & (s <= prev - F.lit(int(window)))
    candidate = ~negative & ~stale & prev.isNotNull() & (s <= prev)
    base_reason = (
        F.when(negative, F.lit("negative_seq"))
        .when(stale, F.lit("stale_seq"))
        .when(~F.col("__first_in_blk"), F.lit("replayed_seq"))
    )
    settled = scanned.filter(~candidate).withColumn(name, base_reason)
    cands = scanned.filter(candidate)
    keys = cands.select(producer, seq)
    first_blk = (scanned.join(keys, [producer, seq], "left_semi")
                 .groupBy(producer, seq).agg(F.min(BLK).alias("__first_blk")))
    checked = cands.join(first_blk, [producer, seq], "left").withColumn(
        name, F.when(~(F.col("__first_in_blk") & (F.col(BLK) == F.col("__first_blk"))), F.lit("replayed_seq"))
    ).drop("__first_blk")
    out = settled.unionByName(checked).drop("__prev_max", "__first_in_blk", BLK)
    return out.unionByName(invalid)


# ------------------------------------------------------------------ I5

def sequence_stamp(df: DataFrame, producer: str, order_by: Sequence, name: str = "seq",
                   n_blocks: int | None = None) -> DataFrame:
    """seq = 0, 1, ... per producer in arrival order (blocked, skew-safe).

    ``producer`` must be a stable shard key of the data (never a task id), so
    that a recomputed task stamps the same numbers.
    """
    out = keyed_row_number(df, [producer], order_by, name="__rn", n=n_blocks)
    return out.withColumn(name, F.col("__rn") - F.lit(1)).drop("__rn")


# ------------------------------------------------------------------ I7

def component_name(label) -> Column:
    """Resolve a label or an enum name (the latter case-insensitively); unknown -> null."""
    c = F.col(label) if isinstance(label, str) else label
    expr = F.lit(None).cast("string")
    for lab, enum in reversed(COMPONENTS):
        expr = F.when((c == F.lit(lab)) | (F.upper(c) == F.lit(enum)), F.lit(lab)).otherwise(expr)
    return expr


def routing_table_check(edges: DataFrame, stage: str = "stage", downstream: str = "downstream") -> DataFrame:
    """Per stage of an edge list: resolved name, downstream count and a status.

    status: ``ok`` (exactly one), ``no_downstream``, ``ambiguous_fanout`` or
    ``unknown_component`` (stage or a downstream name is not a known component).
    """
    e = edges.select(
        F.col(stage).alias("stage"), component_name(stage).alias("__s"),
        F.col(downstream).alias("__d_raw"), component_name(downstream).alias("__d"),
    )
    g = e.groupBy("stage", "__s").agg(
        F.count_distinct("__d").alias("__n"),
        F.max(F.when(F.col("__d_raw").isNotNull() & F.col("__d").isNull(), F.lit(1)).otherwise(F.lit(0))).alias("__unk"),
        F.min("__d").alias("__one"),
    )
    status = (
        F.when(F.col("__s").isNull() | (F.col("__unk") == 1), F.lit("unknown_component"))
        .when(F.col("__n") == 0, F.lit("no_downstream"))
        .when(F.col("__n") > 1, F.lit("ambiguous_fanout"))
        .otherwise(F.lit("ok"))
    )
    return g.select(
        "stage", F.col("__s").alias("component"), F.col("__n").cast("long").alias("n_downstream"),
        F.when(F.col("__n") == 1, F.col("__one")).alias("downstream"), status.alias("status"),
    )


# ------------------------------------------------------------------ I8 / U3

class Split(NamedTuple):
    """Both outputs of one evaluation, and how many rows each has."""

    accepted: DataFrame
    quarantined: DataFrame
    counts: dict[str, int]

    def reasons(self, reason: str = REASON) -> DataFrame:
        """(reason, cnt) of the quarantined rows; reads that part of the table alone."""
        return self.quarantined.groupBy(reason).agg(F.count(F.lit(1)).alias("cnt"))


def split_by_verdict(df: DataFrame, reason: str = REASON) -> Split:
    """Evaluates ``df`` once and writes it with one folder for each verdict; rows without a ``reason`` are accepted.

    The table lies in the shared work folder, whole rows and all: never give it
    plaintext that must not rest on disk.
    """
    spark = df.sparkSession
    path = work_path(spark, "verdicts")
    seen = Observation(f"verdicts-{path[-32:]}")
    bad = F.col(reason).isNotNull()
    (df.withColumn("__verdict", F.when(bad, 1).otherwise(0))
     .observe(seen, F.count_if(~bad).alias("accepted"), F.count_if(bad).alias("quarantined"))
     .write.partitionBy("__verdict").parquet(path))
    rows = spark.read.schema(T.StructType([*df.schema.fields, T.StructField("__verdict", T.IntegerType())])).parquet(path)
    return Split(rows.filter("__verdict = 0").drop("__verdict", reason), rows.filter("__verdict = 1").drop("__verdict"),
                 {k: int(v) for k, v in seen.get.items()})


def apply_policy(df: DataFrame, reason: str = REASON, policy: str = "quarantine"):
    """I8: ``fail`` raises on the first violating row; ``quarantine`` returns (accepted, quarantined).

    Both fail closed: rows with a reason are never in the accepted output.  The
    two outputs are parts of one written table (``split_by_verdict``), so the checks run once.
    ``flag`` returns the rows with their reason column (null = accepted), for
    callers that write one table and split it later instead of evaluating
    the checks once per output.
    """
    if policy == "fail":
        # the guard is a filter condition, so column pruning can never drop the check
        guard = F.when(
            F.col(reason).isNotNull(), F.raise_error(F.concat(F.lit("integrity violation: "), F.col(reason)))
        ).otherwise(F.lit(True))
        return df.filter(guard).drop(reason)
    if policy == "flag":
        return df
    if policy != "quarantine":
        raise ValueError("policy must be 'fail', 'quarantine' or 'flag'")
    split = split_by_verdict(df, reason)
    return split.accepted, split.quarantined


def verified_stage(df: DataFrame, stage: str, source: str, destination: str, producer: str, seq: str,
                   order_by: Sequence, policy: str = "quarantine", check_routes: bool = True,
                   check_replay: bool = True, window: int = DEFAULT_REPLAY_WINDOW,
                   more: Sequence[tuple[str, str, str, str]] = (), opened: Sequence[str] = (),
                   routes: Mapping[str, tuple[str | None, str]] = EXPECTED_INPUT):
    """Routes, tags, agreement, required fields and replay window, then the policy.

    ``more`` names the (source, destination, producer, seq) columns of further
    envelopes of the same value: each must have come by the stage's route, and
    all must agree on producer and seq (I2).  ``opened`` names columns of
    unsealed bodies; null means that the tag did not hold.  A value that fails
    any of these is rejected before it reaches the replay window, so it never
    advances a producer's window.
    """
    out = df
    pre = []
    if check_routes:
        for i, (src, dst) in enumerate([(source, destination), *((m[0], m[1]) for m in more)]):
            out = route_check(out, stage, src, dst, f"__route{i}", routes)
            pre.append(F.col(f"__route{i}"))
    pre += [F.when(F.col(c).isNull(), F.lit("auth_failed")) for c in opened]
    if check_replay:
        pre.append(required_reason(F.col(producer), F.col(seq)))
        if more:
            pre.append(agreement_reason([F.col(producer), *(F.col(m[2]) for m in more)], [F.col(seq), *(F.col(m[3]) for m in more)]))
    out = out.withColumn(REASON, _first_reason(*pre) if pre else F.lit(None).cast("string"))
    out = out.drop(*[f"__route{i}" for i in range(len(more) + 1)])
    if check_replay:
        out = materialize(out, "checked")  # the replay window reads its rows more than once
        passed = out.filter(F.col(REASON).isNull()).drop(REASON)
        failed = out.filter(F.col(REASON).isNotNull())
        replayed = replay_filter(passed, producer, seq, order_by, window, REASON)
        out = replayed.unionByName(failed)
    return apply_policy(out, REASON, policy)
