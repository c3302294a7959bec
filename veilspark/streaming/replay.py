"""Replay window on a stream (W4), one micro-batch at a time.

Each micro-batch is checked with the exact, skew-safe batch filter (I4),
seeded with a per-producer carry from earlier batches: the highest seq seen
and the seqs seen within the last ``window`` below it (at most ``window``
values per producer: the state is bounded).  The carried seqs enter the
batch filter as arrivals that precede every row of the batch.

The carry is a small table written per batch id (``batch_id=<id>``), an empty one
too, and read by the next batch; only batch 0 has none.  A carry that can't be
read stops the query: without it every window would be open again.  And the output is written per batch id with dynamic
partition overwrite, so a replayed batch id reads the same carry and rewrites
the same output: idempotent under retries and restarts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.operators.integrity import replay_filter
from veilspark.params import DEFAULT_REPLAY_WINDOW

_CARRY_SCHEMA = "producer string, max_seen long, recent array<long>"
_MARK = "__batch_row"


def _write_partition(df: DataFrame, path: str, batch_id: int) -> None:
    (df.withColumn("batch_id", F.lit(int(batch_id)).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch_id").parquet(path))


class ReplayBatch:
    """``foreachBatch`` function: writes every row of the batch with its ``reason`` (null = accepted)."""

    def __init__(self, out_path: str, state_path: str, producer: str, seq: str, order_by: Sequence[str],
                 window: int = DEFAULT_REPLAY_WINDOW):
        self.out_path = out_path
        self.state_path = state_path
        self.producer = producer
        self.seq = seq
        self.order_by = list(order_by)
        self.window = int(window)

    def _part(self, batch_id: int) -> str:
        return f"{self.state_path.rstrip('/')}/batch_id={batch_id}"

    def _carry(self, spark: SparkSession, batch_id: int) -> DataFrame:
        if batch_id == 0:
            return spark.createDataFrame([], _CARRY_SCHEMA)
        # Only the previous batch's carry, not a listing of every batch so far; fails if it is not there.
        return spark.read.schema(_CARRY_SCHEMA).parquet(self._part(batch_id - 1))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        p, s, w = self.producer, self.seq, self.window
        carry = self._carry(spark, batch_id)
        here = batch.select(F.col(p).alias("producer")).distinct()
        seeds = carry.join(here, "producer", "left_semi").select(
            F.col("producer").alias(p),
            F.explode(F.array_union(F.coalesce("recent", F.array().cast("array<long>")), F.array("max_seen"))).alias(s),
        ).filter(F.col(s).isNotNull())
        seeds = seeds.select(
            *[F.col(c) if c in (p, s) else F.lit(None).cast(batch.schema[c].dataType).alias(c) for c in batch.columns]
        ).withColumn(_MARK, F.lit(False))
        combined = seeds.unionByName(batch.withColumn(_MARK, F.lit(True)))
        # seeds (mark = false) precede every batch row; batch rows follow ``order_by``
        order = [F.col(_MARK)] + [F.col(c) for c in self.order_by]
        # the flagged batch feeds both the output and the next carry: compute it once for this call
        checked = replay_filter(combined, p, s, order, w, "reason").persist()
        try:
            _write_partition(checked.filter(F.col(_MARK)).drop(_MARK), self.out_path, batch_id)
            self._write_carry(checked, carry.join(here, "producer", "left_anti"), batch_id)
        finally:
            checked.unpersist()

    def _write_carry(self, checked: DataFrame, others: DataFrame, batch_id: int) -> None:
        """``others``: the carry of producers that the batch has no row of, kept as it is."""
        p, s, w = self.producer, self.seq, self.window
        # next carry from the seeds plus this batch's accepted rows, bounded to the window
        acc = checked.filter(~F.col(_MARK) | F.col("reason").isNull()).select(p, s)
        top = acc.groupBy(p).agg(F.max(s).alias("max_seen"))
        recent = (acc.join(top, p).filter(F.col(s) > F.col("max_seen") - F.lit(w))
                  .groupBy(p).agg(F.collect_set(s).alias("recent")))  # <= window values per producer
        nxt = top.join(recent, p, "left").select(F.col(p).alias("producer"), "max_seen", "recent")
        nxt.unionByName(others).write.mode("overwrite").parquet(self._part(batch_id))
