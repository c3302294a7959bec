"""Private histogram releases on a stream.

Each *non-empty* micro-batch is one trigger (W3).  ``StreamRelease`` is the
``foreachBatch`` function:

1. the batch's (key, cnt) is written under ``trigger_id = batch_id``, the record
   of what came when, which no later trigger reads;
2. running totals are kept as a base and deltas (W5): a trigger joins its keys
   with the totals so far and writes one delta with a row (total, trigger index,
   noisy release) for each key *seen in the batch*.  Keyed tree noise (A5) is a
   function of the secret, so it is drawn once for each such row and never for
   a key that wasn't seen.  After ``compact_every`` deltas the newest row of
   each key becomes the next base, so a trigger reads one base and fewer than
   ``compact_every`` deltas however many triggers there were;
3. the newest row of each key, ranked (T1) and rounded (P8), is the snapshot
   (T2), written and committed under ``snapshot_id = batch_id`` (S5).

What a trigger reads and made is committed in a log (``veilspark.sources.commits``)
under its batch id.  A batch that runs again finds its commit and writes the
snapshot from it; one that died earlier starts from the same base and deltas.
Only the first ``horizon`` non-empty triggers reach a release: a later one
writes nothing and is counted in ``cut_triggers``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilspark.operators.counts import trigger_index, with_trigger_index
from veilspark.operators.dp import dp_prefix_sums, with_tree_noise
from veilspark.operators.release import latest_per_key, ordered_release
from veilspark.params import PrivacyParams
from veilspark.sources.commits import CommitLog
from veilspark.sources.snapshot import write_snapshot


class StreamRelease:
    def __init__(self, counts_path: str, snapshots_path: str, key: str, params: PrivacyParams,
                 secret: bytes | str, stream_id: str, trigger: str = "micro-batch", cnt: str | None = None,
                 compact_every: int = 8):
        """``trigger`` names what a trigger is; the noise is bound to it, as in a batch release by that column.

        ``cnt`` is the column of partial counts that rows bring (W2); without it every row counts one.
        """
        self.counts_path = counts_path.rstrip("/")
        self.snapshots_path = snapshots_path
        self.key = key
        self.params = params
        self.secret = secret
        self.stream_id = stream_id
        self.trigger = trigger
        self.cnt = cnt
        self.compact_every = max(1, int(compact_every))
        self.cut_triggers = 0  # non-empty triggers of this run beyond the horizon

    def release(self, counts: DataFrame) -> DataFrame:
        """The release from all counts (trigger_id, key, cnt) at once: the batch twin of what the triggers add up to."""
        k = self.key
        trig = trigger_index(counts, "trigger_id", "i")
        idx = with_trigger_index(counts, trig, "trigger_id", "i", horizon=self.params.horizon)
        rel = dp_prefix_sums(idx.select(k, "i", "cnt"), k, self.params, self.secret, self.stream_id,
                             trigger=self.trigger)
        return ordered_release(latest_per_key(rel, k), k)

    @property
    def state_path(self) -> str:
        return f"{self.counts_path}/_totals"

    def _newest(self, spark, entry: dict) -> DataFrame:
        """The last row of each key in the folders of a commit: (key, total, i, noisy)."""
        rows = spark.read.parquet(*[f"{self.state_path}/{f}" for f in [*entry["base"], *entry["deltas"]]])
        last = F.max_by(F.struct("total", "noisy"), "i")
        return rows.groupBy(self.key).agg(F.max("i").alias("i"), last.alias("__last")).select(
            self.key, F.col("__last.total").alias("total"), "i", F.col("__last.noisy").alias("noisy"))

    def _write_state(self, df: DataFrame, kind: str, batch_id: int) -> str:
        folder = f"{kind}-{batch_id}-{uuid.uuid4().hex}"
        df.write.parquet(f"{self.state_path}/{folder}")
        return folder

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        n = F.sum(self.cnt) if self.cnt else F.count(F.lit(1))
        counts = batch.groupBy(self.key).agg(n.cast("long").alias("cnt")).persist()
        try:
            if counts.isEmpty():
                return  # an empty trigger does not advance the index
            log = CommitLog(spark, self.state_path)
            entry = log.read(batch_id) or self._advance(spark, log, counts, batch_id)
        finally:
            counts.unpersist()
        if entry is None:
            self.cut_triggers += 1
            return
        release = ordered_release(self._newest(spark, entry).select(self.key, "i", "noisy"), self.key)
        write_snapshot(release, self.snapshots_path, batch_id, self.key)

    def _advance(self, spark, log: CommitLog, counts: DataFrame, batch_id: int) -> dict | None:
        """Writes the batch's counts and delta and commits them; None beyond the horizon."""
        k = self.key
        before = log.latest(before=batch_id)
        i = before["i"] + 1 if before else 0
        if i >= self.params.horizon:
            return None
        (counts.withColumn("trigger_id", F.lit(int(batch_id)).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("trigger_id").parquet(self.counts_path))
        totals = counts.select(k, F.col("cnt").alias("total"))
        if before:
            here = counts.select(F.col(k).alias("__k"))
            seen = self._newest(spark, before).join(here, F.col(k).eqNullSafe(F.col("__k")), "left_semi")
            totals = totals.unionByName(seen.select(k, "total")).groupBy(k).agg(F.sum("total").alias("total"))
        rows = with_tree_noise(totals.withColumn("i", F.lit(i).cast("long")), k, "i", "total", self.params, self.secret,
                               self.stream_id, trigger=self.trigger)
        entry = {"i": i, "base": before["base"] if before else [],
                 "deltas": [*(before["deltas"] if before else []), self._write_state(rows.select(k, "total", "i", "noisy"), "delta", batch_id)]}
        if len(entry["deltas"]) >= self.compact_every:
            entry |= {"base": [self._write_state(self._newest(spark, entry), "base", batch_id)], "deltas": []}
        log.commit(batch_id, entry)
        return log.read(batch_id)
