"""Streaming queries (W1-W5) over three micro-batches.

The events table is streamed in arrival order (ts, event_id), a third of it
per micro-batch (``arrival_stream``); each batch is one availableNow run
resumed from the checkpoint.  Results are read back from the sinks.  W1 and
W4 must equal their batch twins exactly; W3's triggers are the micro-batches.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veilspark.params import DEFAULT_REPLAY_WINDOW
from veilspark.plans import fixtures as fx
from veilspark.plans.oracles import ORACLES, _releases_cte
from veilspark.plans.queries import PARAMS, TEST_SECRET, register
from veilspark.session import table, work_path
from veilspark.streaming.bounding import stream_bound_contributions
from veilspark.streaming.release import StreamRelease
from veilspark.streaming.flush import drain, stream_partial_counts
from veilspark.streaming.run import arrival_stream, run_foreach_batch, run_to_parquet
from veilspark.streaming.window import stream_replay_filter


BATCHES = 3
FLUSH_TICK = 1.0  # seconds
FLUSH_STREAM = "events-flushes"
RELEASE_STREAM = "events-micro-batches"  # noise of its own: its triggers are other ones than the days'


def _events_stream(spark, sf_dir, cols):
    ev = table(spark, sf_dir, "events").select(*cols)
    n = ev.count()
    return arrival_stream(spark, ev, fx.EVENT_ORDER, -(-n // BATCHES))


@register("stream_bounding")
def q_stream_bounding(spark, sf_dir):
    """Per-user bounding as keyed streaming state (first 50 arrivals per user)."""
    ev, runs = _events_stream(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"])
    kept = stream_bound_contributions(ev, "user_id", fx.EVENT_ORDER, PARAMS.max_contributions)
    out = run_to_parquet(kept, "stream-bounding", checkpoint=work_path(spark, "stream-bounding-ckpt"), runs=runs)
    return spark.read.parquet(out).select("event_id", "user_id", "event_type")


ORACLES["stream_bounding"] = f"""
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn <= {PARAMS.max_contributions} OR user_id IS NULL""".strip()


@register("stream_replay")
def q_stream_replay(spark, sf_dir):
    """Replay window per producer as keyed state (highest and bitmap) over micro-batches."""
    ev, runs = _events_stream(spark, sf_dir, ["event_id", "ts", "event_type"])
    ev = ev.select("event_id", "ts", F.col("event_type").alias("producer_id"),
                   (F.col("event_id") - (F.col("event_id") * 37) % 200).alias("seq"))
    checked = stream_replay_filter(ev, "producer_id", "seq", fx.EVENT_ORDER, DEFAULT_REPLAY_WINDOW, "replay_reason")
    out = run_to_parquet(checked, "stream-replay", checkpoint=work_path(spark, "stream-replay-ckpt"), runs=runs)
    return spark.read.parquet(out).select("event_id", "producer_id", "seq", "replay_reason")


ORACLES["stream_replay"] = ORACLES["replay_filter"]


@register("stream_release")
def q_stream_release(spark, sf_dir):
    """W1 -> W3/W5: bounded stream, one trigger per non-empty micro-batch (three), latest ranked snapshot."""
    ev, runs = _events_stream(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"])
    kept = stream_bound_contributions(ev, "user_id", fx.EVENT_ORDER, PARAMS.max_contributions)
    counts, snaps = work_path(spark, "stream-release-counts"), work_path(spark, "stream-release-snaps")
    run_foreach_batch(kept, StreamRelease(counts, snaps, "event_type", PARAMS, TEST_SECRET, RELEASE_STREAM),
                      "stream-release", checkpoint=work_path(spark, "stream-release-ckpt"), runs=runs)
    s = spark.read.parquet(snaps)
    last = s.agg(F.max("snapshot_id")).first()[0]
    return s.filter(F.col("snapshot_id") == F.lit(last)).select(
        "rank", F.col("key").alias("event_type"), F.col("count").alias("released"))


ORACLES["stream_release"] = f"""
WITH arr AS (SELECT *, row_number() OVER (ORDER BY ts, event_id) - 1 AS arrival,
                    (SELECT count(*) FROM events) AS n FROM events),
bev AS (SELECT * FROM (SELECT *, CAST(floor(arrival / ((n + {BATCHES} - 1) // {BATCHES})) AS BIGINT) AS batch,
                              row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM arr)
        WHERE rn <= {PARAMS.max_contributions} OR user_id IS NULL),
cnt AS (SELECT batch, event_type, count(*) AS cnt FROM bev GROUP BY ALL),
trig AS (SELECT batch, CAST(row_number() OVER (ORDER BY batch) - 1 AS BIGINT) AS i FROM (SELECT DISTINCT batch FROM cnt)),
idx AS (SELECT c.event_type, c.cnt, t.i FROM cnt c JOIN trig t USING (batch)),
{_releases_cte(PARAMS, 'srel', 'idx', stream=RELEASE_STREAM, trigger='micro-batch')},
latest AS (SELECT event_type, arg_max(noisy, i) AS noisy FROM srel GROUP BY event_type),
kept AS (SELECT event_type, noisy, CAST(floor(noisy + 0.5) AS BIGINT) AS released FROM latest
         WHERE floor(noisy + 0.5) >= 0)
SELECT CAST(row_number() OVER (ORDER BY noisy DESC, event_type ASC) AS BIGINT) AS rank, event_type, released
FROM kept""".strip()


@register("stream_flush")
def q_stream_flush(spark, sf_dir):
    """W1 -> W2 -> W3 in one query: bounded events counted in state, flushed by timers, released per flush; counts per key."""
    ev, runs = _events_stream(spark, sf_dir, ["event_id", "ts", "user_id", "event_type"])
    kept = stream_bound_contributions(ev, "user_id", fx.EVENT_ORDER, PARAMS.max_contributions)
    flushed = stream_partial_counts(kept, "event_type", FLUSH_TICK)
    counts, snaps = work_path(spark, "stream-flush-counts"), work_path(spark, "stream-flush-snaps")
    release = StreamRelease(counts, snaps, "event_type", PARAMS, TEST_SECRET, FLUSH_STREAM, cnt="cnt")
    query = (flushed.writeStream.foreachBatch(release).option("checkpointLocation", work_path(spark, "stream-flush-ckpt"))
             .trigger(processingTime="0 seconds").start())
    drain(query, runs)
    return spark.read.parquet(counts).groupBy("event_type").agg(F.sum("cnt").alias("cnt"))


ORACLES["stream_flush"] = f"""
SELECT event_type, count(*) AS cnt FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events)
WHERE rn <= {PARAMS.max_contributions} OR user_id IS NULL GROUP BY event_type""".strip()
