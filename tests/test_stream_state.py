"""Keyed replay windows (W4), flush timers (W2), incremental releases (W5) and committed snapshots."""

import random
import re

import pytest
from pyspark.sql import functions as F

import veilspark.sources.snapshot as snapshot
from models import SequentialReplay
from veilspark.params import PrivacyParams
from veilspark.session import work_path
from veilspark.sources.commits import CommitLog
from veilspark.sources.snapshot import read_snapshot, write_snapshot
from veilspark.streaming.flush import drain, stream_partial_counts
from veilspark.streaming.release import StreamRelease
from veilspark.streaming.run import run_to_parquet
from veilspark.streaming.window import Window, stream_replay_filter

SCHEMA = "arrival long, producer string, seq long"


def _numbered(spark, rows, schema, per):
    """Rows as a stream of ``per`` each; batch k has arrivals [k per, (k + 1) per)."""
    table = spark.createDataFrame(rows, schema)
    path = work_path(spark, "numbered")
    table.write.parquet(path)
    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", per).load()
    return ticks.select(F.col("value").alias("arrival")).join(spark.read.parquet(path), "arrival")


def test_window_against_the_sequential_model():
    rng = random.Random(11)
    for size in (1, 7, 128):
        window, model = Window(size), SequentialReplay(size)
        seq = 0
        for _ in range(3000):
            seq = rng.choice((seq + 1, seq - rng.randrange(2 * size + 1), seq + rng.randrange(3 * size)))
            assert (window.check(seq) is None) == model.accept(seq)
            assert window.seen < 1 << size


def test_a_batch_writes_the_state_of_its_producers_alone(spark):
    rows = [(i, f"p{i}", 5) for i in range(40)] + [(40 + i, "p3", s) for i, s in enumerate([5, 6, 4, -1] + [7] * 36)] + [(80, None, 1), (81, "p3", None)]
    rows += [(82 + i, "p4", 6 + i) for i in range(38)]
    stream = _numbered(spark, rows, SCHEMA, 40)
    checked = stream_replay_filter(stream, "producer", "seq", ["arrival"], 128)
    checkpoint, out, updated = work_path(spark, "w4k-ck"), work_path(spark, "w4k"), []
    for _ in range(3):  # each run starts anew from the checkpoint
        q = (checked.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
        q.awaitTermination()
        updated += [p["stateOperators"][0]["numRowsUpdated"] for p in q.recentProgress if p["stateOperators"]]
    assert updated == [40, 1, 1]
    reasons = {r.arrival: r.reason for r in spark.read.parquet(out).collect()}
    assert [reasons[i] for i in range(40, 45)] == ["replayed_seq", None, None, "negative_seq", None]
    assert {reasons[i] for i in range(45, 80)} == {"replayed_seq"}
    assert (reasons[80], reasons[81], reasons[82], reasons[119]) == ("missing_producer", "missing_seq", None, None)


def test_flushed_counts_add_up_and_state_empties(spark):
    rows = [(i, None if i % 5 == 0 else f"w{i % 3}") for i in range(90)]
    flushed = stream_partial_counts(_numbered(spark, rows, "arrival long, word string", 30), "word", 0.5)
    out = work_path(spark, "flushed")
    q = (flushed.writeStream.format("parquet").option("path", out).option("checkpointLocation", work_path(spark, "flush-ck"))
         .trigger(processingTime="0 seconds").start())
    drain(q, 3)
    got = {r.word: r.n for r in spark.read.parquet(out).groupBy("word").agg(F.sum("cnt").alias("n")).collect()}
    assert got == {None: 18, "w0": 24, "w1": 24, "w2": 24}
    assert not q.isActive


def _release(spark, horizon=100, **more):
    return StreamRelease(work_path(spark, "inc-counts"), work_path(spark, "inc-snaps"), "k", PrivacyParams(horizon=horizon), "s", "inc", **more)


def test_many_triggers_read_a_base_and_a_few_deltas(spark, monkeypatch):
    rel = _release(spark, cnt="n", compact_every=3)
    monkeypatch.setattr("veilspark.streaming.release.write_snapshot", lambda r, p, i, k: i == 26 and write_snapshot(r, p, i, k))
    rng = random.Random(3)
    read = []
    newest = rel._newest
    rel._newest = lambda s, e: (read.append(len(e["base"]) + len(e["deltas"])), newest(s, e))[1]
    for b in range(14):
        rel(spark.createDataFrame([(f"w{rng.randrange(30)}", rng.randint(1, 50)) for _ in range(4)], "k string, n long"), 2 * b)
    assert max(read) <= 4
    counts = spark.read.parquet(rel.counts_path)
    want = {(r.k, r.released, r["rank"]) for r in rel.release(counts.select("trigger_id", "k", "cnt")).collect()}
    assert {(r.key, r["count"], r["rank"]) for r in read_snapshot(spark, rel.snapshots_path).collect()} == want
    # a delta has the keys of its batch alone
    entry = CommitLog(spark, rel.state_path).latest()
    seen = counts.filter("trigger_id = 26").select("k").distinct().count()
    assert spark.read.parquet(f"{rel.state_path}/{entry['deltas'][-1]}").count() == seen if entry["deltas"] else True


def test_a_trigger_that_dies_is_done_again_without_counting_twice(spark, monkeypatch):
    rel = _release(spark, compact_every=2)
    batch = lambda *words: spark.createDataFrame([(w,) for w in words], "k string")
    rel(batch("a", "a", "b"), 0)
    monkeypatch.setattr(CommitLog, "commit", lambda *a: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        rel(batch("a", "c"), 1)  # before the totals are committed
    monkeypatch.undo()
    rel(batch("a", "c"), 1)
    real = snapshot.CommitLog.commit
    monkeypatch.setattr(CommitLog, "commit", lambda self, v, e: real(self, v, e) if "folder" not in e else (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        rel(batch("b"), 2)  # after the totals, before the snapshot is committed
    monkeypatch.undo()
    assert read_snapshot(spark, rel.snapshots_path).first().snapshot_id == 1
    rel(batch("b"), 2)
    rel(batch("b"), 2)  # and once more when all is done
    state = {r.k: (r.total, r.i) for r in rel._newest(spark, CommitLog(spark, rel.state_path).latest()).collect()}
    assert state == {"a": (3, 1), "b": (2, 2), "c": (1, 1)}
    want = {(r.k, r.released) for r in rel.release(spark.read.parquet(rel.counts_path).select("trigger_id", "k", "cnt")).collect()}
    assert {(r.key, r["count"]) for r in read_snapshot(spark, rel.snapshots_path).collect()} == want


def test_readers_never_see_a_half_written_snapshot(spark, monkeypatch):
    path = work_path(spark, "committed")
    release = lambda *rows: spark.createDataFrame(rows, "word string, released long, rank long")
    assert read_snapshot(spark, path) is None
    assert write_snapshot(release(("a", 5, 1)), path, 0, "word")
    monkeypatch.setattr(CommitLog, "commit", lambda *a: (_ for _ in ()).throw(OSError("died")))
    with pytest.raises(OSError):
        write_snapshot(release(("a", 6, 1), ("b", 1, 2)), path, 7, "word")
    monkeypatch.undo()
    assert [(r.snapshot_id, r.key, r["count"]) for r in read_snapshot(spark, path).collect()] == [(0, "a", 5)]
    assert read_snapshot(spark, path, 7) is None
    assert write_snapshot(release(("b", 2, 1)), path, 7, "word")  # again, whole
    assert not write_snapshot(release(("z", 9, 1)), path, 7, "word")  # the first commit stands
    assert [(r.snapshot_id, r.key, r["count"]) for r in read_snapshot(spark, path).collect()] == [(7, "b", 2)]
    assert read_snapshot(spark, path, 0).count() == 1 and CommitLog(spark, path).versions() == [0, 7]
    assert not [f for f in _names(spark, f"{path}/_commits") if not re.fullmatch(r"\.?\d{20}\.json(\.crc)?", f)]


def _names(spark, path):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return [f.getPath().getName() for f in folder.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(folder)]
