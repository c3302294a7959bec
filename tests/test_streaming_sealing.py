"""W1, W4, W3 over several micro-batches vs their batch twins; C1/C2/S1 round trips."""

import json
import os
import time

import pytest
from pyspark.sql import functions as F

from veilspark.operators.bounding import bound_contributions
from veilspark.operators.integrity import replay_filter
from veilspark.operators.sealing import key_hex, seal_rows, unseal_table
from veilspark.session import work_path
from veilspark.sources.sealed import read_sealed, write_sealed
from veilspark.streaming.bounding import stream_bound_contributions
from veilspark.streaming.release import StreamRelease
from veilspark.streaming.replay import ReplayBatch
from veilspark.streaming.run import parquet_stream, run_foreach_batch, run_to_parquet
from veilspark.params import PrivacyParams

from conftest import SF_SMALL

KEY = "11" * 32


def _split_events(spark, parts=3):
    """The events table written as ``parts`` files in arrival order (one micro-batch each)."""
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    n = ev.count()
    base = work_path(spark, "events-split")
    for k in range(parts):
        lo, hi = k * n // parts, (k + 1) * n // parts
        ev.filter((F.col("event_id") >= lo) & (F.col("event_id") < hi)).coalesce(1).write.parquet(f"{base}/part{k}")
        time.sleep(1.1)  # distinct modification times keep the file order
    return base, ev


def _stream(spark, base):
    schema = spark.read.parquet(f"{base}/part0").schema
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1)
            .option("recursiveFileLookup", "true").parquet(base))


def test_stream_bounding_equals_batch_over_batches(spark):
    base, ev = _split_events(spark)
    kept = stream_bound_contributions(_stream(spark, base).select("event_id", "ts", "user_id", "event_type"),
                                      "user_id", ["ts", "event_id"], 5)
    ckpt = work_path(spark, "w1-ckpt")
    out = run_to_parquet(kept, "w1", checkpoint=ckpt)
    got = {r["event_id"] for r in spark.read.parquet(out).collect()}
    want = {r["event_id"] for r in bound_contributions(ev, "user_id", ["ts", "event_id"], 5).collect()}
    assert got == want
    # a restart from the same checkpoint processes nothing new and changes nothing
    run_to_parquet(kept, "w1", out_path=out, checkpoint=ckpt)
    assert {r["event_id"] for r in spark.read.parquet(out).collect()} == got


def test_stream_replay_equals_batch_over_batches(spark):
    base, ev = _split_events(spark)
    prep = lambda d: d.select("event_id", "ts", F.col("event_type").alias("producer_id"),
                              (F.col("event_id") - (F.col("event_id") * 37) % 200).alias("seq"))
    out, state = work_path(spark, "w4-out"), work_path(spark, "w4-state")
    run_foreach_batch(prep(_stream(spark, base)), ReplayBatch(out, state, "producer_id", "seq", ["ts", "event_id"], 128),
                      "w4", checkpoint=work_path(spark, "w4-ckpt"))
    got = {r["event_id"]: r["reason"] for r in spark.read.parquet(out).collect()}
    want = {r["event_id"]: r["r"] for r in
            replay_filter(prep(ev), "producer_id", "seq", ["ts", "event_id"], 128, "r").collect()}
    assert got == want
    assert spark.read.parquet(out).select("batch_id").distinct().count() == 3


def test_stream_release_one_trigger_per_batch(spark):
    base, _ = _split_events(spark)
    counts, snaps = work_path(spark, "w3-counts"), work_path(spark, "w3-snaps")
    rel = StreamRelease(counts, snaps, "event_type", PrivacyParams(), "s", "unit")
    run_foreach_batch(_stream(spark, base).select("event_type"), rel, "w3", checkpoint=work_path(spark, "w3-ckpt"))
    s = spark.read.parquet(snaps)
    assert sorted(r[0] for r in s.select("snapshot_id").distinct().collect()) == [0, 1, 2]
    # the last snapshot equals a batch release over the three triggers
    c = spark.read.parquet(counts)
    assert c.select("trigger_id").distinct().count() == 3
    want = {(r["event_type"], r["released"]) for r in rel.release(c.select("trigger_id", "event_type", "cnt")).collect()}
    got = {(r["key"], r["count"]) for r in s.filter("snapshot_id = 2").collect()}
    assert got == want


def test_seal_roundtrip_and_tamper(spark):
    df = spark.createDataFrame([(i, f"text {i} é") for i in range(50)], "id long, body string")
    sealed = seal_rows(df, {"source": F.lit("_DATASET"), "destination": F.lit("_MAPPER"), "user_id": F.col("id")}, KEY)
    path = work_path(spark, "sealed")
    write_sealed(sealed, path, extra_cols=["id"])
    back = read_sealed(spark, path, extra_schema="id long")
    assert {r["n"] for r in back.select(F.octet_length("nonce").alias("n")).collect()} == {12}
    ok = unseal_table(back, KEY).collect()
    assert all(json.loads(r["plaintext"])["body"] == f"text {r['id']} é" for r in ok)
    bad = unseal_table(back.withColumn("header", F.concat("header", F.lit(" "))), KEY)
    assert bad.filter(F.col("seal_reason").isNull()).count() == 0
    wrong = unseal_table(back, "22" * 32)
    assert wrong.filter(F.col("plaintext").isNotNull()).count() == 0


def test_sealed_scan_json_array_and_bad_key(spark, tmp_path):
    p = tmp_path / "arr.json"
    p.write_text(json.dumps([{"header": "{}", "nonce": "AAAAAAAAAAAAAAAA", "ciphertext": "AAAA"},
                             {"nonce": "AAAA", "ciphertext": "AAAA"}]))
    got = read_sealed(spark, str(p), multi_line=True).collect()
    assert len(got) == 1 and len(got[0]["nonce"]) == 12
    with pytest.raises(ValueError):
        key_hex("00" * 16)


def test_sealed_scan_strict_requires_array(spark, tmp_path):
    good, bad = tmp_path / "good.json", tmp_path / "bad.json"
    good.write_text('\n [{"header": "{}", "nonce": "AAAAAAAAAAAAAAAA", "ciphertext": "AAAA"}]')
    bad.write_text('{"header": "{}", "nonce": "AAAAAAAAAAAAAAAA", "ciphertext": "AAAA"}')
    assert read_sealed(spark, str(good), multi_line=True, strict=True).count() == 1
    assert read_sealed(spark, str(bad), multi_line=True).count() == 1  # lenient: one record
    with pytest.raises(Exception, match="JSON array"):
        read_sealed(spark, str(bad), multi_line=True, strict=True).collect()
