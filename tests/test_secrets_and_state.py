"""Secrets outside logs, bodies outside the work folder, stream state that fails closed."""

import json
import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from veilspark.functions.headers import update_header
from veilspark.functions.noise import hmac_pads
from veilspark.operators.sealing import reroute, seal, unseal_table
from veilspark.params import PrivacyParams
from veilspark.session import ensure_checkpoint_dir, materialize, work_path
from veilspark.streaming.release import StreamRelease
from veilspark.streaming.replay import ReplayBatch
from veilspark.streaming.run import run_foreach_batch, run_to_parquet

KEY = "5ea1" * 16
SECRET = "a noise secret"

_LOGGED = """
import sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import functions as F
from veilspark.operators.dp import dp_prefix_sums
from veilspark.operators.sealing import seal, unseal_table
from veilspark.params import PrivacyParams
from veilspark.session import build_session
spark = build_session("local[2]", 2, driver_memory="1g", extra={
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": "file://" + sys.argv[2], "spark.eventLog.compress": "false",
    "spark.checkpoint.dir": sys.argv[2] + "/work"})
spark.createDataFrame([("marker body",)], "p string").createOrReplaceTempView("t")
sealed = seal(spark.table("t"), F.col("p"), F.lit("{}"), sys.argv[3])
sealed.write.parquet(sys.argv[2] + "/work/sealed")
assert unseal_table(spark.read.parquet(sys.argv[2] + "/work/sealed"), sys.argv[3]).first()["plaintext"] == "marker body"
counts = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 2.0)], "key string, i long, cnt double")
dp_prefix_sums(counts, "key", PrivacyParams(horizon=4), sys.argv[4], "log").write.parquet(sys.argv[2] + "/work/release")
spark.stop()
"""


def test_no_secret_in_the_event_log(tmp_path):
    (tmp_path / "work").mkdir()
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", _LOGGED, root, str(tmp_path), KEY, SECRET], check=True, timeout=240, capture_output=True)
    logs = [p for p in tmp_path.rglob("*") if p.is_file() and "work" not in p.parts]
    text = "".join(p.read_text(errors="replace") for p in logs).lower()
    assert "sparklistenersqlexecutionstart" in text
    ipad, opad = hmac_pads(SECRET)
    for secret in (KEY, SECRET, SECRET.encode().hex(), ipad, opad, ipad[:64], opad[:64]):
        assert secret.lower() not in text


def _sealed(spark, rows):
    df = spark.createDataFrame(rows, "id long, h string, body string")
    return materialize(seal(df, F.col("body"), F.col("h"), KEY).drop("h", "body"))


def test_reroute_keeps_attributes_and_writes_no_body(spark):
    header = {"source": "_DATASET", "destination": "_MAPPER"}
    rows = [(i, json.dumps(header | extra), f"marker body {i}") for i, extra in enumerate(
        [{"tenant": "x", "n": 1.5, "deep": {"a": [1, None]}}, {}, {"user_id": None, "seq": 99}, {"user_id": 7, "z": True}])]
    rows.append((4, json.dumps(header | {"destination": "other"}), "marker body 4"))
    before = {p for p, _, _ in os.walk(ensure_checkpoint_dir(spark).replace("file://", ""))}
    out = reroute(_sealed(spark, rows), KEY, "stage", "next", "p1", ["id"])
    got = {r.id: r for r in materialize(out).collect()}
    want = {"source": "stage", "destination": "next", "producer_id": "p1"}
    for i in range(4):
        old = {k: v for k, v in json.loads(rows[i][1]).items() if k not in ("source", "destination", "seq")}
        assert json.loads(got[i].header) == old | want | {"seq": i}
        assert list(json.loads(got[i].header)) == sorted(json.loads(got[i].header))
    assert got[4].reason == "destination_mismatch" and got[4].header is None
    opened = unseal_table(out.filter("reason is null"), KEY).collect()
    assert {r.id: r.plaintext for r in opened} == {i: f"marker body {i}" for i in range(4)}
    for folder, _, names in os.walk(ensure_checkpoint_dir(spark).replace("file://", "")):
        if folder not in before:
            for name in names:
                with open(os.path.join(folder, name), "rb") as f:
                    assert b"marker body" not in f.read()


def test_update_header_values(spark):
    df = spark.createDataFrame([('{"b":1,"a":"x","c":null}',), (None,), ("",), ("[1]",), ("no json",)], "h string")
    got = [r[0] for r in df.select(update_header("h", {"a": F.lit("y"), "n": F.lit(3).cast("long")})).collect()]
    assert got == ['{"a":"y","b":1,"c":null,"n":3}'] + ['{"a":"y","n":3}'] * 4


def _replay(spark):
    out, state = work_path(spark, "r-out"), work_path(spark, "r-state")
    return ReplayBatch(out, state, "producer", "seq", ["arrival"], 16), out, state


def _batch(spark, rows):
    return spark.createDataFrame(rows, "arrival long, producer string, seq long")


def test_replay_needs_the_carry_of_the_batch_before(spark):
    fn, out, state = _replay(spark)
    fn(_batch(spark, [(0, "p", 10), (1, "p", 11), (2, "q", 5)]), 0)
    fn(_batch(spark, []), 1)  # an empty batch hands the carry on
    fn(_batch(spark, [(3, "p", 10), (4, "p", 12)]), 2)
    fn(_batch(spark, [(5, "q", 5), (6, "q", 6)]), 3)  # q was in no batch since the first
    reasons = {r.arrival: r.reason for r in spark.read.parquet(out).collect()}
    assert [reasons[i] is None for i in range(7)] == [True, True, True, False, True, False, True]
    fn.state_path = work_path(spark, "moved")
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        fn(_batch(spark, [(7, "p", 10)]), 4)


def test_streams_need_a_checkpoint(spark):
    with pytest.raises(TypeError):
        run_to_parquet(spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load(), "x")
    with pytest.raises(TypeError):
        run_foreach_batch(spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load(), lambda d, i: None, "x")


def test_releases_stop_at_the_horizon(spark):
    counts, snaps = work_path(spark, "h-counts"), work_path(spark, "h-snaps")
    rel = StreamRelease(counts, snaps, "k", PrivacyParams(horizon=2), SECRET, "h")
    for i in range(4):
        rel(spark.createDataFrame([("a",)] * (i + 1), "k string"), i)
    rel(spark.createDataFrame([("a",)] * 2, "k string"), 1)  # a batch that runs again is no new trigger
    assert sorted(r[0] for r in spark.read.parquet(counts).select("trigger_id").distinct().collect()) == [0, 1]
    assert {r[0] for r in spark.read.parquet(snaps).select("snapshot_id").distinct().collect()} <= {0, 1}
    assert rel.cut_triggers == 2


def test_no_machine_local_folder_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *a):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_header_numbers(spark):
    from veilspark.functions.headers import parse_header

    cases = {'{"seq":5.7}': 5, '{"seq":1e3}': 1000, '{"seq":"7"}': 7, '{"seq":" 7 "}': None, '{"seq":"5.7"}': None, '{"seq":-3}': -3,
             '{"seq":9223372036854775807}': 2**63 - 1, '{"seq":"x"}': None, '{"seq":null}': None, '{"a":1}': None}
    df = spark.createDataFrame([(k,) for k in cases], "h string")
    assert {r.h: r.s for r in df.select("h", parse_header("h")["seq"].alias("s")).collect()} == cases


def test_sealed_values_must_be_text(spark, tmp_path):
    from veilspark.sources.sealed import read_sealed

    (tmp_path / "a.json").write_text('{"header":{"a":1},"nonce":"AAAA","ciphertext":"AAAA"}\n{"header":"h","nonce":null,"ciphertext":"AAAA"}\n'
                                     '{"header":null,"nonce":"AAAA","ciphertext":"AAAA"}\n{"nonce":"AAAA","ciphertext":"AAAA"}\n')
    rows = read_sealed(spark, str(tmp_path / "a.json")).collect()
    assert sorted((r.header, r.nonce) for r in rows if r.nonce) == [("", bytearray(3))] and [r.header for r in rows if not r.nonce] == ["h"]
    (tmp_path / "b.json").write_text('{"header":"h","nonce":1234,"ciphertext":"AAAA"}\n')
    with pytest.raises(Exception, match="nonce must be text"):
        read_sealed(spark, str(tmp_path / "b.json")).collect()
