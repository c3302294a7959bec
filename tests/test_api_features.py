"""Own stages and sources (U1, U2), one evaluation for two outputs (I8), broken headers (P3), bounds and sketches (A7, A9), draws (D3)."""

import glob
import json
import os
import random
import sys

import pyarrow as pa
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from veilspark.functions.headers import parse_header
from veilspark.operators.calibration import best_bound, bound_error, exact_percentile, quantile_sketches, sketch_percentile
from veilspark.operators.integrity import apply_policy, split_by_verdict
from veilspark.operators.prep import keyed_uniform
from veilspark.params import PrivacyParams
from veilspark.plans.stages import ArrowStage, run_stages
from veilspark.session import work_path
from veilspark.sources.custom import SplitSource
from veilspark.streaming.run import run_to_parquet

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import tests


class Noted(ArrowStage):
    """Leaves a note when it opens and closes, and fails at a given value."""

    schema = "n long"

    def __init__(self, folder, bad=None):
        self.folder, self.bad = folder, bad

    def note(self, what):
        open(f"{self.folder}/{what}-{os.getpid()}-{random.random()}", "w").close()

    def open(self):
        self.note("open")
        return {"rows": 0}

    def process(self, handle, batch):
        if self.bad in batch.column(0).to_pylist():
            raise ValueError("bad value")
        handle["rows"] += batch.num_rows
        yield pa.RecordBatch.from_arrays(batch.columns, names=["n"])

    def flush(self, handle):
        yield pa.RecordBatch.from_arrays([pa.array([-handle["rows"]])], names=["n"])

    def close(self, handle):
        self.note("close")


def test_stages_open_and_close_once_a_task(spark, tmp_path):
    df = spark.range(10).select(F.col("id").alias("n")).repartition(2)
    got = [r.n for r in run_stages(df, [Noted(str(tmp_path)), lambda d: d.filter("n < 0")]).collect()]
    assert sum(got) == -10 and len(got) == len(glob.glob(f"{tmp_path}/open-*")) == len(glob.glob(f"{tmp_path}/close-*")) == 2


def test_a_stage_that_fails_is_closed(spark, tmp_path):
    df = spark.range(10).coalesce(1).select(F.col("id").alias("n"))
    with pytest.raises(Exception, match="bad value"):
        run_stages(df, [Noted(str(tmp_path), 3)]).collect()
    assert len(glob.glob(f"{tmp_path}/open-*")) == len(glob.glob(f"{tmp_path}/close-*")) > 0


class Squares(SplitSource):
    columns = "n long, square long"

    def splits(self, options):
        return [(0, 5), (5, 12)]

    def slices(self, options, start, end):
        return [(i, min(i + 4, end)) for i in range(start, end, 4)]

    def limit(self, options):
        return int(options["limit"])

    def open(self, options, split):
        open(f"{options['folder']}/open-{split[0]}-{random.random()}", "w").close()
        return options["folder"]

    def rows(self, handle, split):
        for n in range(*split):
            yield n, n * n

    def close(self, handle):
        open(f"{handle}/close-{random.random()}", "w").close()


def test_own_sources_read_and_stream_across_restarts(spark, tmp_path):
    spark.dataSource.register(Squares)
    batch = spark.read.format("Squares").option("folder", tmp_path).option("limit", 12).load()
    assert sorted(map(tuple, batch.collect())) == [(n, n * n) for n in range(12)]
    assert len(glob.glob(f"{tmp_path}/open-*")) == len(glob.glob(f"{tmp_path}/close-*")) == 2
    stream = spark.readStream.format("Squares").option("folder", tmp_path).option("limit", 25).option("rowsPerBatch", 10).load()
    checkpoint, out = work_path(spark, "squares-ck"), work_path(spark, "squares")
    for want in (10, 20, 25, 25):
        run_to_parquet(stream, "squares", out, checkpoint=checkpoint)
        assert sorted(map(tuple, spark.read.parquet(out).collect())) == [(n, n * n) for n in range(want)]
    with pytest.raises(Exception, match="rowsPerBatch"):
        run_to_parquet(spark.readStream.format("Squares").option("limit", 1).option("folder", tmp_path).load(), "x", checkpoint=work_path(spark, "x"))


def test_both_outputs_come_from_one_evaluation(spark, tmp_path):
    def counted(batches):
        for batch in batches:
            open(f"{tmp_path}/{random.random()}", "w").close()
            yield batch

    df = spark.range(20).coalesce(1).mapInArrow(counted, "id long").withColumn("reason", F.when(F.col("id") % 4 == 0, "fourth"))
    split = split_by_verdict(df)
    assert split.counts == {"accepted": 15, "quarantined": 5}
    assert sorted(r.id for r in split.accepted.collect()) == [i for i in range(20) if i % 4]
    assert [tuple(r) for r in split.reasons().collect()] == [("fourth", 5)] and split.accepted.columns == ["id"]
    assert len(os.listdir(tmp_path)) == 1
    accepted, quarantined = apply_policy(df.filter("id < 0"))
    assert accepted.count() == quarantined.count() == 0


def test_headers_give_the_pairs_before_they_break(spark):
    whole = {"source": "aü\"x", "destination": "b", "producer_id": "p", "seq": 12, "user_id": 7}
    text = json.dumps(whole)
    cuts = {text[:i]: {k: v for k, v in whole.items() if text.find(json.dumps(v), text.find(f'"{k}"') + len(k) + 3) + len(json.dumps(v)) <= i - (k in ("seq",))}
            for i in range(1, len(text) - 1)}
    cases = {'{"source":"a","destination":"b" "seq":1}': ("a", "b", None), '{"source":"a",}': ("a", None, None), '{"source":"a","seq":1x}': ("a", None, None),
             '{"source":"a\\q"}': None, '{"source":{"b":1}}': None, 'x{"source":"a"}': None, "{": None, '{"source":"a"': ("a", None, None)}
    df = spark.createDataFrame([(k,) for k in cases], "h string").select("h", parse_header("h").alias("p"))
    got = {r.h: r.p and (r.p.source, r.p.destination, r.p.seq) for r in df.collect()}
    for k, want in cases.items():
        assert got[k] == want or want is None and got[k] in (None, (None, None, None)) or k == '{"source":{"b":1}}'
    df = spark.createDataFrame([(k,) for k in cuts], "h string").select("h", parse_header("h").alias("p"))
    for r in df.collect():
        want = cuts[r.h]
        if "source" in want:
            assert r.p.source == whole["source"] and r.p.destination == want.get("destination") and r.p.producer_id == want.get("producer_id")
        else:
            assert r.p is None


def test_best_bound_against_every_bound(spark):
    rng = random.Random(9)
    for params in (PrivacyParams(), PrivacyParams(epsilon=0.5), PrivacyParams(epsilon=1000.0)):
        totals = [rng.choice((1, 3, rng.randint(0, 400), 250)) for _ in range(60)]
        df = spark.createDataFrame([(i, n) for i, n in enumerate(totals)], "user long, n long")
        noise = bound_error(params)
        want = min((sum(max(n - c, 0) for n in totals) ** 2 + noise * c * c, c) for c in range(1, max(totals) + 1))
        r = best_bound(df, params).first()
        assert r.max_contributions == want[1] and abs(r.error - want[0]) <= 1e-9 * want[0]
        assert r.dropped == sum(max(n - want[1], 0) for n in totals) and r.users_over == sum(n > want[1] for n in totals)
    assert best_bound(spark.createDataFrame([], "user long, n long"), PrivacyParams()).collect() == []


def test_sketches_of_days_merge_to_the_whole(spark):
    df = spark.range(40_000).select((F.col("id") % 7).alias("day"), (F.xxhash64("id") % 100_000).cast("double").alias("v"))
    days = quantile_sketches(df, "v", "day")
    n = df.count()
    for p in (0.0, 0.01, 0.5, 0.99, 1.0):
        merged = sketch_percentile(days, p).first()
        exact = exact_percentile(df, "v", p).first().value
        assert merged.n == n
        between = df.filter(F.col("v").between(min(merged.value, exact), max(merged.value, exact))).count()
        assert between <= 2 + n * merged.rank_error
    small = spark.createDataFrame([(0, float(x)) for x in range(1, 5)] + [(1, None)], "day long, v double")
    assert sketch_percentile(quantile_sketches(small, "v", "day"), 0.5).first().value == 2.5
    assert sketch_percentile(quantile_sketches(small.filter("v < 0"), "v", "day"), 0.5).collect() == []


def test_draws_are_even_for_any_total(spark):
    for total in (3, 1000, 3 * 2**60):
        rows = spark.range(30_000).select(keyed_uniform(total, F.lit("s"), F.col("id").cast("string")).alias("x"))
        cells = dict(rows.groupBy(F.floor(F.col("x") / F.lit(total / 3)).alias("c")).count().collect())
        assert set(cells) == {0, 1, 2}
        assert sum((n - 10_000) ** 2 / 10_000 for n in cells.values()) < 18  # chi-square with two degrees of freedom, beyond 1e-4
    assert rows.agg(F.max("x")).first()[0] > 2**61
