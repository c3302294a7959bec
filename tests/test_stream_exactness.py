"""Streams keep values and order exactly as their batch twins: BIGINTs beside nulls, null orders, NaN."""

from pyspark.sql import functions as F

from veilspark.operators.bounding import bound_contributions
from veilspark.operators.integrity import sequence_stamp
from veilspark.operators.release import snapshot_series
from veilspark.session import work_path
from veilspark.streaming.bounding import stream_bound_contributions
from veilspark.streaming.run import run_to_parquet

BIG = 2**53 + 1


def _written(spark, batches, schema):
    """One file for each micro-batch, in name order by time."""
    import time

    base = work_path(spark, "exact-in")
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{base}/part{i}")
        time.sleep(1.1)
    return base, spark.read.option("recursiveFileLookup", "true").parquet(base)


def _stream(spark, base, schema):
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(base))


def test_bounded_streams_keep_bigints_and_null_orders(spark):
    schema = "id long, user long, at long, score double, payload long, tags array<string>"
    one = [(1, 7, None, 1.0, BIG, ["a"]), (2, 7, 5, None, None, None), (3, 7, 4, float("nan"), BIG + 2, []), (4, None, 1, 0.0, BIG + 4, ["x"]),
           (5, BIG, 3, 2.0, None, ["b"]), (6, BIG, None, 2.0, BIG + 6, None)]
    two = [(7, 7, None, 0.5, BIG + 8, ["late"]), (8, BIG, 1, 0.5, None, None), (9, BIG + 2, 1, float("nan"), BIG, None),
           (10, BIG + 2, 1, None, BIG, None), (11, BIG + 2, 1, 3.0, BIG + 1, None)]
    base, table = _written(spark, [one], schema)
    order = ["at", "score", "id"]
    for limit in (1, 2):
        got = run_to_parquet(stream_bound_contributions(_stream(spark, base, schema), "user", order, limit), "x",
                             checkpoint=work_path(spark, "exact-ck"))
        want = bound_contributions(table, "user", order, limit).select(table.columns).collect()
        assert sorted(map(str, spark.read.parquet(got).collect())) == sorted(map(str, want))
    base, table = _written(spark, [one, two], schema)
    got = spark.read.parquet(run_to_parquet(stream_bound_contributions(_stream(spark, base, schema), "user", order, 3), "x",
                                            checkpoint=work_path(spark, "exact-ck"))).collect()
    given = {r[0]: str(tuple(r)) for r in one + two}
    assert all(str(tuple(r)) == given[r.id] for r in got)
    # batches arrive one after the other: within one its order decides, and NaN comes after every number
    assert sorted(r.id for r in got) == [1, 2, 3, 4, 5, 6, 8, 9, 10, 11]


def test_null_producers_are_numbered_through_all_blocks(spark):
    df = spark.range(60).select(F.col("id"), F.when(F.col("id") % 3 != 0, (F.col("id") % 3).cast("string")).alias("producer"))
    got = sequence_stamp(df, "producer", ["id"], n_blocks=4).collect()
    for p in (None, "1", "2"):
        assert sorted(r.seq for r in got if r.producer == p) == list(range(20))


def test_snapshots_end_at_the_horizon(spark):
    rel = spark.createDataFrame([("a", 1, 2.0), ("a", 5, 9.0), ("b", 0, 1.0), ("b", 2, 4.0), ("c", 3, 1.0)], "k string, i long, noisy double")
    got = sorted((r.t, r.k, r.released) for r in snapshot_series(rel, "k", 3).collect())
    assert got == [(0, "b", 1), (1, "a", 2), (1, "b", 1), (2, "a", 2), (2, "b", 4)]
    assert snapshot_series(rel, "k", 0).collect() == []
