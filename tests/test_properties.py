"""Property tests: random arrival sequences against the sequential referees."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from models import SequentialReplay, sequential_bound
from veilspark.operators.bounding import bound_contributions
from veilspark.operators.integrity import replay_filter
from veilspark.session import work_path
from veilspark.streaming.replay import ReplayBatch

WINDOW = 8
SLOW = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

arrivals = st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(min_value=-3, max_value=60)),
                    min_size=1, max_size=120)


def _expected(rows, window):
    models, out = {}, {}
    for i, (p, s) in enumerate(rows):
        out[i] = models.setdefault(p, SequentialReplay(window)).accept(s)
    return out


@SLOW
@given(rows=arrivals, blocks=st.sampled_from([1, 2, 5]))
def test_replay_filter_property(spark, rows, blocks):
    df = spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(rows)], "arrival long, producer string, seq long")
    got = {r["arrival"]: r["reason"] is None
           for r in replay_filter(df, "producer", "seq", ["arrival"], WINDOW, "reason", n_blocks=blocks).collect()}
    assert got == _expected(rows, WINDOW)


@SLOW
@given(rows=arrivals, cuts=st.lists(st.integers(min_value=0, max_value=120), max_size=3))
def test_replay_carry_across_batches_property(spark, rows, cuts):
    bounds = sorted({0, len(rows), *[c for c in cuts if c < len(rows)]})
    df = spark.createDataFrame([(i, p, s) for i, (p, s) in enumerate(rows)], "arrival long, producer string, seq long")
    out, state = work_path(spark, "prop-out"), work_path(spark, "prop-state")
    fn = ReplayBatch(out, state, "producer", "seq", ["arrival"], WINDOW)
    for b, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        fn(df.filter((F.col("arrival") >= lo) & (F.col("arrival") < hi)), b)
    got = {r["arrival"]: r["reason"] is None for r in spark.read.parquet(out).collect()}
    assert got == _expected(rows, WINDOW)


@SLOW
@given(users=st.lists(st.one_of(st.none(), st.integers(min_value=0, max_value=4)), min_size=1, max_size=150),
       limit=st.integers(min_value=1, max_value=6))
def test_bounding_property(spark, users, limit):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(users)], "arrival long, user long").repartition(3)
    got = {r["arrival"] for r in bound_contributions(df, "user", ["arrival"], limit).collect()}
    assert got == set(sequential_bound([(u, i) for i, u in enumerate(users)], limit))
