"""Plan-shape guards for scale: no cross joins, pruned scans, partial limits and aggregates where promised."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL

STREAMING = {"stream_bounding", "stream_replay", "stream_release", "stream_flush"}
BATCH = sorted(set(E.queries()) - STREAMING)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_or_nested_loop_joins(spark, name):
    plan = _plan(E.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_are_pruned(spark):
    plan = _plan(E.queries()["word_count"](spark, SF_SMALL))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\]", plan)
    assert scans
    for cols in scans:  # only the text column of documents is read
        names = {c.split("#")[0] for c in cols.split(",")}
        assert names == {"text"}, names


def test_bounding_has_partial_group_limit_before_the_shuffle(spark):
    df = E.queries()["bounded_word_count"](spark, SF_SMALL)
    phys = df._jdf.queryExecution().executedPlan()
    text = phys.toString()
    assert "WindowGroupLimit" in text
    # the partial limit sits below (before) the exchange on the user
    partial = df._jdf.queryExecution().sparkPlan().toString()
    assert re.search(r"WindowGroupLimit .*Partial", partial)


def test_counts_use_partial_aggregation(spark):
    text = _plan(E.queries()["word_count"](spark, SF_SMALL))
    assert "partial_count" in text
