"""U4 + T1-T3 against a sequential, tick-by-tick model of the histogram service."""

import math
import os
import re

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from models import HeapTree, keyed_gauss
from veilspark.functions.noise import release_scope
from veilspark.params import PrivacyParams
from veilspark.plans.stages import word_histogram

SECRET, STREAM = "model-secret", "model"


def _tokens(text):
    return [w.lower() for w in re.split(r"[^A-Za-z0-9_]+", text or "") if w]


def _sequential(rows, params, sigma):
    """rows: (user, turn, text) -> (final ordered release, {t: {word: released}})."""
    # arrival order: (user, turn, pos); each user bounded to C tokens over the whole run (user level only)
    per_user = {}
    contrib = []
    for user, turn, text in sorted(rows, key=lambda r: (r[0], r[1])):
        for w in _tokens(text):
            per_user[user] = per_user.get(user, 0) + 1
            if not params.user_level or per_user[user] <= params.max_contributions:
                contrib.append((turn, w))
    # one trigger per turn value, in turn order; empty triggers do not exist in the data
    by_trigger = {}
    for turn, w in contrib:
        by_trigger.setdefault(turn, {}).setdefault(w, 0)
        by_trigger[turn][w] += 1
    forest, current, snapshots = {}, {}, {}
    for i, turn in enumerate(sorted(by_trigger)):
        for w, c in by_trigger[turn].items():
            tree = forest.setdefault(
                w, HeapTree(params.horizon, lambda j, k=w: sigma * keyed_gauss(SECRET, release_scope(STREAM, params, sigma, "turn"), k, j)))
            if i < params.horizon:
                tree.add(i, c)
                current[w] = tree.prefix(i)
        if i < params.horizon:
            snap = {w: math.floor(v + 0.5) for w, v in current.items() if math.floor(v + 0.5) >= 0}
            snapshots[i] = snap
    ordered = sorted(current.items(), key=lambda kv: (-kv[1], kv[0]))
    final = [(w, math.floor(v + 0.5)) for w, v in ordered if math.floor(v + 0.5) >= 0]
    return final, snapshots


@pytest.mark.parametrize("eps,user_level", [(10.0, True), (1.0, True), (10.0, False)])
def test_word_histogram_matches_sequential_service(spark, eps, user_level):
    params = PrivacyParams(epsilon=eps, max_contributions=50, user_level=user_level)
    conv = spark.read.parquet(os.path.join(SF_SMALL, "conversations.parquet")).select(
        F.col("conv_id").alias("user_id"), "turn", "text")
    res = word_histogram(conv, "text", "user_id", "turn", ["turn"], params, SECRET, STREAM)
    got = [(r["word"], r["released"]) for r in res.ordered.orderBy("rank").collect()]
    final, snaps = _sequential([tuple(r) for r in conv.collect()], params, params.sigma)
    assert got == final
    series = {}
    for r in res.snapshots().collect():
        series.setdefault(r["t"], {})[r["word"]] = r["released"]
    assert {t: series.get(t, {}) for t in snaps} == snaps
