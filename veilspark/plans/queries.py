"""Registered queries: one per operator of the inventory, over the driver tables.

Each callable takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names match the DuckDB oracle in ``veilspark.plans.oracles``.  Every query
reads whole tables; no row caps, id subsets or prefixes.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilspark.functions.text import tokenize, unicode_word_count
from veilspark.operators import bounding, calibration, counts, dp, release
from veilspark.plans import fixtures as fx
from veilspark.plans.histogram import private_histogram
from veilspark.plans.stages import ArrowStage, run_stages
from veilspark.params import PrivacyParams
from veilspark.session import materialize, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}

# Fixed values of the fixtures (FIXTURES.md §3)
TEST_SECRET = "veilspark-fixture-secret"   # test key for keyed noise; never a production secret
EVENT_STREAM = "events/event_type"
WORD_STREAM = "conversations/word"
PARAMS = PrivacyParams()                   # eps 10, delta 1e-5, T 60, C 50, L_m 1
WIDE_NOISE = PARAMS.with_(epsilon=1.0)     # sigma ~409: makes negative releases appear
SHORT_HORIZON = PARAMS.with_(horizon=16)
FLUSH_SECONDS = 3600
CLAMP_LIMIT = 50.0
GRID_BOUNDS = (5, 50, 500)
GRID_EPSILONS = (0.1, 1.0, 10.0)
DOC_USERS = 50


def register(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn

    return deco


# ------------------------------------------------------------------ text

@register("tokenize")
def q_tokenize(spark, sf_dir):
    """Conversation tokens with the user (conv_id) carried along."""
    return fx.conversation_tokens(spark, sf_dir).select("user_id", "turn", "pos", "word")


@register("word_count")
def q_word_count(spark, sf_dir):
    """P2 + count: tokens of every document, counted per word."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    toks = tokenize(docs, "text", keep=["doc_id"])
    return toks.groupBy("word").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


@register("unicode_words")
def q_unicode_words(spark, sf_dir):
    """Unicode word count per document."""
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", unicode_word_count("text").alias("words"))


# ------------------------------------------------------------------ bounding

@register("bounded_word_count")
def q_bounded_word_count(spark, sf_dir):
    """P2 -> B1 (C=50 per conversation) -> count per word."""
    toks = fx.conversation_tokens(spark, sf_dir)
    kept = bounding.bound_contributions(toks, "user_id", fx.CONVERSATION_ORDER, PARAMS.max_contributions)
    return kept.groupBy("word").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


@register("bound_contributions")
def q_bound_contributions(spark, sf_dir):
    """B1 on events: first 50 events of each user by (ts, event_id)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    kept = bounding.bound_contributions(ev, "user_id", fx.EVENT_ORDER, PARAMS.max_contributions, rank_col="rank")
    return kept.select("event_id", "user_id", "event_type", "rank")


@register("bound_null_user")
def q_bound_null_user(spark, sf_dir):
    """B2: events whose user is unknown (event_id % 10 = 0) are always kept."""
    ev = table(spark, sf_dir, "events").select(
        "event_id", "ts", "event_type",
        F.when(F.col("event_id") % 10 == 0, F.lit(None).cast("long")).otherwise(F.col("user_id")).alias("user_id"),
    )
    kept = bounding.bound_contributions(ev, "user_id", fx.EVENT_ORDER, PARAMS.max_contributions)
    return kept.select("event_id", "user_id", "event_type")


@register("event_level_count")
def q_event_level_count(spark, sf_dir):
    """Event-level mode skips bounding; counts per (trigger, event_type)."""
    ev = fx.events(spark, sf_dir)
    rows = bounding.apply_privacy_level(ev, PARAMS.with_(user_level=False), "user_id", fx.EVENT_ORDER)
    return rows.groupBy("trigger_id", "event_type").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


@register("clamped_sum")
def q_clamped_sum(spark, sf_dir):
    """B1 + B4: bounded events, value clamped to +-50, summed per event_type."""
    ev = table(spark, sf_dir, "events")
    kept = bounding.bound_contributions(ev, "user_id", fx.EVENT_ORDER, PARAMS.max_contributions)
    return kept.groupBy("event_type").agg(
        F.round(F.sum(bounding.clamp("value", CLAMP_LIMIT)), 6).alias("clamped_sum"),
        F.count(F.lit(1)).cast("long").alias("cnt"),
    )


# ------------------------------------------------------------------ counting

def _bounded_events(spark, sf_dir) -> DataFrame:
    ev = fx.events(spark, sf_dir).withColumn("flush_id", counts.flush_bucket("ts", FLUSH_SECONDS))
    return bounding.bound_contributions(ev, "user_id", fx.EVENT_ORDER, PARAMS.max_contributions)


def _partials(spark, sf_dir) -> DataFrame:
    b = _bounded_events(spark, sf_dir)
    # a flush bucket (1 h) lies inside one trigger (1 day): carry the trigger along
    return b.groupBy("flush_id", "trigger_id", "event_type").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


@register("partial_counts")
def q_partial_counts(spark, sf_dir):
    """Per hourly flush bucket, count of each event_type after bounding."""
    return _partials(spark, sf_dir).select("flush_id", "event_type", "cnt")


@register("merged_counts")
def q_merged_counts(spark, sf_dir):
    """A2: partial counts merged per (day trigger, event_type)."""
    return counts.merged_counts(_partials(spark, sf_dir), "event_type", "trigger_id")


def _indexed(spark, sf_dir, horizon=None) -> DataFrame:
    merged = materialize(counts.merged_counts(_partials(spark, sf_dir), "event_type", "trigger_id"), "trigger-counts")
    trig = counts.trigger_index(merged, "trigger_id", "i")
    return counts.with_trigger_index(merged, trig, "trigger_id", "i", horizon=horizon)


@register("trigger_index")
def q_trigger_index(spark, sf_dir):
    """A3: 0-based index of the non-empty day triggers."""
    merged = materialize(counts.merged_counts(_partials(spark, sf_dir), "event_type", "trigger_id"), "trigger-counts")
    return counts.trigger_index(merged, "trigger_id", "i")


@register("prefix_sum")
def q_prefix_sum(spark, sf_dir):
    """A4: noise-free running count per event_type over trigger indices."""
    idx = _indexed(spark, sf_dir, PARAMS.horizon)
    return counts.prefix_sum(idx, "event_type", "i", "cnt", "prefix").select("event_type", "i", "cnt", "prefix")


def _releases(spark, sf_dir, params=PARAMS) -> DataFrame:
    idx = _indexed(spark, sf_dir, params.horizon).select("event_type", "i", "cnt")
    return dp.dp_prefix_sums(idx, "event_type", params, TEST_SECRET, EVENT_STREAM)


@register("dp_prefix_sum")
def q_dp_prefix_sum(spark, sf_dir):
    """A5: keyed tree noise added to every running count (eps 10, T 60, C 50)."""
    r = _releases(spark, sf_dir)
    return r.select("event_type", "i", "cnt", "prefix", F.round("noisy", 6).alias("noisy"))


@register("horizon_cut")
def q_horizon_cut(spark, sf_dir):
    """With T = 16, counts at trigger index >= 16 are cut (and reported)."""
    idx = _indexed(spark, sf_dir, None)
    return dp.horizon_split(idx, "event_type", SHORT_HORIZON.horizon)


@register("release_round")
def q_release_round(spark, sf_dir):
    """Half-up rounding of noisy releases, negatives dropped (eps 1 -> wide noise)."""
    r = _releases(spark, sf_dir, WIDE_NOISE)
    return release.rounded_release(r, "noisy", "released").select("event_type", "i", "released")


@register("latest_snapshot")
def q_latest_snapshot(spark, sf_dir):
    """Each event_type's latest release."""
    latest = release.latest_per_key(_releases(spark, sf_dir), "event_type")
    return latest.select("event_type", "i", F.round("noisy", 6).alias("noisy"))


@register("release_order")
def q_release_order(spark, sf_dir):
    """T1 + P8: latest releases rounded and ranked by noisy value, then key."""
    latest = release.latest_per_key(_releases(spark, sf_dir, WIDE_NOISE), "event_type")
    return release.ordered_release(latest, "event_type").select("rank", "event_type", "released")


@register("snapshot_series")
def q_snapshot_series(spark, sf_dir):
    """The full released histogram after every trigger."""
    r = _releases(spark, sf_dir, WIDE_NOISE)
    n = r.agg(F.max("i")).first()[0]
    snaps = release.snapshot_series(r, "event_type", 0 if n is None else int(n) + 1)
    return snaps.select("t", "event_type", "release_i", "released")


@register("private_word_histogram")
def q_private_word_histogram(spark, sf_dir):
    """U4: the whole pipeline on conversation words; trigger = turn, user = conversation."""
    toks = fx.conversation_tokens(spark, sf_dir)
    res = private_histogram(toks, "word", "turn", "user_id", fx.CONVERSATION_ORDER, PARAMS, TEST_SECRET,
                            WORD_STREAM)
    return res.ordered.select("rank", "word", "i", "released")


# ------------------------------------------------------------------ choosing C

def _doc_totals(spark, sf_dir) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        (F.col("doc_id") % DOC_USERS).alias("user_id"), unicode_word_count("text").alias("words")
    )
    return calibration.user_totals(docs, "user_id", F.col("words"))


@register("user_totals")
def q_user_totals(spark, sf_dir):
    """A8 + D4: Unicode word totals per user (user = doc_id % 50)."""
    return _doc_totals(spark, sf_dir)


@register("contribution_percentile")
def q_contribution_percentile(spark, sf_dir):
    """Exact 99th percentile of the per-user totals."""
    pct = calibration.exact_percentile(_doc_totals(spark, sf_dir), "n", 0.99)
    return pct.select("p", F.round("value", 6).alias("value"))


@register("event_percentile")
def q_event_percentile(spark, sf_dir):
    """A9 on events: exact 99th percentile of events per user."""
    per_user = table(spark, sf_dir, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    pct = calibration.exact_percentile(per_user, "n", 0.99)
    return pct.select("p", F.round("value", 6).alias("value"))


@register("contribution_summary")
def q_contribution_summary(spark, sf_dir):
    """A10: records, users, min, max and mean per-user total."""
    s = calibration.contribution_summary(_doc_totals(spark, sf_dir))
    return s.select("records", "users", "total", "min_n", "max_n", F.round("mean_n", 6).alias("mean_n"))


@register("bounding_loss")
def q_bounding_loss(spark, sf_dir):
    """A7 (data half): contributions each C in {5, 50, 500} would drop."""
    out = calibration.bounding_loss(_doc_totals(spark, sf_dir), GRID_BOUNDS)
    return out.withColumn("loss", F.round("loss", 9))


@register("calibration_sweep")
def q_calibration_sweep(spark, sf_dir):
    """(C, eps) grid -> rho and sigma, next to each C's data loss."""
    loss = calibration.bounding_loss(_doc_totals(spark, sf_dir), GRID_BOUNDS)
    sweep = calibration.calibration_sweep(loss, GRID_EPSILONS, PARAMS.delta, PARAMS.horizon, PARAMS.per_record_clamp)
    return sweep.select("max_contributions", F.round("loss", 9).alias("loss"), "epsilon", "delta", "horizon",
                        F.round("rho", 9).alias("rho"), F.round("sigma", 6).alias("sigma"))


@register("best_bound")
def q_best_bound(spark, sf_dir):
    """A7 over every C: the bound of least squared bias plus release variance for the document totals."""
    out = calibration.best_bound(_doc_totals(spark, sf_dir), PARAMS)
    return out.withColumns({c: F.round(c, 6) for c in ("loss", "noise_variance", "error")})


@register("sketch_percentile")
def q_sketch_percentile(spark, sf_dir):
    """A9 per trigger: a sketch of event values for each day, written, merged; is the 99th percentile within the stated rank error?"""
    ev = fx.events(spark, sf_dir).select("trigger_id", "value")
    sketches = materialize(calibration.quantile_sketches(ev, "value", "trigger_id"), "value-sketches")
    found = calibration.sketch_percentile(sketches, 0.99)
    p, n, value, error = found.select("p", "n", "value", "rank_error").first()
    upto = ev.agg(F.count_if(F.col("value") < value).alias("under"), F.count_if(F.col("value") <= value).alias("upto"))
    near = (F.col("under") <= F.lit(n * (p + error) + 1)) & (F.col("upto") >= F.lit(n * (p - error) - 1))
    return upto.select(F.lit(p).alias("p"), F.lit(n).cast("long").alias("n"), near.alias("within"))


class _Vowels(ArrowStage):
    """Letters counted by a stage object with a life of its own in every task."""

    schema = "doc_id long, vowels long"

    def open(self):
        return re.compile("[aeiou]")

    def process(self, handle, batch):
        counts = [len(handle.findall(t or "")) for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], names=["doc_id", "vowels"])


@register("custom_stage")
def q_custom_stage(spark, sf_dir):
    """A stage of one's own between two others: documents with text -> vowels of each -> per number of vowels mod 10."""
    def with_text(d):
        return d.filter(F.col("text").isNotNull()).select("doc_id", "text")

    def by_digit(d):
        return d.groupBy((F.col("vowels") % 10).alias("digit")).agg(F.count(F.lit(1)).alias("docs"), F.sum("vowels").alias("vowels"))

    return run_stages(table(spark, sf_dir, "documents"), [with_text, _Vowels(), by_digit])
