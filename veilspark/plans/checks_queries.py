"""Queries for body extraction (P1), headers (P3, P4) and integrity checks.

Oracles are registered next to each query; they rebuild the fixture in
DuckDB with its own JSON functions and check it with plain window SQL.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from veilspark.functions.headers import COMPONENTS, with_header
from veilspark.functions.text import extract_body
from veilspark.operators import integrity
from veilspark.plans import fixtures as fx
from veilspark.plans.oracles import ORACLES
from veilspark.params import DEFAULT_REPLAY_WINDOW
from veilspark.plans.queries import register
from veilspark.session import materialize, table

REPLAY_WINDOW = DEFAULT_REPLAY_WINDOW


def _parsed_headers(spark, sf_dir):
    return with_header(fx.event_headers(spark, sf_dir), "header", "h")


# ------------------------------------------------------------------ P1

def _body_json():
    m = F.col("doc_id") % 6
    opts = {"ignoreNullFields": "false"}
    return (
        F.when(m == 0, F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("text").alias("body")), opts))
        .when(m == 1, F.to_json(F.struct(F.col("doc_id").alias("id")), opts))
        .when(m == 2, F.to_json(F.struct(F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("body")), opts))
        .when(m == 3, F.to_json(F.struct(F.col("doc_id").alias("id"), F.col("n_chars").alias("body")), opts))
        .when(m == 4, F.to_json(F.struct(F.col("doc_id").alias("id"),
                                         F.struct(F.col("text").alias("t")).alias("body")), opts))
        .otherwise(F.concat(F.lit("not json "), F.col("text")))
    )


@register("extract_body")
def q_extract_body(spark, sf_dir):
    """``body`` when it is a JSON string, else '' (missing, null, number, object, unparsable)."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    return docs.select("doc_id", extract_body(_body_json()).alias("body"))


_BODY_JSON_SQL = """CASE doc_id % 6
    WHEN 0 THEN CAST(json_object('id', doc_id, 'body', text) AS VARCHAR)
    WHEN 1 THEN CAST(json_object('id', doc_id) AS VARCHAR)
    WHEN 2 THEN CAST(json_object('id', doc_id, 'body', NULL) AS VARCHAR)
    WHEN 3 THEN CAST(json_object('id', doc_id, 'body', n_chars) AS VARCHAR)
    WHEN 4 THEN CAST(json_object('id', doc_id, 'body', json_object('t', text)) AS VARCHAR)
    ELSE 'not json ' || text END"""

ORACLES["extract_body"] = f"""
WITH j AS (SELECT doc_id, {_BODY_JSON_SQL} AS js FROM documents)
SELECT doc_id, CASE WHEN json_valid(js) AND json_type(js, '$.body') = 'VARCHAR'
                    THEN json_extract_string(js, '$.body') ELSE '' END AS body
FROM j""".strip()


# ------------------------------------------------------------------ P3, P4

HEADER_SQL = """CASE event_id % 7
    WHEN 1 THEN CAST(json_object('destination', 'word-count', 'producer_id', event_type, 'seq', event_id,
                                 'source', 'sentence-split', 'user_id', user_id) AS VARCHAR)
    WHEN 2 THEN CAST(json_object('destination', 'user-contribution-bounding', 'seq', event_id,
                                 'source', 'sentence-split', 'user_id', user_id) AS VARCHAR)
    WHEN 3 THEN CAST(json_object('destination', 'user-contribution-bounding', 'producer_id', event_type,
                                 'seq', CAST(event_id AS VARCHAR), 'source', 'sentence-split', 'user_id', user_id) AS VARCHAR)
    WHEN 4 THEN CAST(json_object('destination', 'user-contribution-bounding', 'producer_id', event_type,
                                 'seq', 'x' || CAST(event_id AS VARCHAR), 'source', 'sentence-split', 'user_id', user_id) AS VARCHAR)
    WHEN 5 THEN CAST(json_object('destination', 'user-contribution-bounding', 'producer_id', event_type, 'seq', event_id,
                                 'user_id', user_id) AS VARCHAR)
    WHEN 6 THEN ''
    ELSE CAST(json_object('destination', 'user-contribution-bounding', 'producer_id', event_type, 'seq', event_id,
                          'source', 'sentence-split', 'user_id', user_id) AS VARCHAR) END"""


def _field(path: str, cast: str | None = None) -> str:
    v = f"json_extract_string(header, '$.{path}')"
    if cast:
        v = f"TRY_CAST({v} AS {cast})"
    return f"CASE WHEN header <> '' AND json_valid(header) THEN {v} END"


PARSED_SQL = f"""
hdr AS (SELECT event_id, ts, user_id AS uid, event_type, {HEADER_SQL} AS header FROM events),
ph AS (SELECT event_id, ts, event_type, header,
              {_field('source')} AS source, {_field('destination')} AS destination,
              {_field('producer_id')} AS producer_id, {_field('seq', 'BIGINT')} AS seq,
              {_field('user_id', 'BIGINT')} AS user_id FROM hdr)"""


@register("header_json")
def q_header_json(spark, sf_dir):
    """Canonical header JSON (sorted keys, compact) built for every event."""
    return fx.event_headers(spark, sf_dir).select("event_id", "header")


ORACLES["header_json"] = f"SELECT event_id, {HEADER_SQL} AS header FROM events"


@register("header_fields")
def q_header_fields(spark, sf_dir):
    """Header JSON parsed to source, destination, producer_id, seq and user_id; broken off in the source where event_id % 8 = 0."""
    cut = F.concat(F.substring_index("header", '"source"', 1), F.lit('"source":"sent'))
    broken = (F.col("event_id") % 8 == 0) & F.col("header").contains('"source"')
    h = with_header(fx.event_headers(spark, sf_dir).withColumn("header", F.when(broken, cut).otherwise(F.col("header"))), "header", "h")
    return h.select("event_id", "h.source", "h.destination", "h.producer_id", "h.seq", "h.user_id")


ORACLES["header_fields"] = f"""
WITH {PARSED_SQL}
SELECT event_id, CASE WHEN event_id % 8 <> 0 THEN source END AS source, destination, producer_id, seq,
       CASE WHEN event_id % 8 <> 0 OR source IS NULL THEN user_id END AS user_id FROM ph""".strip()

# ------------------------------------------------------------------ I1, I2, I3/I6

ROUTE_SQL = """CASE WHEN source IS NULL THEN 'missing_source'
     WHEN source <> 'sentence-split' THEN 'source_mismatch'
     WHEN destination IS NULL THEN 'missing_destination'
     WHEN destination <> 'user-contribution-bounding' THEN 'destination_mismatch' END"""
REQ_SQL = """CASE WHEN producer_id IS NULL THEN 'missing_producer' WHEN seq IS NULL THEN 'missing_seq' END"""


@register("route_check")
def q_route_check(spark, sf_dir):
    """Headers arriving at the bounding stage checked against its expected route."""
    h = _parsed_headers(spark, sf_dir).select("event_id", "stage", F.col("h.source").alias("src"),
                                               F.col("h.destination").alias("dst"))
    out = integrity.route_check(h, "stage", "src", "dst", "route_reason")
    return out.select("event_id", "route_reason")


ORACLES["route_check"] = f"WITH {PARSED_SQL} SELECT event_id, {ROUTE_SQL} AS route_reason FROM ph"


@register("header_required")
def q_header_required(spark, sf_dir):
    """I3 + I6: producer_id and seq must be present, seq must equal the expected event_id."""
    h = _parsed_headers(spark, sf_dir)
    reason = integrity.required_reason(F.col("h.producer_id"), F.col("h.seq"), F.col("event_id"))
    return h.select("event_id", reason.alias("reason"))


ORACLES["header_required"] = f"""
WITH {PARSED_SQL}
SELECT event_id, CASE WHEN producer_id IS NULL THEN 'missing_producer' WHEN seq IS NULL THEN 'missing_seq'
                      WHEN seq <> event_id THEN 'seq_mismatch' END AS reason FROM ph""".strip()


@register("header_agreement")
def q_header_agreement(spark, sf_dir):
    """The word and count envelopes of one event must carry the same (producer_id, seq).

    The count envelope's seq is moved by one where event_id % 9 = 0, its producer is another where event_id % 10 = 0.
    """
    h = _parsed_headers(spark, sf_dir)
    count_seq = F.when(F.col("event_id") % 9 == 0, F.col("h.seq") + 1).otherwise(F.col("h.seq"))
    count_producer = F.when(F.col("event_id") % 10 == 0, F.concat("h.producer_id", F.lit("-2"))).otherwise(F.col("h.producer_id"))
    reason = integrity.agreement_reason([F.col("h.producer_id"), count_producer], [F.col("h.seq"), count_seq])
    return h.select("event_id", reason.alias("reason"))


ORACLES["header_agreement"] = f"""
WITH {PARSED_SQL}
SELECT event_id, CASE WHEN (event_id % 9 = 0 AND seq IS NOT NULL) OR (event_id % 10 = 0 AND producer_id IS NOT NULL)
                      THEN 'header_mismatch' END AS reason FROM ph""".strip()

# ------------------------------------------------------------------ I4, I5


def _replay_input(spark, sf_dir):
    ev = table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("producer_id"))
    return ev.withColumn("seq", F.col("event_id") - (F.col("event_id") * 37) % 200)


@register("replay_filter")
def q_replay_filter(spark, sf_dir):
    """I4: per producer (event_type), window 128; seq = arrival - (event_id * 37 % 200)."""
    out = integrity.replay_filter(_replay_input(spark, sf_dir), "producer_id", "seq", fx.EVENT_ORDER, REPLAY_WINDOW,
                                  "replay_reason")
    return out.select("event_id", "producer_id", "seq", "replay_reason")


def _replay_sql(src: str, extra: str = "") -> str:
    return f"""
SELECT *{extra},
  CASE WHEN seq < 0 THEN 'negative_seq'
       WHEN mx IS NOT NULL AND seq <= mx - {REPLAY_WINDOW} THEN 'stale_seq'
       WHEN rn > 1 THEN 'replayed_seq' END AS replay_reason
FROM (SELECT *,
        max(CASE WHEN seq >= 0 THEN seq END) OVER (PARTITION BY producer_id ORDER BY ts, event_id
                                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mx,
        row_number() OVER (PARTITION BY producer_id, seq ORDER BY ts, event_id) AS rn
      FROM {src})"""


ORACLES["replay_filter"] = f"""
WITH e AS (SELECT event_id, ts, event_type AS producer_id, event_id - (event_id * 37) % 200 AS seq FROM events),
r AS ({_replay_sql('e')})
SELECT event_id, producer_id, seq, replay_reason FROM r""".strip()


@register("sequence_stamp")
def q_sequence_stamp(spark, sf_dir):
    """Seq 0, 1, ... per producer (event_type) in arrival order (ts, event_id)."""
    ev = table(spark, sf_dir, "events").select("event_id", "ts", F.col("event_type").alias("producer_id"))
    return integrity.sequence_stamp(ev, "producer_id", fx.EVENT_ORDER, "seq").select("event_id", "producer_id", "seq")


ORACLES["sequence_stamp"] = """
SELECT event_id, event_type AS producer_id,
       CAST(row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) - 1 AS BIGINT) AS seq
FROM events""".strip()

# ------------------------------------------------------------------ I7


def _edges(spark, sf_dir):
    h = _parsed_headers(spark, sf_dir)
    observed = h.select(F.col("h.source").alias("stage"), F.col("h.destination").alias("downstream")).filter(
        F.col("stage").isNotNull()
    )
    # event types posing as stages that feed the histogram: unknown names
    typed = table(spark, sf_dir, "events").select(F.col("event_type").alias("stage"),
                                                  F.lit("HISTOGRAM_GLOBAL").alias("downstream"))
    return observed.unionByName(typed)


@register("routing_table_check")
def q_routing_table_check(spark, sf_dir):
    """Edges observed in headers (plus event types as stages) checked for a single known downstream."""
    return integrity.routing_table_check(_edges(spark, sf_dir))


def _component_sql(x: str) -> str:
    parts = " ".join(f"WHEN {x} = '{lab}' OR upper({x}) = '{enum}' THEN '{lab}'" for lab, enum in COMPONENTS)
    return f"CASE {parts} END"


ORACLES["routing_table_check"] = f"""
WITH {PARSED_SQL},
edges AS (SELECT source AS stage, destination AS downstream FROM ph WHERE source IS NOT NULL
          UNION ALL SELECT event_type, 'HISTOGRAM_GLOBAL' FROM events),
r AS (SELECT stage, {_component_sql('stage')} AS comp, downstream, {_component_sql('downstream')} AS d FROM edges),
g AS (SELECT stage, comp, count(DISTINCT d) AS n,
             max(CASE WHEN downstream IS NOT NULL AND d IS NULL THEN 1 ELSE 0 END) AS unk, min(d) AS one
      FROM r GROUP BY stage, comp)
SELECT stage, comp AS component, CAST(n AS BIGINT) AS n_downstream, CASE WHEN n = 1 THEN one END AS downstream,
       CASE WHEN comp IS NULL OR unk = 1 THEN 'unknown_component' WHEN n = 0 THEN 'no_downstream'
            WHEN n > 1 THEN 'ambiguous_fanout' ELSE 'ok' END AS status
FROM g""".strip()

# ------------------------------------------------------------------ I8 / U3


@register("quarantine_counts")
def q_quarantine_counts(spark, sf_dir):
    """Verified stage (route, required fields, replay), split by verdict in one evaluation; rows per outcome."""
    h = _parsed_headers(spark, sf_dir).select(
        "event_id", "ts", "stage", F.col("h.source").alias("src"), F.col("h.destination").alias("dst"),
        F.col("h.producer_id").alias("producer_id"), F.col("h.seq").alias("seq"))
    accepted, quarantined = integrity.verified_stage(h, "stage", "src", "dst", "producer_id", "seq", fx.EVENT_ORDER,
                                                     policy="quarantine", window=REPLAY_WINDOW)
    outcomes = accepted.select(F.lit("accepted").alias("reason")).unionByName(quarantined.select("reason"))
    return outcomes.groupBy("reason").agg(F.count(F.lit(1)).cast("long").alias("cnt"))


ORACLES["quarantine_counts"] = f"""
WITH {PARSED_SQL},
pre AS (SELECT *, coalesce({ROUTE_SQL}, {REQ_SQL}) AS pre_reason FROM ph),
ok AS (SELECT * FROM pre WHERE pre_reason IS NULL),
rp AS ({_replay_sql('ok')}),
allr AS (SELECT replay_reason AS reason FROM rp UNION ALL SELECT pre_reason FROM pre WHERE pre_reason IS NOT NULL)
SELECT coalesce(reason, 'accepted') AS reason, count(*) AS cnt FROM allr GROUP BY ALL""".strip()


#: A graph of the caller's own, beside the example's stages.
AUDIT_ROUTES = {"audit": (None, "user-contribution-bounding"), "tally": ("sentence-split", "user-contribution-bounding")}


@register("verified_stage")
def q_verified_stage(spark, sf_dir):
    """U3 on a graph of one's own: two envelopes per value, tags, agreement, required fields, replay; the reason of each event.

    The second envelope is the first one's but for its destination where event_id % 23 = 0 and its seq where
    event_id % 9 = 0; the tag does not hold where event_id % 13 = 0; every 17th seq is that of the event before.
    """
    e = F.col("event_id")
    seq = F.when(e % 17 == 0, F.col("h.seq") - 1).otherwise(F.col("h.seq"))
    h = _parsed_headers(spark, sf_dir).select(
        "event_id", "ts", F.when(e % 2 == 0, F.lit("audit")).otherwise(F.lit("tally")).alias("stage"),
        F.col("h.source").alias("src"), F.col("h.destination").alias("dst"), F.lit("p").alias("producer"),
        seq.alias("seq"), F.when(e % 23 == 0, F.lit("elsewhere")).otherwise(F.col("h.destination")).alias("dst2"),
        F.when(e % 9 == 0, seq + 1).otherwise(seq).alias("seq2"), F.when(e % 13 != 0, F.lit("body")).alias("body"))
    flagged = integrity.verified_stage(
        materialize(h, "parsed-headers"), "stage", "src", "dst", "producer", "seq", fx.EVENT_ORDER, policy="flag", window=REPLAY_WINDOW,
        more=[("src", "dst2", "producer", "seq2")], opened=["body"], routes=AUDIT_ROUTES)
    return flagged.select("event_id", "reason")


_AUDIT_ROUTE_SQL = """CASE WHEN event_id % 2 = 1 AND source IS NULL THEN 'missing_source'
     WHEN event_id % 2 = 1 AND source <> 'sentence-split' THEN 'source_mismatch'
     WHEN destination IS NULL THEN 'missing_destination'
     WHEN destination <> 'user-contribution-bounding' THEN 'destination_mismatch'
     WHEN event_id % 23 = 0 THEN 'destination_mismatch' END"""

ORACLES["verified_stage"] = f"""
WITH {PARSED_SQL},
two AS (SELECT event_id, ts, source, destination, 'p' AS producer_id,
               CASE WHEN event_id % 17 = 0 THEN seq - 1 ELSE seq END AS seq FROM ph),
pre AS (SELECT *, coalesce({_AUDIT_ROUTE_SQL}, CASE WHEN event_id % 13 = 0 THEN 'auth_failed' END, {REQ_SQL},
                           CASE WHEN event_id % 9 = 0 THEN 'header_mismatch' END) AS pre_reason FROM two),
ok AS (SELECT * FROM pre WHERE pre_reason IS NULL),
rp AS ({_replay_sql('ok')})
SELECT event_id, replay_reason AS reason FROM rp
UNION ALL SELECT event_id, pre_reason FROM pre WHERE pre_reason IS NOT NULL""".strip()
