"""Queries for dataset preparation (D1-D3), sealing (C1-C3, P6) and sources.

Sealed outputs carry a random IV, so every query here *writes* the sealed
table to the shared work folder (``spark.checkpoint.dir``) and reads it back
before using it; nothing sealed is recomputed.
"""

from __future__ import annotations

import hashlib
import math

from pyspark.sql import functions as F

from veilspark.functions.headers import DOWNSTREAM, envelope_reason
from veilspark.functions.noise import TWO48
from veilspark.operators import prep, release, sealing
from veilspark.plans import fixtures as fx
from veilspark.plans.oracles import ORACLES
from veilspark.plans.queries import _releases, register, WIDE_NOISE
from veilspark.session import table, work_path
from veilspark.sources.custom import SplitSource
from veilspark.sources.records import read_records, read_records_variant, write_records
from veilspark.sources.sample import sample_with_replacement
from veilspark.sources.sealed import read_sealed, write_sealed
from veilspark.sources.snapshot import snapshot_lines
from veilspark.streaming.run import run_to_parquet

USERS_SEED = "fixture-users"
SAMPLE_SEED = "fixture-sample"
NUM_USERS = 500
DOC_USERS = 50
MAPPER_STAGE = "random-joke-spout"
MAPPER_PRODUCER = "mapper"

# ------------------------------------------------------------------ D1-D3

_DOC_JSON_SQL = """CASE WHEN doc_id % 17 = 0
      THEN CAST(json_object('id', doc_id, 'category', CASE WHEN doc_id % 19 = 0 THEN NULL ELSE source END,
                            'body', CASE WHEN doc_id % 13 = 0 THEN '' ELSE text END) AS VARCHAR)
      ELSE CAST(json_object('id', doc_id, 'category', CASE WHEN doc_id % 19 = 0 THEN NULL ELSE source END,
                            'rating', CAST(n_chars % 5 AS DOUBLE),
                            'body', CASE WHEN doc_id % 13 = 0 THEN '' ELSE text END) AS VARCHAR) END"""

CLEAN_SQL = f"""
raw AS (SELECT doc_id, {_DOC_JSON_SQL} AS js FROM documents),
cleaned AS (SELECT CAST(json_extract(js, '$.id') AS BIGINT) AS id, json_extract_string(js, '$.category') AS category,
                   TRY_CAST(json_extract_string(js, '$.rating') AS DOUBLE) AS rating,
                   json_extract_string(js, '$.body') AS body
            FROM raw
            WHERE json_exists(js, '$.body') AND json_exists(js, '$.category') AND json_exists(js, '$.id')
              AND json_exists(js, '$.rating') AND json_extract_string(js, '$.body') IS NOT NULL
              AND NOT regexp_full_match(json_extract_string(js, '$.body'), '[\\s\\p{{Z}}]*'))"""


def _cleaned(spark, sf_dir):
    return prep.clean_records(fx.doc_records(spark, sf_dir), "record")


@register("clean_records")
def q_clean_records(spark, sf_dir):
    """Drop records missing a required key or with a blank body (null-valued keys are kept)."""
    return _cleaned(spark, sf_dir).select("id", "category", "rating", "body")


ORACLES["clean_records"] = f"WITH {CLEAN_SQL} SELECT id, category, rating, body FROM cleaned"


@register("dense_ids")
def q_dense_ids(spark, sf_dir):
    """Cleaned records renumbered 0..n-1 in input (id) order."""
    c = _cleaned(spark, sf_dir).select(F.col("id").alias("doc_id"), "category")
    return prep.dense_ids(c, ["doc_id"], "id").select("id", "doc_id")


ORACLES["dense_ids"] = f"""
WITH {CLEAN_SQL}
SELECT CAST(row_number() OVER (ORDER BY id) - 1 AS BIGINT) AS id, id AS doc_id FROM cleaned""".strip()


@register("weighted_users")
def q_weighted_users(spark, sf_dir):
    """D3: each cleaned record gets one of 500 users, drawn with keyed lognormal weights."""
    c = _cleaned(spark, sf_dir).select(F.col("id").alias("doc_id"))
    return prep.assign_weighted_users(c, "doc_id", NUM_USERS, USERS_SEED, "user_id").select("doc_id", "user_id")


def _gauss_sql(h: str) -> str:
    u = f"CAST(('0x' || substr({h}, 1, 12)) AS BIGINT)"
    v = f"CAST(('0x' || substr({h}, 13, 12)) AS BIGINT)"
    return f"(sqrt(-2.0 * ln(({u} + 1.0) / {TWO48 + 1.0!r})) * cos({2.0 * math.pi!r} * {v} / {TWO48!r}))"


ORACLES["weighted_users"] = f"""
WITH {CLEAN_SQL},
u AS (SELECT range AS user_id FROM range(1, {NUM_USERS + 1})),
w AS (SELECT user_id,
             CAST(floor(exp({_gauss_sql(f"sha256('{USERS_SEED}|weight|' || CAST(user_id AS VARCHAR))")}) * {prep.WEIGHT_SCALE})
                  AS BIGINT) AS weight FROM u),
c AS (SELECT user_id, CAST(sum(weight) OVER (ORDER BY user_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS hi, weight FROM w),
t AS (SELECT max(hi) AS total FROM c),
r AS (SELECT id AS doc_id,
             (CAST(('0x' || substr(sha256('{USERS_SEED}|record|' || CAST(id AS VARCHAR)), 1, 15)) AS HUGEINT) * {1 << 60}
              + CAST(('0x' || substr(sha256('{USERS_SEED}|record|' || CAST(id AS VARCHAR)), 16, 15)) AS HUGEINT))
               % (SELECT total FROM t) AS x FROM cleaned)
SELECT r.doc_id, c.user_id FROM r JOIN c ON r.x >= c.hi - c.weight AND r.x < c.hi""".strip()


# ------------------------------------------------------------------ sealing

def _sealed_docs_path(spark, sf_dir, **attributes):
    """Seal every document (payload = {doc_id, text}) for DATASET -> MAPPER and write it.

    The header has ``user_id`` and ``attributes``; with the latter, an attribute that is null in a row is left out there.
    """
    docs = table(spark, sf_dir, "documents")
    header = {"source": F.lit("_DATASET"), "destination": F.lit("_MAPPER"),
              "user_id": (F.col("doc_id") % DOC_USERS).cast("long"), **attributes}
    if attributes:
        docs = docs.select("doc_id", "text", F.to_json(F.struct(*[c.alias(k) for k, c in sorted(header.items())])).alias("h"))
        sealed = sealing.seal(docs, F.to_json(F.struct("doc_id", "text")), F.col("h"), fx.FIXTURE_KEY_HEX).drop("h")
    else:
        sealed = sealing.seal_rows(docs.select("doc_id", "text"), header, fx.FIXTURE_KEY_HEX, ["doc_id", "text"])
    path = work_path(spark, "sealed-docs")
    write_sealed(sealed, path, extra_cols=["doc_id"])
    return path


def _read_docs(spark, path):
    return read_sealed(spark, path, extra_schema="doc_id long")


@register("seal_roundtrip")
def q_seal_roundtrip(spark, sf_dir):
    """C1 + S4 + S1 + C2: seal documents, write, read back, unseal; plaintext must match."""
    s = _read_docs(spark, _sealed_docs_path(spark, sf_dir))
    u = sealing.unseal_table(s.drop("doc_id"), fx.FIXTURE_KEY_HEX, "plaintext")
    doc = F.from_json("plaintext", "doc_id long, text string")
    return u.select(doc["doc_id"].alias("doc_id"), doc["text"].alias("text"))


ORACLES["seal_roundtrip"] = "SELECT doc_id, text FROM documents"


@register("unseal_tampered")
def q_unseal_tampered(spark, sf_dir):
    """Headers changed where doc_id % 11 = 0 must fail authentication (fail closed)."""
    s = _read_docs(spark, _sealed_docs_path(spark, sf_dir))
    t = s.withColumn("header", F.when(F.col("doc_id") % 11 == 0, F.regexp_replace("header", "_MAPPER", "_MAPPEX"))
                     .otherwise(F.col("header")))
    u = sealing.unseal_table(t, fx.FIXTURE_KEY_HEX, "plaintext", "seal_reason")
    return u.select("doc_id", F.col("seal_reason").isNull().alias("ok"), "seal_reason")


ORACLES["unseal_tampered"] = """
SELECT doc_id, doc_id % 11 <> 0 AS ok, CASE WHEN doc_id % 11 = 0 THEN 'auth_failed' END AS seal_reason
FROM documents""".strip()


@register("sealed_shape")
def q_sealed_shape(spark, sf_dir):
    """Envelope shape check; nonces cut to 8 bytes (doc_id % 5 = 1), ciphertexts emptied (% 5 = 2)."""
    s = _read_docs(spark, _sealed_docs_path(spark, sf_dir))
    m = F.col("doc_id") % 5
    t = (s.withColumn("nonce", F.when(m == 1, F.substring("nonce", 1, 8)).otherwise(F.col("nonce")))
         .withColumn("ciphertext", F.when(m == 2, F.lit(b"").cast("binary")).otherwise(F.col("ciphertext"))))
    return t.select("doc_id", envelope_reason("nonce", "ciphertext", "header").alias("shape_reason"))


ORACLES["sealed_shape"] = """
SELECT doc_id, CASE doc_id % 5 WHEN 1 THEN 'bad_nonce_length' WHEN 2 THEN 'empty_ciphertext' END AS shape_reason
FROM documents""".strip()


@register("sealed_scan")
def q_sealed_scan(spark, sf_dir):
    """Read sealed JSON Lines back: header text, 12-byte nonce, ciphertext = plaintext + 16-byte tag."""
    s = _read_docs(spark, _sealed_docs_path(spark, sf_dir))
    return s.select("doc_id", "header", F.octet_length("nonce").cast("long").alias("nonce_bytes"),
                    (F.octet_length("ciphertext") > 16).alias("has_body"))


ORACLES["sealed_scan"] = f"""
SELECT doc_id, CAST(json_object('destination', '_MAPPER', 'source', '_DATASET', 'user_id', doc_id % {DOC_USERS}) AS VARCHAR)
       AS header, CAST(12 AS BIGINT) AS nonce_bytes, true AS has_body
FROM documents""".strip()


@register("reroute_headers")
def q_reroute_headers(spark, sf_dir):
    """DATASET -> MAPPER envelopes re-sealed for the spout -> split edge (tampered ones rejected).

    Every header has a tenant and a size, every fifth one no user: all must come through as they are.
    """
    user = F.when(F.col("doc_id") % 5 != 0, (F.col("doc_id") % DOC_USERS).cast("long"))
    s = _read_docs(spark, _sealed_docs_path(spark, sf_dir, user_id=user, tenant=F.col("source"), size=F.col("n_chars")))
    t = s.withColumn("header", F.when(F.col("doc_id") % 11 == 0, F.regexp_replace("header", "_MAPPER", "_MAPPEX"))
                     .otherwise(F.col("header")))
    down = DOWNSTREAM[MAPPER_STAGE][0]
    r = sealing.reroute(t, fx.FIXTURE_KEY_HEX, MAPPER_STAGE, down, MAPPER_PRODUCER, ["doc_id"])
    path = work_path(spark, "rerouted")
    write_sealed(r.filter(F.col("reason").isNull()), path, extra_cols=["doc_id"])
    back = _read_docs(spark, path)
    u = sealing.unseal_table(back, fx.FIXTURE_KEY_HEX, "plaintext")
    good = u.select("doc_id", "header", F.from_json("plaintext", "doc_id long, text string")["text"].alias("text"),
                    F.col("seal_reason").alias("reason"))
    bad = r.filter(F.col("reason").isNotNull()).select("doc_id", "header", F.lit(None).cast("string").alias("text"),
                                                       "reason")
    return good.unionByName(bad)


ORACLES["reroute_headers"] = f"""
WITH ok AS (SELECT doc_id, text, source, n_chars, CAST(row_number() OVER (ORDER BY doc_id) - 1 AS BIGINT) AS seq
            FROM documents WHERE doc_id % 11 <> 0)
SELECT doc_id, CASE WHEN doc_id % 5 <> 0
       THEN CAST(json_object('destination', '{DOWNSTREAM[MAPPER_STAGE][0]}', 'producer_id', '{MAPPER_PRODUCER}', 'seq', seq,
                             'size', n_chars, 'source', '{MAPPER_STAGE}', 'tenant', source, 'user_id', doc_id % {DOC_USERS}) AS VARCHAR)
       ELSE CAST(json_object('destination', '{DOWNSTREAM[MAPPER_STAGE][0]}', 'producer_id', '{MAPPER_PRODUCER}', 'seq', seq,
                             'size', n_chars, 'source', '{MAPPER_STAGE}', 'tenant', source) AS VARCHAR) END
       AS header, text, CAST(NULL AS VARCHAR) AS reason FROM ok
UNION ALL
SELECT doc_id, NULL, NULL, 'destination_mismatch' FROM documents WHERE doc_id % 11 = 0""".strip()


# ------------------------------------------------------------------ S2, S6, S3, S5

@register("record_scan")
def q_record_scan(spark, sf_dir):
    """S2 + D1 + S6: raw records written as JSON Lines, scanned as VARIANT, cleaned, written, read typed."""
    raw = fx.doc_records(spark, sf_dir).select(F.to_json("record").alias("value"))
    src = work_path(spark, "records-raw")
    raw.write.text(src)
    cleaned = prep.clean_records(read_records_variant(spark, src, name="record"), "record")
    out = work_path(spark, "records-clean")
    write_records(cleaned.select("id", "category", "rating", "body"), out, "json")
    return read_records(spark, out).select("id", "category", "rating", "body")


ORACLES["record_scan"] = f"WITH {CLEAN_SQL} SELECT id, category, rating, body FROM cleaned"


@register("replay_sample")
def q_replay_sample(spark, sf_dir):
    """S3: as many uniform draws with replacement as there are documents, keyed by a seed."""
    docs = table(spark, sf_dir, "documents").select("doc_id")
    n = docs.count()
    return sample_with_replacement(docs, ["doc_id"], n, SAMPLE_SEED).select("draw", "doc_id")


ORACLES["replay_sample"] = f"""
WITH d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS idx FROM documents),
n AS (SELECT count(*) AS n FROM documents),
dr AS (SELECT range AS draw FROM range((SELECT n FROM n))),
x AS (SELECT draw, CAST(('0x' || substr(sha256('{SAMPLE_SEED}|' || CAST(draw AS VARCHAR)), 1, 12)) AS BIGINT)
                    % (SELECT n FROM n) AS idx FROM dr)
SELECT x.draw, d.doc_id FROM x JOIN d USING (idx)""".strip()


@register("snapshot_lines")
def q_snapshot_lines(spark, sf_dir):
    """The release in text form, ``event_type:count`` lines in release order (banner excluded)."""
    latest = release.latest_per_key(_releases(spark, sf_dir, WIDE_NOISE), "event_type")
    ordered = release.ordered_release(latest, "event_type")
    return snapshot_lines(ordered, "event_type").filter(F.col("line_no") > 0)


ORACLES["snapshot_lines"] = ORACLES["release_order"].replace(
    "SELECT CAST(row_number() OVER (ORDER BY noisy DESC, event_type ASC) AS BIGINT) AS rank, event_type, released\nFROM kept",
    "SELECT CAST(row_number() OVER (ORDER BY noisy DESC, event_type ASC) AS BIGINT) AS line_no,\n"
    "       event_type || ':' || CAST(released AS VARCHAR) AS line\nFROM kept",
)


class DrawSource(SplitSource):
    """The draws of S3 as a source of one's own, a few hundred to a split."""

    columns = "draw long, idx long"

    def splits(self, options):
        return self.slices(options, 0, int(options["draws"]))

    def slices(self, options, start, end):
        return [(i, min(i + 500, end)) for i in range(start, end, 500)]

    def limit(self, options):
        return int(options["draws"])

    def open(self, options, split):
        return options["seed"], int(options["table"])

    def rows(self, handle, split):
        seed, n = handle
        for draw in range(*split):
            yield draw, int(hashlib.sha256(f"{seed}|{draw}".encode()).hexdigest()[:12], 16) % n


@register("custom_source")
def q_custom_source(spark, sf_dir):
    """U2 + S3: draws with replacement streamed from an own source, a third per run, each run restarted; joined to the documents."""
    docs = prep.dense_ids(table(spark, sf_dir, "documents").select("doc_id"), ["doc_id"], "idx")
    n = docs.count()
    spark.dataSource.register(DrawSource)
    draws = (spark.readStream.format("DrawSource").option("seed", SAMPLE_SEED).option("table", n).option("draws", n)
             .option("rowsPerBatch", max(1, -(-n // 3))).load())
    out = run_to_parquet(draws.join(docs, "idx"), "custom-source", checkpoint=work_path(spark, "custom-source-ckpt"), runs=3)
    return spark.read.parquet(out).select("draw", "doc_id")


ORACLES["custom_source"] = ORACLES["replay_sample"]
