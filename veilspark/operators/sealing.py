"""Sealing whole tables with authenticated encryption.

Sealing uses Spark's built-in AES-GCM (``aes_encrypt`` / ``aes_decrypt``)
with the header as associated data: the ciphertext is bound to its header, so
a changed header, key or byte makes unsealing fail.  ``aes_encrypt`` draws a
fresh 12-byte IV per value; its output is IV || ciphertext || 16-byte tag,
split here into ``nonce`` and ``ciphertext``.

Because the IV is random, a sealed column must be *materialised* (written)
before it is used twice; ``seal_table`` callers write it with
``veilspark.sources.sealed.write_sealed``.  Keys are data of a one-row table
(``veilspark.session.with_secrets``): no plan, setting or event log shows one.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilspark.functions.headers import NONCE_BYTES, encode_header, update_header, with_header
from veilspark.session import materialize, with_secrets

KEY_BYTES = 32  # 256-bit keys only


def key_hex(key: bytes | str) -> str:
    """Validate a 32-byte key (raw bytes or 64 hex chars) and return it as hex."""
    if isinstance(key, str):
        try:
            raw = bytes.fromhex(key)
        except ValueError as e:
            raise ValueError("key is not valid hex") from e
    else:
        raw = bytes(key)
    if len(raw) != KEY_BYTES:
        raise ValueError(f"key must be {KEY_BYTES} bytes, got {len(raw)}")
    return raw.hex()


_KEY = "__sealing_key"


def _with_key(df: DataFrame, key: bytes | str) -> DataFrame:
    return with_secrets(df, **{_KEY: bytes.fromhex(key_hex(key))})


def seal(df: DataFrame, payload: Column, header: Column, key: bytes | str) -> DataFrame:
    """Add ``header`` (string), ``nonce`` and ``ciphertext`` (binary) sealing ``payload`` (string)."""
    aad = F.encode(header, "UTF-8")
    blob = F.aes_encrypt(F.encode(payload, "UTF-8"), F.col(_KEY), F.lit("GCM"), F.lit("DEFAULT"), F.lit(b"").cast("binary"), aad)
    return (
        _with_key(df, key).withColumn("__blob", blob)
        .withColumn("header", header)
        .withColumn("nonce", F.substring(F.col("__blob"), 1, NONCE_BYTES))
        .withColumn("ciphertext", F.expr(f"substring(__blob, {NONCE_BYTES + 1})"))
        .drop("__blob", _KEY)
    )


def seal_rows(df: DataFrame, header_fields: Mapping[str, Column], key: bytes | str,
              payload_cols: list[str] | None = None) -> DataFrame:
    """C1 for whole rows: payload = compact JSON of the row, header = canonical JSON."""
    cols = payload_cols or list(df.columns)
    payload = F.to_json(F.struct(*[F.col(c) for c in cols]))
    return seal(df, payload, encode_header(header_fields), key)


def unseal(nonce: Column, ciphertext: Column, header: Column, key: Column) -> Column:
    """C2 building block: plaintext string, or null when authentication fails."""
    blob = F.concat(nonce, ciphertext)
    aad = F.encode(F.coalesce(header, F.lit("")), "UTF-8")
    pt = F.try_aes_decrypt(blob, key, F.lit("GCM"), F.lit("DEFAULT"), aad)
    return F.decode(pt, "UTF-8")


def unseal_table(df: DataFrame, key: bytes | str, name: str = "plaintext", reason: str = "seal_reason") -> DataFrame:
    """Add the plaintext and a reason (``auth_failed``) where unsealing fails."""
    pt = unseal(F.col("nonce"), F.col("ciphertext"), F.col("header"), F.col(_KEY))
    return _with_key(df, key).withColumn(name, pt).drop(_KEY).withColumn(reason, F.when(F.col(name).isNull(), F.lit("auth_failed")))


def reroute(df: DataFrame, key: bytes | str, stage: str, downstream: str, producer_id: str, order_by: list,
            expected_source: str = "_DATASET", expected_destination: str = "_MAPPER") -> DataFrame:
    """Check DATASET -> MAPPER, unseal, re-seal for ``stage`` -> ``downstream``.

    The new header keeps every input attribute as it was and sets ``source``,
    ``destination``, ``producer_id`` and ``seq``: 0, 1, ... over the envelopes
    that passed, in ``order_by`` order (I5, a blocked scan).  Rows failing the
    route or the tag keep a ``reason`` and get no new envelope.  What the scan
    writes to the shared folder are the sealed rows; a body is in the clear only
    within the projections that check its tag and that seal it again.
    """
    from veilspark.operators.integrity import sequence_stamp

    base = [c for c in df.columns if c not in ("header", "nonce", "ciphertext")]
    body = unseal(F.col("nonce"), F.col("ciphertext"), F.col("header"), F.col(_KEY))
    checked = with_header(_with_key(df, key), "header", "__h")
    reason = (
        F.when(F.col("__h.source").isNull() | (F.col("__h.source") != F.lit(expected_source)), F.lit("source_mismatch"))
        .when(F.col("__h.destination").isNull() | (F.col("__h.destination") != F.lit(expected_destination)),
              F.lit("destination_mismatch"))
        .when(body.isNull(), F.lit("auth_failed"))
    )
    # One pass checks and writes the sealed rows with their verdict; numbering and sealing read that table.
    checked = materialize(checked.withColumn("reason", reason).drop("__h", _KEY), "reroute-checked")
    ok = checked.filter(F.col("reason").isNull()).withColumn("__producer", F.lit(producer_id))
    stamped = sequence_stamp(ok, "__producer", order_by, "__seq").withColumnRenamed("header", "__old")
    header = update_header(F.col("__old"), {
        "source": F.lit(stage),
        "destination": F.lit(downstream),
        "producer_id": F.col("__producer"),
        "seq": F.col("__seq"),
    })
    opened = unseal(F.col("nonce"), F.col("ciphertext"), F.col("__old"), F.col(_KEY))
    resealed = seal(_with_key(stamped, key).withColumn("__body", opened).drop(_KEY).drop("nonce", "ciphertext"), F.col("__body"), header, key)
    good = resealed.select(*base, "header", "nonce", "ciphertext", "reason")
    bad = checked.filter(F.col("reason").isNotNull()).select(
        *base, F.lit(None).cast("string").alias("header"), F.lit(None).cast("binary").alias("nonce"),
        F.lit(None).cast("binary").alias("ciphertext"), "reason",
    )
    return good.unionByName(bad)
