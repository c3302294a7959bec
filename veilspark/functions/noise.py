"""Keyed Gaussian noise and the binary-tree node arithmetic (A5).

Noise is a pure function of a secret: node ``j`` of key ``w`` in stream ``s``
gets ``sigma * z`` with

    h = HMAC-SHA256(secret, s | len(w) | w | j)      (hex digest)
    u = int(h[0:12], 16),  v = int(h[12:24], 16)      (two 48-bit uniforms)
    z = sqrt(-2 ln((u + 1) / (2^48 + 1))) * cos(2 pi v / 2^48)   (Box-Muller)

A re-run task, a recomputed stage or a restarted stream therefore draws the
very same noise for the same node, so re-computation never leaks a second,
independent sample.  HMAC is two nested ``sha2`` calls, so it runs in the JVM.
The two pads derived from the secret come as columns of a one-row table
(``veilspark.session.with_secrets``), so no plan shows them.  ``s`` is a *scope*: the stream's name with every
parameter that the release depends on, so releases of the same counts under
other parameters draw other noise and their difference cancels nothing.

Tree arithmetic (T leaves padded to L = 2^H, H = ceil(log2 T)): the release at
0-based index i sums, for each set bit b of n = i + 1, the node with
level-order index ``(2^(H-b) - 1) + ((n >> b) - 1)``.  Those nodes cover
exactly [0, i], so the count part of the sum is the prefix sum S_i and only
the noise needs the node ids.
"""

from __future__ import annotations

import hashlib
import json
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64
TWO48 = float(2 ** 48)


def hmac_pads(secret: bytes | str) -> tuple[str, str]:
    """(inner pad, outer pad) of HMAC-SHA256 for ``secret`` as hex strings."""
    key = secret.encode("utf-8") if isinstance(secret, str) else bytes(secret)
    if not key:
        raise ValueError("noise secret must not be empty")
    if len(key) > _BLOCK:
        key = hashlib.sha256(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    ipad = bytes(b ^ 0x36 for b in key).hex()
    opad = bytes(b ^ 0x5C for b in key).hex()
    return ipad, opad


def hmac_sha256_hex(msg_utf8: Column, pads: tuple[str | Column, str | Column]) -> Column:
    """HMAC-SHA256 hex digest of a string column (UTF-8 bytes); pads as hex text or as binary columns."""
    ipad, opad = (p if isinstance(p, Column) else F.unhex(F.lit(p)) for p in pads)
    inner = F.sha2(F.concat(ipad, F.encode(msg_utf8, "UTF-8")), 256)
    return F.sha2(F.concat(opad, F.unhex(inner)), 256)


def noise_message(stream_id: str, key: Column, node: Column) -> Column:
    """Length-framed message ``stream | len(key) | key | node``."""
    return F.concat_ws(
        "|", F.lit(stream_id), F.length(key).cast("string"), key, node.cast("string")
    )


def std_gaussian(h: Column) -> Column:
    """Box-Muller standard normal from a hex digest (first 24 hex chars)."""
    u = F.conv(F.substring(h, 1, 12), 16, 10).cast("double")
    v = F.conv(F.substring(h, 13, 12), 16, 10).cast("double")
    return F.sqrt(F.lit(-2.0) * F.log((u + F.lit(1.0)) / F.lit(TWO48 + 1.0))) * F.cos(
        F.lit(2.0 * math.pi) * v / F.lit(TWO48)
    )


def node_noise(stream_id: str, key: Column, node: Column, pads: tuple[str | Column, str | Column]) -> Column:
    """Standard normal draw for one tree node of one key."""
    return std_gaussian(hmac_sha256_hex(noise_message(stream_id, key, node), pads))


def tree_height(horizon: int) -> int:
    return int(math.ceil(math.log(horizon) / math.log(2)))


def node_for_bit(n: Column, bit: int, height: int) -> Column:
    """Level-order node summed for set bit ``bit`` of n = i + 1."""
    return (F.lit((1 << (height - bit)) - 1) + (F.shiftright(n, bit) - F.lit(1))).cast("long")


def prefix_noise(key: Column, index: Column, horizon: int, sigma: float, stream_id: str,
                 pads: tuple[str | Column, str | Column]) -> Column:
    """sigma x (sum of the node draws on the binary decomposition of index+1).

    Unrolled over the H + 1 bits at plan time (H is a constant of the
    horizon), so it stays an ordinary codegen expression.  Only set bits
    evaluate their hash (CASE short-circuits).
    """
    h = tree_height(horizon)
    n = (index + F.lit(1)).cast("long")
    total = F.lit(0.0)
    for b in range(h + 1):
        bit_set = F.shiftright(n, b).bitwiseAND(F.lit(1)) == F.lit(1)
        total = total + F.when(bit_set, node_noise(stream_id, key, node_for_bit(n, b, h), pads)).otherwise(
            F.lit(0.0)
        )
    return F.lit(float(sigma)) * total


def release_scope(stream_id: str, params, sigma: float, trigger: str = "trigger_id") -> str:
    """What the noise of a release is bound to: its stream, trigger, privacy parameters and sigma (nine digits)."""
    return json.dumps([stream_id, trigger, params.epsilon, params.delta, params.horizon, params.max_contributions,
                       params.per_record_clamp, params.user_level, f"{sigma:.9g}"])
