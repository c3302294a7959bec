"""DuckDB SQL oracles, one per registered query with an exact SQL form.

Written independently of the Spark plans: windows where Spark uses blocked
scans, plain aggregates where Spark uses stacks, CASE chains where Spark uses
unrolled expressions.  Column names match the Spark results.
"""

from __future__ import annotations

import math

from veilspark.functions.noise import TWO48, tree_height
from veilspark.plans import queries as Q

ORACLES: dict[str, str] = {}

C = Q.PARAMS.max_contributions

# Sigma of the registered releases (delta 1e-5, T 60, C 50, L_m 1) by epsilon, and the HMAC pads of the fixture secret.
SIGMA = {10.0: 53.58072704605254, 1.0: 409.255684277121}
FIXTURE_PADS = ("40535f5a454657445d1b505f4e424344531b45535544534236363636363636363636363636363636363636363636363636363636363636363636363636363636",
                "2a3935302f2c3d2e37713a352428292e39712f393f2e39285c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c5c")


def _reg(name: str, sql: str) -> None:
    ORACLES[name] = sql.strip()


# ------------------------------------------------------------- building blocks

def _tokens_cte(src: str, id_cols: str, text: str = "text") -> str:
    return f"""
    SELECT {id_cols},
           list_filter(list_transform(regexp_split_to_array(coalesce({text}, ''), '\\W+'),
                                      lambda x: trim(lower(x))), lambda x: x <> '') AS ws
    FROM {src}"""


CONV_TOKENS = f"""
conv_ws AS ({_tokens_cte('conversations', 'conv_id AS user_id, turn')}),
conv_tok AS (SELECT user_id, turn, CAST(generate_subscripts(ws, 1) - 1 AS BIGINT) AS pos, unnest(ws) AS word
             FROM conv_ws)"""

TRIGGER = "CAST(date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS BIGINT)"

BOUNDED_EVENTS = f"""
bev AS (
  SELECT * FROM (
    SELECT *, {TRIGGER} AS trigger_id, CAST(floor(epoch(ts) / {Q.FLUSH_SECONDS}) AS BIGINT) AS flush_id,
           row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn
    FROM events) WHERE rn <= {C} OR user_id IS NULL),
partials AS (SELECT flush_id, trigger_id, event_type, count(*) AS cnt FROM bev GROUP BY ALL),
merged AS (SELECT trigger_id, event_type, CAST(sum(cnt) AS BIGINT) AS cnt FROM partials GROUP BY ALL),
trig AS (SELECT trigger_id, CAST(row_number() OVER (ORDER BY trigger_id) - 1 AS BIGINT) AS i
         FROM (SELECT DISTINCT trigger_id FROM merged)),
idx_all AS (SELECT m.trigger_id, m.event_type, m.cnt, t.i FROM merged m JOIN trig t USING (trigger_id))"""


def _noise_sql(key: str, index: str, horizon: int, sigma: float, stream: str) -> str:
    ipad, opad = FIXTURE_PADS
    h = tree_height(horizon)
    n = f"(CAST({index} AS BIGINT) + 1)"
    terms = []
    for b in range(h + 1):
        node = f"(({(1 << (h - b)) - 1}) + (({n} >> {b}) - 1))"
        msg = f"('{stream}' || '|' || CAST(length({key}) AS VARCHAR) || '|' || {key} || '|' || CAST({node} AS VARCHAR))"
        inner = f"sha256(unhex('{ipad}') || encode({msg}))"
        dig = f"sha256(unhex('{opad}') || unhex({inner}))"
        u = f"CAST(('0x' || substr({dig}, 1, 12)) AS BIGINT)"
        v = f"CAST(('0x' || substr({dig}, 13, 12)) AS BIGINT)"
        z = f"(sqrt(-2.0 * ln(({u} + 1.0) / {TWO48 + 1.0!r})) * cos({2.0 * math.pi!r} * {v} / {TWO48!r}))"
        terms.append(f"(CASE WHEN (({n} >> {b}) & 1) = 1 THEN {z} ELSE 0.0 END)")
    return f"({sigma!r} * (" + " + ".join(terms) + "))"


def _releases_cte(params, name: str = "rel", idx: str = "idx_all", key: str = "event_type",
                  stream: str = Q.EVENT_STREAM, trigger: str = "trigger_id") -> str:
    sigma = SIGMA[params.epsilon]
    scope = (f'["{stream}", "{trigger}", {params.epsilon!r}, 1e-05, 60, 50, 1.0, true, "{sigma:.9g}"]')
    noise = _noise_sql(key, "i", 60, sigma, scope)
    return f"""
{name}_p AS (SELECT {key}, i, cnt,
               CAST(sum(cnt) OVER (PARTITION BY {key} ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
                    AS BIGINT) AS prefix
             FROM {idx} WHERE i < {params.horizon}),
{name} AS (SELECT *, CAST(prefix AS DOUBLE) + {noise} AS noisy FROM {name}_p)"""


# ------------------------------------------------------------------ text

_reg("tokenize", f"WITH {CONV_TOKENS} SELECT user_id, turn, pos, word FROM conv_tok")

_reg("word_count", f"""
WITH d AS ({_tokens_cte('documents', 'doc_id')}),
tok AS (SELECT unnest(ws) AS word FROM d)
SELECT word, count(*) AS cnt FROM tok GROUP BY word""")

UNICODE_WORDS = "CAST(length(regexp_extract_all(coalesce(text, ''), '[\\p{L}\\p{N}_]+')) AS BIGINT)"

_reg("unicode_words", f"SELECT doc_id, {UNICODE_WORDS} AS words FROM documents")

# ------------------------------------------------------------------ bounding

_reg("bounded_word_count", f"""
WITH {CONV_TOKENS},
r AS (SELECT word, row_number() OVER (PARTITION BY user_id ORDER BY turn, pos) AS rn FROM conv_tok)
SELECT word, count(*) AS cnt FROM r WHERE rn <= {C} GROUP BY word""")

_reg("bound_contributions", f"""
SELECT event_id, user_id, event_type, rank FROM (
  SELECT event_id, user_id, event_type,
         CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS rank
  FROM events WHERE user_id IS NOT NULL) WHERE rank <= {C}
UNION ALL
SELECT event_id, user_id, event_type, CAST(NULL AS BIGINT) AS rank FROM events WHERE user_id IS NULL""")

_reg("bound_null_user", f"""
WITH e AS (SELECT event_id, ts, event_type,
                  CASE WHEN event_id % 10 = 0 THEN NULL ELSE user_id END AS user_id FROM events)
SELECT event_id, user_id, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM e WHERE user_id IS NOT NULL)
WHERE rn <= {C}
UNION ALL
SELECT event_id, user_id, event_type FROM e WHERE user_id IS NULL""")

_reg("event_level_count", f"""
SELECT {TRIGGER} AS trigger_id, event_type, count(*) AS cnt FROM events GROUP BY ALL""")

_reg("clamped_sum", f"""
WITH {BOUNDED_EVENTS}
SELECT event_type, round(sum(greatest(least(value, {Q.CLAMP_LIMIT!r}), {-Q.CLAMP_LIMIT!r})), 6) AS clamped_sum,
       count(*) AS cnt
FROM bev GROUP BY event_type""")

# ------------------------------------------------------------------ counting

_reg("partial_counts", f"WITH {BOUNDED_EVENTS} SELECT flush_id, event_type, cnt FROM partials")
_reg("merged_counts", f"WITH {BOUNDED_EVENTS} SELECT trigger_id, event_type, cnt FROM merged")
_reg("trigger_index", f"WITH {BOUNDED_EVENTS} SELECT trigger_id, i FROM trig")

_reg("prefix_sum", f"""
WITH {BOUNDED_EVENTS}
SELECT event_type, i, cnt,
       CAST(sum(cnt) OVER (PARTITION BY event_type ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS prefix
FROM idx_all WHERE i < {Q.PARAMS.horizon}""")

_reg("dp_prefix_sum", f"""
WITH {BOUNDED_EVENTS}, {_releases_cte(Q.PARAMS)}
SELECT event_type, i, cnt, prefix, round(noisy, 6) AS noisy FROM rel""")

_H = Q.SHORT_HORIZON.horizon
_reg("horizon_cut", f"""
WITH {BOUNDED_EVENTS}
SELECT event_type,
       CAST(sum(CASE WHEN i < {_H} THEN cnt ELSE 0 END) AS BIGINT) AS kept_cnt,
       CAST(sum(CASE WHEN i < {_H} THEN 0 ELSE cnt END) AS BIGINT) AS cut_cnt,
       CAST(max(CASE WHEN i < {_H} THEN i END) AS BIGINT) AS last_i,
       CAST(count(CASE WHEN i >= {_H} THEN 1 END) AS BIGINT) AS cut_triggers
FROM idx_all GROUP BY event_type""")

_reg("release_round", f"""
WITH {BOUNDED_EVENTS}, {_releases_cte(Q.WIDE_NOISE)}
SELECT event_type, i, released FROM (
  SELECT event_type, i, CAST(floor(noisy + 0.5) AS BIGINT) AS released FROM rel) WHERE released >= 0""")

_reg("latest_snapshot", f"""
WITH {BOUNDED_EVENTS}, {_releases_cte(Q.PARAMS)}
SELECT event_type, max(i) AS i, round(arg_max(noisy, i), 6) AS noisy
FROM rel GROUP BY event_type""")

_reg("release_order", f"""
WITH {BOUNDED_EVENTS}, {_releases_cte(Q.WIDE_NOISE)},
latest AS (SELECT event_type, arg_max(noisy, i) AS noisy FROM rel GROUP BY event_type),
kept AS (SELECT event_type, noisy, CAST(floor(noisy + 0.5) AS BIGINT) AS released FROM latest
         WHERE floor(noisy + 0.5) >= 0)
SELECT CAST(row_number() OVER (ORDER BY noisy DESC, event_type ASC) AS BIGINT) AS rank, event_type, released
FROM kept""")

_reg("snapshot_series", f"""
WITH {BOUNDED_EVENTS}, {_releases_cte(Q.WIDE_NOISE)},
v AS (SELECT event_type, i, noisy,
             coalesce(lead(i) OVER (PARTITION BY event_type ORDER BY i), (SELECT max(i) + 1 FROM rel)) AS nxt
      FROM rel),
x AS (SELECT event_type, i AS release_i, noisy, CAST(unnest(range(i, nxt)) AS BIGINT) AS t FROM v)
SELECT t, event_type, release_i, CAST(floor(noisy + 0.5) AS BIGINT) AS released FROM x
WHERE floor(noisy + 0.5) >= 0""")

_reg("private_word_histogram", f"""
WITH {CONV_TOKENS},
b AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY turn, pos) AS rn FROM conv_tok)
      WHERE rn <= {C}),
cnts AS (SELECT turn, word, count(*) AS cnt FROM b GROUP BY ALL),
trig AS (SELECT turn, CAST(row_number() OVER (ORDER BY turn) - 1 AS BIGINT) AS i FROM (SELECT DISTINCT turn FROM cnts)),
widx AS (SELECT c.word, c.cnt, t.i FROM cnts c JOIN trig t USING (turn)),
{_releases_cte(Q.PARAMS, 'wrel', 'widx', 'word', Q.WORD_STREAM, 'turn')},
latest AS (SELECT word, max(i) AS i, arg_max(noisy, i) AS noisy FROM wrel GROUP BY word),
kept AS (SELECT *, CAST(floor(noisy + 0.5) AS BIGINT) AS released FROM latest WHERE floor(noisy + 0.5) >= 0)
SELECT CAST(row_number() OVER (ORDER BY noisy DESC, word ASC) AS BIGINT) AS rank, word, i, released FROM kept""")

# ------------------------------------------------------------------ choosing C

DOC_TOTALS = f"""
dw AS (SELECT doc_id % {Q.DOC_USERS} AS user_id, {UNICODE_WORDS} AS words FROM documents),
totals AS (SELECT user_id, CAST(sum(words) AS BIGINT) AS n, count(*) AS records FROM dw GROUP BY user_id)"""

_reg("user_totals", f"WITH {DOC_TOTALS} SELECT user_id, n, records FROM totals")

_reg("contribution_percentile", f"""
WITH {DOC_TOTALS} SELECT CAST(0.99 AS DOUBLE) AS p, round(quantile_cont(CAST(n AS DOUBLE), 0.99), 6) AS value FROM totals""")

_reg("event_percentile", """
WITH t AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id)
SELECT CAST(0.99 AS DOUBLE) AS p, round(quantile_cont(CAST(n AS DOUBLE), 0.99), 6) AS value FROM t""")

_reg("contribution_summary", f"""
WITH {DOC_TOTALS}
SELECT CAST(sum(records) AS BIGINT) AS records, count(*) AS users, CAST(sum(n) AS BIGINT) AS total,
       min(n) AS min_n, max(n) AS max_n, round(avg(n), 6) AS mean_n FROM totals""")

_bounds = ", ".join(str(b) for b in Q.GRID_BOUNDS)
_reg("bounding_loss", f"""
WITH {DOC_TOTALS}, g AS (SELECT CAST(unnest([{_bounds}]) AS BIGINT) AS c)
SELECT g.c AS max_contributions, count(*) AS users, count(CASE WHEN n > g.c THEN 1 END) AS users_over,
       CAST(sum(n) AS BIGINT) AS total, CAST(sum(greatest(n - g.c, 0)) AS BIGINT) AS dropped,
       round(CAST(sum(greatest(n - g.c, 0)) AS DOUBLE) / CAST(sum(n) AS DOUBLE), 9) AS loss
FROM totals, g GROUP BY g.c""")


# Rho-zCDP of (epsilon, delta = 1e-5); a test checks each against the conversion formula.
RHO = {0.1: 0.0004329937294018, 1.0: 0.030556595197640, 10.0: 1.7826956163289518}
_rho = "CASE epsilon " + " ".join(f"WHEN {e!r} THEN CAST({r!r} AS DOUBLE)" for e, r in RHO.items()) + " END"

_eps_list = ", ".join(f"CAST({e!r} AS DOUBLE)" for e in Q.GRID_EPSILONS)
_reg("calibration_sweep", f"""
WITH {DOC_TOTALS}, g AS (SELECT CAST(unnest([{_bounds}]) AS BIGINT) AS c),
loss AS (SELECT g.c AS max_contributions,
                CAST(sum(greatest(n - g.c, 0)) AS DOUBLE) / CAST(sum(n) AS DOUBLE) AS loss
         FROM totals, g GROUP BY g.c),
grid AS (SELECT max_contributions, loss, unnest([{_eps_list}]) AS epsilon,
                CAST({Q.PARAMS.delta!r} AS DOUBLE) AS delta, CAST({Q.PARAMS.horizon} AS BIGINT) AS horizon FROM loss),
r AS (SELECT *, {_rho} AS rho FROM grid)
SELECT max_contributions, round(loss, 9) AS loss, epsilon, delta, horizon, round(rho, 9) AS rho,
       round(sqrt(ln(horizon) * power(max_contributions * {Q.PARAMS.per_record_clamp!r}, 2) / (2.0 * rho)), 6) AS sigma
FROM r""")

# Fixed value: variance of one release (7 tree nodes) per squared bound at epsilon 10, delta 1e-5, T 60, L_m 1.
RELEASE_VARIANCE = 7 * (SIGMA[10.0] / 50) ** 2

_reg("best_bound", f"""
WITH {DOC_TOTALS},
held AS (SELECT n, count(*) AS users FROM totals WHERE n > 0 GROUP BY n),
c AS (SELECT unnest(range(1, (SELECT max(n) FROM held) + 1)) AS c),
e AS (SELECT c, CAST(sum(CASE WHEN n > c THEN users ELSE 0 END) AS BIGINT) AS users_over,
             CAST(sum(greatest(n - c, 0) * users) AS BIGINT) AS dropped, CAST(sum(n * users) AS BIGINT) AS total
      FROM c, held GROUP BY c),
j AS (SELECT *, CAST(dropped AS DOUBLE) * dropped + CAST({RELEASE_VARIANCE!r} AS DOUBLE) * c * c AS error FROM e)
SELECT c AS max_contributions, users_over, dropped, round(dropped / total, 6) AS loss,
       round(CAST({RELEASE_VARIANCE!r} AS DOUBLE) * c * c, 6) AS noise_variance, round(error, 6) AS error
FROM j ORDER BY j.error, c LIMIT 1""")

_reg("sketch_percentile", "SELECT CAST(0.99 AS DOUBLE) AS p, count(*) AS n, true AS within FROM events WHERE value IS NOT NULL")

_reg("custom_stage", """
WITH v AS (SELECT length(regexp_replace(text, '[^aeiou]', '', 'g')) AS vowels FROM documents WHERE text IS NOT NULL)
SELECT vowels % 10 AS digit, count(*) AS docs, CAST(sum(vowels) AS BIGINT) AS vowels FROM v GROUP BY ALL""")
