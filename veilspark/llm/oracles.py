"""DuckDB SQL of the queries of this subpackage that SQL can express."""


def crc32(number: str) -> str:
    """Unsigned CRC-32 of an integer's decimal text, bit by bit."""
    code = f"list_transform(string_split(CAST({number} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))"
    byte = "list_reduce(list_concat([xor(r, b)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, s: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(list_reduce(list_concat([4294967295], {code}), lambda r, b: {byte}), 4294967295)"


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(n: str) -> str:
    return "sha256(" + " || ".join(_field(x) for x in ("doc_id", "source", "lang", n, "text")) + ")"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('=' || lang, '') AS g, {_leaf("n_chars")} AS leaf,
         CASE WHEN doc_id IS NOT NULL AND {crc32("doc_id")} % 7 = 0 THEN {_leaf("(n_chars + 1)")} END AS tampered
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         count(*) OVER (PARTITION BY g) AS n
  FROM leaves),
nodes AS (
  SELECT 0 AS level, g, pos, n, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, g, pos // 2, max((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, g, pos // 2),
subroots AS (SELECT g, digest AS subroot FROM nodes WHERE n = 1),
langs AS (SELECT *, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM subroots),
above AS (
  SELECT 0 AS level, pos, n, subroot AS digest FROM langs
  UNION ALL
  SELECT level + 1, pos // 2, max((n + 1) // 2), sha256(string_agg(digest, '' ORDER BY pos))
  FROM above WHERE n > 1 GROUP BY level, pos // 2),
root AS (SELECT digest AS root FROM above WHERE n = 1),
steps AS (
  SELECT p.g, p.pos, l.level AS step, (p.pos >> l.level) & 1 AS slot, coalesce(s.digest, '') AS sibling
  FROM placed p JOIN (SELECT DISTINCT g, level FROM nodes WHERE n > 1) l ON l.g = p.g
  LEFT JOIN nodes s ON s.g = p.g AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
  UNION ALL
  SELECT p.g, p.pos, 1000 + l.level, (q.pos >> l.level) & 1, coalesce(s.digest, '')
  FROM placed p JOIN langs q ON q.g = p.g CROSS JOIN (SELECT DISTINCT level FROM above WHERE n > 1) l
  LEFT JOIN above s ON s.level = l.level AND s.pos = xor(q.pos >> l.level, 1)),
paths AS (
  SELECT g, pos, list(struct_pack(slot := slot, sibling := sibling) ORDER BY step) AS path FROM steps GROUP BY g, pos),
folded AS (
  SELECT p.*, coalesce(h.path, []) AS path FROM placed p LEFT JOIN paths h USING (g, pos)),
folds AS (
  SELECT g, pos, path, 1 AS step, coalesce(tampered, leaf) AS digest FROM folded
  UNION ALL
  SELECT g, pos, path, step + 1,
         sha256(CASE WHEN path[step].slot = 1 THEN path[step].sibling || digest ELSE digest || path[step].sibling END)
  FROM folds WHERE step <= len(path))
SELECT f.doc_id, f.leaf, s.subroot, r.root,
       sha256(coalesce(list_aggregate(list_transform(f.path, lambda x: x.sibling), 'string_agg', ''), '')) AS proof_sha256,
       e.digest AS folded_root, e.digest = r.root AS verified
FROM folded f JOIN subroots s USING (g) CROSS JOIN root r
JOIN folds e ON e.g = f.g AND e.pos = f.pos AND e.step = len(f.path) + 1
"""

_TURN = "sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))"

TRIE = f"""
WITH RECURSIVE own AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, {_TURN}) AS place, {_TURN} AS digest,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (
  SELECT conv_id, count(*) AS size, {crc32("conv_id")} % 4 AS h, conv_id - conv_id % 20 AS base FROM own GROUP BY conv_id),
whole AS (
  SELECT s.*, least(s.h, coalesce(b.size, 0)) AS taken FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.base),
turns AS (
  SELECT w.conv_id, o.place AS depth, o.digest, o.words FROM whole w JOIN own o ON o.conv_id = w.base AND o.place <= w.taken
  UNION ALL
  SELECT w.conv_id, o.place - w.h + w.taken, o.digest, o.words FROM whole w JOIN own o ON o.conv_id = w.conv_id AND o.place > w.h),
paths AS (
  SELECT conv_id, 0::BIGINT AS depth, '' AS node, NULL::VARCHAR AS parent, 0::BIGINT AS words FROM sizes
  UNION ALL
  SELECT p.conv_id, t.depth, sha256(p.node || t.digest), p.node, t.words
  FROM paths p JOIN turns t ON t.conv_id = p.conv_id AND t.depth = p.depth + 1),
nodes AS (
  SELECT node, depth, parent, max(words) AS words, min(conv_id) AS conv_id, count(*) AS n FROM paths GROUP BY node, depth, parent),
kids AS (SELECT parent AS node, count(*) AS children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
counted AS (SELECT n.*, coalesce(k.children, 0) AS children FROM nodes n LEFT JOIN kids k USING (node)),
under AS (
  SELECT p.node, count(*) FILTER (x.children = 0) AS leaves, sum((x.n - 1) * x.words) AS saved
  FROM counted x JOIN paths p ON p.conv_id = x.conv_id AND p.depth <= x.depth GROUP BY p.node),
lengths AS (SELECT conv_id, max(depth) AS depth FROM paths GROUP BY conv_id),
ends AS (
  SELECT p.node, string_agg(p.conv_id::VARCHAR, ',' ORDER BY p.conv_id) AS ids
  FROM paths p JOIN lengths l ON l.conv_id = p.conv_id AND l.depth = p.depth GROUP BY p.node)
SELECT c.conv_id, c.depth, a.conv_id AS parent_conv_id, c.n AS n_convs, c.children AS n_children, u.leaves AS n_leaves,
       u.saved::BIGINT AS saved_tokens, sha256(coalesce(e.ids, '')) AS ends_sha256
FROM counted c JOIN under u USING (node) LEFT JOIN nodes a ON a.node = c.parent LEFT JOIN ends e ON e.node = c.node
"""
