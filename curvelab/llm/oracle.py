"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

_COMPONENTS = """
reach(node, other) AS (
  SELECT {key}, {key} FROM {nodes}
  UNION
  SELECT r.node, l.b FROM reach r JOIN both_ways l ON l.a = r.other
)
"""

OP1 = (
    """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) END AS s
  FROM words
), sized AS (
  SELECT doc_id, len(s)::BIGINT AS n, s FROM sets
), rows_ AS (
  SELECT doc_id, n, unnest(s) AS sh FROM sized
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS both_n, any_value(x.n) AS na, any_value(y.n) AS nb
  FROM rows_ x JOIN rows_ y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs WHERE 100 * both_n >= 80 * (na + nb - both_n)
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
),"""
    + _COMPONENTS.format(key="doc_id", nodes="sized")
    + """
SELECT s.doc_id, s.n AS n_shingles, c.component_id, s.doc_id = c.component_id AS kept
FROM sized s JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) c ON c.node = s.doc_id
"""
)

OP7 = """
WITH turns AS (
  SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, ''))
    ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), spotted AS (
  SELECT conv_id, t, list_filter(range(1, len(t) + 1), lambda i: t[i].role = 'assistant') AS s FROM turns
), ended AS (
  SELECT conv_id, t[1:list_max(s)] AS c, s, ((conv_id % len(s)) + len(s)) % len(s) AS place,
    coalesce(lead(conv_id) OVER (ORDER BY conv_id), min(conv_id) OVER ()) AS follower
  FROM spotted WHERE len(s) > 0
), pairs AS (
  SELECT e.conv_id, e.c AS a, list_concat(e.c[1:e.s[e.place + 1] - 1], o.c[o.s[least(e.place, len(o.s) - 1) + 1]:]) AS b
  FROM ended e JOIN ended o ON o.conv_id = e.follower AND o.conv_id <> e.conv_id
), split AS (
  SELECT conv_id, a, b, coalesce(list_min(list_filter(range(1, least(len(a), len(b)) + 1), lambda i: a[i] <> b[i])) - 1,
    least(len(a), len(b))) AS n
  FROM pairs
)
SELECT conv_id AS pair_id, n::INTEGER AS n_prompt_turns,
  coalesce(array_to_string(list_transform(a[1:n], lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), ''), '') AS prompt,
  coalesce(array_to_string(list_transform(a[n+1:], lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), ''), '') AS chosen,
  coalesce(array_to_string(list_transform(a[n+1:], lambda x: '0x' || (13 + length(x.role)) || ',' ||
    (CASE WHEN x.role = 'assistant' THEN '1x' ELSE '0x' END) || (length(x.text) + 11)), ','), '') AS chosen_mask,
  coalesce(array_to_string(list_transform(b[n+1:], lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)), ''), '') AS rejected,
  coalesce(array_to_string(list_transform(b[n+1:], lambda x: '0x' || (13 + length(x.role)) || ',' ||
    (CASE WHEN x.role = 'assistant' THEN '1x' ELSE '0x' END) || (length(x.text) + 11)), ','), '') AS rejected_mask
FROM split
"""

OP9 = (
    """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE label IS NOT NULL AND vec_id IS NOT NULL AND len(e) > 0
    AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM good x JOIN good y
    ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e) AND list_cosine_similarity(x.e, y.e) >= 0.93
), both_ways AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
),"""
    + _COMPONENTS.format(key="vec_id", nodes="v")
    + """
SELECT v.vec_id, coalesce(n.n, 0)::BIGINT AS n_links, c.component_id, v.vec_id = c.component_id AS kept
FROM v JOIN (SELECT node, min(other) AS component_id FROM reach GROUP BY node) c ON c.node = v.vec_id
LEFT JOIN (SELECT a, count(*) AS n FROM both_ways GROUP BY a) n ON n.a = v.vec_id
"""
)

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), anchors AS (
  SELECT row_number() OVER () AS anchor, * FROM v WHERE vec_id % 100 = 0
), scores AS (
  SELECT a.anchor, a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same,
    list_inner_product(a.e, r.e)::BIGINT AS score
  FROM anchors a JOIN v r ON len(a.e) = len(r.e)
), positives AS (
  SELECT anchor, anchor_id, other_id AS positive_id, score,
    row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id) AS number
  FROM scores WHERE same AND other_id <> anchor_id
), ranked AS (
  SELECT p.anchor_id, p.positive_id, n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.number ORDER BY n.score DESC, n.other_id) AS rank
  FROM positives p JOIN scores n ON n.anchor = p.anchor AND NOT n.same
    AND 80 * p.score <= 100 * n.score AND n.score <= p.score
  WHERE p.number <= 5
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 5
"""

# one round: every part goes to its nearest entry, then every entry becomes the floor of its parts' mean
_OP13_ASSIGNED = """
a{r} AS MATERIALIZED (
  SELECT x.vec_id, x.p, min(list_sum(list_transform(range(1, len(x.s) + 1), lambda i: (x.s[i] - c.s[i]) * (x.s[i] - c.s[i])))::BIGINT
    * 16 + c.k) AS best
  FROM x JOIN c{r} c ON c.p = x.p GROUP BY x.vec_id, x.p
)"""
_OP13_ROUND = """
m{r} AS (
  SELECT p, k, list(floor(total / n)::BIGINT ORDER BY i) AS s FROM (
    SELECT x.p, a.best % 16 AS k, i, sum(x.s[i]) AS total, count(*) AS n
    FROM x JOIN a{r} a ON a.vec_id = x.vec_id AND a.p = x.p, range(1, 65) t(i) WHERE i <= len(x.s) GROUP BY 1, 2, 3
  ) GROUP BY p, k
), c{next} AS MATERIALIZED (
  SELECT c.p, c.k, coalesce(m.s, c.s) AS s FROM c{r} c LEFT JOIN m{r} m ON m.p = c.p AND m.k = c.k
)"""

OP13 = (
    """
WITH v AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT vec_id, p, e[p * (len(e) // 8) + 1 : (p + 1) * (len(e) // 8)] AS s FROM v, range(8) t(p)
), c0 AS MATERIALIZED (
  SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, s
  FROM x WHERE vec_id IN (SELECT vec_id FROM v ORDER BY vec_id LIMIT 16)
),"""
    + ",".join(_OP13_ASSIGNED.format(r=r) + "," + _OP13_ROUND.format(r=r, next=r + 1) for r in range(6))
    + ","
    + _OP13_ASSIGNED.format(r=6)
    + """,
codes AS (
  SELECT vec_id, string_agg(printf('%02x', best % 16), '' ORDER BY p) AS code, sum(best // 16)::BIGINT AS error FROM a6 GROUP BY vec_id
), digest AS (
  SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM c6
)
SELECT c.vec_id, c.code, c.error, (sum(c.error) OVER (PARTITION BY v.label))::BIGINT AS label_error, d.codebooks_sha256
FROM codes c JOIN v ON v.vec_id = c.vec_id, digest d
"""
)

ORACLE = {
    "op1_minhash_dedup": OP1,
    "op7_preference_format": OP7,
    "op9_vector_dedup": OP9,
    "op12_hard_negatives": OP12,
    "op13_vector_codes": OP13,
}
