"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

ORACLE_SQL: dict[str, str] = {
    "op2_topk": """
WITH x AS (SELECT vec_id, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM x q JOIN x c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INT) AS rank, vec_id, score FROM s WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""",
    "op6_preference": """
WITH t AS (SELECT conv_id, list(struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) ORDER BY turn, coalesce(role, ''), coalesce(text, '')) AS c FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
l AS (SELECT *, coalesce(list_max(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant')), 0) AS last FROM t),
p AS (SELECT a.conv_id, a.c, CASE WHEN a.last > 0 AND b.last > 0 THEN list_append(a.c[1:a.last - 1], b.c[b.last]) ELSE [] END AS r
  FROM l a LEFT JOIN l b ON b.conv_id = xor(a.conv_id, 1)),
n AS (SELECT *, coalesce(list_min(list_filter(range(1, least(len(c), len(r)) + 1), lambda i: c[i].role <> r[i].role OR c[i].text <> r[i].text)) - 1, least(len(c), len(r))) AS n FROM p),
k AS (SELECT conv_id, n, c[1:n] AS p, c[n + 1:] AS c, r[n + 1:] AS r FROM n),
o AS (SELECT conv_id, n, list_transform(p, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) AS p,
  c, r, list_transform(c, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) AS cs, list_transform(r, lambda x: '<|im_start|>' || x.role || chr(10) || x.text || '<|im_end|>' || chr(10)) AS rs FROM k),
e AS (SELECT *, list_transform(range(1, len(cs) + 1), lambda i: CAST(coalesce(list_sum(list_transform(cs[1:i], lambda z: length(z))), 0) AS BIGINT)) AS ce, list_transform(range(1, len(rs) + 1), lambda i: CAST(coalesce(list_sum(list_transform(rs[1:i], lambda z: length(z))), 0) AS BIGINT)) AS re FROM o)
SELECT conv_id AS pair_id, CAST(n AS BIGINT) AS n_prompt_turns, coalesce(array_to_string(p, ''), '') AS prompt, coalesce(array_to_string(cs, ''), '') AS chosen,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(c) + 1), lambda i: c[i].role = 'assistant'), lambda i: CAST(ce[i] - 11 - length(c[i].text) AS VARCHAR) || ':' || CAST(ce[i] AS VARCHAR)), ','), '') AS chosen_mask,
  coalesce(array_to_string(rs, ''), '') AS rejected,
  coalesce(array_to_string(list_transform(list_filter(range(1, len(r) + 1), lambda i: r[i].role = 'assistant'), lambda i: CAST(re[i] - 11 - length(r[i].text) AS VARCHAR) || ':' || CAST(re[i] AS VARCHAR)), ','), '') AS rejected_mask,
  len(list_filter(c, lambda x: x.role = 'assistant')) > 0 AND len(list_filter(r, lambda x: x.role = 'assistant')) > 0 AS is_pair
FROM e""",
    "op10_decontaminate": r"""
WITH w AS MATERIALIZED (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
i AS (SELECT DISTINCT item_id, size, g FROM (SELECT item_id, least(10, len(w)) AS size, unnest(list_transform(range(1, greatest(len(w) - 10, 0) + 2), lambda k: array_to_string(w[k:k + least(10, len(w)) - 1], ' '))) AS g FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM i),
g AS (SELECT doc_id, size, unnest(range(1, len(w) - size + 2)) AS spot, unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k:k + size - 1], ' '))) AS g FROM w, sizes WHERE len(w) >= size),
h AS (SELECT g.doc_id, g.spot, g.size, i.item_id FROM g JOIN i ON i.size = g.size AND i.g = g.g),
p AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(spot, spot + size)) AS pos FROM h) GROUP BY doc_id),
q AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items FROM h GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN p ON p.doc_id = w.doc_id LEFT JOIN q ON q.doc_id = w.doc_id""",
    "op11_view_maintenance": r"""
WITH t AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
names AS (SELECT 'c' || client_id AS k FROM clients UNION SELECT 's' || sale_id FROM sales UNION SELECT 'l' || sale_id || ':' || line_no FROM sale_lines),
h AS (SELECT k, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) AS h FROM names, t WHERE k IS NOT NULL),
w AS (SELECT k, CASE WHEN h % 7 < (h // 7) % 7 THEN h % 7 ELSE -1 END AS born, CASE WHEN h % 7 < (h // 7) % 7 THEN (h // 7) % 7 ELSE 99 END AS gone FROM h),
n AS (SELECT n_nationkey, CAST(n_regionkey AS INT) AS region FROM nation),
c AS (SELECT client_id, region, born, gone FROM clients JOIN n ON nation_id = n_nationkey JOIN w ON k = 'c' || client_id),
s AS (SELECT sale_id, client_id, CAST(date_diff('day', DATE '1970-01-01', CAST(sold_at AS DATE)) AS BIGINT) AS part, born, gone FROM sales JOIN w ON k = 's' || sale_id WHERE sold_at IS NOT NULL),
l AS (SELECT sale_id, item_id, region, CAST(floor(100 * amount + 0.5) AS BIGINT) * CAST(100 - floor(100 * discount + 0.5) AS BIGINT) AS revenue, coalesce(born, -1) AS born, coalesce(gone, 99) AS gone
  FROM sale_lines x JOIN vendors v ON x.vendor_id = v.vendor_id JOIN n ON v.nation_id = n_nationkey LEFT JOIN w ON k = 'l' || sale_id || ':' || line_no WHERE amount IS NOT NULL AND discount IS NOT NULL),
j AS (SELECT c.region, part, c.client_id, item_id, revenue, greatest(c.born, s.born, l.born) AS born, least(c.gone, s.gone, l.gone) AS gone
  FROM l JOIN s ON l.sale_id = s.sale_id JOIN c ON s.client_id = c.client_id AND l.region = c.region)
SELECT CAST(b.b AS INT) AS batch, region, part, count(*) AS n_lines, CAST(sum(revenue) AS BIGINT) AS revenue, min(revenue) AS min_revenue, count(DISTINCT client_id) AS n_clients, count(DISTINCT item_id) AS n_items
FROM j JOIN range(7) b(b) ON born <= b.b AND b.b < gone GROUP BY b.b, region, part""",
    "op12_hard_negatives": """
WITH x AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_inner_product(a.v, c.v) AS BIGINT) AS score FROM x a JOIN x c ON a.vec_id <> c.vec_id WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 3""",
}
