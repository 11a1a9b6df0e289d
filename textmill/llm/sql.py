"""SQL for the queries that it can express; the others are tested against brute force."""

COMPONENTS = """
edges AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(node, root) AS (SELECT a, a FROM edges UNION SELECT b, root FROM reach JOIN edges ON node = a WHERE root < b),
roots AS (SELECT node, min(root) AS root FROM reach GROUP BY node)"""

OP2 = rf"""WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id < y.vec_id AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.98),
{COMPONENTS},
n AS (SELECT a, count(*) AS n FROM edges GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(root, vec_id) AS component_id, coalesce(root, vec_id) = vec_id AS kept FROM embeddings LEFT JOIN n ON vec_id = a LEFT JOIN roots ON vec_id = node"""

_ESCAPED = "replace(replace(replace({0}, chr(92), chr(92) || chr(92)), '<', chr(92) || 'l'), '>', chr(92) || 'g')"
OP5 = rf"""WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, 0, 'user', chr(92) || '### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', chr(92) || '### Assistant: </turn> ok'),
g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS learnt,
CAST(sum(length('<turn ' || {_ESCAPED.format("role")} || '>' || chr(10) || {_ESCAPED.format("text")} || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256, formatted_chars FROM g"""

OP10 = rf"""WITH RECURSIVE t AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS h FROM t),
k AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y ON x.h = y.h AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM i JOIN k p ON a = p.doc_id JOIN k q ON b = q.doc_id WHERE 100 * m >= 75 * (p.n + q.n - m)),
{COMPONENTS}
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(root, d.doc_id) AS component_id, coalesce(root, d.doc_id) = d.doc_id AS kept FROM documents d LEFT JOIN k ON d.doc_id = k.doc_id LEFT JOIN roots ON d.doc_id = node"""

OP13 = r"""WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e FROM embeddings
WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label = v.label AS same, v.vec_id, CAST(list_inner_product(a.e, v.e) AS BIGINT) AS score FROM v a JOIN v ON a.vec_id <> v.vec_id AND len(a.e) = len(v.e) WHERE a.vec_id % 50 = 0),
p AS (SELECT anchor_id, vec_id, score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.anchor_id, p.vec_id AS positive_id, s.vec_id AS negative_id, p.score AS positive_score, s.score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY s.score DESC, s.vec_id) AS k
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(k AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 3"""

# CRC-32 by its bits; a batch's number by day; a version dies in the first batch whose horizon has a later version of its client
OP11 = r"""WITH crc AS (SELECT DISTINCT change_id, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(CAST(change_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
lambda acc, x: list_reduce(list_prepend(xor(acc, x), list_transform(range(8), lambda i: CAST(i AS BIGINT))), lambda a, i: CASE WHEN a & 1 = 1 THEN xor(a >> 1, CAST(3988292384 AS BIGINT)) ELSE a >> 1 END)), CAST(4294967295 AS BIGINT)) % 4 AS shift FROM client_changes),
d AS (SELECT DISTINCT * FROM client_changes WHERE valid_at IS NOT NULL),
c AS (SELECT d.*, greatest(0, least(9, CAST(floor((date_diff('day', DATE '1970-01-01', CAST(valid_at AS DATE)) + coalesce(shift, 0) - 19723) * 10 / 152) AS BIGINT))) AS b FROM d LEFT JOIN crc ON d.change_id = crc.change_id),
s AS (SELECT *, row_number() OVER () AS r, coalesce(greatest(0, least(9, CAST(floor((date_diff('day', DATE '1970-01-01', CAST(arrived_at AS DATE)) - 19723) * 10 / 152) AS BIGINT))), 9) AS b FROM sales),
n AS (SELECT unnest(range(10)) AS b),
w AS (SELECT n.b, (SELECT max(valid_at) FROM c WHERE c.b < n.b) - INTERVAL 36 HOUR AS wc, (SELECT max(sold_at) FROM s WHERE s.b < n.b) - INTERVAL 36 HOUR AS ws FROM n),
h AS (SELECT b, wc, CASE WHEN wc IS NOT NULL AND ws IS NOT NULL THEN least(wc, ws) END AS h FROM w),
v AS (SELECT c.*, row_number() OVER (ORDER BY c.valid_at, c.seq NULLS FIRST, c.change_id NULLS FIRST, floor(100 * c.balance + 0.5) NULLS FIRST, c.op NULLS FIRST) AS k FROM c JOIN h USING (b) WHERE h.wc IS NULL OR c.valid_at >= h.wc),
dead AS (SELECT v.k, min(h.b) AS dead FROM v JOIN h ON h.b >= v.b AND v.valid_at <= h.h JOIN v u ON u.client_id = v.client_id AND u.k > v.k AND u.valid_at <= h.h AND u.b <= h.b GROUP BY v.k),
live AS (SELECT v.*, coalesce(dead, 99) AS dead FROM v LEFT JOIN dead USING (k)),
e AS (SELECT s.*, CASE WHEN sold_at IS NULL THEN s.b ELSE coalesce((SELECT min(h.b) FROM h WHERE h.b >= s.b AND s.sold_at < h.h), 10) END AS out FROM s),
f AS (SELECT e.r, count(*) AS n_held, max(l.k) FILTER (l.valid_at <= e.sold_at) AS k FROM e JOIN live l ON l.client_id = e.client_id AND l.b <= e.out AND l.dead >= e.out GROUP BY e.r)
SELECT 'sale' AS rec, e.sale_id AS id, CAST(e.out AS BIGINT) AS batch, coalesce(f.n_held, 0) AS n_held, live.change_id, CAST(floor(100 * live.balance + 0.5) AS BIGINT) AS balance_cents, live.op FROM e LEFT JOIN f ON e.r = f.r LEFT JOIN live ON live.k = f.k
UNION ALL SELECT 'change', c.change_id, CAST(c.b AS BIGINT), NULL, NULL, NULL, NULL FROM c JOIN h USING (b) WHERE c.valid_at < h.wc"""

SQL = {"op2_embedding_dup": OP2, "op5_chat": OP5, "op10_near_dup": OP10, "op11_enrichment": OP11, "op13_hard_negatives": OP13}
