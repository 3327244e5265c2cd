"""SQL twins of the operators' queries."""

MIXING_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         ('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), text, '')), 1, 15))::BIGINT AS h
  FROM documents),
ranked AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w
  FROM rows GROUP BY source),
ordered AS (  -- the sources that meet their cap first come first
  SELECT *, 3 * source_size AS cap, row_number() OVER (ORDER BY source_size / w, source NULLS LAST) AS i FROM ranked),
summed AS (
  SELECT *, CAST((SELECT sum(source_size) FROM ranked) - coalesce(sum(cap) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS HUGEINT) AS budget,
         CAST(sum(w) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS HUGEINT) AS active FROM ordered),
level AS (SELECT budget, active FROM summed WHERE w * budget <= cap * active ORDER BY i LIMIT 1),
targets AS (
  SELECT o.source, o.source_size,
         CASE WHEN o.w * l.budget > o.cap * l.active THEN CAST(o.cap AS DOUBLE)
              ELSE CAST(o.w AS DOUBLE) * CAST(l.budget AS DOUBLE) / CAST(l.active AS DOUBLE) END AS target
  FROM ordered o, level l),
parts AS (
  SELECT *, floor(target / greatest(source_size, 1)) AS n_full, target - floor(target / greatest(source_size, 1)) * source_size AS rest FROM targets),
placed AS (
  SELECT r.*, p.source_size, p.target, p.n_full, p.rest,
         sum(size) OVER (PARTITION BY r.source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto,
         sum(size) OVER (PARTITION BY r.source, h) AS own
  FROM rows r JOIN parts p ON r.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(size * (n_full + CASE WHEN rest > 0 AND (upto <= rest OR upto - own <= rest AND upto - rest < rest - (upto - own)) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM placed
"""

WORDS_SQL = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"

SUBSTRINGS_SQL = rf"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS r, {WORDS_SQL} AS w FROM documents),
windows AS (
  SELECT r, i, array_to_string(w[i : i + 34], ' ') AS s FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY s) AS n FROM windows) WHERE n > 1),
covered AS (SELECT DISTINCT r, j FROM (SELECT r, unnest(range(i, i + 35)) AS j FROM again)),
words AS (SELECT r, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS j FROM docs),
kept AS (SELECT r, count(*) AS n, string_agg(x, ' ' ORDER BY j) AS t FROM words ANTI JOIN covered USING (r, j) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

JACCARD_SQL = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, row_number() OVER () AS r,
         list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, r, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                         ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS s
  FROM docs),
grams AS (SELECT r, len(s) AS n, unnest(s) AS g FROM sets),
ordered AS (SELECT r, n, g, row_number() OVER (PARTITION BY r ORDER BY c, g) AS i FROM (SELECT *, count(*) OVER (PARTITION BY g) AS c FROM grams)),
starts AS (SELECT r, n, g FROM ordered WHERE i <= n - ceil(n * 4 / 5) + 1),
pairs AS (
  SELECT DISTINCT a.r AS x, b.r AS y FROM starts a JOIN starts b ON a.g = b.g AND a.r < b.r AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4),
links AS (
  SELECT x, y FROM (SELECT x, y, len(p.s) AS m, len(q.s) AS n, len(list_intersect(p.s, q.s)) AS o FROM pairs JOIN sets p ON p.r = x JOIN sets q ON q.r = y)
  WHERE 100 * o >= 80 * (m + n - o)),
both_ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reached AS (SELECT x, x AS y FROM (SELECT DISTINCT x FROM both_ways) UNION SELECT reached.x, b.y FROM reached JOIN both_ways b ON reached.y = b.x),
least AS (SELECT reached.x, min(sets.doc_id) AS c FROM reached JOIN sets ON sets.r = reached.y GROUP BY 1)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id, coalesce(n, 0) AS n_links
FROM sets LEFT JOIN least ON least.x = r LEFT JOIN (SELECT x AS lx, count(*) AS n FROM both_ways GROUP BY 1) ON lx = r
"""

URLS_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) END AS rest FROM pages),
named AS (
  SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM parts),
rules(verdict, h, p) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT page_id, arg_max(h || p, length(h) * 1000 + length(p)) AS rule, arg_max(verdict, length(h) * 1000 + length(p)) AS verdict
  FROM named JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY page_id)
SELECT named.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM named LEFT JOIN fits USING (page_id)
"""

VECTORS_SQL = r"""
WITH RECURSIVE fine AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM fine a JOIN fine b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.98),
reached AS (SELECT x, x AS y FROM (SELECT DISTINCT x FROM pairs) UNION SELECT reached.x, pairs.y FROM reached JOIN pairs ON reached.y = pairs.x),
least AS (SELECT x, min(y) AS c FROM reached GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM pairs GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(c, vec_id) AS component_id, vec_id = coalesce(c, vec_id) AS kept
FROM embeddings LEFT JOIN counted ON counted.x = vec_id LEFT JOIN least ON least.x = vec_id
"""

CHAT_SQL = r"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
shown AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place,
         coalesce('=' || length(role) || ':' || role, '-') || coalesce('=' || length(text) || ':' || text, '-') AS own,
         '<|im_start|>' || replace(coalesce(role, ''), '<|', '< |') || chr(10) || replace(coalesce(text, ''), '<|', '< |') || '<|im_end|>' || chr(10) AS block
  FROM turns),
starts AS (
  SELECT conv_id, place, string_agg(own, '') OVER w AS start, string_agg(block, '') OVER w AS chat, count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM shown WINDOW w AS (PARTITION BY conv_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
whole AS (SELECT start, min(conv_id) AS conv_id, count(*) AS copies, any_value(n_turns) AS n_turns, any_value(chat) AS chat FROM starts WHERE place = n_turns GROUP BY start)
SELECT conv_id, CAST(n_turns AS INTEGER) AS n_turns, copies, chat FROM whole
WHERE start NOT IN (SELECT start FROM starts WHERE place < n_turns)
"""


def crc32_sql(text: str) -> str:
    """crc32 of an ASCII expression, bit by bit."""
    bits = f"flatten(list_transform(string_split({text}, ''), lambda c: list_transform(range(8), lambda k: CAST((unicode(c) >> k) & 1 AS BIGINT))))"
    return f"xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], {bits}), lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"


TRIE_SQL = rf"""
WITH own AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p, coalesce(role, '') AS r, coalesce(text, '') AS t
  FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, {crc32_sql("CAST(c AS VARCHAR)")} % 4 AS h, c - c % 20 AS d, count(*) AS n FROM own GROUP BY c),
rebuilt AS (
  SELECT i.c, p, r, t FROM ids i JOIN own ON own.c = i.d AND p <= h
  UNION ALL SELECT i.c, p - h + least(h, (SELECT count(*) FROM own o WHERE o.c = i.d)), r, t FROM ids i JOIN own ON own.c = i.c AND p > h),
paths AS (
  SELECT c, p AS depth, md5(string_agg(length(r) || ':' || r || t, chr(1) || '|') OVER (PARTITION BY c ORDER BY p)) || p AS node, len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS words FROM rebuilt
  UNION ALL SELECT c, 0, '', 0 FROM ids),
nodes AS (
  SELECT node, any_value(depth) AS depth, min(c) AS conv_id, count(*) AS n_convs, any_value(words) AS words FROM paths GROUP BY node),
up AS (SELECT DISTINCT a.node, b.node AS parent FROM paths a JOIN paths b ON a.c = b.c AND a.depth = b.depth + 1),
kids AS (SELECT parent AS node, count(*) AS n_children FROM up GROUP BY parent),
below AS (  -- each node stands once, at its smallest member
  SELECT m.node, sum((w.n_convs - 1) * w.words) AS saved, count(*) FILTER (WHERE k.node IS NULL) AS leaves
  FROM nodes w JOIN paths m ON m.c = w.conv_id AND m.depth <= w.depth LEFT JOIN kids k ON k.node = w.node GROUP BY m.node),
ends AS (
  SELECT node, string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) AS ids FROM (SELECT c, arg_max(node, depth) AS node FROM paths GROUP BY c) GROUP BY node)
SELECT n.conv_id, CAST(n.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, leaves AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM nodes n JOIN below b ON b.node = n.node LEFT JOIN kids k ON k.node = n.node LEFT JOIN ends e ON e.node = n.node
LEFT JOIN up ON up.node = n.node LEFT JOIN nodes p ON p.node = up.parent
"""


REPAIR_SQL = rf"""
WITH RECURSIVE given AS (
  SELECT conv_id, turn, coalesce(CAST(conv_id AS VARCHAR), ' ') AS c, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {crc32_sql("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
damaged AS (
  SELECT c, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, copy
  FROM given, (VALUES (0), (1)) AS t(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
placed AS (
  SELECT *, substr(role, 1, 1) AS i, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text, copy) AS p,
         row_number() OVER (PARTITION BY c, role, text ORDER BY turn NULLS FIRST, copy) AS seen FROM damaged),
marked AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][ 	-
]*$') THEN 'truncated' ELSE 'fine' END AS fault,
         lag(i) OVER (PARTITION BY c ORDER BY p) || i AS twin FROM placed),
inserts(p, q, cost, e) AS (VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (3, 2, 3, 'I'), (2, 3, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')),
moves(i, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
edits AS (
  SELECT '' AS i, p, q, 4 AS cost, 'D' AS e FROM inserts WHERE p = q UNION ALL SELECT i, p, q, 0, 'K' FROM moves
  UNION ALL SELECT '', p, q, 3, 'R' FROM moves WHERE i <> 's'),
dp AS (
  SELECT DISTINCT c, CAST(0 AS BIGINT) AS done, 0 AS s, 0 AS cost, '' AS audit FROM given
  UNION ALL
  SELECT c, done, s, cost, audit FROM (
    SELECT *, row_number() OVER (PARTITION BY c, s ORDER BY cost, audit) AS best FROM (
      SELECT d.c, m.p AS done, o.q AS s, d.audit || n.e || o.e AS audit,
             d.cost + n.cost + o.cost + CASE WHEN o.e <> 'D' AND m.fault = 'truncated' THEN 3 ELSE 0 END AS cost
      FROM dp d JOIN marked m ON m.c = d.c AND m.p = d.done + 1 JOIN inserts n ON n.p = d.s
      JOIN edits o ON o.p = n.q AND (o.e = 'D' OR m.fault IN ('truncated', 'fine')) AND (o.e <> 'K' OR o.i = m.i)))
  WHERE best = 1),
ends AS (
  SELECT d.c, d.cost + n.cost AS cost, d.audit || n.e AS audit, row_number() OVER (PARTITION BY d.c ORDER BY d.cost + n.cost, d.audit || n.e) AS best
  FROM dp d JOIN inserts n ON n.p = d.s AND n.q IN (0, 3) WHERE d.done = (SELECT count(*) FROM marked m WHERE m.c = d.c)),
walk AS (
  SELECT c, k, e, count(*) FILTER (WHERE e <> 'I') OVER (PARTITION BY c ORDER BY k) AS p, count(*) FILTER (WHERE e <> 'D') OVER (PARTITION BY c ORDER BY k) - 1 AS o
  FROM (SELECT c, k, substr(audit, k, 1) AS e FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS k FROM ends WHERE best = 1))),
outs AS (
  SELECT w.c, k, o, e, role, CASE WHEN e = 'I' THEN '' ELSE text END AS text, first_value(e = 'K' AND i = 's') OVER (PARTITION BY w.c ORDER BY k) AS sys
  FROM walk w LEFT JOIN marked m ON m.c = w.c AND m.p = w.p AND e <> 'I' WHERE e <> 'D'),
texts AS (
  SELECT c, string_agg(CASE WHEN e = 'K' THEN role WHEN (o % 2 = 1) = sys THEN 'user' ELSE 'assistant' END || ':' || text, chr(10) ORDER BY k) AS t FROM outs GROUP BY c),
counts AS (
  SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE p > 1 AND twin NOT IN ('su', 'ua', 'au')) AS illegal FROM marked GROUP BY c)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       CAST(cost AS BIGINT) AS cost, audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT c, conv_id FROM given) g JOIN ends ON ends.c = g.c AND best = 1 LEFT JOIN counts ON counts.c = g.c LEFT JOIN texts ON texts.c = g.c
"""
