"""DuckDB SQL of the queries that SQL can express."""

# Chat formatting: escaped lengths are counted by replacing in the same order.
OP3 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
esc AS (
  SELECT *, replace(replace(replace(text, '\', '\\'), '##', '#\#'), '</', '<\/') AS t,
    replace(replace(replace(replace(role, '\', '\\'), '##', '#\#'), '</', '<\/'), ':', '\:') AS r
  FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(r) + length(t) + 14) AS BIGINT) AS formatted_chars
FROM esc GROUP BY conv_id
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
    md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS kind FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][kind + 1] AS weight, 2 * source_size AS most FROM s),
o AS (
  SELECT *, (sum(source_size) OVER () * CAST(1.5 AS DOUBLE)
      - coalesce(sum(most) OVER (ORDER BY most / weight, source ASC NULLS LAST
          ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY most / weight, source ASC NULLS LAST
          ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
v AS (  -- the level at which the capped shares add up to the whole mix
  SELECT max(level) AS water FROM o WHERE level > 0 AND (
    SELECT abs(sum(least(CAST(x.most AS DOUBLE), o.level * x.weight)) - 1.5 * sum(x.source_size)) < 1e-6
      * greatest(sum(x.source_size), 1) FROM w x)),
t AS (SELECT *, coalesce(least(CAST(most AS DOUBLE), weight * water), CAST(most AS DOUBLE)) AS target FROM o, v),
p AS (
  SELECT d.*, t.source_size, t.target, t.kind,
    coalesce(CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS BIGINT), 0) AS start
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (
  SELECT *, CASE WHEN size = 0 THEN 0 ELSE CAST(start + size <= target AS INT)
    + CAST(source_size + start + size <= target AS INT) END AS copies FROM p),
l AS (
  SELECT *, target - sum(size * copies) OVER (PARTITION BY source) AS gap,
    min(copies) FILTER (size > 0) OVER (PARTITION BY source) AS done FROM c),
b AS (
  SELECT *, CASE WHEN copies = done AND copies < 2 AND size > 0 AND size < 2 * gap THEN
    row_number() OVER (PARTITION BY source,
      (copies = done AND copies < 2 AND size > 0 AND size < 2 * gap) ORDER BY abs(size - gap), h, start)
    END AS nth FROM l),
m AS (SELECT *, copies + CASE WHEN nth = 1 THEN 1 ELSE 0 END AS n FROM b)
SELECT doc_id, size, source_size, target, CAST(size * n AS BIGINT) AS taken FROM m
"""

OP1 = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS payload_bytes, sha256(h) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id > first THEN first END AS refers_to
FROM f
"""

OP6 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.doc_id = p.a JOIN n y ON y.doc_id = p.b
  WHERE 100 * i >= 90 * (x.n + y.n - i)),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(r.b) AS component_id
FROM documents d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""

# Rows: every line with its words, numbered from 0 as in Spark's posexplode.
LINE_ROWS = r"""
l AS (
  SELECT doc_id, i AS line_no, string_split(text, chr(10))[i + 1] AS line FROM (
    SELECT doc_id, text, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM {docs})),
w AS (SELECT doc_id, line_no, line, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM l),
c AS (
  SELECT ws, len(ws) AS n, arg_min(doc_id, (doc_id, line_no)) AS d, min((doc_id, line_no)) AS place
  FROM w WHERE len(ws) > 0 GROUP BY ws),
v AS (
  SELECT place, n - 1 AS n, i AS pos, array_to_string(ws[1:i - 1] || ws[i + 1:], ' ') AS t FROM (
    SELECT *, unnest(range(1, n + 1)) AS i FROM c WHERE n >= 5)),
f AS (SELECT place, n, array_to_string(ws, ' ') AS t FROM c WHERE n >= 5),
near AS (
  SELECT place FROM (SELECT place, min(place) OVER (PARTITION BY t, n, pos) AS o FROM v) WHERE o < place
  UNION SELECT v.place FROM v JOIN f USING (t, n) WHERE f.place < v.place
  UNION SELECT f.place FROM f JOIN v USING (t, n) WHERE v.place < f.place),
m AS (
  SELECT w.doc_id, w.line_no, w.line, near.place IS NOT NULL AS is_near,
    c.place IS NOT NULL AND near.place IS NULL AND c.place <> (w.doc_id, w.line_no) AS is_copy
  FROM w LEFT JOIN c ON c.ws = w.ws LEFT JOIN near ON near.place = c.place)"""

OP4 = "WITH " + LINE_ROWS.format(docs="documents") + r"""
SELECT d.doc_id, count(m.doc_id) AS n_lines, count(*) FILTER (is_copy) AS n_exact, count(*) FILTER (is_near) AS n_near,
  CASE WHEN any_value(d.text) IS NOT NULL THEN
    length(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT is_copy AND NOT is_near), '')) END
    AS kept_chars,
  CASE WHEN any_value(d.text) IS NOT NULL THEN
    sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (NOT is_copy AND NOT is_near), '')) END
    AS kept_sha256
FROM documents d LEFT JOIN m ON m.doc_id = d.doc_id GROUP BY d.doc_id
"""

# All pairs, by brute force.
OP10 = r"""
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE NOT isnan(list_cosine_similarity(a.e, b.e)) AND list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON l.a = r.b),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT r.a AS vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.b) AS component_id, r.a = min(r.b) AS kept
FROM r LEFT JOIN n ON n.a = r.a GROUP BY r.a
"""

# Prefixes as lists of turns; totals over all pairs of a node and an ancestor.
OP11 = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS own FROM t GROUP BY conv_id),
h AS (  -- bit by bit: the checksum of the decimal id
  SELECT conv_id, own, xor(list_reduce([4294967295] || flatten(list_transform(
    string_split(CAST(conv_id AS VARCHAR), ''), lambda x: [ascii(x), -1, -1, -1, -1, -1, -1, -1, -1])),
    lambda c, s: CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295) % 4 AS h
  FROM o),
c AS (
  SELECT h.conv_id, coalesce(d.own[1:h.h], []) || h.own[h.h + 1:] AS turns
  FROM h LEFT JOIN o d ON d.conv_id = h.conv_id - h.conv_id % 20),
p AS (
  SELECT conv_id, d AS depth, len(turns) AS size, md5(CAST(to_json(turns[1:d]) AS VARCHAR)) AS g,
    md5(CAST(to_json(turns[1:d - 1]) AS VARCHAR)) AS up, CASE WHEN d > 0 THEN turns[d].t END AS last
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM c)),
n AS (
  SELECT depth, g, any_value(up) AS up, min(conv_id) AS conv_id, count(*) AS n_convs,
    coalesce((count(*) - 1) * len(regexp_extract_all(any_value(last), '[^\x20\x09-\x0D]+')), 0) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (size = depth), '')) AS ends_sha256
  FROM p GROUP BY depth, g),
k AS (SELECT up, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
f AS (
  SELECT n.*, CASE WHEN n.depth > 0 THEN a.conv_id END AS parent_conv_id, coalesce(k.n_children, 0) AS n_children
  FROM n LEFT JOIN n a ON a.depth = n.depth - 1 AND a.g = n.up LEFT JOIN k ON k.depth = n.depth AND k.up = n.g),
s AS (
  SELECT p.depth, p.g, sum(CAST(f.n_children = 0 AS INT)) AS n_leaves, sum(f.saved) AS saved_tokens
  FROM f JOIN p ON p.conv_id = f.conv_id AND p.depth <= f.depth GROUP BY p.depth, p.g)
SELECT conv_id, f.depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM f JOIN s ON s.depth = f.depth AND s.g = f.g
"""
