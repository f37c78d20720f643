"""DuckDB SQL for the queries that SQL can express."""

OP2 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON c.vec_id <> q.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
         vec_id, score
  FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP1 = r"""
WITH dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL),
bw AS (
  SELECT item_id, list_filter(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
  FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
ds AS (
  SELECT DISTINCT doc_id, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i+k-1], ' '))) AS s
  FROM dw, (SELECT 5 AS k UNION SELECT DISTINCT len(w) FROM bw WHERE len(w) BETWEEN 1 AND 4) WHERE len(w) >= k),
bs AS (
  SELECT DISTINCT item_id, unnest(CASE
    WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM bw),
n AS (SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id),
m AS (SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_item, n_shared
FROM m JOIN n USING (item_id) WHERE n_shared * 1000 >= n_item * 800
"""

OP10 = r"""
WITH p AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
l AS (
  SELECT doc_id, i, parts[i] AS line,
         list_filter(regexp_split_to_array(lower(parts[i]), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w
  FROM p, unnest(range(1, len(parts) + 1)) AS r(i)
  WHERE doc_id IS NOT NULL AND text IS NOT NULL),
f AS (
  SELECT array_to_string(w, ' ') AS k, any_value(w) AS w, min(doc_id * 100000000 + i) AS place
  FROM l WHERE len(w) > 0 GROUP BY 1),
v AS (
  SELECT place, k, array_to_string(list_concat(w[1:j-1], w[j+1:len(w)]), ' ') AS cut, j
  FROM f, unnest(range(1, len(w) + 1)) AS r(j) WHERE len(w) >= 8),
swapped AS (
  SELECT v.place FROM v JOIN (SELECT cut, j, min(place) AS best FROM v GROUP BY cut, j) b
  ON v.cut = b.cut AND v.j = b.j AND b.best < v.place),
longer AS (SELECT v.place AS a, f.place AS b FROM v JOIN f ON v.cut = f.k AND len(f.w) >= 8),
near AS (
  SELECT place FROM swapped
  UNION SELECT a FROM longer WHERE b < a
  UNION SELECT b FROM longer WHERE a < b),
kept AS (SELECT place FROM f WHERE place NOT IN (SELECT place FROM near)),
j AS (
  SELECT l.doc_id, l.i, l.line, len(l.w) = 0 AS blank, kept.place IS NOT NULL AS stays
  FROM l LEFT JOIN kept ON kept.place = l.doc_id * 100000000 + l.i),
g AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE NOT blank AND NOT stays) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE blank OR stays), '') AS text
  FROM j GROUP BY doc_id)
SELECT p.doc_id, coalesce(g.n_lines, 0) AS n_lines, coalesce(g.n_dropped, 0) AS n_dropped,
       CASE WHEN p.text IS NULL THEN NULL ELSE g.text END AS text
FROM p LEFT JOIN g USING (doc_id)
"""

OP8 = r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[ \x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
ds AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM dw),
n AS (SELECT doc_id, count(*) AS n FROM ds GROUP BY doc_id),
m AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o
  FROM ds x JOIN ds y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM m JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
  WHERE 100 * o >= 85 * (p.n + q.n - o)),
both_ways AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT reach.doc_id, g.b FROM reach JOIN both_ways g ON g.a = reach.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(k.n_links, 0) AS n_links
FROM documents d JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) c USING (doc_id)
LEFT JOIN n USING (doc_id)
LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM both_ways GROUP BY a) k USING (doc_id)
"""

OP6 = r"""
WITH RECURSIVE m AS (
  SELECT row_number() OVER () AS id, conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
l AS (
  SELECT id, conv_id, turn, i, parts[i] AS line,
         length(regexp_replace(regexp_extract(parts[i], '^((?:\s?>)+)', 1), '[^>]', '', 'g')) AS lev
  FROM (SELECT *, string_split(text, chr(10)) AS parts FROM m), unnest(range(1, len(parts) + 1)) AS r(i)),
b AS (
  SELECT id, any_value(conv_id) AS conv_id, any_value(turn) AS turn,
         list(line ORDER BY i) FILTER (WHERE lev = 0 AND NOT regexp_matches(line, '^On .* wrote:\s*$')) AS body
  FROM l GROUP BY id),
g AS (
  SELECT id, conv_id, turn, lev, min(i) AS run,
         list(regexp_replace(line, '^((?:\s?>)+)\s?', '') ORDER BY i) AS lines
  FROM (SELECT *, i - row_number() OVER (PARTITION BY id, lev ORDER BY i) AS island FROM l) x
  WHERE lev > 0 AND conv_id IS NOT NULL AND turn IS NOT NULL GROUP BY id, conv_id, turn, lev, island),
a AS (
  SELECT id, conv_id, turn, lev, run, part, trim(regexp_replace(lower(t), '\s+', ' ', 'g')) AS t FROM (
    SELECT *, 0 AS part, array_to_string(lines, chr(10)) AS t FROM g
    UNION ALL SELECT g.*, k, lines[k] FROM g, unnest(range(1, len(lines) + 1)) AS r(k)) y),
o AS (
  SELECT DISTINCT conv_id, turn, trim(regexp_replace(lower(t), '\s+', ' ', 'g')) AS t FROM (
    SELECT conv_id, turn, array_to_string(body, chr(10)) AS t FROM b
    UNION ALL SELECT conv_id, turn, unnest(body) FROM b) y
  WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND regexp_matches(t, '[\p{L}\p{N}]')),
inside AS (SELECT t, conv_id, min(turn) AS turn FROM o GROUP BY t, conv_id),
whole AS (SELECT t, conv_id, turn FROM o QUALIFY row_number() OVER (PARTITION BY t ORDER BY conv_id, turn) = 1),
c AS (
  SELECT a.*, 0 AS far, i.conv_id AS p_conv, i.turn AS p_turn FROM a JOIN inside i USING (t, conv_id) WHERE i.turn < a.turn
  UNION ALL SELECT a.*, 1, w.conv_id, w.turn FROM a JOIN whole w ON w.t = a.t WHERE w.conv_id < a.conv_id),
p AS (
  SELECT *, (SELECT count(DISTINCT d.run) FROM c d WHERE d.id = c.id) AS n_linked FROM c
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY lev, run, part, far, p_conv, p_turn) = 1),
up AS (SELECT conv_id, turn, p_conv, p_turn FROM p
       QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY p_conv, p_turn) = 1),
chain(conv_id, turn, r_conv, r_turn, n) AS (
  SELECT conv_id, turn, p_conv, p_turn, 1 FROM up
  UNION ALL SELECT chain.conv_id, chain.turn, up.p_conv, up.p_turn, n + 1
  FROM chain JOIN up ON up.conv_id = chain.r_conv AND up.turn = chain.r_turn),
root AS (SELECT conv_id, turn, arg_max(r_conv, n) AS r_conv FROM chain GROUP BY conv_id, turn),
q AS (SELECT id, count(*) AS n_quotes, max(lev) AS max_level FROM g GROUP BY id),
f AS (
  SELECT m.*, CASE WHEN m.turn IS NOT NULL THEN coalesce(root.r_conv, m.conv_id) END AS conversation,
         coalesce(array_to_string(b.body, chr(10)), '') AS content, p.p_conv, p.p_turn, p.n_linked, q.n_quotes, q.max_level
  FROM m JOIN b USING (id) LEFT JOIN p USING (id) LEFT JOIN q USING (id)
  LEFT JOIN root ON root.conv_id = m.conv_id AND root.turn = m.turn)
SELECT conversation,
       CASE WHEN conversation IS NULL THEN 0 ELSE row_number() OVER (PARTITION BY conversation ORDER BY conv_id, turn) END AS position,
       conv_id, turn, role, content, p_conv AS parent_conv, p_turn AS parent_turn,
       coalesce(n_quotes, 0) AS n_quotes, coalesce(n_linked, 0) AS n_linked, coalesce(max_level, 0) AS max_level
FROM f
"""

OP11 = r"""
WITH d AS (
  SELECT row_number() OVER () AS id, doc_id, source, coalesce(text, '') AS t,
         list_filter(regexp_split_to_array(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS l
  FROM documents),
win AS (SELECT id, i, array_to_string(w[i:i+7], ' ') AS s FROM d, unnest(range(1, len(w) - 6)) AS r(i) WHERE len(w) > 8),
twice AS (SELECT id, i FROM win QUALIFY count(*) OVER (PARTITION BY id, s) > 1),
rep AS (SELECT id, count(DISTINCT i + k) AS n FROM twice, unnest(range(0, 8)) AS r(k) GROUP BY id),
m AS (
  SELECT d.id, doc_id, source, len(w) AS n_words,
         CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
         len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words
  FROM d LEFT JOIN rep ON rep.id = d.id),
f AS (
  SELECT *, n_words < 20 AS short, 100 * n_repeat_words > 30 * n_words AS repetitive, 10 * n_symbols > n_words AS symbols,
         n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 10 * n_words) AS word_length,
         100 * n_dup_lines > 30 * n_lines AS dup_lines
  FROM m),
r AS (
  UNPIVOT (SELECT source, count(*) AS n, sum(short::INT) AS short, sum(repetitive::INT) AS repetitive, sum(symbols::INT) AS symbols,
                  sum(word_length::INT) AS word_length, sum(dup_lines::INT) AS dup_lines
           FROM f WHERE source <> '' GROUP BY source)
  ON short, repetitive, symbols, word_length, dup_lines INTO NAME rule VALUE failed),
s AS (SELECT rule, avg(failed / n) AS mean, var_samp(failed / n) AS v, avg(1 / n) AS inv FROM r GROUP BY rule),
u AS (SELECT *, (v - mean * (1 - mean) * inv) / nullif(1 - inv, 0) AS spread FROM s),
p AS (SELECT rule, mean, least(greatest(CASE WHEN spread > 0 THEN mean * (1 - mean) / spread - 1 ELSE 10000 END, 2), 10000) AS k FROM u),
g AS (SELECT source, rule, n + k AS total, (failed + mean * k) / (n + k) AS rate FROM r JOIN p USING (rule)),
bad AS (SELECT DISTINCT source FROM g WHERE rate - 2 * sqrt(rate * (1 - rate) / (total + 1)) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repetitive AS base_failed,
       bad.source IS NOT NULL AS host_failed, NOT (short OR repetitive) AND bad.source IS NULL AS kept
FROM f LEFT JOIN bad ON bad.source = f.source
"""

OP12 = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
         CAST(coalesce(list_sum(list_transform(list_zip(a.e, c.e), lambda z: z[1] * z[2])), 0) AS BIGINT) AS score
  FROM v a JOIN v c ON c.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, s.vec_id AS negative_id,
       positive_score, s.score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER w <= 10
"""

# crc32 bit by bit over the bytes of the decimal id
OP13 = r"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT DISTINCT conv_id, conv_id - conv_id % 20 AS base, xor(4294967295::UBIGINT, list_reduce(
    list_prepend(4294967295::UBIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
    lambda x, y: list_reduce(list_prepend(xor(x, y), [0::UBIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, b: xor(a >> 1, 3988292384::UBIGINT * (a & 1))))) % 4 AS h
  FROM t),
b AS (
  SELECT c.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.base AND t.pos <= c.h
  UNION ALL SELECT t.conv_id, t.pos, t.role, t.text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h),
r AS (
  SELECT c.conv_id, coalesce(list({'r': role, 't': text} ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS path
  FROM c LEFT JOIN b USING (conv_id) GROUP BY c.conv_id),
m AS (SELECT conv_id, d AS depth, path[1:d] AS node, len(path) = d AS ends FROM r, unnest(range(0, len(path) + 1)) AS x(d)),
n AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends
  FROM m GROUP BY node, depth),
k AS (SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
w AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children,
         CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * len(regexp_extract_all(node[depth].t, '[^\x20\x09-\x0D]+')) END AS saved
  FROM n LEFT JOIN k USING (node)),
sub AS (
  SELECT node[1:d] AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM w, unnest(range(0, depth + 1)) AS x(d) GROUP BY 1)
SELECT w.conv_id, w.depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, sub.n_leaves, sub.saved_tokens,
       sha256(w.ends) AS ends_sha256
FROM w JOIN sub ON sub.node = w.node LEFT JOIN n p ON w.depth > 0 AND p.node = w.node[1:w.depth - 1]
"""

ORACLE: dict[str, str] = {"op1_benchmark_decontamination": OP1, "op2_exact_topk": OP2,
                            "op6_chat_formatting": OP6, "op8_ngram_jaccard": OP8, "op10_line_dedup": OP10,
                            "op11_quality_rules": OP11, "op12_hard_negatives": OP12, "op13_prefix_trie": OP13}
