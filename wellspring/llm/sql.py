"""DuckDB twins of the queries that SQL can express."""

_WORDS = "list_filter(regexp_split_to_array({text}, '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINKED = f"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents
), sets AS (
  SELECT r, doc_id, CASE
    WHEN len(w) = 0 THEN []
    WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words
), items AS (
  SELECT list_sort(s) AS s, min(r) AS r FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)
), grams AS (
  SELECT r, len(s) AS n, unnest(s) AS g FROM items
), links AS (
  SELECT a.r AS a, b.r AS b FROM grams a JOIN grams b ON a.g = b.g AND a.r < b.r
  GROUP BY a.r, b.r, a.n, b.n HAVING 100 * count(*) >= @PERCENT * (a.n + b.n - count(*))
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links
), reach AS (
  SELECT r AS a, r AS b FROM items
  UNION
  SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
), rows_of AS (
  SELECT sets.doc_id, items.r FROM sets JOIN items ON list_sort(sets.s) = items.s
), least AS (
  SELECT a, min(doc_id) AS component_id FROM reach JOIN rows_of ON rows_of.r = reach.b GROUP BY a
)
, classes AS (
  SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles,
    CASE WHEN len(sets.s) = 0 THEN sets.doc_id ELSE least.component_id END AS component_id
  FROM sets LEFT JOIN items ON list_sort(sets.s) = items.s AND len(sets.s) > 0 LEFT JOIN least ON least.a = items.r
)
"""

OP5 = _LINKED.replace("@PERCENT", "80") + "SELECT doc_id, n_shingles, component_id FROM classes"
OP12 = (
    _LINKED.replace("@PERCENT", "85")
    + "SELECT doc_id, n_shingles, component_id, doc_id IS NOT DISTINCT FROM component_id AS kept FROM classes"
)

OP10 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores
) WHERE rank <= 5
"""

# crc32 of a decimal id, a byte at a time and in it a bit at a time
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP13 = f"""
WITH turns AS (
  SELECT conv_id, turn, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS words,
    sha256(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, ''))) AS id
  FROM conversations WHERE conv_id IS NOT NULL
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id[1:32]) AS place FROM turns
), ids AS (
  SELECT conv_id, {_CRC} % 4 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), whole AS (
  SELECT ids.conv_id, place, id, words FROM ids JOIN placed ON placed.conv_id = ids.conv_id - ids.conv_id % 20 AND place <= h
  UNION ALL
  SELECT ids.conv_id, place, id, words FROM ids JOIN placed USING (conv_id) WHERE place > h
), paths AS (
  SELECT ids.conv_id, coalesce(list(whole.id ORDER BY place) FILTER (WHERE whole.id IS NOT NULL), []) AS path,
    coalesce(list(whole.words ORDER BY place) FILTER (WHERE whole.id IS NOT NULL), []) AS words
  FROM ids LEFT JOIN whole USING (conv_id) GROUP BY ids.conv_id
), begun AS (
  SELECT conv_id, unnest(range(len(path) + 1)) AS depth, path, words FROM paths
), nodes AS (
  SELECT path[1:depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, max(CASE WHEN depth > 0 THEN words[depth] ELSE 0 END) AS words,
    coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE len(path) = depth), '') AS ends
  FROM begun GROUP BY path[1:depth], depth
), children AS (
  SELECT node[1:depth - 1] AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), known AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node)
), climbed AS (
  SELECT node, n_convs, words, n_children, unnest(range(depth + 1)) AS up FROM known
), sums AS (
  SELECT node[1:up] AS node, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum((n_convs - 1) * words) AS saved_tokens
  FROM climbed GROUP BY 1
)
SELECT known.conv_id, known.depth, above.conv_id AS parent_conv_id, known.n_convs, known.n_children, sums.n_leaves,
  CAST(sums.saved_tokens AS BIGINT) AS saved_tokens, sha256(known.ends) AS ends_sha256
FROM known JOIN sums USING (node) LEFT JOIN known above ON known.depth > 0 AND above.node = known.node[1:known.depth - 1]
"""

ORACLES = {"op5_ngram_jaccard_join": OP5, "op10_topk_search": OP10, "op12_lsh_forest": OP12, "op13_prefix_trie": OP13}
