"""DuckDB SQL for the operators that SQL can express."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"list_filter(string_split_regex({_LOWER}, '[\x20\x09-\x0D]+'), lambda x: x <> '')"


def _sets(name: str, source: str, key: str) -> str:
    """CTEs `name` (key, s): the distinct five-word shingles of each row."""
    return f"""{name}_words AS (SELECT {key}, {_WORDS} AS w FROM {source}),
{name} AS (SELECT {key}, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM {name}_words)"""


DECONTAMINATE = f"""
WITH {_sets("docs", "documents", "doc_id")},
{_sets("items", "benchmark", "item_id")},
d AS (SELECT doc_id, unnest(s) AS t FROM docs),
b AS (SELECT item_id, len(s) AS item_size, unnest(s) AS t FROM items)
SELECT doc_id, item_id, count(*) AS shared, any_value(item_size)::BIGINT AS item_size
FROM d JOIN b USING (t) GROUP BY doc_id, item_id HAVING 5 * count(*) >= 4 * any_value(item_size)
"""

REPEATS = rf"""
WITH docs AS (SELECT doc_id, {_WORDS} AS w, list_transform(regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+'), lambda x: length(x)) AS long FROM documents),
placed AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM docs),
keyed AS (SELECT *, md5_number_lower(word) AS k FROM placed),
begun AS (SELECT doc_id, i, word, coalesce(k < min(k) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 4 PRECEDING AND 1 PRECEDING), true)
    AND coalesce(k <= min(k) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 1 FOLLOWING AND 4 FOLLOWING), true) OR i = 0 AS b FROM keyed),
lined AS (SELECT *, max(CASE WHEN b THEN i END) OVER (PARTITION BY doc_id ORDER BY i) AS begin FROM begun),
lines AS (SELECT doc_id, min(i) AS f, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS u FROM lined GROUP BY doc_id, begin, (i - begin) // 32),
numbered AS (SELECT *, row_number() OVER o AS line, coalesce(lag(n) OVER o, 0) AS before, coalesce(lead(n) OVER o, 0) AS after FROM lines WINDOW o AS (PARTITION BY doc_id ORDER BY f)),
ranked AS (SELECT *, row_number() OVER p AS place, first_value(doc_id) OVER p AS kept, first_value(f) OVER p AS kept_at FROM numbered WINDOW p AS (PARTITION BY u ORDER BY doc_id, line)),
runs AS (SELECT *, line - row_number() OVER (PARTITION BY doc_id ORDER BY line) AS run FROM ranked WHERE place > 1),
edges AS (SELECT doc_id, count(*) AS n_lines, sum(n) AS n, min(f) AS a, max(f + n) AS z, arg_min(kept, line) AS ka, arg_min(kept_at, line) AS kat, arg_max(kept, line) AS kz, arg_max(kept_at + n, line) AS kzt
    FROM runs GROUP BY doc_id, run HAVING sum(n) + arg_min(before, line) + arg_max(after, line) + 8 >= 50),
grown AS (SELECT e.*, d.w, d.long,
    coalesce(nullif(list_position(list_transform(range(1, 1 + least(36, a, kat)), lambda j: d.w[a - j + 1] = ka.w[kat - j + 1]), false), 0) - 1, least(36, a, kat)) AS l,
    coalesce(nullif(list_position(list_transform(range(1, 1 + least(36, len(d.w) - z, len(kz.w) - kzt)), lambda j: d.w[z + j] = kz.w[kzt + j]), false), 0) - 1, least(36, len(d.w) - z, len(kz.w) - kzt)) AS r
    FROM edges e JOIN docs d USING (doc_id) JOIN docs ka ON ka.doc_id = e.ka JOIN docs kz ON kz.doc_id = e.kz)
SELECT doc_id, (coalesce(list_sum(long[1:a - l]), 0) + long[a - l + 1] - length(w[a - l + 1]))::BIGINT AS "start", list_sum(long[1:z + r])::BIGINT AS "end", n_lines, (n + l + r)::BIGINT AS n_words, ka AS kept_doc_id
FROM grown WHERE n + l + r >= 50
"""

NEAR_VECTORS = """
WITH RECURSIVE v AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS x, vec_id AS y FROM embeddings UNION SELECT r.x, p.b FROM reach r JOIN pairs p ON r.y = p.a),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT l.x AS vec_id, coalesce(d.n, 0)::BIGINT AS n_links, l.component_id, l.x = l.component_id AS kept
FROM least l LEFT JOIN degree d ON d.a = l.x
"""

NGRAM_JOIN = f"""
WITH RECURSIVE {_sets("docs", "documents", "doc_id")},
keyed AS (SELECT doc_id, len(s) AS n, s, list_sort(s) AS k FROM docs),
classes AS (SELECT min(doc_id) AS id, k, any_value(s) AS s, any_value(n) AS n, count(*) AS size FROM keyed WHERE n > 0 GROUP BY k),
t AS (SELECT id, n, size, unnest(s) AS t FROM classes),
pairs AS (SELECT a.id AS a, b.id AS b, any_value(b.size) AS size FROM t a JOIN t b ON a.t = b.t AND a.id <> b.id
    GROUP BY a.id, b.id HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
reach AS (SELECT id AS x, id AS y FROM classes UNION SELECT r.x, p.b FROM reach r JOIN pairs p ON r.y = p.a),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT a, sum(size) AS n FROM pairs GROUP BY a)
SELECT d.doc_id, d.n AS n_shingles, (coalesce(c.size - 1, 0) + coalesce(g.n, 0))::BIGINT AS n_links, coalesce(l.component_id, d.doc_id) AS component_id
FROM keyed d LEFT JOIN classes c ON d.n > 0 AND c.k = d.k LEFT JOIN least l ON l.x = c.id LEFT JOIN degree g ON g.a = c.id
"""

SHARDS = """
WITH h AS (SELECT doc_id, coalesce(strlen(text), 0) AS size, ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'text:' || coalesce(text, ''))), 1, 15))::BIGINT AS h FROM documents),
p AS (SELECT doc_id, size, d.depth, h >> (60 - d.depth) AS prefix FROM h, (SELECT unnest(range(0, 61))::INTEGER AS depth) d),
b AS (SELECT depth, prefix, sum(size)::BIGINT AS shard_bytes, count(*) AS shard_rows FROM p GROUP BY depth, prefix HAVING sum(size) <= 1048576),
leaf AS (SELECT doc_id, arg_min(prefix, depth) AS prefix, min(depth) AS depth FROM p SEMI JOIN b USING (depth, prefix) GROUP BY doc_id)
SELECT doc_id, CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), depth, '0') END AS shard, depth, shard_bytes, shard_rows
FROM leaf JOIN b USING (depth, prefix)
"""
