"""DuckDB SQL of the queries that SQL can express, over the whole tables."""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({text}, '[^ \t\n\x0B\f\r]+')"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

OP8 = f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS ws FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN []
        WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
        ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS items FROM w),
n AS (SELECT doc_id, CAST(len(items) AS BIGINT) AS n_shingles FROM s),
e AS (SELECT doc_id, unnest(items) AS item FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
      FROM e x JOIN e y ON x.item = y.item AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b
      WHERE 100 * same >= 75 * (p.n_shingles + q.n_shingles - same)),
both_ways AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n
          UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON t.a = r.b)
SELECT n.doc_id, n.n_shingles, m.component_id, n.doc_id = m.component_id AS kept
FROM n JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) m ON m.a = n.doc_id
"""

# A line goes when an equal line of 40 characters or more, or three equal lines
# in a row that hold it, start earlier.
OP9 = """
WITH l AS (SELECT doc_id, generate_subscripts(parts, 1) - 1 AS i, unnest(parts) AS t
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)),
x AS (SELECT doc_id, i, t, lead(t, 1) OVER d AS t1, lead(t, 2) OVER d AS t2 FROM l
      WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
y AS (SELECT doc_id, i, t, t2,
             row_number() OVER (PARTITION BY t ORDER BY doc_id, i) > 1 AND length(t) >= 40 AS one,
             t2 IS NOT NULL AND row_number() OVER (PARTITION BY t, t1, t2 ORDER BY doc_id, i) > 1 AS three FROM x),
z AS (SELECT doc_id, i, t, one OR three OR coalesce(lag(three, 1) OVER d, false) OR coalesce(lag(three, 2) OVER d, false) AS gone
      FROM y WINDOW d AS (PARTITION BY doc_id ORDER BY i)),
r AS (SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), false) AS opens FROM z)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CAST(gone AS INT)) AS BIGINT) AS n_removed,
       CAST(sum(CAST(opens AS INT)) AS BIGINT) AS n_runs,
       md5(coalesce(string_agg(CASE WHEN NOT gone THEN t END, chr(10) ORDER BY i), '')) AS kept_md5
FROM r GROUP BY doc_id
"""

OP1 = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
      AND len(x.e) = len(y.e) WHERE list_cosine_similarity(x.e, y.e) >= 0.93),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN l ON l.a = r.b),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n_links, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.a = e.vec_id LEFT JOIN n ON n.a = e.vec_id
"""

# Pairs of equal words q apart form islands: an island of m pairs is a run of
# m + q words.  3988292384 is the polynomial of crc32.
OP11 = r"""
WITH c AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS ws,
  list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(regexp_extract_all(CAST(doc_id AS VARCHAR), '.'), lambda x: CAST(ascii(x) AS BIGINT))),
    lambda s, b: list_reduce(list_prepend(xor(s, b), [CAST(0 AS BIGINT) FOR k IN range(8)]),
      lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, CAST(3988292384 AS BIGINT)) ELSE x >> 1 END)) AS s FROM documents),
h AS (SELECT doc_id, ws, len(ws) AS n, xor(s, CAST(4294967295 AS BIGINT)) AS h FROM c),
g AS (SELECT *, h // 10 AS g, h % 10 = 0 AND n > 0 AS planted, CASE WHEN n > 0 THEN (h // 10) % n END AS a FROM h),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM g),
w AS (SELECT doc_id, i, CASE WHEN planted AND i >= a THEN ws[a + (i - a) % p + 1] ELSE ws[i + 1] END AS w, n
      FROM (SELECT doc_id, ws, n, planted, a, p, unnest(range(n)) AS i FROM p)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.doc_id = y.doc_id AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
t AS (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM m),
e AS (SELECT doc_id, q, min(i) AS s, count(*) + q AS len FROM t GROUP BY doc_id, q, island HAVING count(*) >= 3 * q AND count(*) + q >= 6),
r AS (SELECT doc_id, s, len, min(q) AS q FROM e GROUP BY doc_id, s, len),
k AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS txt FROM r GROUP BY doc_id),
b AS (SELECT DISTINCT ON (doc_id) doc_id, s, len, q FROM r ORDER BY doc_id, CAST(len AS DOUBLE) / q DESC, s, q),
d AS (SELECT DISTINCT doc_id, unnest(range(s + q, s + len)) AS i FROM r),
o AS (SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS kept FROM w LEFT JOIN d ON d.doc_id = w.doc_id AND d.i = w.i WHERE d.i IS NULL GROUP BY w.doc_id)
SELECT c.doc_id, coalesce(k.n_runs, 0) AS n_runs, b.s AS start, b.len AS length, b.q AS period,
       (1000 * b.len) // b.q AS exponent_milli, sha256(coalesce(k.txt, '')) AS runs_sha256, sha256(coalesce(o.kept, '')) AS collapsed_sha256
FROM c LEFT JOIN k ON k.doc_id = c.doc_id LEFT JOIN b ON b.doc_id = c.doc_id LEFT JOIN o ON o.doc_id = c.doc_id
"""

OP13 = f"""
WITH t AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL),
d AS (SELECT doc_id, count(*) AS n FROM t GROUP BY doc_id),
g AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM d),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, g GROUP BY term),
s AS (SELECT tf.doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))) AS s
      FROM tf JOIN d USING (doc_id) JOIN w USING (term), g),
q AS (SELECT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
c AS (SELECT item_id, term, count(*) AS c FROM q GROUP BY ALL),
r AS (SELECT item_id, doc_id, CAST(sum(c * s) AS BIGINT) AS score FROM c JOIN s USING (term) GROUP BY ALL HAVING sum(c * s) > 0),
k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r)
SELECT * FROM k WHERE rank <= 20
"""

ORACLE_SQL = {
    "op1_embedding_near_dedup": OP1,
    "op8_minhash_near_dedup": OP8,
    "op9_line_runs": OP9,
    "op11_periodic_runs": OP11,
    "op13_ranked_search": OP13,
}
