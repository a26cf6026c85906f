"""DuckDB SQL of the operators on whole texts whose results SQL can express (6 and 7)."""

#: Operator 6: equal sets become one class, classes are joined on shingles, links are followed from the smallest id.
SHINGLE_COMPONENTS = r"""
    WITH RECURSIVE
    w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    p AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM w),
    g AS (SELECT DISTINCT doc_id, token FROM (
              SELECT doc_id, n, pos, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
                                               lead(word, 4) OVER o) AS token
              FROM p WINDOW o AS (PARTITION BY doc_id ORDER BY pos)) WHERE pos <= greatest(n - 4, 1)),
    s AS (SELECT doc_id, list(token ORDER BY token) AS s, count(*) AS n FROM g GROUP BY doc_id),
    classes AS (SELECT min(doc_id) AS class, s, n FROM s GROUP BY s, n),
    members AS (SELECT s.doc_id, s.n, c.class FROM s JOIN classes c ON c.s = s.s),
    tokens AS (SELECT c.class, c.n, g.token FROM classes c JOIN g ON g.doc_id = c.class),
    links AS (SELECT a.class AS x, b.class AS y FROM tokens a JOIN tokens b ON a.token = b.token AND a.class < b.class
              GROUP BY a.class, b.class, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
    reach AS (SELECT class AS origin, class AS seen FROM classes
              UNION SELECT r.origin, b.y FROM reach r JOIN edges b ON b.x = r.seen),
    smallest AS (SELECT origin AS class, min(seen) AS component_id FROM reach GROUP BY origin)
    SELECT w.doc_id, CAST(coalesce(m.n, 0) AS BIGINT) AS n_shingles, coalesce(l.component_id, w.doc_id) AS component_id
    FROM w LEFT JOIN members m ON m.doc_id = w.doc_id LEFT JOIN smallest l ON l.class = m.class"""

#: Operator 7: every 100-byte string by document and start; those that start earlier elsewhere cover what is removed.
REPEATED_BYTES = r"""
    WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b, octet_length(encode(coalesce(text, ''))) AS n FROM documents),
    starts AS (SELECT doc_id, b, unnest(range(1, n - 98)) AS i FROM t WHERE n >= 100),
    windows AS (SELECT doc_id, i, b[i:i + 99] AS s FROM starts),
    firsts AS (SELECT s, min(struct_pack(d := doc_id, i := i)) AS f FROM windows GROUP BY s HAVING count(*) > 1),
    again AS (SELECT w.doc_id, w.i FROM windows w JOIN firsts USING (s) WHERE w.doc_id <> f.d OR w.i <> f.i),
    marked AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 100 THEN 0 ELSE 1 END AS new
               FROM again),
    numbered AS (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM marked),
    spans AS (SELECT doc_id, span, min(i) AS lo, max(i) + 99 AS hi FROM numbered GROUP BY doc_id, span),
    totals AS (SELECT doc_id, sum(hi - lo + 1) AS n_removed, count(*) AS n_spans FROM spans GROUP BY doc_id),
    cuts AS (SELECT doc_id, lo, coalesce(lag(hi) OVER (PARTITION BY doc_id ORDER BY lo), 0) AS before FROM spans
             UNION ALL SELECT t.doc_id, t.n + 1, coalesce(max(s.hi), 0) FROM t LEFT JOIN spans s ON s.doc_id = t.doc_id
             GROUP BY t.doc_id, t.n),
    kept AS (SELECT c.doc_id, string_agg(hex(t.b[c.before + 1:c.lo - 1]), '' ORDER BY c.lo) AS h
             FROM cuts c JOIN t ON t.doc_id = c.doc_id AND c.lo - 1 > c.before GROUP BY c.doc_id)
    SELECT t.doc_id, CAST(t.n AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
           CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(h, ''))) AS kept_sha256
    FROM t LEFT JOIN totals ON totals.doc_id = t.doc_id LEFT JOIN kept ON kept.doc_id = t.doc_id"""
