"""DuckDB SQL for the queries that SQL can express."""

LINES = r"""WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
w AS (
  SELECT doc_id, k, line AS a, lead(line) OVER d AS b, lead(line, 2) OVER d AS c, [i, lead(i) OVER d, lead(i, 2) OVER d] AS covered
  FROM r WINDOW d AS (PARTITION BY doc_id ORDER BY k) QUALIFY c IS NOT NULL),
later AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, k) AS n FROM w QUALIFY n > 1),
gone AS (SELECT DISTINCT doc_id, unnest(covered) AS i FROM later),
kept AS (
  SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (gone.i IS NULL), '') AS text,
         count(*) AS n_lines, count(gone.i) AS n_removed
  FROM l LEFT JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT * FROM kept"""

GROUPS = r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b USING (g) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.a, e.b FROM reach r JOIN edges e ON e.a = r.b),
roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, component_id, d.doc_id = component_id AS kept
FROM documents d JOIN roots USING (doc_id) LEFT JOIN n USING (doc_id)"""

# The level is the greatest that any set of the least words per weight, clamped, leaves to the others.
MIX = r"""WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix-1:' || coalesce(doc_id::varchar, '') || ':' || coalesce(md5(text), '')) AS key FROM documents),
s AS (
  SELECT source, sum(size)::bigint AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM d GROUP BY source),
c AS (
  SELECT coalesce(sum(2 * source_size) OVER lower, 0) AS kept,
         sum(weight) OVER () - coalesce(sum(weight) OVER lower, 0) AS free FROM s
  WINDOW lower AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (SELECT max((1.5 * (SELECT sum(source_size) FROM s)::double - kept::double) / free::double) AS level FROM c),
t AS (
  SELECT source, source_size, CASE WHEN 2 * source_size <= weight * level THEN (2 * source_size)::double
                                   ELSE weight * level END AS target FROM s, l),
p AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::bigint ELSE 0 END AS whole FROM t),
r AS (SELECT *, floor(target + 0.5)::bigint - whole * source_size AS rest FROM p),
k AS (
  SELECT source, key, sum(size) AS n, coalesce(sum(sum(size)) OVER (
    PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d GROUP BY source, key)
SELECT d.doc_id, d.size::bigint AS size, r.source_size, r.target,
       (whole * size + CASE WHEN before + n <= rest THEN size WHEN before < rest THEN size * (rest - before) // n
                            ELSE 0 END)::bigint AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source
JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.key = k.key"""
