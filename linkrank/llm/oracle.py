"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP2 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {WORDS.format(text=LOWER)} AS w FROM documents
), s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3
    THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s
  FROM w
), t AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM t a JOIN t b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM s
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT s.doc_id, CAST(len(any_value(s.s)) AS BIGINT) AS n_shingles, min(r.b) AS component_id
FROM s JOIN reach r ON r.a = s.doc_id GROUP BY s.doc_id
"""

OP3 = """
WITH g AS (
  SELECT coalesce(text, '') AS body, max(doc_id) AS keep_id, count(*) AS group_size
  FROM documents GROUP BY 1
)
SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept,
  sha256(g.body) AS text_sha256
FROM documents d JOIN g ON coalesce(d.text, '') = g.body
"""

OP7 = r"""
WITH l AS (
  SELECT doc_id, text, CASE WHEN text IS NULL THEN [] ELSE string_split(text, chr(10)) END AS lines
  FROM documents
), w AS (
  SELECT doc_id, i, array_to_string(lines[i:i + 2], chr(10)) AS passage
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) - 1)) AS i FROM l)
), again AS (
  SELECT doc_id, i FROM w WHERE regexp_matches(passage, '[^\x20\x09-\x0D]')
  QUALIFY row_number() OVER (PARTITION BY passage ORDER BY doc_id, i) > 1
), gone AS (
  SELECT doc_id, list_distinct(flatten(list([i, i + 1, i + 2]))) AS gone FROM again GROUP BY doc_id
)
SELECT doc_id, CAST(len(lines) AS BIGINT) AS n_lines,
  CAST(coalesce(len(gone), 0) AS BIGINT) AS n_removed,
  sha256(CASE WHEN gone IS NULL THEN coalesce(text, '') ELSE coalesce(array_to_string(
    list_transform(list_filter(range(1, len(lines) + 1), lambda i: NOT list_contains(gone, i)),
      lambda i: lines[i]), chr(10)), '') END) AS kept_sha256
FROM l LEFT JOIN gone USING (doc_id)
"""

# The targets by one pass over the levels at which sources are held back.
OP8 = f"""
WITH d AS (
  SELECT doc_id, source, CAST(len({WORDS.format(text="coalesce(text, '')")}) AS BIGINT) AS size,
    md5(coalesce(text, '')) AS tie,
    -ln((CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13)
      AS BIGINT) + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE) / (1.0::DOUBLE / (1.0::DOUBLE
      + 20.0::DOUBLE * (length(coalesce(text, ''))
        - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')))
      / greatest(length(coalesce(text, '')), 1))) AS key
  FROM documents
), s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, 3 * sum(size) AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM d GROUP BY source
), l AS (
  SELECT *, sum(source_size) OVER () - sum(cap) OVER o + cap AS rest,
    sum(weight) OVER () - sum(weight) OVER o + weight AS weights
  FROM s WINDOW o AS (ORDER BY cap / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), f AS (
  SELECT arg_max(rest, weights) AS rest_all, max(weights) AS weights_all
  FROM l WHERE rest * weight <= cap * weights
), t AS (
  SELECT source, source_size, CASE WHEN rest * weight <= cap * weights
    THEN CAST(rest_all AS DOUBLE) * weight / weights_all ELSE CAST(cap AS DOUBLE) END AS target
  FROM l, f
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT)
    ELSE 0 END AS epochs FROM t
), r AS (
  SELECT d.*, e.source_size, e.target, e.epochs, sum(d.size) OVER (PARTITION BY d.source
    ORDER BY key, doc_id, tie ROWS UNBOUNDED PRECEDING) AS used
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  CAST(size * (epochs + CASE WHEN used - size / 2 < target - epochs * source_size THEN 1 ELSE 0 END)
    AS BIGINT) AS taken
FROM r
"""

ORACLE = {
    "op2_near_duplicates": OP2,
    "op3_exact_duplicates": OP3,
    "op7_repeated_lines": OP7,
    "op8_mix_sources": OP8,
}
