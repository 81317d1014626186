"""DuckDB SQL for every query, written from the definitions and not from the plans."""

from __future__ import annotations

from workload.fixtures import BROKEN_SQL, HARD_SQL, LISTED_SIZE, ODD_SQL, WIKI_SQL

ITERATIONS = 8

# Pages, candidate links, existing pages and edges (one row per copy) of the wiki dump.
# rid numbers the records: two may share a doc_id as well as a title.
_WIKI = rf"""
WITH raw AS (SELECT *, row_number() OVER () AS rid FROM (
    {WIKI_SQL.format(text_type="VARCHAR", documents="documents")})),
  parsed AS (SELECT rid, doc_id,
      replace(regexp_extract(xml, '(?s)<title>(.*?)</title>', 1), ' ', '_') AS title,
      regexp_matches(xml, '(?s)<text[^>]*>.*</text>') AS has_body,
      regexp_extract(xml, '(?s)<text[^>]*>(.*?)</text>', 1) AS body FROM raw),
  pg AS MATERIALIZED (SELECT rid, doc_id, title, body FROM parsed WHERE has_body),
  lk AS (SELECT rid, doc_id, title,
      unnest(regexp_extract_all(body, '\[\[([^\]]*)\]', 1)) AS l FROM pg),
  cand AS MATERIALIZED (SELECT DISTINCT rid, doc_id, title AS src,
      split_part(replace(l, ' ', '_'), '|', 1) AS dst FROM lk),
  pair AS (SELECT rid, doc_id, src, dst FROM cand WHERE src <> dst),
  node AS MATERIALIZED (SELECT DISTINCT title FROM pg),
  e AS MATERIALIZED (SELECT src, dst FROM pair WHERE dst IN (SELECT title FROM node)),
  n AS (SELECT count(*)::DOUBLE AS n FROM node)
"""

# The same tables of the part graph.
_PARTS = f"""
WITH node AS MATERIALIZED (
    SELECT 'Part_' || p_partkey AS title FROM part WHERE p_size <= {LISTED_SIZE}),
  pair AS (SELECT DISTINCT 'Part_' || l_partkey AS src, 'Part_' || l_suppkey AS dst
    FROM lineitem WHERE l_partkey <> l_suppkey),
  e AS MATERIALIZED (SELECT src, dst FROM pair
    WHERE src IN (SELECT title FROM node) AND dst IN (SELECT title FROM node)),
  n AS (SELECT count(*)::DOUBLE AS n FROM node)
"""

_INIT = """,
  deg AS (SELECT src, count(*)::DOUBLE AS d FROM e GROUP BY src),
  w AS MATERIALIZED (SELECT e.src, e.dst, d FROM e JOIN deg USING (src)),
  r0 AS (SELECT title, 1.0::DOUBLE / n AS pr FROM node, n)
"""

_STEP = """,
  c{i} AS (SELECT dst, sum(pr / d) AS s FROM w JOIN r{j} ON w.src = r{j}.title GROUP BY dst),
  r{i} AS MATERIALIZED (SELECT node.title, (1.0::DOUBLE - 0.85::DOUBLE) / n
      + 0.85::DOUBLE * coalesce(s, 0) AS pr
    FROM node CROSS JOIN n LEFT JOIN c{i} ON dst = node.title)
"""


def _ranked(base: str, iterations: int = ITERATIONS) -> str:
    steps = "".join(_STEP.format(i=i, j=i - 1) for i in range(1, iterations + 1))
    return base + _INIT + steps


_OUTLINKS = """
SELECT title AS page, count(dst) AS n_out,
  coalesce(string_agg(dst, ' ' ORDER BY dst), '') AS outlinks
FROM node LEFT JOIN e ON src = title GROUP BY title
"""

_INLINKS = """
SELECT title AS page, count(src) AS n_in,
  coalesce(string_agg(src, ' ' ORDER BY src), '') AS inlinks
FROM node LEFT JOIN e ON dst = title GROUP BY title
"""

_EDGES = "SELECT src, dst, count(*) AS copies FROM e GROUP BY src, dst"
_RANKS = "SELECT title AS page, round(pr, 12) AS pr FROM r{i}"
_TOP = "SELECT title AS page, round(pr, 12) AS pr FROM r8, n WHERE pr >= 5.0::DOUBLE / n"
_PLACES = """SELECT page, pr, row_number() OVER (ORDER BY pr DESC, page) AS position FROM ({ranks}) x"""
_MATRIX = f"""
SELECT page, round(pr, 12) AS pr, outlinks FROM r8 JOIN ({_OUTLINKS}) o ON page = title
"""

_BROKEN = f"""
WITH raw AS ({BROKEN_SQL.format(text_type="VARCHAR", documents="documents")}),
  why AS (SELECT doc_id, CASE
    WHEN NOT regexp_matches(xml, '(?s)<title>.*</title>') THEN 'no title'
    WHEN NOT regexp_matches(xml, '(?s)<text[^>]*>') THEN 'no body'
    WHEN NOT regexp_matches(xml, '(?s)<text[^>]*>.*</text>') THEN 'open body' END AS dropped
  FROM raw WHERE xml IS NOT NULL)
"""
_HARD = HARD_SQL.format(text_type="VARCHAR", documents="documents", line="\n")

ORACLE = {
    "html_titles": """
        SELECT page_id,
          replace(regexp_extract(html, '(?s)<title>(.*?)</title>', 1), ' ', '_') AS title
        FROM pages WHERE regexp_matches(html, '(?s)<title>.*</title>')""",
    "html_malformed": """
        SELECT page_id FROM pages
        WHERE NOT (regexp_matches(html, '(?s)<title>.*</title>')
          AND regexp_matches(html, '(?s)<text[^>]*>'))""",
    "wiki_pages": _WIKI + "SELECT doc_id, title, length(body) AS body_chars FROM pg",
    "wiki_link_targets": _WIKI + "SELECT doc_id, src AS title, dst AS link FROM pair",
    "wiki_link_pairs": _WIKI + "SELECT src, dst FROM pair",
    "wiki_merged_links": _WIKI + "SELECT src, dst, count(*) AS copies FROM pair GROUP BY src, dst",
    "wiki_nodes": _WIKI
    + """SELECT title AS page, count(DISTINCT pg.rid) AS records, count(dst) AS links
        FROM pg LEFT JOIN pair ON pair.rid = pg.rid GROUP BY title""",
    "wiki_edges": _WIKI + _EDGES,
    "wiki_red_links": _WIKI
    + """SELECT dst, count(*) AS n FROM pair
        WHERE dst NOT IN (SELECT title FROM node) GROUP BY dst""",
    "wiki_inlinks": _WIKI + _INLINKS,
    "wiki_outlinks": _WIKI + _OUTLINKS,
    "wiki_transpose": _WIKI + "SELECT src, dst FROM e",
    "page_count": _WIKI + "SELECT count(*) AS n, 'N=' || count(*) AS line FROM node",
    "out_degree": _WIKI + "SELECT src, count(*) AS deg FROM e GROUP BY src",
    "in_degree": _WIKI + "SELECT dst, count(*) AS deg FROM e GROUP BY dst",
    "rank_init": _ranked(_WIKI, 0) + _RANKS.format(i=0),
    "contributions": _ranked(_WIKI, 0)
    + """SELECT src, dst, count(*) AS copies, round(sum(pr / d), 12) AS c
        FROM w JOIN r0 ON src = title GROUP BY src, dst""",
    "contribution_sums": _ranked(_WIKI, 1) + "SELECT dst, round(s, 12) AS s FROM c1",
    "rank_iter1": _ranked(_WIKI, 1) + _RANKS.format(i=1),
    "rank_iter8": _ranked(_WIKI) + _RANKS.format(i=8),
    "rank_snapshots": _ranked(_WIKI)
    + """SELECT 1 AS iteration, title AS page, round(pr, 12) AS pr FROM r1
        UNION ALL SELECT 8, title, round(pr, 12) FROM r8""",
    "rank_matrix8": _ranked(_WIKI) + _MATRIX,
    "rank_resumed": _ranked(_WIKI) + _RANKS.format(i=8),
    "rank_resumed_from_matrix": _ranked(_WIKI) + _RANKS.format(i=8),
    "sorted_iter8": _ranked(_WIKI) + _PLACES.format(ranks=_RANKS.format(i=8)),
    "top_ranked": _ranked(_WIKI) + _PLACES.format(ranks=_TOP),
    "parts_edges": _PARTS + _EDGES,
    "parts_rank8": _ranked(_PARTS) + _RANKS.format(i=8),
    "parts_top": _ranked(_PARTS) + _PLACES.format(ranks=_TOP),
    "xml_file_pages": _WIKI + "SELECT title, length(body) AS body_chars FROM pg",
    "xml_file_records": f"""
        SELECT regexp_extract(xml, '(?s)<title>(.*?)</title>', 1) AS title, sha256(xml) AS sha256
        FROM (SELECT first AS xml FROM ({_HARD}) h UNION ALL SELECT second FROM ({_HARD}) h) r
        WHERE xml IS NOT NULL""",
    "wiki_malformed": _BROKEN + "SELECT doc_id, dropped FROM why WHERE dropped IS NOT NULL",
    "wiki_malformed_counts": _BROKEN
    + """SELECT count(*) FILTER (dropped IS NULL) AS pages,
        count(*) FILTER (dropped = 'no title') AS no_title,
        count(*) FILTER (dropped = 'no body') AS no_body,
        count(*) FILTER (dropped = 'open body') AS open_body, 0::BIGINT AS cut FROM why""",
    "odd_titles_round_trip": f"""
        SELECT page, concat(head, '|', page, '|') AS outlinks FROM (
        {ODD_SQL.format(text_type="VARCHAR", documents="documents", char="chr")}) o""",
    "outlink_text_round_trip": _WIKI + _OUTLINKS,
    "inlink_text_round_trip": _WIKI + _INLINKS,
    "matrix_text_round_trip": _ranked(_WIKI) + _MATRIX,
    "ranked_from_files": _ranked(_WIKI) + _TOP,
    "count_from_files": _WIKI + "SELECT count(*) AS pages, count(*) AS published FROM node",
}
