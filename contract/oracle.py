"""DuckDB SQL for every query whose result SQL can express."""
from __future__ import annotations

from contract.views import PRE_SQL, SERIES_SQL, STAR_SQL, WORKS_SQL

_HAS_ABSTRACT = "coalesce(abstract <> '', false)"
_WS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_NOT_BLANK = f"trim(abstract, {_WS}) <> ''"
_EMBEDDABLE = f"(language IS NULL OR language = 'en') AND {_NOT_BLANK}"
_SLICE = "subfield = 1702 AND type IN ('article', 'preprint') AND year BETWEEN 2010 AND 2025"
_COLLAPSED = "trim(regexp_replace(text, '\\s+', ' ', 'g'))"


# Views hide the files behind them, so this one names the folder of the size at which SQL is compared.
_MANIFEST_FILES = """SELECT parse_filename(filename) AS path, size AS bytes, sha256(content) AS sha256
  FROM read_blob('/root/testdata/sf0.01/*.parquet')"""


def _w(body: str, *more: str) -> str:
    return "WITH " + ", ".join([WORKS_SQL, *more]) + body


def _s(body: str, *more: str) -> str:
    return "WITH " + ", ".join([STAR_SQL, *more]) + body


def _p(body: str, *more: str) -> str:
    return "WITH " + ", ".join([WORKS_SQL, PRE_SQL, *more]) + body


def _joined(lst: str) -> str:
    return f"array_to_string(list_transform({lst}, lambda x: coalesce(x, '-')), '|')"


def _flat(abstract: str = "abstract") -> str:
    return f""" SELECT id, doi, arxiv_id, title, {abstract} AS abstract, year AS publication_year,
  publication_date, publication_date LIKE '%-01-01' AS date_is_placeholder, type, language, is_oa,
  cited AS cited_by_count, topic_id, topic_name, round(CAST(topic_score AS DOUBLE), 6) AS topic_score,
  subfield AS primary_subfield_id, CAST(CASE WHEN topic_id IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_topics,
  {_joined('org_ids')} AS institution_ids, {_joined('orgs')} AS institution_names,
  {_joined('countries')} AS institution_countries, author_count, venue FROM w"""


_RESTORED = (f"CASE WHEN abstract IS NULL OR abstract = '   ' THEN NULL"
             f" ELSE {_COLLAPSED.replace('text', 'abstract')} END")

_LINK = "coalesce(doi, 'https://openalex.org/' || id)"
_CATALOGUE = f"""
k AS (SELECT id, substring(coalesce(nullif(title, ''), 'без заголовка'), 1, 160) AS title, year,
  CASE WHEN type = 'preprint' THEN 'препринт' ELSE 'статья' END AS kind,
  coalesce(topic_name, '—') AS topic, cited, {_HAS_ABSTRACT} AS has_abstract, orgs[1] AS org,
  countries[1] AS country, {_LINK} AS link FROM w)"""


def _short(c: str, width: int) -> str:
    text = f"trim(regexp_replace({c}, '\\s+', ' ', 'g'))"
    head = f"regexp_extract(substring({text}, 1, {width - 5}), '^(.*) ', 1)"
    return f"CASE WHEN length({text}) <= {width} THEN {text} ELSE ltrim({head} || ' [...]') END"


_SERIES = f"""
y AS (SELECT year, count(*) AS corpus_all, count(*) FILTER (type IN ('article', 'preprint')) AS corpus_articles,
  count(*) FILTER ({_SLICE}) AS slice_all,
  count(*) FILTER ({_SLICE} AND {_HAS_ABSTRACT}) AS slice_with_abstract FROM w GROUP BY year),
ys AS (SELECT series, year, CAST(n AS BIGINT) AS n FROM (
  SELECT 'corpus_all' AS series, year, corpus_all AS n FROM y
  UNION ALL SELECT 'corpus_articles', year, corpus_articles FROM y
  UNION ALL SELECT 'slice_all', year, slice_all FROM y
  UNION ALL SELECT 'slice_with_abstract', year, slice_with_abstract FROM y) WHERE n > 0)"""
_EMB_YEAR = f"""SELECT year, count(*) FILTER ((language IS NULL OR language = 'en') AND {_HAS_ABSTRACT}) AS n
  FROM w GROUP BY year"""

# Topic by year on the dense grid, with shares of the corpus of the same year.
_GRID = """
b AS (SELECT year, count(*) AS base FROM s GROUP BY year),
yr AS (SELECT year, base, row_number() OVER (ORDER BY year) - 1 AS i, count(*) OVER () AS n FROM b),
t AS (SELECT topic_id, min(topic_name) AS name, count(*) AS total, min(year) AS first_year FROM s GROUP BY topic_id),
c AS (SELECT topic_id, year, count(*) AS works FROM s GROUP BY topic_id, year),
g AS (SELECT t.topic_id, t.name, t.total, t.first_year, yr.year, yr.i, yr.n, yr.base,
  coalesce(c.works, 0) AS works, coalesce(c.works, 0) / CAST(yr.base AS DOUBLE) * 10000 AS share
  FROM t CROSS JOIN yr LEFT JOIN c ON c.topic_id = t.topic_id AND c.year = yr.year)"""
_METRICS = _GRID + """,
m1 AS (SELECT topic_id, name, total, first_year,
  coalesce(sum(share) FILTER (i < n // 2), 0) AS early, coalesce(sum(share) FILTER (i >= n // 2), 0) AS late,
  coalesce(sum(share) FILTER (i < greatest(1, n // 3)), 0) AS p1,
  coalesce(sum(share) FILTER (i >= greatest(1, n // 3) AND i < 2 * greatest(1, n // 3)), 0) AS p2,
  coalesce(sum(share) FILTER (i >= 2 * greatest(1, n // 3)), 0) AS p3,
  string_agg(CAST(works AS VARCHAR), ',' ORDER BY year) AS series
  FROM g WHERE total >= 40 GROUP BY topic_id, name, total, first_year),
m AS (SELECT topic_id, name, total, first_year, series,
  late / CASE WHEN early = 0 THEN 0.01 ELSE early END AS growth,
  (p3 / CASE WHEN p2 = 0 THEN 0.01 ELSE p2 END)
    / (CASE WHEN p2 = 0 THEN 0.01 ELSE p2 END / CASE WHEN p1 = 0 THEN 0.01 ELSE p1 END) AS acceleration FROM m1)"""
_NAMES = """
nm AS (SELECT topic_id, 'org' AS kind, org AS value, count(*) AS n FROM s GROUP BY topic_id, org
  UNION ALL SELECT topic_id, 'country', country, count(*) FROM s GROUP BY topic_id, country),
nr AS (SELECT *, CAST(row_number() OVER (PARTITION BY topic_id, kind ORDER BY n DESC, value) AS INTEGER) AS rank
  FROM nm QUALIFY rank <= 5)"""
_BEST = """
br AS (SELECT topic_id, id, title, year, venue, cited AS cited_by,
  CAST(row_number() OVER (PARTITION BY topic_id ORDER BY cited DESC, id) AS INTEGER) AS rank
  FROM s QUALIFY rank <= 6)"""
_RANKED = """
r AS (SELECT *, CAST(row_number() OVER (ORDER BY growth DESC, topic_id) AS INTEGER) AS rank FROM m
  QUALIFY rank <= 15)"""

_COUNTRIES = """
cc AS (SELECT country, count(*) AS n FROM (SELECT id, unnest(countries) AS country FROM w)
  GROUP BY id, country),
ct AS (SELECT country, count(*) AS n FROM cc GROUP BY country)"""

_RAW_GROWTH = """
ty AS (SELECT topic_id, min(topic_name) AS name, count(*) AS works FROM w WHERE topic_id IS NOT NULL GROUP BY topic_id),
tn AS (SELECT topic_id, year, count(*) AS n FROM w WHERE topic_id IS NOT NULL GROUP BY topic_id, year),
yy AS (SELECT year, row_number() OVER (ORDER BY year) - 1 AS i, count(*) OVER () AS n FROM
  (SELECT DISTINCT year FROM w)),
tg AS (SELECT ty.topic_id, ty.name, ty.works,
  coalesce(sum(tn.n) FILTER (yy.i < yy.n // 2), 0) AS early,
  coalesce(sum(tn.n) FILTER (yy.i >= yy.n // 2), 0) AS late,
  string_agg(CAST(coalesce(tn.n, 0) AS VARCHAR), ',' ORDER BY yy.year) AS series
  FROM ty CROSS JOIN yy LEFT JOIN tn ON tn.topic_id = ty.topic_id AND tn.year = yy.year
  WHERE ty.works >= 20 GROUP BY ty.topic_id, ty.name, ty.works),
tr AS (SELECT topic_id, name, works, late / CAST(greatest(early, 1) AS DOUBLE) AS growth, series FROM tg
  ORDER BY growth DESC, topic_id LIMIT 40)"""

_LETTER_VECTOR = f"""
x AS (SELECT id, lower(trim(coalesce(title, ''), {_WS}) || '[SEP]' || trim(abstract, {_WS})) AS t
  FROM w WHERE {_EMBEDDABLE}),
l AS (SELECT id, list_transform(range(97, 123), lambda c: CAST(length(t) - length(replace(t, chr(CAST(c AS INTEGER)), ''))
  AS DOUBLE)) AS v FROM x),
q AS (SELECT id, v, sqrt(list_sum(list_transform(v, lambda e: e * e))) AS norm FROM l)"""
_LETTERS = _w(""" SELECT id, CAST(generate_subscripts(v, 1) - 1 AS INTEGER) AS at,
  round(CAST(CAST(unnest(v) / CASE WHEN norm > 0 THEN norm ELSE 1 END AS FLOAT) AS DOUBLE), 6) AS v FROM q""",
              _LETTER_VECTOR)

_QUOTA = """
z AS (SELECT year, count(*) AS size FROM w GROUP BY year),
qt AS (SELECT year, least(size, CAST(round_even(300.0 * size / (SELECT sum(size) FROM z), 0) AS BIGINT)) AS drawn FROM z)"""

_MANIFEST = ", ".join(f"('{name}.parquet')" for name in (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations", "gone"))
_MANIFEST_CHECK = f"""SELECT path, CASE path WHEN 'gone.parquet' THEN 'missing' WHEN 'labels.parquet' THEN 'extra'
  WHEN 'pages.parquet' THEN 'changed' ELSE 'ok' END AS status FROM (VALUES {_MANIFEST}) v(path)"""

_STEP = "greatest(1, (SELECT count(*) FROM w) // {0})"

_LOST = "CASE WHEN doc_id % 11 = 3 THEN NULL WHEN doc_id % 13 = 5 THEN '' ELSE id END"

_DIFFUSION = _s(""" SELECT topic_id, count(DISTINCT org) AS organizations,
  count(DISTINCT country) AS countries FROM s GROUP BY topic_id""")

ORACLE: dict[str, str] = {
    "scan_works": _w(_flat()),
    "scan_pruned": _w(" SELECT id, language, year AS publication_year FROM w"),
    "scan_year": _w(" SELECT id, title FROM w WHERE year = 2015"),
    "preprints_dedup": _p(""" SELECT id, created, title, text AS abstract, 'cs.LG cs.' || upper(lang) AS categories,
  doi, 'Ann ' || source || '|Bo ' || lang AS authors, 2 AS author_count FROM p"""),
    "raw_works_scan": _w(f""" SELECT 'https://t.org/' || id AS id, publication_date, cited AS cited_by_count,
  author_count AS n_authors, CASE WHEN {_HAS_ABSTRACT} AND abstract <> '   ' THEN CAST(len(list_distinct(
  string_split(trim(regexp_replace(abstract, '\\s+', ' ', 'g')), ' '))) AS INTEGER) ELSE -1 END AS n_words FROM w"""),
    "oai_parse": _p(f""" SELECT id, created, CAST(NULL AS VARCHAR) AS updated, title,
  {_COLLAPSED} AS abstract, 'cs.LG cs.' || upper(lang) AS categories, 'cs.LG' AS primary_category,
  CAST(NULL AS VARCHAR) AS doi, 'Ann ' || source || '|' || lang AS authors, 2 AS author_count
  FROM p WHERE doc_id % 10 <> 9"""),
    "ingest_resume": _w(_flat(_RESTORED)),
    "ingest_progress": _w(""" SELECT e.year, count(*) AS rows, e.expected,
  abs(count(*) - e.expected) / CAST(e.expected AS DOUBLE) <= 0.02 AS closed
  FROM e JOIN w ON w.year = e.year GROUP BY e.year, e.expected""", SERIES_SQL),
    "probe_limit": "SELECT least(100, count(*)) AS n FROM documents",
    "series_long": _w(" SELECT series, year, n FROM ys", _SERIES),
    "series_refresh": _w(f""" SELECT series, year, n FROM ys
  UNION ALL SELECT 'slice_embeddable', year, n FROM ({_EMB_YEAR})""", _SERIES),
    "series_incremental": _w(f""" SELECT series, year, n FROM ys
  UNION ALL SELECT 'slice_embeddable', year, n FROM ({_EMB_YEAR})""", _SERIES),
    "manifest_files": _MANIFEST_FILES,
    "manifest_streamed": _MANIFEST_FILES,
    "manifest_check": _MANIFEST_CHECK,
    "manifest_saved": _MANIFEST_CHECK,
    "ground_truth_rules": _s(""", t AS (SELECT topic_name AS name, min(year) AS year, count(*) AS n FROM s GROUP BY 1),
v AS (SELECT count(*) FILTER (NOT coalesce(name <> '', false)) AS a, count(*) FILTER (NOT coalesce(year > 1900 AND year < 1996, false)) AS b,
  count(*) FILTER (n % 2 = 1) AS c, CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS d, CASE WHEN max(year) >= 1992 THEN 0 ELSE 1 END AS e FROM t)
  SELECT rule, CAST(violations AS BIGINT) AS violations FROM (SELECT 'name_not_empty' AS rule, a AS violations FROM v
  UNION ALL SELECT 'year_in_range', b FROM v UNION ALL SELECT 'note_not_empty', c FROM v UNION ALL SELECT 'not_empty', d FROM v
  UNION ALL SELECT 'year_reaches_1992', e FROM v)"""),
    "sink_preprints": """SELECT 'cs' AS "set", count(*) AS n, count(DISTINCT doc_id) AS ids FROM documents WHERE doc_id % 3 <> 0
  UNION ALL SELECT 'stat', count(*), count(DISTINCT doc_id) FROM documents WHERE doc_id % 3 <> 1""",
    "sample_sink": _w(f""" SELECT id, title FROM (SELECT id, title, row_number() OVER (ORDER BY id) - 1 AS i FROM w)
  WHERE i % {_STEP.format(60)} = 0 AND i < 60 * {_STEP.format(60)}"""),
    "works_source": _w(f""" SELECT 'full slice' AS source, count(*) AS n FROM w
  UNION ALL SELECT 'year 2015', count(*) FILTER (year = 2015) FROM w UNION ALL SELECT 'sample', count(*) FROM (
  SELECT row_number() OVER (ORDER BY id) - 1 AS i FROM w) WHERE i % {_STEP.format(60)} = 0 AND i < 60 * {_STEP.format(60)}"""),
    "schema_conformity": _p(""" SELECT name, name IN ('works', 'preprints') AS conforms, CASE name WHEN 'preprints'
  THEN (SELECT count(*) FROM p) ELSE (SELECT count(*) FROM w) END AS n FROM (VALUES ('works'), ('preprints'), ('works_without_doi'),
  ('works_as_preprints'), ('wider_counts')) v(name)"""),
    "trend_published": _s(""", z AS (SELECT topic_id, string_agg(printf('%.1f', share), ',' ORDER BY year) AS shares FROM g GROUP BY topic_id)
  SELECT topic_id, CAST(printf('%.2f', growth) AS DOUBLE) AS normalized_growth, CAST(printf('%.2f', acceleration) AS DOUBLE) AS acceleration,
  CAST(printf('%.3f', least(growth / 3, 1)) AS DOUBLE) AS score, shares FROM m JOIN z USING (topic_id)""",
        _METRICS.replace("coalesce(c.works, 0) / CAST(yr.base AS DOUBLE) * 10000 AS share",
                         "CAST(printf('%.1f', coalesce(c.works, 0) / CAST(yr.base AS DOUBLE) * 10000) AS DOUBLE) AS share")),
    "manifest_years": _w(""" SELECT e.year, count(*) AS rows, e.expected,
  round_even(abs(count(*) - e.expected) / CAST(e.expected AS DOUBLE), 4) AS gap, true AS has_files, true AS has_bytes
  FROM e JOIN w ON w.year = e.year GROUP BY e.year, e.expected""", SERIES_SQL),
    "rows_per_file": " UNION ALL ".join(
        f"SELECT '{n}.parquet' AS path, count(*) AS rows FROM {n}"
        for n in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                  "documents", "embeddings", "pages", "benchmark", "labels", "conversations")),
    "sink_roundtrip": _w(_flat()),
    "shape_rules": _w(""", v AS (SELECT count(*) FILTER (NOT coalesce(title <> '', false)) AS a,
  count(*) FILTER (NOT (year > 2000 AND year < 2022)) AS b,
  count(*) FILTER (NOT coalesce(abstract <> '', false)) AS c,
  CASE WHEN count(*) > 0 THEN 0 ELSE 1 END AS d, CASE WHEN bool_or(type = 'preprint') THEN 0 ELSE 1 END AS e,
  CASE WHEN bool_or(type = 'patent') THEN 0 ELSE 1 END AS f, CASE WHEN max(year) >= 2025 THEN 0 ELSE 1 END AS g FROM w)
  SELECT rule, CAST(violations AS BIGINT) AS violations FROM (
  SELECT 'name_not_empty' AS rule, a AS violations FROM v UNION ALL SELECT 'year_in_range', b FROM v
  UNION ALL SELECT 'note_not_empty', c FROM v UNION ALL SELECT 'not_empty', d FROM v
  UNION ALL SELECT 'type_has_preprint', e FROM v UNION ALL SELECT 'type_has_patent', f FROM v
  UNION ALL SELECT 'year_reaches_2025', g FROM v)"""),
    "restore_text": _w(f" SELECT 'https://t.org/' || id AS id, {_RESTORED} AS abstract FROM w"),
    "normalize_works": _w(_flat(_RESTORED)),
    "link_id_extract": _w(" SELECT id, arxiv_id FROM w"),
    "institutions_dedup": _w(f""" SELECT id, {_joined('org_ids')} AS institution_ids,
  {_joined('orgs')} AS institution_names, {_joined('countries')} AS institution_countries FROM w"""),
    "date_placeholder": _w(" SELECT id, publication_date LIKE '%-01-01' AS placeholder FROM w"),
    "embed_text": _w(f""" SELECT id, trim(coalesce(title, ''), {_WS}) || '[SEP]' || trim(abstract, {_WS}) AS text
  FROM w WHERE {_EMBEDDABLE}"""),
    "catalog_rows": _w(" SELECT * FROM k", _CATALOGUE),
    "work_snippet": _w(f""" SELECT id, {_short("coalesce(nullif(title, ''), 'без заголовка')", 88)} AS title,
  publication_date, type, coalesce(language, '?') AS language, cited AS cited_by_count, topic_name AS topic,
  round(CAST(topic_score AS DOUBLE), 6) AS score, array_to_string(orgs, ', ') AS orgs,
  CASE WHEN countries[1] IS NULL THEN '' WHEN len(countries) = 1 OR countries[1] = countries[2]
    THEN countries[1] ELSE countries[1] || ', ' || countries[2] END AS countries,
  coalesce({_short('abstract', 200)}, 'аннотации нет') AS abstract, {_LINK} AS link, arxiv_id FROM w"""),
    "preprint_snippet": _p(f""" SELECT id, title, created, 2 AS author_count, 'cs.LG cs.' || upper(lang) AS categories,
  {_short('text', 200)} AS abstract, 'https://arxiv.org/abs/' || id AS link FROM p"""),
    "slice_filter": _w(f" SELECT id, type, year, subfield AS primary_subfield_id FROM w WHERE {_SLICE}"),
    "slice_filter_year": _w(f" SELECT id, type FROM w WHERE {_SLICE} AND year = 2014"),
    "embeddable": _w(f" SELECT id, title, trim(abstract, {_WS}) AS abstract FROM w WHERE {_EMBEDDABLE}"),
    "search_title": _w(""", f AS (SELECT id, title FROM w WHERE contains(lower(title), 'the'))
  SELECT id, title, (SELECT count(*) FROM f) AS total FROM f ORDER BY id LIMIT 10"""),
    "search_topic": _w(" SELECT id, topic_name AS name FROM w WHERE contains(lower(topic_name), 'src1')"),
    "search_category": _p(" SELECT id FROM p WHERE contains(lower('cs.LG cs.' || upper(lang)), 'lg cs.f')"),
    "facet_search": _w(""" SELECT id, title, year FROM k WHERE contains(lower(title), 'e')
  AND kind = 'статья' AND country = 'C1' AND year >= 2013 AND has_abstract""", _CATALOGUE),
    "facet_page": _w(""" SELECT id, title FROM k ORDER BY id LIMIT 40
  OFFSET (SELECT CAST(40 * least(3, greatest(1, ceil(count(*) / 40.0)) - 1) AS BIGINT) FROM k)""", _CATALOGUE),
    "facet_all_pages": _w(""" SELECT id, year, CAST((row_number() OVER (ORDER BY year, id) - 1) // 300 AS INTEGER) AS page
  FROM k""", _CATALOGUE),
    "facet_index": _w(""", o AS (SELECT id, year, (row_number() OVER (ORDER BY year, id) - 1) // 40 AS p FROM k),
  q AS (SELECT 'first' AS page, CAST(0 AS BIGINT) AS p UNION ALL SELECT 'last', max(p) FROM o
  UNION ALL SELECT 'opened', least((SELECT max(p) FROM o), count(*) FILTER (year < 2018) // 40) FROM k)
  SELECT id, year, page FROM o JOIN q USING (p)""", _CATALOGUE),
    "facet_last_page": _w(""" SELECT id, title FROM k ORDER BY id LIMIT 40
  OFFSET (SELECT CAST(40 * (greatest(1, ceil(count(*) / 40.0)) - 1) AS BIGINT) FROM k)""", _CATALOGUE),
    "facet_values": _w(""" SELECT DISTINCT 'topic' AS facet, topic AS value FROM k
  UNION ALL SELECT DISTINCT 'country', country FROM k WHERE country IS NOT NULL""", _CATALOGUE),
    "works_by_year": _w(" SELECT series, year, n FROM ys", _SERIES),
    "embeddable_by_year": _w(" " + _EMB_YEAR),
    "filter_funnel": _w(f""", f AS (SELECT count(*) FILTER (subfield = 1702) AS a, count(*) FILTER ({_SLICE}) AS b,
  count(*) FILTER ({_SLICE} AND {_HAS_ABSTRACT}) AS c FROM w)
  SELECT 1 AS step, 'subfield, all years' AS label, a AS n FROM f
  UNION ALL SELECT 2, 'years and types', b FROM f UNION ALL SELECT 3, 'with abstract', c FROM f"""),
    "count_filtered": _w(f" SELECT count(*) AS n FROM w WHERE {_SLICE} AND {_HAS_ABSTRACT}"),
    "completeness": _w(f""", f AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(*) FILTER ({_HAS_ABSTRACT}) AS a,
  count(doi) AS b, count(arxiv_id) AS c, count(*) FILTER (publication_date LIKE '%-01-01') AS d,
  count(*) FILTER (type = 'preprint') AS e, count(*) FILTER (len(org_ids) > 0) AS o,
  count(*) FILTER (coalesce(topic_score, 0) < 0.5) AS h FROM w)
  SELECT 'has_abstract' AS field, round(a / n, 6) AS share FROM f UNION ALL SELECT 'has_doi', round(b / n, 6) FROM f
  UNION ALL SELECT 'has_arxiv_id', round(c / n, 6) FROM f UNION ALL SELECT 'placeholder_date', round(d / n, 6) FROM f
  UNION ALL SELECT 'is_preprint', round(e / n, 6) FROM f UNION ALL SELECT 'has_orgs', round(o / n, 6) FROM f
  UNION ALL SELECT 'weak_topic', round(h / n, 6) FROM f"""),
    "top_languages": _w(""" SELECT language, count(*) AS n FROM w GROUP BY language
  ORDER BY n DESC, language NULLS LAST LIMIT 4"""),
    "works_by_type": _w(" SELECT type, count(*) AS n FROM w GROUP BY type"),
    "abstract_share": _w(f""" SELECT year, count(*) AS works, count(*) FILTER ({_HAS_ABSTRACT}) AS with_abstract,
  round(count(*) FILTER ({_HAS_ABSTRACT}) / CAST(count(*) AS DOUBLE) * 100, 6) AS share_pct FROM w GROUP BY year"""),
    "country_top": _w(" SELECT country, n FROM ct ORDER BY n DESC, country NULLS LAST LIMIT 20", _COUNTRIES),
    "country_mentions": _w(""" SELECT country, count(*) AS n FROM (SELECT unnest(countries) AS country FROM w)
  WHERE country <> '' GROUP BY country"""),
    "preprints_by_year": _p(""" SELECT a.year, a.works, coalesce(b.n, 0) AS preprints FROM
  (SELECT year, count(*) AS works FROM w GROUP BY year) a LEFT JOIN
  (SELECT CAST(substring(created, 1, 4) AS INTEGER) AS year, count(*) AS n FROM p GROUP BY 1) b USING (year)"""),
    "corpus_totals": _p(f""" SELECT 'works' AS total, CAST(count(*) AS DOUBLE) AS value FROM w
  UNION ALL SELECT 'with_abstract', count(*) FILTER ({_HAS_ABSTRACT}) FROM w
  UNION ALL SELECT 'preprints', count(*) FROM p UNION ALL SELECT 'countries', count(*) FROM ct
  UNION ALL SELECT 'topics', count(DISTINCT topic_id) FROM w
  UNION ALL SELECT 'shown_pct', round(100 / CAST(count(*) AS DOUBLE) * 100, 6) FROM w""", _COUNTRIES),
    "table_summary": _p(""" SELECT 'works' AS tbl, count(*) AS n, min(year) AS year_min, max(year) AS year_max,
  round(count(abstract) / CAST(count(*) AS DOUBLE), 6) AS share_abstract,
  round(count(doi) / CAST(count(*) AS DOUBLE), 6) AS share_doi,
  round(count(arxiv_id) / CAST(count(*) AS DOUBLE), 6) AS share_arxiv_id,
  (SELECT string_agg(type || ': ' || n, ', ' ORDER BY n DESC, type) FROM (SELECT type, count(*) AS n FROM w
    GROUP BY type ORDER BY n DESC, type LIMIT 5)) AS types FROM w
  UNION ALL SELECT 'preprints', count(*), min(CAST(substring(created, 1, 4) AS INTEGER)),
  max(CAST(substring(created, 1, 4) AS INTEGER)), round(count(text) / CAST(count(*) AS DOUBLE), 6),
  round(count(doi) / CAST(count(*) AS DOUBLE), 6), NULL, NULL FROM p"""),
    "dup_counts": _w(f""" SELECT 'id' AS key, count(*) - count(DISTINCT coalesce({_LOST}, chr(1))) AS duplicates FROM w
  UNION ALL SELECT 'doi', count(doi) - count(DISTINCT doi) FROM w"""),
    "coverage_gap": _w(""" SELECT e.year, count(*) AS actual, e.expected,
  round(abs(count(*) - e.expected) / CAST(e.expected AS DOUBLE), 8) AS gap
  FROM e JOIN w ON w.year = e.year GROUP BY e.year, e.expected""", SERIES_SQL),
    "gap_years": _w(""" SELECT e.year FROM e JOIN w ON w.year = e.year GROUP BY e.year, e.expected
  HAVING abs(count(*) - e.expected) / CAST(e.expected AS DOUBLE) > 0.005""", SERIES_SQL),
    "preprint_link": _p(""" SELECT count(DISTINCT p.id) AS matched, count(DISTINCT arxiv_id) AS total
  FROM w LEFT JOIN p ON p.id = w.arxiv_id"""),
    "linked_preprints": _p(" SELECT DISTINCT arxiv_id AS id FROM w JOIN p ON p.id = w.arxiv_id"),
    "acceptance": _p(f""", a AS (SELECT CAST(count(*) AS DOUBLE) AS n, count(abstract) AS ab,
  count(*) - count(DISTINCT coalesce({_LOST}, chr(1))) AS di, count(doi) - count(DISTINCT doi) AS dd FROM w),
  h AS (SELECT max(gap) AS worst FROM (SELECT abs(count(*) - e.expected) / CAST(e.expected AS DOUBLE) AS gap
    FROM e JOIN w ON w.year = e.year GROUP BY e.year, e.expected)),
  l AS (SELECT count(DISTINCT p.id) AS matched, count(DISTINCT arxiv_id) AS total FROM w LEFT JOIN p ON p.id = w.arxiv_id)
  SELECT CAST(no AS INTEGER) AS no, "check", ok, round(CAST(value AS DOUBLE), 6) AS value FROM (
  SELECT 1 AS no, 'works' AS "check", n >= 500 AS ok, n AS value FROM a
  UNION ALL SELECT 2, 'abstract_share', ab / n >= 0.7, ab / n FROM a
  UNION ALL SELECT 3, 'undated', true, 0 UNION ALL SELECT 4, 'duplicate_ids', di = 0, di FROM a
  UNION ALL SELECT 5, 'shared_dois', true, dd FROM a UNION ALL SELECT 6, 'worst_gap', worst <= 0.02, worst FROM h
  UNION ALL SELECT 7, 'undated_preprints', true, 0 UNION ALL SELECT 8, 'duplicate_preprints', true, 0
  UNION ALL SELECT 9, 'preprints_in_range', true, count(*) FROM p
  UNION ALL SELECT 10, 'linked_preprints', true, matched FROM l
  UNION ALL SELECT 11, 'named_preprints', true, total FROM l
  UNION ALL SELECT 12, 'manifest_problems', false, count(*) FILTER (status <> 'ok') FROM ({_MANIFEST_CHECK})
  UNION ALL SELECT 13, 'sample', true, least(100, count(*)) FROM w)""", SERIES_SQL),
    "topic_year_series": _s(" SELECT topic_id, year, works FROM g", _GRID),
    "topic_share": _s(" SELECT topic_id, year, base, round(share, 6) AS per_10k FROM g", _GRID),
    "trend_growth": _s(""" SELECT topic_id, round(growth, 6) AS normalized_growth,
  round(least(growth / 3, 1), 6) AS score FROM m""", _METRICS),
    "trend_acceleration": _s(" SELECT topic_id, round(acceleration, 6) AS acceleration FROM m", _METRICS),
    "topic_orgs": _s(" SELECT topic_id, kind, value, n, rank FROM nr", _NAMES),
    "topic_diffusion": _DIFFUSION,
    "topic_diffusion_sketch": _DIFFUSION,
    "topic_best_works": _s(" SELECT topic_id, id, title, year, venue, cited_by, rank FROM br", _BEST),
    "topic_growth": _w(" SELECT topic_id, name, works, round(growth, 6) AS growth, series FROM tr", _RAW_GROWTH),
    "trend_cards": _s(""" SELECT r.rank, replace(r.topic_id, 'T/', '') AS id, name AS title, total AS works_total,
  first_year, round(growth, 6) AS normalized_growth, round(acceleration, 6) AS acceleration,
  d.organizations, d.countries, round(least(growth / 3, 1), 6) AS score, o.names AS top_organizations,
  k.names AS top_countries, b.title AS case_title, b.cited_by AS case_cited, x.titles AS sources, r.series
  FROM r JOIN (SELECT topic_id, count(DISTINCT org) AS organizations, count(DISTINCT country) AS countries
    FROM s GROUP BY topic_id) d USING (topic_id)
  JOIN (SELECT topic_id, string_agg(value, '|' ORDER BY rank) AS names FROM nr WHERE kind = 'org' GROUP BY 1) o USING (topic_id)
  JOIN (SELECT topic_id, string_agg(value, '|' ORDER BY rank) AS names FROM nr WHERE kind = 'country' GROUP BY 1) k USING (topic_id)
  JOIN (SELECT topic_id, title, cited_by FROM br WHERE rank = 1) b USING (topic_id)
  JOIN (SELECT topic_id, string_agg(title, '|' ORDER BY rank) AS titles FROM br WHERE rank > 1 GROUP BY 1) x USING (topic_id)""",
                      _METRICS, _NAMES, _BEST, _RANKED),
    "sample_systematic": _w(f""" SELECT id, title FROM (SELECT id, title, row_number() OVER (ORDER BY id) - 1 AS i FROM w)
  WHERE i % {_STEP.format(60)} = 0 AND i < 60 * {_STEP.format(60)}"""),
    "sample_stratified": _w(""" SELECT id, year FROM (SELECT w.id, w.year, qt.drawn, row_number() OVER (
  PARTITION BY w.year ORDER BY md5(w.id || '|' || w.year || '|11'), w.id) AS i FROM w JOIN qt USING (year))
  WHERE i <= drawn""", _QUOTA),
    "sample_stratified_sizes": _w(" SELECT year, drawn FROM qt WHERE drawn > 0", _QUOTA),
    "sample_uniform": _w(" SELECT id FROM w ORDER BY md5(id || '|42'), id LIMIT 200"),
    "sample_uniform_size": "SELECT least(200, count(*)) AS n, least(200, count(*)) AS ids FROM documents",
    "embed_chunks": _w(f""" SELECT id, row_index, CAST(row_index // 50 AS INTEGER) AS chunk FROM (
  SELECT id, row_number() OVER (ORDER BY id) - 1 AS row_index FROM w WHERE {_EMBEDDABLE})"""),
    "embed": _LETTERS,
    "embed_resume": _LETTERS,
    "embed_store": _LETTERS,
    "l2_normalize": """WITH n AS (SELECT vec_id AS id, list_transform(embedding, lambda x: CAST(x * CAST(vec_id % 5 + 1 AS FLOAT) AS FLOAT)) AS e
  FROM embeddings), q AS (SELECT id, e, sqrt(list_sum(list_transform(e, lambda x: CAST(x AS DOUBLE) * CAST(x AS DOUBLE)))) AS norm FROM n)
  SELECT id, CAST(generate_subscripts(e, 1) - 1 AS INTEGER) AS at,
  round(CAST(CAST(CAST(unnest(e) AS DOUBLE) / norm AS FLOAT) AS DOUBLE), 6) AS v FROM q""",
    "embedding_check": """SELECT count(*) AS rows, count(*) FILTER (len(embedding) <> 64) AS wrong_dim,
  CAST(0 AS BIGINT) AS not_unit, count(*) - count(DISTINCT vec_id) AS duplicate_ids FROM embeddings""",
    "catalog_doc": _p(f""", a AS (SELECT year, count(*) AS n, count(*) FILTER ({_HAS_ABSTRACT}) AS ab FROM w GROUP BY year),
  b AS (SELECT CAST(substring(created, 1, 4) AS INTEGER) AS year, count(*) AS pn FROM p GROUP BY 1)
  SELECT 'ai-2010-2025' AS slice_id, string_agg(CAST(year AS VARCHAR), ',' ORDER BY year) AS years,
  string_agg(CAST(n AS VARCHAR), ',' ORDER BY year) AS by_year,
  string_agg(CAST(ab AS VARCHAR), ',' ORDER BY year) AS abstract_by_year,
  string_agg(CAST(coalesce(pn, 0) AS VARCHAR), ',' ORDER BY year) AS preprints_by_year,
  (SELECT count(*) FROM w) AS n_works, (SELECT count(*) FROM p) AS preprints,
  (SELECT count(*) FILTER ({_HAS_ABSTRACT}) FROM w) AS with_abstract, (SELECT count(*) FROM ct) AS countries,
  (SELECT count(DISTINCT topic_id) FROM w) AS n_topics,
  (SELECT string_agg(type || '=' || n, ',' ORDER BY n DESC, type) FROM (SELECT type, count(*) AS n FROM w GROUP BY type)) AS by_type,
  (SELECT string_agg(coalesce(country, 'null') || '=' || n, ',' ORDER BY n DESC, coalesce(country, 'null')) FROM
    (SELECT country, n FROM ct ORDER BY n DESC, country NULLS LAST LIMIT 20)) AS by_country,
  (SELECT coalesce(string_agg(topic_id, ',' ORDER BY growth DESC, topic_id), '') FROM tr) AS topic_ids,
  (SELECT string_agg({_LINK}, ',' ORDER BY id) FROM (
    SELECT *, row_number() OVER (ORDER BY id) - 1 AS i FROM w)
    WHERE i % {_STEP.format(60)} = 0 AND i < 60 * {_STEP.format(60)}) AS links
  FROM a LEFT JOIN b USING (year)""", _COUNTRIES, _RAW_GROWTH),
    "index_doc": _s(""" SELECT 'v1' AS index_version, 'ai-2010-2025' AS slice_id,
  (SELECT min(year) || '-' || max(year) FROM s) AS span,
  string_agg(rank || '=' || name, ',' ORDER BY rank) AS ranking, 2 AS controls FROM r""", _METRICS, _RANKED),
}
