"""DuckDB SQL for the results that SQL can express, written the plain way: all pairs are compared."""
from __future__ import annotations

from trendloom.llm import licenses, secrets


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(repr(v) for v in r) + ")" for r in rows)


def op1() -> str:
    up, a = licenses.THRESHOLD[1], licenses.THRESHOLD[0]
    words = [(n, label, w) for n, (label, notice) in enumerate(licenses.TEMPLATES)
             for w in sorted(set(notice.split()))]
    base = [(p, label, len(p.split())) for p, label in licenses.BASE_PHRASES]
    step = licenses.STRIDE
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
    '{licenses.UPPER}', '{licenses.LOWER}'), '{licenses.WORD}') AS ws FROM documents),
w AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS i FROM d),
l AS (SELECT r, i, word, lead(word, 1, '') OVER o AS w1, lead(word, 2, '') OVER o AS w2,
    lead(word, 3, '') OVER o AS w3 FROM w WINDOW o AS (PARTITION BY r ORDER BY i)),
p(phrase, label, n) AS (VALUES {_values(base)}),
h AS (SELECT r, i, label FROM l JOIN p ON phrase = CASE n WHEN 3 THEN concat_ws(' ', word, w1, w2)
    ELSE concat_ws(' ', word, w1, w2, w3) END),
b AS (SELECT r, i // {step} AS b, word FROM w
    UNION ALL SELECT r, i // {step} - 1, word FROM w WHERE i >= {step}),
t(n, label, word) AS (VALUES {_values(words)}),
s AS (SELECT n, label, count(*) AS size FROM t GROUP BY ALL),
m AS (SELECT r, b, n, count(DISTINCT b.word) AS shared FROM b JOIN t ON b.word = t.word GROUP BY ALL),
k AS (SELECT r, label, shared / size AS score FROM m JOIN s USING (n) WHERE {up} * shared >= {a} * size),
f AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(score) AS score
    FROM (SELECT * FROM k UNION ALL SELECT r, label, 1.0 FROM h) GROUP BY r),
g AS (SELECT r, count(*) AS n_base, min(i) AS first_word, max(i) AS last_word,
    string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM h GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base,
  CAST(first_word AS BIGINT) AS first_word, CAST(last_word AS BIGINT) AS last_word,
  coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
  CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN f USING (r) LEFT JOIN g USING (r)"""


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def op4() -> str:
    keyword = "|".join(_any_case(k) for k in secrets.KEYWORDS)
    quote = '["\']?'.replace("'", "''")
    value = secrets.VALUE
    assign = f"({keyword}){quote}\\x20*[:=]\\x20*{quote}({value})"
    kinds = [("assign", 0, assign, 2), ("access", 1, secrets.ACCESS, 0),
             ("hex", 2, "[0-9a-f]{16,}", 0), ("blob", 3, "[A-Za-z0-9+/_-]{24,}", 0)]
    placeholder = "(" + "|".join(_any_case(p) for p in (
        "example", "sample", "dummy", "changeme", "placeholder", "x{4}", "0{6}", "123456")) + ")"
    parts = " UNION ALL ".join(
        f"""SELECT r, '{kind}' AS kind, {order} AS ord, {secrets.LEAST[kind]} AS least,
  unnest(list_transform(ms, lambda m, i: list_sum(list_transform(bs[1:i], lambda x: length(x)))
    + list_sum(list_transform(ms[1:i], lambda x: length(x))) - length(m))) AS start,
  unnest(list_transform(ms, lambda m: length(m))) AS n, unnest(vs) AS value
FROM (SELECT r, regexp_extract_all(text, '{p}') AS ms, regexp_extract_all(text, '{p}', {g}) AS vs,
  string_split_regex(text, '{p}') AS bs FROM d)""" for kind, order, p, g in kinds)
    listed = "string_agg(kind || ':' || CAST(start AS BIGINT) || ':' || CAST(start + n AS BIGINT), ',' ORDER BY start, ord)"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
e AS ({parts}),
c AS (SELECT * FROM e WHERE length(value) >= least AND (kind <> 'blob' OR (regexp_matches(value, '[0-9]')
    AND regexp_matches(value, '[a-z]') AND regexp_matches(value, '[A-Z]')))),
o AS (SELECT value, count(DISTINCT coalesce(source, chr(0))) AS owners, count(DISTINCT row(source, doc_id)) AS repositories
    FROM c JOIN d USING (r) GROUP BY value),
j AS (SELECT c.*, owners <= {secrets.FEW_OWNERS} AND repositories <= {secrets.REPOSITORIES_PER_OWNER} * owners AND NOT regexp_matches(value, '{placeholder}') AS live
    FROM c JOIN o USING (value)),
g AS (SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
    count(*) FILTER (kind = 'hex') AS n_hex, {listed} FILTER (kind <> 'blob') AS base, {listed} AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM j WHERE kind <> 'blob' OR live GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans,
  coalesce(n_live, 0) AS n_live, coalesce(n_copied, 0) AS n_copied FROM d LEFT JOIN g USING (r)"""


def op6() -> str:
    return """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS response FROM d WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN response IS NULL OR page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> response THEN response END AS refers_to FROM d LEFT JOIN f USING (payload_digest)"""


def op8() -> str:
    return f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{licenses.UPPER}',
    '{licenses.LOWER}'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT doc_id, unnest(list_distinct(CASE WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')] ELSE
    list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) END)) AS g
  FROM d WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS size FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * shared >= 85 * (na.size + nb.size - shared)),
r AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT r.doc_id, l.b FROM r JOIN l ON l.a = r.reach),
k AS (SELECT doc_id, min(reach) AS component_id FROM r GROUP BY doc_id)
SELECT doc_id, coalesce(size, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM k LEFT JOIN n USING (doc_id)"""


def op11() -> str:
    return """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
    list_inner_product(a.v, b.v)::BIGINT AS score
    FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS rank
    FROM p JOIN s USING (anchor_id)
    WHERE NOT same AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM n WHERE rank <= 5"""


def op12() -> str:
    """The grammar as an automaton, gone through from the last row to the first. A state holds the least
    (cost, audit) of the rest as one text: nine digits, then letters. ``e``, ``o``, ``m``: even, odd, even but not
    none turns to come; ``l``: with the system turn in front."""
    def more(cost: str, letter: str, rest: str) -> str:
        return f"lpad((left({rest}, 9)::INTEGER + {cost})::VARCHAR, 9, '0') || {letter} || substr({rest}, 10)"
    never = "'999999999'"

    def step(kind: str, rest: str) -> str:
        return (f"CASE WHEN gone THEN {never} WHEN kind = '{kind}' THEN {more('late', "'K'", rest)} "
                f"ELSE {more('3 + late', "'R'", rest)} END")
    white = "\\x20\\x09-\\x0D"
    return f"""
WITH RECURSIVE tab AS (SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(
    list_prepend(n::UBIGINT, range(8)::UBIGINT[]), lambda x, y:
    CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::UBIGINT) ELSE x >> 1 END) AS c FROM range(256) r(n))),
k AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_transform(string_split(
    concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' ')), ''), lambda c: ascii(c)::UBIGINT) AS bs
    FROM conversations),
h AS (SELECT conv_id, turn, role, text, xor(list_reduce(list_prepend(4294967295::UBIGINT, bs), lambda s, b:
    xor(s >> 8, t[(xor(s, b) & 255)::INTEGER + 1])), 4294967295::UBIGINT) % 20 AS what FROM k, tab),
d AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role,
    CASE what WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
    FROM h, range(2) c(copy) WHERE what <> 0 AND (copy = 0 OR what = 3)),
i AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
    CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS kind,
    NOT regexp_matches(text, '[^{white}]') AS blank,
    regexp_extract(text, '([^{white}])[{white}]*$', 1) NOT IN ('.', '!', '?') AS cut FROM d),
j AS (SELECT *, NOT blank AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS dup,
    coalesce(lag(kind) OVER (PARTITION BY conv_id ORDER BY i) || kind NOT IN ('su', 'ua', 'au'), false) AS odd FROM i),
f AS (SELECT *, blank OR dup AS gone, cut AND NOT blank AND NOT dup AS truncated,
    CASE WHEN cut THEN 3 ELSE 0 END AS late FROM j),
g AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count_if(blank)::BIGINT AS blank, count_if(dup)::BIGINT AS duplicate,
    count_if(truncated)::BIGINT AS truncated, count_if(odd)::BIGINT AS illegal
    FROM f GROUP BY conv_id),
z(conv_id, i, e, o, m, l) AS (
    SELECT conv_id, n + 1, '000000000', '000000003I', '000000006II', {never} FROM g
    UNION ALL
    SELECT conv_id, i, least(e0, {more('3', "'I'", 'o0')}), o1, least({more('4', "'D'", 'm')}, us, {more('3', "'I'", 'o1')}),
        CASE WHEN kind = 's' AND NOT gone THEN least(l, lpad((4 * (i - 1) + late + left(m, 9)::INTEGER)::VARCHAR, 9, '0')
            || repeat('D', (i - 1)::INTEGER) || 'K' || substr(m, 10)) ELSE l END
    FROM (SELECT *, least(o0, {more('3', "'I'", 'e0')}) AS o1 FROM (
        SELECT *, least({more('4', "'D'", 'e')}, us) AS e0, least({more('4', "'D'", 'o')}, asst) AS o0 FROM (
            SELECT z.conv_id, f.i, kind, gone, late, e, o, m, l, {step('u', 'o')} AS us, {step('a', 'e')} AS asst
            FROM z JOIN f ON f.i = z.i - 1 AND f.conv_id IS NOT DISTINCT FROM z.conv_id)))),
b AS (SELECT conv_id, left(least(e, l), 9)::BIGINT AS cost, substr(least(e, l), 10) AS audit FROM z WHERE i = 1),
x AS (SELECT conv_id, unnest(string_split(audit, '')) AS x, unnest(range(len(audit))) AS p FROM b WHERE audit <> ''),
y AS (SELECT conv_id, x, sum((x <> 'I')::INTEGER) OVER w AS i, sum((x <> 'D')::INTEGER) OVER w AS q FROM x
    WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
v AS (SELECT y.conv_id, x, q, kind, role, text, max((q = 1 AND x = 'K' AND kind = 's')::INTEGER)
    OVER (PARTITION BY y.conv_id) AS led
    FROM y LEFT JOIN f ON f.i = y.i AND x <> 'I' AND f.conv_id IS NOT DISTINCT FROM y.conv_id WHERE x <> 'D'),
r AS (SELECT conv_id, sha256(string_agg(CASE WHEN x = 'K' THEN role WHEN (q - led) % 2 = 1 THEN 'user'
    ELSE 'assistant' END || ':' || CASE WHEN x = 'I' THEN '' ELSE text END, chr(10) ORDER BY q)) AS repaired FROM v
    GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
    coalesce(audit, '') AS audit, coalesce(repaired, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM c.conv_id"""


ORACLE = {"op1_licenses": op1(), "op4_secrets": op4(), "op6_warc": op6(), "op8_minhash_forest": op8(),
          "op11_hard_negatives": op11(), "op12_conversation_repair": op12()}
