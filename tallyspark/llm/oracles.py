"""SQL for the queries of this subpackage that SQL can express over whole tables."""

_LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"'[^\x20\x09-\x0D]+'"

_HOST = "lower(nullif(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1), ''))"

URL_LISTS = f"""
WITH captures AS (SELECT page_id, {_HOST} AS host, CAST((page_id * 37) % 365 AS INTEGER) AS fetched FROM pages),
hosts AS (SELECT host AS pattern, min(page_id) AS k FROM captures WHERE host IS NOT NULL GROUP BY host),
entries AS (
  SELECT 'abuse' AS list, pattern, (k * 13) % 365 AS at, 1 AS adds FROM hosts WHERE k % 3 = 0
  UNION ALL SELECT 'abuse', pattern, (k * 13) % 365 + 40, 0 FROM hosts WHERE k % 6 = 0
  UNION ALL SELECT 'abuse', pattern, (k * 13) % 365 + 90, 1 FROM hosts WHERE k % 12 = 0
  UNION ALL SELECT 'parked', regexp_extract(pattern, '([^.]+[.][^.]+[.][^.]+)$', 1), (k * 13) % 365 + 5, 1 FROM hosts
    WHERE k % 10 = 0 AND regexp_extract(pattern, '([^.]+[.][^.]+[.][^.]+)$', 1) <> ''),
seen AS (
  SELECT c.host, c.fetched, e.list, e.pattern, arg_max(e.adds, e.at * 2 + 1 - e.adds) AS adds
  FROM (SELECT DISTINCT host, fetched FROM captures WHERE host IS NOT NULL) c
  JOIN entries e ON (c.host = e.pattern OR ends_with(c.host, '.' || e.pattern)) AND e.at <= c.fetched
  GROUP BY ALL),
hits AS (SELECT host, fetched, string_agg(DISTINCT list, ',' ORDER BY list) AS lists FROM seen WHERE adds = 1 GROUP BY ALL)
SELECT c.page_id, c.host, c.fetched, coalesce(h.lists, '') AS lists, h.lists IS NOT NULL AS blocked
FROM captures c LEFT JOIN hits h ON c.host = h.host AND c.fetched = h.fetched
"""

# Every 100-byte string, as hex, cut from blocks of 599 bytes; all but the first of equal ones are covered, and covered starts up to 100 apart are one run.
SUFFIX_DEDUP = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
b AS (SELECT r, base, substr(h, 2 * base + 1, 1198) AS x FROM (SELECT r, h, unnest(range(0, length(h) // 2 - 99, 500)) AS base FROM d WHERE length(h) >= 200)),
w AS (SELECT r, base + o AS s, substr(x, 2 * o + 1, 200) AS key FROM (SELECT r, base, x, unnest(range(0, length(x) // 2 - 99)) AS o FROM b)),
k AS (SELECT r, s, row_number() OVER (PARTITION BY key ORDER BY r, s) > 1 AS again FROM w),
c AS (SELECT r, s, CASE WHEN s <= lag(s) OVER (PARTITION BY r ORDER BY s) + 100 THEN 0 ELSE 1 END AS fresh FROM k WHERE again),
g AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS run FROM c),
runs AS (SELECT r, min(s) AS a, max(s) + 100 AS b FROM g GROUP BY r, run),
cuts AS (SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM runs),
kept AS (SELECT r, count(*) AS n, sum(b - a) AS gone, string_agg(substr(d.h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) || substr(any_value(d.h), 2 * max(b) + 1) AS h
  FROM cuts JOIN d USING (r) GROUP BY r)
SELECT doc_id, length(d.h) // 2 AS n_bytes, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, coalesce(n, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""

# A match ends after all pieces between matches and all matches up to it. The last two kinds are the method's own.
_KINDS = (
    ("assign", r"([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[""''" r"""]?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", "length(g) >= 8", 2),
    ("access", "AKIA[A-Z0-9]+", "length(m) >= 16", 0),
    ("hex", "[0-9a-f]+", "length(m) >= 32", 0),
    ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", "TRUE", 0),
    ("forge", "gh[pousr]_[A-Za-z0-9]{36,}", "TRUE", 0),
)


def _spans(rank: int, kind: str, pattern: str, when: str, group: int) -> str:
    return f"""SELECT r, {rank} AS rank, '{kind}' AS kind, e - length(m) AS s, e FROM (
  SELECT r, m, g, sum(length(gap) + length(m)) OVER (PARTITION BY r ORDER BY i) AS e FROM (
    SELECT r, unnest(hits) AS m, unnest(kept) AS g, unnest(gaps[1:len(hits)]) AS gap, generate_subscripts(hits, 1) AS i FROM (
      SELECT r, regexp_extract_all(t, '{pattern}', 0) AS hits, regexp_extract_all(t, '{pattern}', {group}) AS kept, string_split_regex(t, '{pattern}') AS gaps
      FROM d WHERE regexp_matches(t, '{pattern}')))) WHERE {when}"""


SECRET_LEDGER = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_spans(i, *k) for i, k in enumerate(_KINDS))}),
x AS (SELECT r, rank, s, concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)) AS span FROM s),
f AS (SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
  string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY s, rank) AS spans FROM x GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN f USING (r)
"""

_RULES = {"short": "n_words < 20", "repeated": "100 * n_repeat_words > 30 * n_words", "symbols": "100 * n_symbols > 10 * word_chars", "dup_lines": "n_dup_lines > greatest(3, n_words / 20)"}
_STRENGTH = "CASE WHEN q_{0} - m_{0} * m_{0} > 1e-12 THEN least(1000.0::DOUBLE, greatest(1.0::DOUBLE, m_{0} * (1 - m_{0}) / (q_{0} - m_{0} * m_{0}) - 1)) ELSE 1000.0::DOUBLE END"

HOST_QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_WORDS}) AS w FROM documents),
l AS (SELECT r, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines FROM d),
k AS (SELECT r, i, array_to_string(w[i:i + 7], ' ') AS key FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, key) > 1 AS again FROM k),
hit AS (SELECT r, count(DISTINCT i + o) AS n FROM (SELECT r, i, unnest(range(0, 8)) AS o FROM twice WHERE again) GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(w) AS n_words, coalesce(CAST(list_sum(list_transform(w, lambda x: length(x))) AS BIGINT), 0) AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(hit.n, 0) AS n_repeat_words
  FROM d JOIN l USING (r) LEFT JOIN hit USING (r)),
h AS (SELECT source, count(*) AS n, {", ".join(f"count(*) FILTER ({c}) AS f_{k}" for k, c in _RULES.items())} FROM m WHERE source IS NOT NULL GROUP BY source),
p AS (SELECT {", ".join(f"sum(f_{k}) / sum(n)::DOUBLE AS m_{k}, sum(f_{k} * f_{k} / n::DOUBLE) / sum(n) AS q_{k}" for k in _RULES)} FROM h),
v AS (SELECT source, greatest({", ".join(f"(f_{k} + m_{k} * s_{k}) / (n + s_{k})" for k in _RULES)}) > 0.5 AS bad
  FROM h, (SELECT *, {", ".join(f"{_STRENGTH.format(k)} AS s_{k}" for k in _RULES)} FROM p))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, ({_RULES["short"]} OR {_RULES["repeated"]}) AS base_failed,
  NOT ({_RULES["short"]} OR {_RULES["repeated"]}) AND NOT coalesce(bad, FALSE) AS kept, coalesce(bad, FALSE) AS host_rejected
FROM m LEFT JOIN v ON v.source = m.source
"""

_PLAIN = rf"regexp_extract_all(translate(coalesce(text, ''), {_LETTERS}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATE = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_PLAIN} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS size FROM (SELECT item_id, {_PLAIN} AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item, size, array_to_string(w[i:i + size - 1], ' ') AS key FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM b)),
dw AS (SELECT r, size, i, array_to_string(w[i:i + size - 1], ' ') AS key FROM (
  SELECT r, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM d JOIN (SELECT DISTINCT size FROM b) ON len(w) >= size)),
hits AS (SELECT r, i, dw.size, item FROM dw JOIN bw ON dw.size = bw.size AND dw.key = bw.key),
n AS (SELECT r, count(DISTINCT i + o) AS n_hit FROM (SELECT r, i, unnest(range(0, size)) AS o FROM hits) GROUP BY r),
x AS (SELECT r, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (r) LEFT JOIN x USING (r)
"""

# Calls as turns_as_calls derives them; levels by recursion over the dependencies, which all point back.
TOOL_CALLS = """
WITH RECURSIVE t AS (SELECT conv_id AS c, turn AS n, coalesce(role, '') IN ('user', 'system') AS asks, role, text, c % 11 AS odd FROM conversations),
calls AS (SELECT c, n, text, odd, CAST(c AS VARCHAR) || ':' || CAST(n AS VARCHAR) AS id,
  CASE WHEN role = 'system' THEN 'configure' WHEN odd = 3 THEN 'forecast' WHEN n % 4 = 0 THEN 'search' ELSE 'translate' END AS name FROM t WHERE asks),
shaped AS (SELECT *, CASE WHEN name = 'configure' THEN 'policy' WHEN odd = 5 THEN 'broken' WHEN odd = 7 THEN 'many' WHEN name = 'translate' THEN 'text' ELSE 'query' END AS shape, to_json(text) AS j FROM calls),
edges AS (SELECT id, c, n - 2 AS up FROM calls WHERE n >= 2 UNION SELECT id, c, n - 6 FROM calls WHERE n >= 6 AND n % 3 = 0),
known AS (SELECT id, c, n, count(*) AS many FROM calls WHERE id IS NOT NULL GROUP BY ALL),
links AS (SELECT e.id, k.id AS parent, CAST(e.c AS VARCHAR) || ':' || CAST(up AS VARCHAR) AS wanted FROM edges e LEFT JOIN known k ON k.c = e.c AND k.n = e.up),
paths AS (SELECT id, 0 AS level FROM known UNION SELECT l.id, p.level + 1 FROM paths p JOIN links l ON l.parent = p.id),
levels AS (SELECT id, max(level) AS level FROM paths GROUP BY id),
lost AS (SELECT DISTINCT id FROM links WHERE parent IS NULL),
needs AS (SELECT id, '[' || string_agg(DISTINCT '"' || wanted || '"', ',' ORDER BY '"' || wanted || '"') || ']' AS deps FROM links GROUP BY id),
answers AS (SELECT c, n, text, CAST(c AS VARCHAR) || ':' || CAST(n - 1 AS VARCHAR) AS id FROM t WHERE NOT asks),
firsts AS (SELECT id, count(*) AS many, arg_min(coalesce(CAST(to_json(text) AS VARCHAR), 'null'), [lpad(CAST(n AS VARCHAR), 9, '0'), coalesce(text, '')]) AS j FROM answers WHERE id IS NOT NULL GROUP BY id),
told AS (SELECT s.c, s.id, s.n, coalesce(v.level, NULL) AS topo_level, array_to_string(list_filter([
    CASE WHEN s.id IS NULL THEN 'no_id' END, CASE WHEN k.many > 1 THEN 'repeated_call' END, CASE WHEN f.many IS NULL THEN 'no_result' END, CASE WHEN f.many > 1 THEN 'repeated_result' END,
    CASE WHEN l.id IS NOT NULL THEN 'missing_dependency' END, CASE WHEN name = 'forecast' THEN 'unknown_tool' END, CASE WHEN shape = 'broken' THEN 'bad_json' END,
    CASE WHEN name = 'search' AND shape <> 'broken' AND s.text IS NULL THEN 'missing:query' END, CASE WHEN name = 'search' AND shape = 'many' THEN 'type:limit' END,
    CASE WHEN name = 'translate' AND shape = 'many' THEN CASE WHEN s.text IS NULL THEN 'unexpected:limit,missing:text,missing:into' ELSE 'unexpected:limit+query,missing:text,missing:into' END END,
    CASE WHEN shape = 'text' AND s.text IS NULL THEN 'missing:text' END, CASE WHEN shape = 'policy' AND s.text IS NULL THEN 'missing:policy' END], lambda x: x IS NOT NULL), ',') AS problems,
  '{"arguments":' || CASE shape WHEN 'broken' THEN coalesce(CAST(to_json('{broken ' || s.text) AS VARCHAR), 'null')
    WHEN 'many' THEN '{"limit":"many"' || coalesce(',"query":' || s.j, '') || '}' WHEN 'text' THEN '{"into":"en"' || coalesce(',"text":' || s.j, '') || '}'
    WHEN 'policy' THEN coalesce('{"policy":' || s.j || '}', '{}') ELSE '{' || array_to_string(list_filter(['"limit":' || s.n, '"query":' || s.j], lambda x: x IS NOT NULL), ',') || '}' END
  || ',"call_id":' || coalesce('"' || s.id || '"', 'null') || ',"depends_on":' || coalesce(d.deps, '[]') || ',"name":"' || name || '","result":' || coalesce(f.j, 'null') || '}' AS message
  FROM shaped s LEFT JOIN known k ON k.id = s.id LEFT JOIN firsts f ON f.id = s.id LEFT JOIN lost l ON l.id = s.id LEFT JOIN levels v ON v.id = s.id LEFT JOIN needs d ON d.id = s.id),
stray AS (SELECT a.c, a.id, a.n, CASE WHEN a.id IS NULL THEN 'orphan_result,no_id' WHEN f.many > 1 THEN 'orphan_result,repeated_result' ELSE 'orphan_result' END AS problems,
  '{"call_id":' || coalesce('"' || a.id || '"', 'null') || ',"result":' || coalesce(CAST(to_json(a.text) AS VARCHAR), 'null') || '}' AS message
  FROM answers a LEFT JOIN firsts f ON f.id = a.id WHERE a.id IS NULL OR a.id NOT IN (SELECT id FROM known))
SELECT c AS conv_id, id AS call_id, n AS turn, topo_level, problems = '' AS valid, problems, message FROM told
UNION ALL SELECT c, id, n, CAST(NULL AS INTEGER), FALSE, problems, message FROM stray
"""

# Terms of items alone are looked up in the documents; every number but the logarithm is whole.
RANKED_SEARCH = f"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(text, {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts FROM documents),
kept AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, ts, len(ts) AS n FROM docs WHERE len(ts) > 0),
totals AS (SELECT count(*) AS n_docs, sum(n) AS n_all FROM kept),
wanted AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, {_LETTERS}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t FROM benchmark),
tf AS (SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(ts) AS t FROM kept) GROUP BY ALL),
df AS (SELECT t, count(*) AS df FROM tf WHERE t IN (SELECT t FROM wanted) GROUP BY t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM df, totals),
m AS (SELECT r, doc_id, 50 + CAST((50 * n * n_docs) // n_all AS BIGINT) AS m FROM kept, totals),
scores AS (SELECT item_id, r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score FROM wanted JOIN tf USING (t) JOIN w USING (t) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores JOIN m USING (r) WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= 50
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda x: x[1] * x[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (SELECT p.*, s.vec_id AS negative_id, score AS negative_score, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, s.vec_id) AS INTEGER) AS rank
  FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""

# The pages of the tables have one layout, whose main text SQL can cut out by its tags; references in them are of two characters only, some without their end.
MAIN_TEXT = r"""
WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS a FROM pages),
b AS (SELECT page_id, url, list_transform(regexp_split_to_array(a, '</?(?:p|h1)>'), lambda x: trim(regexp_replace(replace(regexp_replace(
  regexp_replace(replace(x, '<br>', ' '), '<[^>]*>', '', 'g'), '&quot;?', '"', 'g'), '&amp;', '&'), '\s+', ' ', 'g'))) AS bs FROM a),
t AS (SELECT page_id, url, array_to_string(list_filter(list_transform(bs, lambda x: regexp_replace(x, '&amp', '&', 'g')), lambda x: x <> ''), chr(10)) AS text FROM b)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM t
"""
