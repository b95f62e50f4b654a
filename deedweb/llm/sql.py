"""DuckDB SQL for the queries that SQL can express. The others are tested against brute force in tests/llm."""

import re

URL_FILTERS = r"""
WITH RECURSIVE rules(host, path, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
p AS (SELECT page_id, url, html,
  translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
  regexp_replace(trim(url), '(?s)#.*$', '') AS bare, regexp_extract_all(html, '(?is)<(?:link|meta)\b[^<>]*>') AS tags FROM pages),
tag AS (SELECT bare, url, coalesce(list_filter(tags, lambda t: regexp_matches(t, '(?is)^<link\b.*[\s"''/]rel\s*=\s*["'']?\s*canonical\b'))[1], '') AS t, 'href' AS a FROM p
  UNION ALL SELECT bare, url, coalesce(list_filter(tags, lambda t: regexp_matches(t, '(?is)^<meta\b.*[\s"''/]http-equiv\s*=\s*["'']?\s*refresh\b'))[1], ''), 'content' FROM p),
given AS (SELECT bare, url, a, trim(regexp_replace(coalesce(nullif(regexp_extract(t, '(?is)[\s"''/](?:href|content)\s*=\s*"([^"]*)"', 1), ''),
    nullif(regexp_extract(t, '(?is)[\s"''/](?:href|content)\s*=\s*''([^'']*)''', 1), ''),
    regexp_extract(t, '(?is)[\s"''/](?:href|content)\s*=\s*([^\s"''>]+)', 1)), '(?i)&(?:amp|#38|#x26);', '&', 'g')) AS v FROM tag),
aimed AS (SELECT bare, url, CASE WHEN a = 'href' THEN v ELSE regexp_extract(v, '(?is)(?:^|[;,\s])url\s*=\s*(.*)$', 1) END AS v, a FROM given),
links AS (SELECT bare, url, trim(CASE WHEN a = 'content' AND regexp_matches(v, '^["'']') THEN regexp_extract(v, '(?s)^["'']([^"'']*)', 1) ELSE v END) AS link FROM aimed),
far AS (SELECT bare, regexp_replace(trim(CASE WHEN regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN link
    WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?:)//', 1) || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) || link
    WHEN NOT regexp_matches(link, '^[A-Za-z][A-Za-z0-9+.-]*:|^#|^$')
    THEN rtrim(regexp_extract(url, '(?s)^(.*?://[^/?#]*(?:/[^?#]*/|/)?)', 1), '/') || '/' || link END), '(?s)#.*$', '') AS dst
  FROM links WHERE contains(bare, '://') AND link <> ''),
aim AS (SELECT NODE(bare) AS src, NODE(dst) AS dst FROM far WHERE contains(dst, '://')),
edges AS (SELECT src, dst FROM aim WHERE dst IS NOT NULL UNION SELECT dst, src FROM aim WHERE dst IS NOT NULL),
nodes AS (SELECT page_id, p.host, p.path, CASE WHEN contains(bare, '://') THEN NODE(bare) END AS node FROM p),
named AS (SELECT node AS n FROM nodes WHERE node IS NOT NULL UNION SELECT dst FROM edges),
split AS (SELECT n, regexp_extract(n, '(?s)^.*?://([^/?#]*)([^?#]*)', 1) AS host,
                    regexp_extract(n, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path FROM named),
fits AS (SELECT n, arg_max(verdict, length(r.host || r.path)) AS verdict FROM split s JOIN rules r
  ON (s.host = r.host OR ends_with(s.host, '.' || r.host)) AND starts_with(s.path, r.path) GROUP BY n),
reach(n) AS (SELECT n FROM fits WHERE verdict = 'block' UNION SELECT e.dst FROM reach JOIN edges e ON e.src = reach.n),
best AS (SELECT p.host AS h, p.path AS pa, arg_max(r.host || r.path, length(r.host || r.path)) AS rule,
                arg_max(r.verdict, length(r.host || r.path)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p) p JOIN rules r
  ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path) GROUP BY ALL)
SELECT p.page_id, p.host, p.path, b.rule,
  coalesce(b.verdict, CASE WHEN p.node IN (SELECT n FROM reach) THEN 'block' ELSE 'allow' END) AS verdict
FROM nodes p LEFT JOIN best b ON p.host = b.h AND p.path = b.pa
"""
#: A url without its fragment, with its host in lower case.
_NODE = r"""(regexp_extract(\1, '(?s)^(.*?://)', 1) || translate(regexp_extract(\1, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') || regexp_replace(\1, '(?s)^.*?://[^/?#]*', ''))"""
URL_FILTERS = re.sub(r"NODE\((\w+)\)", lambda m: _NODE.replace(r"\1", m[1]), URL_FILTERS)

LINE_DEDUP = r"""
WITH lines AS (SELECT doc_id, coalesce(source, '') AS site, trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13)) AS line
  FROM documents),
boiler AS (SELECT line, min(doc_id) AS keeper FROM lines WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 5),
rows AS (SELECT row_number() OVER () AS r, doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
each AS (SELECT r, doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS i FROM rows),
stay AS (SELECT e.r, e.part, e.i FROM each e LEFT JOIN boiler b ON trim(e.part, ' ' || chr(9) || chr(13)) = b.line
  WHERE b.keeper IS NULL OR b.keeper = e.doc_id),
kept AS (SELECT r, count(*) AS n, string_agg(part, chr(10) ORDER BY i) AS text FROM stay GROUP BY r)
SELECT d.doc_id, coalesce(len(d.parts), 0)::BIGINT AS n_lines, (coalesce(len(d.parts), 0) - coalesce(k.n, 0))::BIGINT AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM rows d LEFT JOIN kept k ON d.r = k.r
"""

SUBSTRING_DEDUP = r"""
WITH w AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(ws[i:i+49], ' ')) AS s FROM w, unnest(range(1, len(ws) - 48)) t(i) WHERE len(ws) >= 50),
first AS (SELECT s, min(doc_id) AS m FROM win GROUP BY s),
hit AS (SELECT doc_id, i FROM win JOIN first USING (s) WHERE m < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM hit, range(0, 50) r(j)),
each AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS text FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""

WARC = r"""
WITH p AS (SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND first <> page_id THEN first END AS refers_to
FROM p JOIN f USING (payload_digest)
"""

EXACT_DEDUP = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
  doc_id = first_value(doc_id) OVER g AS kept, text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""

#: A part's distance from an entry, and each round of the codebooks: parts choose, then entries move to the floors of the means.
_CODE_ROUND = """
a{r} AS MATERIALIZED (SELECT r, p, arg_min(e, d::HUGEINT * 16 + e) AS e, min(d) AS d
  FROM (SELECT q.r, q.p, b.e, list_sum(list_transform(list_zip(q.x, b.x), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d
        FROM parts q JOIN b{r} b USING (p)) GROUP BY r, p),
b{n} AS MATERIALIZED (SELECT p, e, coalesce(m.x, b.x) AS x FROM b{r} b LEFT JOIN (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
    SELECT p, e, i, sum(x[i])::HUGEINT AS s, count(*) AS n FROM a{r} JOIN parts USING (r, p), range(1, 9) t(i) GROUP BY p, e, i)
  GROUP BY p, e) m USING (p, e)),"""

VECTOR_CODES = (
    """
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label,
    list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT r, p, v[p * 8 + 1 : p * 8 + 8] AS x FROM kept, range(8) t(p)),
b0 AS MATERIALIZED (SELECT p, r - 1 AS e, x FROM parts WHERE r <= 16),"""
    + "".join(_CODE_ROUND.format(r=r, n=r + 1) for r in range(7))
    + """
codes AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a6 GROUP BY r),
sums AS (SELECT label, sum(error)::BIGINT AS label_error FROM kept JOIN codes USING (r) GROUP BY label),
book AS (SELECT sha256(string_agg(array_to_string(x, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM kept JOIN codes USING (r) JOIN sums ON kept.label IS NOT DISTINCT FROM sums.label, book
"""
)

JACCARD_JOIN = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []::VARCHAR[] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i+2], ' ')) END) AS g FROM w),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL)
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * k >= 90 * (na.n + nb.n - k)),
ends AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(d, c) AS (SELECT doc_id, doc_id FROM w UNION SELECT ends.b, reach.c FROM reach JOIN ends ON ends.a = reach.d WHERE reach.c < ends.b)
SELECT w.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(c) AS component_id
FROM reach LEFT JOIN n ON n.doc_id = reach.d JOIN w ON w.doc_id = reach.d GROUP BY w.doc_id
"""

CONVERSATION_TRIE = r"""
WITH own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS i,
    coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
convs AS (SELECT c, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END))) % 6 AS h
  FROM (SELECT DISTINCT c FROM own)),
turns AS (SELECT convs.c, i, role, text FROM convs JOIN own ON own.c = convs.c - convs.c % 100 AND i <= h
  UNION ALL SELECT convs.c, i, role, text FROM convs JOIN own ON own.c = convs.c AND i > h),
seqs AS (SELECT c, list({r: role, t: text} ORDER BY i) FILTER (i IS NOT NULL) AS s FROM convs LEFT JOIN turns USING (c) GROUP BY c),
steps AS (SELECT c, s, d, coalesce(s[1:d], []) AS k FROM (SELECT c, coalesce(s, []) AS s, unnest(range(len(coalesce(s, [])) + 1)) AS d FROM seqs)),
nodes AS MATERIALIZED (SELECT k, d, min(c) AS conv_id, count(*) AS n, string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (len(s) = d) AS ends FROM steps GROUP BY k, d),
links AS (SELECT p.k, p.conv_id AS parent, x.k AS child FROM nodes x JOIN nodes p ON x.d = p.d + 1 AND x.k[1:p.d] = p.k),
kids AS (SELECT k, count(*) AS n_children FROM links GROUP BY k),
below AS (SELECT p.k, count(*) FILTER (kids.k IS NULL) AS n_leaves,
    sum(CASE WHEN x.d > 0 THEN (x.n - 1) * length(x.k[x.d].t) ELSE 0 END)::BIGINT AS saved_tokens
  FROM nodes p JOIN nodes x ON x.d >= p.d AND x.k[1:p.d] = p.k LEFT JOIN kids ON kids.k = x.k GROUP BY p.k)
SELECT conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, n_leaves, saved_tokens,
  sha256(coalesce(ends, '')) AS ends_sha256
FROM nodes LEFT JOIN links ON links.child = nodes.k LEFT JOIN kids ON kids.k = nodes.k JOIN below ON below.k = nodes.k
"""

ORACLE_SQL = {
    "op1_url_filters": URL_FILTERS,
    "op3_line_dedup": LINE_DEDUP,
    "op7_substring_dedup": SUBSTRING_DEDUP,
    "op8_warc": WARC,
    "op9_exact_dedup": EXACT_DEDUP,
    "op11_vector_codes": VECTOR_CODES,
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_jaccard_join": JACCARD_JOIN,
}
