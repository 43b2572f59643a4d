"""DuckDB SQL for the corpus queries that SQL can express."""

from __future__ import annotations

_CASE = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_BLANK = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_LINES = f"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
k AS (SELECT *, translate(trim(line, {_BLANK}), {_CASE}) AS key FROM l),
h AS (SELECT key, max(doc_id) AS top FROM k WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
m AS (SELECT k.*, (h.key IS NOT NULL AND k.doc_id <> h.top) AS gone FROM k LEFT JOIN h ON k.key = h.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY doc_id"""

_URLS = rf"""WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, coalesce(translate(regexp_extract(rest, '^([^/?#]*)', 1), {_CASE}), '') AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM r),
rules(h, p, v) AS (VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')),
c AS (SELECT p.*, regexp_replace(regexp_replace(regexp_replace(regexp_replace(host, '^.*@', ''), '\.*(:80|:443)?$', ''), '\.+$', ''), '^www\.(.)', '\1') AS canon, coalesce(length(html), 0) AS n FROM p JOIN pages USING (page_id)),
listed(h) AS (SELECT unnest(['ads-track.example.com', 'adult-x.example.com', 'casino-win.example.net', 'cheap-pills.example.net', 'free-bets.example.net', 'spam-farm.example.org'])
 UNION SELECT canon FROM c WHERE canon <> '' GROUP BY 1 HAVING count(*) >= 5 AND count(*) FILTER (n < 1000) >= 0.25 * count(*)),
f AS (SELECT page_id, rules.h || rules.p AS rule, rules.v, row_number() OVER (PARTITION BY page_id ORDER BY length(rules.h || rules.p) DESC) AS n
 FROM p JOIN rules ON (host = rules.h OR host LIKE '%.' || rules.h) AND starts_with(path, rules.p))
SELECT p.page_id, host, path, f.rule, coalesce(f.v, CASE WHEN EXISTS (SELECT 1 FROM listed WHERE canon = listed.h OR canon LIKE '%.' || listed.h) THEN 'block' ELSE 'allow' END) AS verdict
FROM c p LEFT JOIN f ON f.page_id = p.page_id AND f.n = 1"""

_WORDS = f"regexp_extract_all(translate(coalesce(text, ''), {_CASE}), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
_LEAKS = f"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
bw AS (SELECT item, least(10, len(w)) AS k, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item, k, array_to_string(w[i:i + k - 1], ' ') AS x FROM bw),
d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
dw AS (SELECT doc_id, k, unnest(range(1, len(w) - k + 2)) AS i, w FROM d, (SELECT DISTINCT k FROM win) WHERE len(w) >= k),
hit AS (SELECT doc_id, item, i, dw.k FROM dw JOIN win ON win.k = dw.k AND win.x = array_to_string(dw.w[i:i + dw.k - 1], ' ')),
words AS (SELECT doc_id, count(DISTINCT j) AS n FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM hit) GROUP BY 1),
items AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hit GROUP BY 1)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items, sha256(coalesce(items.s, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_CASE}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
_DIVERGENCE = f"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, {_TERMS} AS w FROM documents),
t AS (SELECT doc_id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term, count(*)::HUGEINT AS n FROM t GROUP BY 1, 2 HAVING count(DISTINCT doc_id) >= 10),
groups AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
cells AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, k.n AS lang_n FROM groups g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT *, sum(n) OVER (PARTITION BY lang, source) AS total, sum(lang_n) OVER (PARTITION BY lang, source) AS lang_total, count(*) OVER (PARTITION BY lang, source) AS v FROM cells),
p AS (SELECT lang, source, term, n, 1 + (1000000000 * (n + 2)) // (total + 2 * v)::HUGEINT AS p, 1 + (1000000000 * (lang_n + 2)) // (lang_total + 2 * v)::HUGEINT AS q FROM sums),
pairs AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
every AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pairs x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source
 UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM ranked WHERE part = 'pair' OR rank <= 10"""

SQL: dict[str, str] = {"op2_line_dedup": _LINES, "op5_url_filter": _URLS, "op6_decontaminate": _LEAKS, "op11_source_divergence": _DIVERGENCE}
