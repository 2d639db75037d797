"""DuckDB SQL of the URL filter and the phrase mining queries."""

OP12_SQL = r"""
WITH RECURSIVE own AS (
  SELECT page_id, url, html, regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1) AS raw_host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
         regexp_replace(url, '(?s)#.*$', '') AS bare FROM pages),
pg AS (
  SELECT *, translate(raw_host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(bare, '(?s)^(.*?://[^/?#]*)', 1) AS head FROM own),
tags AS (
  SELECT url, path, unnest(regexp_extract_all(regexp_replace(html,
    '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<template\b.*?</template\s*>', ' ', 'g'),
    '(?is)<(?:link|meta)\s[^>]*>')) AS tag
  FROM pg WHERE url IS NOT NULL AND regexp_matches(html, '(?i)canonical|refresh')),
names AS (SELECT unnest(['rel', 'href', 'http-equiv', 'content']) AS a),
attrs AS (
  SELECT DISTINCT url, path, tag, a, trim(regexp_replace(replace(replace(replace(replace(replace(replace(replace(
      CASE a WHEN 'rel' THEN regexp_extract(tag, '(?is)\srel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 0)
             WHEN 'href' THEN regexp_extract(tag, '(?is)\shref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 0)
             WHEN 'content' THEN regexp_extract(tag, '(?is)\scontent\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 0)
             ELSE regexp_extract(tag, '(?is)\shttp-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', 0) END,
      '&quot;', '"'), '&#34;', '"'), '&#39;', ''''), '&lt;', '<'), '&gt;', '>'), '&#38;', '&'), '&amp;', '&'),
      '[\x09-\x0D]', '', 'g'), ' ') AS raw
  FROM tags, names),
-- without the name, the sign and the quotes
vals AS (
  SELECT url, path, tag, a, trim(CASE WHEN rest[1] IN ('"', '''') THEN rest[2:len(rest) - 1] ELSE rest END, ' ') AS v
  FROM (SELECT *, regexp_replace(raw, '(?is)^http-equiv\s*=\s*|^rel\s*=\s*|^href\s*=\s*|^content\s*=\s*', '') AS rest FROM attrs)),
wide AS (
  SELECT url, path, tag, max(v) FILTER (a = 'rel') AS rel, max(v) FILTER (a = 'href') AS href,
         max(v) FILTER (a = 'http-equiv') AS equiv, max(v) FILTER (a = 'content') AS content FROM vals GROUP BY ALL),
targets AS (
  SELECT url, path, CASE
    WHEN regexp_matches(tag, '(?i)^<link') AND list_contains(regexp_split_to_array(lower(rel), '\s+'), 'canonical') THEN href
    WHEN regexp_matches(tag, '(?i)^<meta') AND lower(equiv) = 'refresh'
      THEN trim(regexp_extract(content, '(?is)^\s*[0-9.]*\s*[;,]\s*url\s*=\s*[''"]?([^''"]*)', 1), ' ') END AS t FROM wide),
parts AS (
  SELECT DISTINCT url, path, t, regexp_extract(url, '(?s)^(.*?)://', 1) AS scheme, regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS site,
    regexp_extract(CASE WHEN path = '' THEN '/' ELSE path END, '(?s)^(.*/)', 1) AS folder,
    regexp_extract(t, '(?s)^([^?#]*)', 1) AS tp, regexp_extract(t, '(?s)^[^?#]*(.*)$', 1) AS tail
  FROM targets WHERE t <> ''),
-- a path without its . and .. segments, one at a time
walk AS (SELECT *, string_split(CASE WHEN t[1] = '/' THEN tp ELSE folder || tp END, '/') AS seg FROM parts),
dots(url, t, seg, k, kept) AS (
  SELECT url, t, seg, 1, CAST([] AS VARCHAR[]) FROM walk WHERE len(list_filter(seg, lambda s: s IN ('.', '..'))) > 0
  UNION ALL
  SELECT url, t, seg, k + 1, CASE WHEN seg[k] = '.' THEN kept
      WHEN seg[k] = '..' THEN CASE WHEN len(kept) > 1 THEN kept[:len(kept) - 1] ELSE kept END
      ELSE list_append(kept, seg[k]) END
  FROM dots WHERE k <= len(seg)),
tidy AS (
  SELECT url, t, CASE WHEN seg[len(seg)] IN ('.', '..') THEN array_to_string(list_append(kept, ''), '/')
                      ELSE array_to_string(kept, '/') END AS p FROM dots WHERE k = len(seg) + 1),
linked AS (
  SELECT w.url, CASE
    WHEN regexp_matches(w.t, '(?i)^https?://[^/?#]') THEN w.t
    WHEN regexp_matches(w.t, '(?i)^[a-z][a-z0-9+.-]*:') OR w.site = '' OR w.t[1] = '#' THEN NULL
    WHEN w.t[1:2] = '//' THEN w.scheme || ':' || w.t
    WHEN w.t[1] = '?' THEN w.site || w.path || w.tail
    ELSE w.site || coalesce(y.p, array_to_string(w.seg, '/')) || w.tail END AS to_url
  FROM walk w LEFT JOIN tidy y ON w.url = y.url AND w.t = y.t),
norm AS (
  SELECT regexp_replace(url, '(?s)#.*$', '') AS x, regexp_replace(to_url, '(?s)#.*$', '') AS y FROM linked WHERE to_url IS NOT NULL),
edges AS (
  SELECT DISTINCT list_transform([x, y], lambda u:
    translate(regexp_extract(u, '(?s)^(.*?://[^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
    || substr(u, length(regexp_extract(u, '(?s)^(.*?://[^/?#]*)', 1)) + 1)) AS e FROM norm),
near AS (SELECT e[1] AS x, e[2] AS y FROM edges WHERE e[1] <> e[2] UNION SELECT e[2], e[1] FROM edges WHERE e[1] <> e[2]),
reach(x, y) AS (SELECT x, y FROM near UNION SELECT r.x, n.y FROM reach r JOIN near n ON r.y = n.x),
rules(rule, rh, rp, verdict) AS (VALUES ('net/', 'net', '/', 'block'), ('example.net/en/', 'example.net', '/en/', 'allow'),
  ('example.com/de/', 'example.com', '/de/', 'block'), ('org/fr/', 'org', '/fr/', 'allow')),
far AS (
  SELECT DISTINCT y, regexp_extract(y, '(?s)^.*?://([^/?#]*)', 1) AS h, regexp_extract(y, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS p FROM reach),
far_rule AS (
  SELECT y, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM far JOIN rules ON (h = rh OR ends_with(h, '.' || rh)) AND starts_with(p, rp) GROUP BY y),
blocked AS (SELECT x, min(rule) AS rule FROM reach r JOIN far_rule f ON r.y = f.y AND f.verdict = 'block' GROUP BY x),
ruled AS (
  SELECT host, path, arg_max(rule, length(rule)) AS rule, arg_max(verdict, length(rule)) AS verdict
  FROM (SELECT DISTINCT host, path FROM pg) JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY host, path)
SELECT p.page_id, p.host, p.path, r.rule, coalesce(r.verdict, CASE WHEN b.rule IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict,
       CASE WHEN r.rule IS NULL THEN b.rule END AS blocked_by
FROM pg p LEFT JOIN ruled r ON p.host = r.host AND p.path = r.path
LEFT JOIN blocked b ON b.x = translate(p.head, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') || substr(p.bare, length(p.head) + 1)
"""

OP13_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
tok AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM tok GROUP BY lang),
sizes AS (SELECT unnest([1, 2, 3, 4]) AS m),
starts AS (SELECT lang, m, w, unnest(range(1, len(w) - m + 2)) AS i FROM tok, sizes WHERE len(w) >= m),
f AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS a FROM starts GROUP BY ALL HAVING count(*) >= 30),
cuts AS (
  SELECT lang, m, phrase, a, k, string_split(phrase, ' ') AS w FROM f, (SELECT unnest([1, 2, 3]) AS k) WHERE m > 1 AND k < m),
marks AS (
  SELECT c.lang, c.m, c.phrase, c.a, c.k, l.a AS l, r.a AS r,
         (CAST(2000000 AS HUGEINT) * c.a) // (CAST(l.a AS HUGEINT) + r.a) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(w[:k], ' ')
              JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM marks QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_of AS (
  SELECT lang, m, a, string_split(phrase, ' ') AS w, n, unnest(range(1, m - n + 2)) AS i
  FROM f, (SELECT unnest([2, 3]) AS n) WHERE m > 2 AND n < m),
most AS (SELECT lang, array_to_string(w[i:i + n - 1], ' ') AS phrase, max(a) AS top FROM inner_of GROUP BY ALL),
kept AS (
  SELECT b.* FROM best b LEFT JOIN most t ON b.lang = t.lang AND b.phrase = t.phrase
  WHERE t.top IS NULL OR CAST(100 AS HUGEINT) * t.top < CAST(80 AS HUGEINT) * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT r.lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score FROM ranked r JOIN total t ON r.lang = t.lang WHERE rank <= 2000
"""
