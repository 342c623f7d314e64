"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

# Hosts and paths of the URLs, then the longest of the four rules that fits.
OP10 = r"""
WITH rules(verdict, rule, host, path) AS (
  VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
         ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')
),
cut AS (
  SELECT page_id, CASE WHEN url IS NOT NULL AND contains(url, '://')
    THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest FROM pages
),
parts AS (
  SELECT page_id,
    translate(split_part(rest, '/', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    CASE WHEN contains(rest, '/') THEN substr(rest, strpos(rest, '/')) ELSE '' END AS path FROM cut
),
fitting AS (
  SELECT p.page_id, r.rule, r.verdict,
    row_number() OVER (PARTITION BY p.page_id ORDER BY length(r.rule) DESC) AS k
  FROM parts p JOIN rules r
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
)
SELECT p.page_id, p.host, p.path, f.rule, coalesce(f.verdict, 'allow') AS verdict
FROM parts p LEFT JOIN fitting f ON f.page_id = p.page_id AND f.k = 1
"""

# Measures by document, then the beta prior from the hosts' means and variance.
OP4 = r"""
WITH t AS (SELECT doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT doc_id, source, text, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM t
),
grams AS (
  SELECT doc_id, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w WHERE len(words) >= 3)
),
again AS (SELECT doc_id, i FROM grams QUALIFY count(*) OVER (PARTITION BY doc_id, a, b, c) >= 2),
covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (VALUES (0), (1), (2)) AS three(k) GROUP BY doc_id
),
m AS (
  SELECT w.doc_id, source, len(words)::BIGINT AS n_words,
    length(regexp_replace(text, '[ \t\n\x0B\f\r]', '', 'g'))::BIGINT AS word_chars,
    (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
    (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM w LEFT JOIN covered ON covered.doc_id = w.doc_id
),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS f FROM judged GROUP BY source),
total AS (SELECT sum(n) AS n, sum(f) AS f, count(*) AS h, sum(n * n) AS nn, sum(f) / sum(n) AS mean FROM hosts),
spread AS (
  SELECT (SELECT sum(n * (f / n - mean) * (f / n - mean)) FROM hosts) AS q, total.* FROM total
),
prior AS (
  SELECT mean, mean * (1 - mean) AS binomial,
    CASE WHEN n - nn / n > 0 THEN (q - (h - 1) * mean * (1 - mean)) / (n - nn / n) ELSE 0 END AS between_hosts
  FROM spread
),
weighed AS (
  SELECT mean, CASE WHEN between_hosts > 0 AND binomial > 0
    THEN least(1e6, greatest(1e-3, binomial / between_hosts - 1)) ELSE 1e6 END AS weight FROM prior
),
rejected AS (SELECT source, (f + mean * weight) / (n + weight) > 0.5 AS bad FROM hosts, weighed)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT bad AS kept
FROM judged JOIN rejected ON judged.source IS NOT DISTINCT FROM rejected.source
"""

# Every window of 13 words, the smallest document it starts in, and the words of the others covered.
OP1 = r"""
WITH w AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words
  FROM documents
),
windows AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS content
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w WHERE len(words) >= 13)
),
again AS (SELECT doc_id, i FROM windows QUALIFY min(doc_id) OVER (PARTITION BY content) < doc_id),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM again, range(13) AS r(k)),
words AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM words ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT w.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

# Pairs that share a shingle, their similarity, and the smallest document reachable.
OP5 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words FROM documents
),
tokens AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 3
    THEN list_transform(range(1, len(words) - 1), lambda i: array_to_string(words[i:i + 2], ' '))
    WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS token FROM w
),
sizes AS (SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM tokens a JOIN tokens b ON a.token = b.token AND a.doc_id < b.doc_id
  GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)
),
linked AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, linked.b FROM reach JOIN linked ON linked.a = reach.b
)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM documents d JOIN reach ON reach.a = d.doc_id LEFT JOIN sizes ON sizes.doc_id = d.doc_id GROUP BY d.doc_id
"""

# The cuts are numbers of code points, and substring counts these.
OP11 = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
),
numbers AS (
  SELECT doc_id, text, length(text) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2,
    ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4 FROM t
),
cuts AS (
  SELECT doc_id, text, n, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
      WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
),
parts AS (
  SELECT *, substring(text, 1, a) AS prefix, substring(text, a + 1, b - a) AS middle, substring(text, b + 1) AS suffix FROM cuts
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN a END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN b - a END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM parts
"""

# Terms of whole texts, every group's share of every kept term, then all pairs of a language's sources.
OP12 = r"""
WITH d AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents
),
t AS (
  SELECT row, lang, source, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
),
kept AS (SELECT lang, term, count(*) AS n FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
whole AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (sum(n) OVER (PARTITION BY lang) + 2 * count(*) OVER (PARTITION BY lang)) AS p
  FROM kept
),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT lang, source, term, count(*) AS n FROM t GROUP BY lang, source, term),
dense AS (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n FROM g JOIN kept ON kept.lang = g.lang
  LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term
),
shares AS (
  SELECT *, 1 + (1000000000::HUGEINT * (n + 2))
    // (sum(n) OVER (PARTITION BY lang, source) + 2 * count(*) OVER (PARTITION BY lang, source)) AS p FROM dense
),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((s.p - w.p) * (s.p - w.p)) // (s.p + w.p) AS value
  FROM shares s JOIN whole w USING (lang, term) WHERE s.n > 0 AND s.p > w.p
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

# The turns as they are; the length of the formatted text from its parts.
OP13 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
ordered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
    coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) <> role, true) AS starts,
    length(replace(replace(replace(role, '### ', '\### '), '<text>', '\<text>'), '</turn>', '\</turn>')) AS role_chars,
    length(replace(replace(replace(text, '### ', '\### '), '<text>', '\<text>'), '</turn>', '\</turn>')) AS text_chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(8 + text_chars) + coalesce(sum(4 + role_chars + 9) FILTER (starts), 0))::BIGINT AS formatted_chars
FROM ordered GROUP BY conv_id
"""

ORACLES = {
    "op5_jaccard_join": OP5, "op1_substring_dedup": OP1, "op4_quality_rules": OP4, "op10_url_filter": OP10,
    "op11_fill_in_middle": OP11, "op12_source_divergence": OP12, "op13_chat_format": OP13,
}
