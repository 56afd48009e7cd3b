"""DuckDB SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
#: Words between ASCII white space; words of letters and digits in lower-cased text.
_PLAIN = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_ALNUM = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_DECONTAMINATION = f"""
WITH docs AS (
    SELECT doc_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS words FROM documents
), items AS (
    SELECT item_id, words, least(len(words), 10) AS size
    FROM (SELECT item_id, {_ALNUM.format(_LOWER.format("coalesce(text, '')"))} AS words FROM benchmark)
    WHERE len(words) > 0
), item_starts AS (
    SELECT item_id, words, size, unnest(range(1, CAST(len(words) - size + 2 AS BIGINT))) AS start_at FROM items
), item_windows AS (
    SELECT DISTINCT item_id, size, array_to_string(words[start_at:start_at + size - 1], ' ') AS w FROM item_starts
), sizes AS (
    SELECT DISTINCT size FROM items
), doc_starts AS (
    SELECT d.doc_id, d.words, s.size, unnest(range(1, CAST(len(d.words) - s.size + 2 AS BIGINT))) AS start_at
    FROM docs d JOIN sizes s ON len(d.words) >= s.size
), found AS (
    SELECT d.doc_id, d.size, d.start_at, i.item_id
    FROM doc_starts d JOIN item_windows i
      ON i.size = d.size AND i.w = array_to_string(d.words[d.start_at:d.start_at + d.size - 1], ' ')
), hit AS (
    SELECT doc_id, count(DISTINCT place) AS n_hit
    FROM (SELECT doc_id, unnest(range(start_at, CAST(start_at + size AS BIGINT))) AS place
          FROM (SELECT DISTINCT doc_id, size, start_at FROM found))
    GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words, CAST(coalesce(h.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n.n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(n.ids, '')) AS items_sha256,
       coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit h USING (doc_id) LEFT JOIN named n USING (doc_id)
"""

_SUBSTRING_DEDUP = f"""
WITH docs AS (
    SELECT doc_id, {_PLAIN.format("coalesce(text, '')")} AS words FROM documents
), windows AS (
    SELECT doc_id, start_at, md5_number(array_to_string(words[start_at:start_at + 12], ' ')) AS w
    FROM (SELECT doc_id, words, unnest(range(1, CAST(len(words) - 11 AS BIGINT))) AS start_at FROM docs)
), firsts AS (
    SELECT w, min(doc_id) AS first_id FROM windows GROUP BY w HAVING min(doc_id) < max(doc_id)
), gone AS (
    SELECT doc_id, list(DISTINCT place) AS places
    FROM (SELECT x.doc_id, unnest(range(x.start_at, x.start_at + 13)) AS place
          FROM windows x JOIN firsts f ON x.w = f.w AND f.first_id < x.doc_id)
    GROUP BY doc_id
), spelled AS (
    SELECT doc_id, generate_subscripts(words, 1) AS place, unnest(words) AS word FROM docs
), out_of AS (
    SELECT doc_id, unnest(places) AS place FROM gone
), kept AS (
    SELECT s.doc_id, string_agg(s.word, ' ' ORDER BY s.place) AS text, count(*) AS n
    FROM spelled s ANTI JOIN out_of o ON s.doc_id = o.doc_id AND s.place = o.place GROUP BY s.doc_id
)
SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
       CAST(len(d.words) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.text, '')) AS kept_sha256
FROM docs d LEFT JOIN kept k USING (doc_id)
"""

# Sets this alike share a shingle among the rarest quarter of each, so only those are joined.
_MINHASH = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, {_PLAIN.format(_LOWER.format("coalesce(text, '')"))} AS words FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, md5_number(array_to_string(words[place:place + 4], ' ')) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, CAST(greatest(len(words) - 3, 2) AS BIGINT))) AS place
          FROM docs WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), ordered AS (
    SELECT doc_id, shingle, row_number() OVER (PARTITION BY doc_id ORDER BY often, shingle) AS place
    FROM shingles JOIN (SELECT shingle, count(*) AS often FROM shingles GROUP BY shingle) USING (shingle)
), rarest AS (
    SELECT doc_id, shingle FROM ordered JOIN sizes USING (doc_id) WHERE place <= n - (3 * n + 3) // 4 + 1
), candidates AS (
    SELECT DISTINCT a.doc_id AS one, b.doc_id AS other FROM rarest a JOIN rarest b USING (shingle) WHERE a.doc_id < b.doc_id
), links AS (
    SELECT c.one, c.other FROM candidates c
    JOIN shingles a ON a.doc_id = c.one JOIN shingles b ON b.doc_id = c.other AND b.shingle = a.shingle
    JOIN sizes x ON x.doc_id = c.one JOIN sizes y ON y.doc_id = c.other
    GROUP BY c.one, c.other, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), both_ways AS (
    SELECT one AS doc_id, other FROM links UNION ALL SELECT other, one FROM links
), reached AS (
    SELECT doc_id, doc_id AS smallest FROM docs
    UNION
    SELECT b.other, r.smallest FROM reached r JOIN both_ways b ON b.doc_id = r.doc_id WHERE r.smallest < b.other
), components AS (
    SELECT doc_id, min(smallest) AS component_id FROM reached GROUP BY doc_id
)
SELECT d.doc_id, CAST(coalesce(s.n, 0) AS BIGINT) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
FROM docs d JOIN components c USING (doc_id) LEFT JOIN sizes s USING (doc_id)
"""

_LINE_DEDUP = f"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, {_LOWER.format(f"trim(line, {_SPACE})")} AS line_key FROM lines
), often AS (
    SELECT line_key FROM keyed WHERE length(line_key) >= 1
    GROUP BY line_key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
    SELECT k.*, o.line_key IS NOT NULL AS gone FROM keyed k LEFT JOIN often o USING (line_key)
)
SELECT doc_id, count(*) AS n_lines, CAST(sum(CASE WHEN gone THEN 1 ELSE 0 END) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

# A base32 digit is five of the digest's 160 bits: they lie in two neighbouring hex digits.
_WARC = """
WITH digests AS (
    SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes,
           sha1(coalesce(html, '')) AS hex FROM pages
), owners AS (
    SELECT hex, max(page_id) AS owner FROM digests GROUP BY hex
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + (
           ((strpos('0123456789abcdef', substr(hex, CAST(5 * k // 4 + 1 AS BIGINT), 1)) - 1) * 16
             + strpos('0123456789abcdef', substr(hex, CAST(5 * k // 4 + 2 AS BIGINT), 1)) - 1)
           // CAST(pow(2, 3 - (5 * k) % 4) AS BIGINT)) % 32 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM digests JOIN owners USING (hex)
"""

# Templates are lines that ten different texts of a host carry. Near copies share a third of
# the shingles of their other lines, of which the operator's marks are a sample.
_QUALITY_RULES = f"""
WITH docs AS (
    SELECT doc_id, source, coalesce(text, '') AS text, {_PLAIN.format("coalesce(text, '')")} AS words,
           string_split(coalesce(text, ''), chr(10)) AS parts FROM documents
), windows AS (
    SELECT doc_id, start_at, array_to_string(words[start_at:start_at + 4], ' ') AS w
    FROM (SELECT doc_id, words, unnest(range(1, CAST(len(words) - 3 AS BIGINT))) AS start_at FROM docs)
), twice AS (
    SELECT doc_id, w FROM windows GROUP BY doc_id, w HAVING count(*) > 1
), repeats AS (
    SELECT doc_id, count(DISTINCT place) AS n
    FROM (SELECT doc_id, unnest(range(start_at, start_at + 5)) AS place FROM windows JOIN twice USING (doc_id, w))
    GROUP BY doc_id
), lines AS (
    SELECT doc_id, source, text, line, {_LOWER.format(f"trim(line, {_SPACE})")} AS line_key,
           {_PLAIN.format(_LOWER.format("line"))} AS line_words, len(line_words) AS n
    FROM (SELECT doc_id, source, text, unnest(parts) AS line FROM docs)
), full_lines AS (
    SELECT * FROM lines WHERE n > 0
), dups AS (
    SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM full_lines GROUP BY doc_id
), texts AS (
    SELECT DISTINCT source, md5(text) AS t, line_key, line_words FROM full_lines
), often AS (
    SELECT source, line_key FROM texts GROUP BY source, line_key HAVING count(DISTINCT t) >= 10
), carried AS (
    SELECT t.source, t.line_key, t.t FROM texts t
    JOIN often o ON t.source IS NOT DISTINCT FROM o.source AND t.line_key = o.line_key
), shingles AS (
    SELECT DISTINCT source, t, line_key, array_to_string(w[place:place + 4], ' ') AS shingle
    FROM (SELECT x.*, unnest(range(1, CAST(greatest(len(w) - 3, 2) AS BIGINT))) AS place
          FROM (SELECT source, t, line_key, line_words AS w FROM texts
                SEMI JOIN carried USING (t)) x)
), rests AS (
    SELECT DISTINCT c.source, c.line_key, c.t, s.shingle FROM carried c
    JOIN shingles s ON c.t = s.t AND c.source IS NOT DISTINCT FROM s.source AND s.line_key <> c.line_key
), rest_sizes AS (
    SELECT source, line_key, t, count(*) AS n FROM rests GROUP BY source, line_key, t
), alike AS (
    SELECT a.source, a.line_key, b.t, count(*) AS common, any_value(x.n) AS n_a, any_value(y.n) AS n_b
    FROM rests a JOIN rests b ON a.source IS NOT DISTINCT FROM b.source AND a.line_key = b.line_key
                             AND a.shingle = b.shingle AND a.t < b.t
    JOIN rest_sizes x ON x.t = a.t AND x.line_key = a.line_key AND x.source IS NOT DISTINCT FROM a.source
    JOIN rest_sizes y ON y.t = b.t AND y.line_key = b.line_key AND y.source IS NOT DISTINCT FROM b.source
    GROUP BY a.source, a.line_key, a.t, b.t HAVING 3 * count(*) >= any_value(x.n) + any_value(y.n) - count(*)
), bare AS (
    SELECT c.source, c.line_key, c.t, min(c.t) OVER (PARTITION BY c.source, c.line_key) AS first_t
    FROM carried c ANTI JOIN rest_sizes r ON r.t = c.t AND r.line_key = c.line_key AND r.source IS NOT DISTINCT FROM c.source
), copies AS (
    SELECT DISTINCT source, line_key, t FROM alike
    UNION SELECT source, line_key, t FROM bare WHERE t > first_t
), templates AS (
    SELECT c.source, c.line_key FROM carried c
    ANTI JOIN copies x ON x.t = c.t AND x.line_key = c.line_key AND x.source IS NOT DISTINCT FROM c.source
    GROUP BY c.source, c.line_key HAVING count(*) >= 10
), hit AS (
    SELECT l.doc_id, sum(l.n) AS n FROM full_lines l
    JOIN templates t ON l.source IS NOT DISTINCT FROM t.source AND l.line_key = t.line_key GROUP BY l.doc_id
), measured AS (
    SELECT d.doc_id, CAST(len(d.words) AS BIGINT) AS n_words,
           CAST(length(array_to_string(d.words, '')) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           CAST(coalesce(p.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words,
           coalesce(len(d.words) - h.n < 10, false) AS depleted
    FROM docs d LEFT JOIN dups p USING (doc_id) LEFT JOIN repeats r USING (doc_id) LEFT JOIN hit h USING (doc_id)
), judged AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, depleted FROM judged
"""

_SOURCE_DIVERGENCE = f"""
WITH docs AS (
    SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS no,
           regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
    FROM documents
), spelled AS (
    SELECT lang, source, no, unnest(terms) AS term FROM docs
), kept AS (
    SELECT lang, term, count(*) AS all_n FROM spelled GROUP BY lang, term HAVING count(DISTINCT no) >= 10
), counted AS (
    SELECT s.lang, s.source, s.term, count(*) AS n FROM spelled s SEMI JOIN kept k ON s.lang = k.lang AND s.term = k.term
    GROUP BY s.lang, s.source, s.term
), langs AS (
    SELECT lang, sum(all_n) AS lang_n, count(*) AS v FROM kept GROUP BY lang
), groups AS (
    SELECT g.lang, g.source, coalesce(c.group_n, 0) AS group_n
    FROM (SELECT DISTINCT lang, source FROM docs) g
    LEFT JOIN (SELECT lang, source, sum(n) AS group_n FROM counted GROUP BY lang, source) c USING (lang, source)
), priced AS (
    SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
           1 + CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 2) // (g.group_n + 2 * l.v) AS p,
           1 + CAST(1000000000 AS HUGEINT) * (k.all_n + 2) // (l.lang_n + 2 * l.v) AS q
    FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
    LEFT JOIN counted c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), summed AS (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
    FROM priced a JOIN priced b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
    SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN summed s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
), found AS (
    SELECT lang, source, 'pair' AS part, item, value,
           CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS INTEGER) AS rank FROM pairs
    UNION ALL
    SELECT lang, source, 'term', term, value,
           CAST(row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, term) AS INTEGER)
    FROM (SELECT lang, source, term, CAST((p - q) * (p - q) // (p + q) AS BIGINT) AS value
          FROM priced WHERE n > 0 AND p > q)
)
SELECT lang, source, part, item, value, rank FROM found WHERE part = 'pair' OR rank <= 10
"""

# A set of filters is a number of five bits, A the lowest; a document fails such a set.
_FILTER_AUDIT = f"""
WITH docs AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
           {_PLAIN.format("coalesce(text, '')")} AS words FROM documents
), firsts AS (
    SELECT text, min(doc_id) AS first_id FROM docs GROUP BY text
), told AS (
    SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS bad FROM labels GROUP BY doc_id
), fails AS (
    SELECT d.part, coalesce(t.good, false) AS good, coalesce(t.bad, false) AS bad,
           CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
           + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
           + CASE WHEN 100 * length(regexp_replace(d.text, '[^A-Z]', '', 'g')) > 5 * length(d.text) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(d.text, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN f.first_id < d.doc_id THEN 16 ELSE 0 END AS mask
    FROM docs d JOIN firsts f ON d.text = f.text LEFT JOIN told t ON d.doc_id = t.doc_id
), masks AS (
    SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE bad) AS bad
    FROM fails GROUP BY part, mask
), letters AS (
    SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
), orders AS (
    SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order,
           [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31
      AND len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
), steps AS (
    SELECT filter_order, step, bits[step] AS own, CAST(list_sum(bits[1:step]) - bits[step] AS INTEGER) AS before
    FROM (SELECT filter_order, bits, unnest(range(1, 6)) AS step FROM orders)
), audited AS (
    SELECT m.part, s.filter_order, s.step, s.own,
           sum(CASE WHEN m.mask & (s.before + s.own) = 0 THEN m.n ELSE 0 END) AS kept,
           sum(CASE WHEN m.mask & s.own > 0 AND m.mask & s.before = 0 THEN m.n ELSE 0 END) AS removed,
           sum(CASE WHEN m.mask & s.own > 0 AND m.mask & s.before > 0 THEN m.n ELSE 0 END) AS redundant,
           sum(CASE WHEN m.mask = s.own THEN m.n ELSE 0 END) AS unique_fails,
           sum(CASE WHEN m.mask & s.own > 0 AND m.mask & s.before = 0 THEN m.good ELSE 0 END) AS good_lost,
           sum(CASE WHEN m.mask & s.own > 0 AND m.mask & s.before = 0 THEN m.bad ELSE 0 END) AS toxic_lost
    FROM masks m, steps s GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, own) AS BIGINT) AS shapley
FROM audited
"""


def _level(name: str, above: str, key: str) -> str:
    """Shares of a level's groups, shrunk towards those of the level above."""
    return f"""{name}_met AS (
    SELECT g.*, a.share AS mean FROM {name}_counts g JOIN {above} a USING ({key})
), {name}_worth AS (
    SELECT 1 / least(greatest(coalesce(
        sum(power(y - n * mean, 2) - n * mean * (1 - mean)) / nullif(sum((n - 1) * n * mean * (1 - mean)), 0),
        0.5), 1e-6), 0.5) - 1 AS worth FROM {name}_met
), {name}_shares AS (
    SELECT m.*, n + worth AS weight, (y + worth * mean) / (n + worth) AS share FROM {name}_met m, {name}_worth
)"""


_URL_FILTER = f"""
WITH rules AS (
    SELECT * FROM (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'),
                          ('allow', 'org', '/fr/')) AS v(what, name, start)
), urls AS (
    SELECT page_id, {_LOWER.format("regexp_extract(after, '^[^/?#]*')")} AS host,
           regexp_extract(after, '(?s)^[^/?#]*([^?#]*)', 1) AS path
    FROM (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS after
          FROM pages)
), ruled AS (
    SELECT host, path, arg_max(name || start, length(name || start)) AS rule, arg_max(what, length(name || start)) AS what
    FROM (SELECT DISTINCT host, path FROM urls)
    JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, start) GROUP BY host, path
), told AS (
    SELECT doc_id, min(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id
), host_counted AS (
    SELECT host, count(good) AS n, coalesce(sum(good), 0) AS y, string_split(host, '.') AS parts
    FROM urls LEFT JOIN told ON page_id = doc_id GROUP BY host
), host_counts AS (
    SELECT host, n, y, array_to_string(parts[-width:], '.') AS suffix, array_to_string(parts[-width - 1:], '.') AS domain
    FROM (SELECT *, CASE WHEN length(parts[-1]) = 2 AND parts[-2] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')
                         THEN 2 ELSE 1 END AS width FROM host_counted)
), domain_counts AS (
    SELECT domain, suffix, sum(n) AS n, sum(y) AS y FROM host_counts GROUP BY domain, suffix
), suffix_counts AS (
    SELECT suffix, sum(n) AS n, sum(y) AS y, 0 AS root FROM domain_counts GROUP BY suffix
), total AS (
    SELECT 0 AS root, (coalesce(sum(y), 0) + 1) / (coalesce(sum(n), 0) + 2) AS share FROM suffix_counts
), {_level("suffix", "total", "root")}, {_level("domain", "suffix_shares", "suffix")}, {_level("host", "domain_shares", "domain")}
, reputed AS (
    SELECT host, CASE WHEN share + 1.645 * sqrt(share * (1 - share) / (weight + 1)) < 0.5 THEN 'block' ELSE 'allow' END AS verdict
    FROM host_shares
)
SELECT u.page_id, u.host, u.path, r.rule, coalesce(r.what, h.verdict) AS verdict
FROM urls u JOIN reputed h ON u.host = h.host LEFT JOIN ruled r ON u.host = r.host AND u.path = r.path
"""

ORACLES = {
    "op3_decontamination": _DECONTAMINATION, "op5_substring_dedup": _SUBSTRING_DEDUP,
    "op6_minhash": _MINHASH, "op7_line_dedup": _LINE_DEDUP, "op9_warc": _WARC, "op10_quality_rules": _QUALITY_RULES,
    "op11_source_divergence": _SOURCE_DIVERGENCE, "op12_filter_audit": _FILTER_AUDIT, "op13_url_filter": _URL_FILTER,
}
