"""SQL twins of the corpus queries, for DuckDB."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_LETTERS = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _words(text: str, pattern: str, table: str = "documents", key: str = "doc_id") -> str:
    return f"SELECT {key}, regexp_extract_all({text}, {pattern}) AS w FROM {table}"


#: Links between all pairs that share a shingle, and what they reach.
OP1 = f"""
  WITH RECURSIVE d AS ({_words(_LOWER, _SPACED)}), s AS (
    SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS g FROM d
  ), x AS (SELECT doc_id, len(g) AS n, unnest(g) AS g FROM s),
  links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM x a JOIN x b ON a.g = b.g AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
  ), reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
  least AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
  SELECT doc_id, CAST(len(g) AS BIGINT) AS n_shingles, least(doc_id, coalesce(b, doc_id)) AS component_id,
    coalesce(b, doc_id) >= doc_id AS kept
  FROM s LEFT JOIN least ON a = doc_id
"""

OP2 = f"""
  WITH d AS ({_words("coalesce(text, '')", _SPACED)}),
  p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
  g AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS pos, w FROM d),
  h AS (SELECT doc_id, pos, array_to_string(w[pos:pos + 12], ' ') AS g FROM g),
  c AS (SELECT doc_id, pos, min(doc_id) OVER (PARTITION BY g) < doc_id AS copy FROM h),
  m AS (
    SELECT doc_id, pos, word, coalesce(bool_or(copy) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN 12 PRECEDING AND CURRENT ROW), false) AS gone
    FROM p LEFT JOIN c USING (doc_id, pos)
  ), k AS (
    SELECT doc_id, count(*) FILTER (gone) AS lost, string_agg(word, ' ' ORDER BY pos) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id
  )
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(lost, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
  FROM d LEFT JOIN k USING (doc_id)
"""

OP3 = f"""
  WITH d AS ({_words(_LOWER, _LETTERS)}),
  i AS (SELECT CAST(item_id AS VARCHAR) AS item, w, least(10, len(w)) AS n FROM ({_words(_LOWER, _LETTERS, "benchmark", "item_id")}) WHERE len(w) > 0),
  g AS (SELECT DISTINCT item, n, array_to_string(w[pos:pos + n - 1], ' ') AS g FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS pos FROM i)),
  q AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, (SELECT DISTINCT n FROM i) WHERE len(w) >= n),
  f AS (SELECT doc_id, pos, q.n, item FROM q JOIN g ON g.n = q.n AND g.g = array_to_string(w[pos:pos + q.n - 1], ' ')),
  hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS p FROM f) GROUP BY doc_id),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM f) GROUP BY doc_id)
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
  FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

OP4 = f"""
  WITH d AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), {_SPACED})) AS BIGINT) AS size,
      substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS key FROM documents
  ), s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
      [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
    FROM d GROUP BY source
  ), l AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0) AS DOUBLE)
      / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS DOUBLE) AS level
    FROM s WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  ), t AS (
    SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM l
  ), b AS (
    SELECT d.doc_id, d.source, size, source_size, target, CAST(floor(target + 0.5) AS BIGINT) AS budget,
      coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
  )
  SELECT doc_id, source, size, source_size, target, CAST(CASE WHEN source_size = 0 THEN 0
    ELSE budget // source_size * size + greatest(0, least(size, budget % source_size - before)) END AS BIGINT) AS taken
  FROM b
"""

OP5 = rf"""
  WITH d AS ({_words("coalesce(text, '')", _SPACED)}),
  p AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM d),
  g AS (
    SELECT doc_id, n, pos, count(*) OVER (PARTITION BY doc_id, n, g) > 1 AS twice
    FROM (SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM d, (SELECT unnest([3, 5, 6, 7, 8, 9, 10]) AS n)))
  ), c AS (
    SELECT doc_id, n, p FROM (SELECT DISTINCT doc_id, n, unnest(range(pos, pos + n)) AS p FROM g WHERE twice)
  ), r AS (
    SELECT c.doc_id, c.n, count(*) AS words, sum(length(word)) AS chars FROM c JOIN p ON p.doc_id = c.doc_id AND p.pos = c.p GROUP BY ALL
  ), rr AS (
    SELECT doc_id, coalesce(max(words) FILTER (n = 3), 0) AS triples,
      {", ".join(f"coalesce(max(chars) FILTER (n = {n}), 0) AS c{n}" for n in range(5, 11))} FROM r GROUP BY doc_id
  ), line AS (
    SELECT doc_id, line, row_number() OVER (PARTITION BY doc_id, line ORDER BY pos) AS nth, regexp_extract_all(line, {_SPACED}) AS w
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS pos FROM documents)
  ), ll AS (
    SELECT doc_id, count(*) AS dup, sum(list_sum(list_transform(w, lambda x: length(x)))) AS chars FROM line WHERE nth > 1 AND len(w) > 0 GROUP BY doc_id
  ), m AS (
    SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
      CAST(length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
      CAST(coalesce(triples, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(ll.chars, 0) AS BIGINT) AS dup_line_chars,
      [{", ".join(f"CAST(coalesce(c{n}, 0) AS BIGINT)" for n in range(5, 11))}] AS dup_ngram_chars
    FROM d JOIN documents USING (doc_id) LEFT JOIN rr USING (doc_id) LEFT JOIN ll USING (doc_id)
  ), v AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
  SELECT *, NOT (base_failed OR dup_line_chars > 0.3 * word_chars OR n_symbols > 0.1 * n_words
    OR list_max(dup_ngram_chars) > 0.4 * word_chars) AS kept FROM v
"""

_WORDS = "|".join(("casino", "poker", "porn", "xxx", "viagra", "torrent", "warez"))

OP7 = rf"""
  WITH rules(rule, verdict, host, path) AS (VALUES ('com/', 'allow', 'com', '/'), ('example.com/en/', 'block', 'example.com', '/en/'),
    ('www.example.com/en/', 'allow', 'www.example.com', '/en/'), ('net/es/', 'block', 'net', '/es/'), ('net/fr/', 'block', 'net', '/fr/')),
  u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
  a AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
  f AS (SELECT a.*, (SELECT max_by(struct_pack(rule := r.rule, verdict := r.verdict), length(r.rule)) FROM rules r
    WHERE (a.host = r.host OR ends_with(a.host, '.' || r.host)) AND starts_with(a.path, r.path)) AS best FROM a)
  SELECT page_id, host, path, best.rule AS rule, CASE WHEN best IS NOT NULL THEN best.verdict WHEN host = ''
    OR regexp_matches(host || path, '(^|[^A-Za-z0-9])({_WORDS})([^A-Za-z0-9]|$)')
    OR regexp_matches(host || path, '/download/(?s:.*)\.(exe|msi|apk|zip|rar|iso)$')
    OR regexp_matches(host || path, '^\d+\.\d+\.\d+\.\d+(:\d+)?(/|$)') THEN 'block' ELSE 'allow' END AS verdict
  FROM f
"""

#: Blocks of equal neighbouring roles have a head each; marks and escapes are counted.
OP9 = r"""
  WITH t AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
  ), o AS (
    SELECT *, coalesce(role <> lag(role) OVER w, true) AS head,
      replace(replace(replace(text, '\', '\\'), '### ', '##\# '), '</turn>', '<\/turn>') AS escaped,
      replace(replace(replace(replace(role, '\', '\\'), '### ', '##\# '), '</turn>', '<\/turn>'), ':', '\:') AS name
    FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
  )
  SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
    CAST(sum(length(escaped) + 7 + CASE WHEN head THEN 7 + length(name) ELSE 0 END) - 1 AS BIGINT) AS formatted_chars
  FROM o GROUP BY conv_id
"""

#: CRC-32 by bytes, from a table that the rule makes; ``t`` is that table.
_CRC_TABLE = """SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))"""


def _crc(text: str) -> str:
    code = f"hex(encode({text}))"
    byte = f"list_transform(range(0, length({code}) // 2), lambda k: CAST('0x' || substr({code}, CAST(2 * k + 1 AS INTEGER), 2) AS BIGINT))"
    return f"xor(list_reduce(list_concat([4294967295], {byte}), lambda a, b: xor(t[CAST((xor(a, b) & 255) + 1 AS INTEGER)], a >> 8)), 4294967295)"


#: Near words share what is left without one letter, or one of them is what is left.
OP11 = rf"""
  WITH RECURSIVE crc AS ({_CRC_TABLE}),
  r AS (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
  u AS (SELECT doc_id, run, count(*) AS n FROM r WHERE length(run) >= 7 GROUP BY ALL),
  h AS (SELECT run, n, {_crc("concat(doc_id, ':', run)")} AS h FROM u, crc),
  s AS (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
  w AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM s WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
  d AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
  p AS (SELECT a.word AS a, b.word AS b FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
    UNION SELECT d.word, w.word FROM d JOIN w ON d.rest = w.word UNION SELECT w.word, d.word FROM d JOIN w ON d.rest = w.word),
  b AS (SELECT a, b, n, count(*) OVER (PARTITION BY a) AS near, row_number() OVER (PARTITION BY a ORDER BY n DESC, b) AS nth FROM p JOIN w ON b = word),
  f AS (SELECT w.word, w.n, coalesce(near, 0) AS n_near, CASE WHEN b.n >= 10 * w.n THEN b.b END AS form, CASE WHEN b.n >= 10 * w.n THEN b.n END AS form_n
    FROM w LEFT JOIN b ON b.a = w.word AND nth = 1),
  c AS (SELECT word, form AS root FROM f WHERE form IS NOT NULL UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.root WHERE f.form IS NOT NULL),
  e AS (SELECT word, root FROM c WHERE root NOT IN (SELECT word FROM f WHERE form IS NOT NULL))
  SELECT f.word, form, coalesce(root, f.word) AS root, n, n_near, form_n FROM f LEFT JOIN e ON e.word = f.word
"""

#: Stretches of equal words at one distance; one whose period is a multiple of another run's around it goes.
OP12 = rf"""
  WITH crc AS ({_CRC_TABLE}),
  h AS (SELECT doc_id, w, {_crc("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h FROM ({_words("coalesce(text, '')", _SPACED)}), crc),
  g AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS plant, (h // 10) % greatest(1, len(w)) AS a, 3 + (h // 10) % 8 AS k FROM h),
  d AS (SELECT doc_id, len(w) AS n, CASE WHEN plant THEN list_transform(range(len(w)), lambda i: w[CASE WHEN i < a THEN i
    ELSE a + (i - a) % (1 + (len(w) - a) // k) END + 1]) ELSE w END AS w FROM g),
  x AS (SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS pos FROM d),
  y AS (SELECT x.doc_id, x.pos, y.pos - x.pos AS p FROM x JOIN x y ON x.doc_id = y.doc_id AND x.word = y.word AND y.pos > x.pos AND 3 * (y.pos - x.pos) <= x.n),
  z AS (SELECT doc_id, p, min(pos) AS start, count(*) + p AS length FROM (SELECT *, pos - row_number() OVER (PARTITION BY doc_id, p ORDER BY pos) AS island FROM y)
    GROUP BY doc_id, p, island HAVING count(*) + p >= greatest(24, 3 * p)),
  r AS (SELECT doc_id, start, CAST(length AS BIGINT) AS length, p AS period FROM z WHERE NOT EXISTS (SELECT 1 FROM z v
    WHERE v.doc_id = z.doc_id AND v.p < z.p AND z.p % v.p = 0 AND v.start <= z.start AND v.start + v.length >= z.start + z.length)),
  s AS (SELECT doc_id, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS runs FROM r GROUP BY doc_id),
  b AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY length / period DESC, start, period) AS nth FROM r),
  o AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS pos FROM r),
  k AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS kept FROM x ANTI JOIN o USING (doc_id, pos) GROUP BY doc_id)
  SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start, length, period, 1000 * length // period AS exponent_milli,
    sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
  FROM d LEFT JOIN s USING (doc_id) LEFT JOIN b ON b.doc_id = d.doc_id AND nth = 1 LEFT JOIN k ON k.doc_id = d.doc_id
"""

#: The article of these pages: ``<b>`` stands inside a block, other marks around blocks.
OP13 = r"""
  WITH a AS (SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*)</article>', 1) AS article FROM pages),
  t AS (SELECT page_id, url, trim(regexp_replace(regexp_replace(regexp_replace(article, '</?b>', '', 'g'), '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g')) AS raw FROM a),
  d AS (SELECT page_id, url, replace(replace(replace(replace(raw, '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&') AS text FROM t)
  SELECT page_id, url, text, length(text) AS n_chars FROM d
"""
