"""SQL twins of this package's queries, for DuckDB."""

from __future__ import annotations

from textmill.llm import mixing, quality_rules as q, url_rules

ORACLES: dict[str, str] = {}

_RULE_ROWS = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in url_rules.RULES)

ORACLES["op1_quality_rules"] = rf"""
WITH docs AS (
  SELECT doc_id, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, source, text, w, len(w) AS n_words,
         CASE WHEN len(w) < 3 THEN [] ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]
              FOR i IN range(1, len(w) - 1)] END AS t
  FROM docs),
placed AS (SELECT doc_id, unnest(t) AS t, unnest(range(1, len(t) + 1)) AS p FROM windows),
repeated AS (SELECT doc_id, p FROM placed QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
covered AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM repeated, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
identity AS (SELECT doc_id, md5(text) AS identity FROM docs),
lines AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM docs),
worded AS (SELECT * FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM worded GROUP BY doc_id),
normal AS (
  SELECT doc_id, source, identity,
         lower(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g'))) AS line,
         len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n
  FROM worded JOIN identity USING (doc_id)),
hosts AS (SELECT source, count(DISTINCT identity) AS n FROM normal GROUP BY source),
counted AS (
  SELECT source, line, count(DISTINCT identity) AS n, min(doc_id) AS first_id FROM normal GROUP BY source, line),
frequent AS (
  SELECT c.source, c.line, c.first_id FROM counted c JOIN hosts h ON c.source IS NOT DISTINCT FROM h.source
  WHERE c.n > {q.MAX_LINE_DOCS} AND (c.n * 1000 > h.n * {q.MAX_LINE_PER_MILLE} OR c.n > {q.ALWAYS_LINE_DOCS})),
removed AS (
  SELECT n.doc_id, sum(n.n) AS n FROM normal n
  JOIN frequent f ON n.line = f.line AND n.source IS NOT DISTINCT FROM f.source
  WHERE n.doc_id <> f.first_id GROUP BY n.doc_id),
based AS (
  SELECT d.doc_id, d.n_words::BIGINT AS n_words,
         length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
         removed.n AS n_removed, (d.n_words - coalesce(removed.n, 0))::BIGINT AS n_left
  FROM windows d LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id) LEFT JOIN removed USING (doc_id)),
failed AS (
  SELECT *, n_words < {q.MIN_WORDS} OR 100 * n_repeat_words > {q.MAX_REPEAT_PERCENT} * n_words AS base_failed,
         n_removed IS NOT NULL AND (n_left < {q.MIN_LEFT_WORDS} OR 100 * n_left < {q.MIN_LEFT_PERCENT} * n_words)
           AS depleted
  FROM based)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT depleted AS kept, n_left
FROM failed
"""

ORACLES["op4_url_filters"] = rf"""
WITH parsed AS (
  SELECT page_id, url,
         CASE WHEN instr(coalesce(url, ''), '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{url_rules._UPPER}', '{url_rules._LOWER}') AS host,
         regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path
  FROM parsed),
rules(verdict, rule_host, rule_path) AS (VALUES {_RULE_ROWS}),
fits AS (
  SELECT page_id, url, max((length(rule_host || rule_path), length(rule_host), rule_host || rule_path, verdict)) AS best
  FROM (SELECT DISTINCT page_id, url, host, path FROM parts)
  JOIN rules ON starts_with(path, rule_path) AND (host = rule_host OR ends_with(host, '.' || rule_host))
  GROUP BY page_id, url)
SELECT p.page_id, p.host, p.path, f.best[3] AS rule, coalesce(f.best[4], '{url_rules.ALLOW}') AS verdict
FROM parts p LEFT JOIN fits f ON p.page_id IS NOT DISTINCT FROM f.page_id AND p.url IS NOT DISTINCT FROM f.url
"""

_WEIGHT_LIST = ", ".join(map(str, mixing.WEIGHTS))
ORACLES["op7_mixing"] = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, coalesce('1' || source, '2') AS key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents),
sources AS (
  SELECT key, sum(size)::BIGINT AS s,
         ([{_WEIGHT_LIST}])[((row_number() OVER (ORDER BY key)) - 1) % {len(mixing.WEIGHTS)} + 1] AS w
  FROM sized GROUP BY key),
shares AS (
  SELECT 0 AS round, key, s, w, false AS capped, 0.0::DOUBLE AS level FROM sources
  UNION ALL
  SELECT round + 1, key, s, w, (capped OR next_level * w > {mixing.MAX_COPIES} * s), next_level
  FROM (SELECT *, ((sum(s) OVER ()) - coalesce(sum(CASE WHEN capped THEN {mixing.MAX_COPIES} * s END) OVER (), 0))::DOUBLE
                  / (sum(CASE WHEN capped THEN 0 ELSE w END) OVER ()) AS next_level FROM shares)
  WHERE round <= (SELECT count(*) FROM sources)),
targets AS (
  SELECT key, s, CASE WHEN capped THEN ({mixing.MAX_COPIES} * s)::DOUBLE ELSE w * level END AS target
  FROM shares WHERE round = (SELECT max(round) FROM shares)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY size DESC, doc_id) AS place FROM sized),
rated AS (
  SELECT doc_id, size, s AS source_size, target, place, CASE WHEN s > 0 THEN target / s ELSE 0.0 END AS rate,
         ('0x' || substr(md5('{mixing.SEED}' || key), 1, 8))::BIGINT / 4294967296.0::DOUBLE AS u
  FROM ranked JOIN targets USING (key))
SELECT doc_id, size, source_size, target,
       (size * least(floor(place * rate + u) - floor((place - 1) * rate + u), {mixing.MAX_COPIES}))::BIGINT AS taken
FROM rated
"""

ORACLES["op2_minhash"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
         ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END) AS s
  FROM docs),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS s FROM sets),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS common
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY a.doc_id, b.doc_id),
links AS (SELECT a, b FROM shared WHERE 100 * common >= 85 * (na + nb - common)),
reach AS (
  SELECT doc_id AS node, doc_id AS seen FROM sets
  UNION
  SELECT r.node, l.b FROM reach r JOIN links l ON r.seen = l.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, min(r.seen) AS component_id, min(r.seen) = s.doc_id AS kept
FROM sets s JOIN reach r ON s.doc_id = r.node GROUP BY s.doc_id, s.s
"""

ORACLES["op5_decontamination"] = r"""
WITH folded AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 'b', item_id, text FROM benchmark),
tokens AS (
  SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM folded),
grams AS (
  SELECT DISTINCT id AS item_id, least(len(w), 10) AS n,
         unnest([array_to_string(w[i:i + least(len(w), 10) - 1], ' ') FOR i IN range(1, len(w) - least(len(w), 10) + 2)]) AS g
  FROM tokens WHERE kind = 'b' AND len(w) > 0),
lengths AS (SELECT DISTINCT n FROM grams),
windows AS (
  SELECT id AS doc_id, n, unnest(range(1, len(w) - n + 2)) AS p,
         unnest([array_to_string(w[i:i + n - 1], ' ') FOR i IN range(1, len(w) - n + 2)]) AS g
  FROM tokens, lengths WHERE kind = 'd' AND len(w) >= n),
hits AS (SELECT doc_id, p, n, item_id FROM windows JOIN grams USING (n, g)),
covered AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT DISTINCT doc_id, unnest(range(p, p + n)) AS word FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT t.id AS doc_id, len(t.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM tokens t LEFT JOIN covered c ON t.id = c.doc_id LEFT JOIN items i ON t.id = i.doc_id WHERE t.kind = 'd'
"""

ORACLES["op6_chat_formatting"] = r"""
WITH m AS (
  SELECT conv_id, turn, role, text, length(text) AS n,
         CASE WHEN role = 'assistant' THEN 'call' WHEN role = 'user' AND turn > 0 THEN 'result' ELSE 'message' END AS kind
  FROM conversations),
tagged AS (
  SELECT *, CASE kind WHEN 'call' THEN 'c' || conv_id || '-' || turn WHEN 'result' THEN 'c' || conv_id || '-' || (turn - 1) END AS call_id,
         CASE WHEN kind = 'call' THEN (['compute', 'lookup', 'search'])[n % 3 + 1] END AS name,
         CASE WHEN kind = 'call' AND turn >= 2 THEN 'c' || conv_id || '-' || (turn - 2) END AS needed
  FROM m),
known AS (SELECT conv_id, kind, call_id, min(turn) AS first_turn FROM tagged WHERE call_id IS NOT NULL GROUP BY ALL),
joined AS (
  SELECT t.*, k.first_turn, c.first_turn AS c_turn, r.first_turn AS r_turn, d.first_turn AS d_turn
  FROM tagged t
  LEFT JOIN known k ON t.conv_id = k.conv_id AND t.kind = k.kind AND t.call_id = k.call_id
  LEFT JOIN known c ON t.conv_id = c.conv_id AND c.kind = 'call' AND t.call_id = c.call_id
  LEFT JOIN known r ON t.conv_id = r.conv_id AND r.kind = 'result' AND t.call_id = r.call_id
  LEFT JOIN known d ON t.conv_id = d.conv_id AND d.kind = 'call' AND t.needed = d.call_id),
written AS (
  SELECT conv_id, turn, kind, call_id,
    CASE WHEN kind = 'message' THEN 'plain' WHEN turn <> first_turn THEN 'repeated'
         WHEN kind = 'call' AND r_turn IS NOT NULL THEN 'answered' WHEN kind = 'call' THEN 'unanswered'
         WHEN c_turn IS NOT NULL THEN 'linked' ELSE 'orphan' END AS status,
    CASE WHEN kind = 'call' THEN concat_ws('; ',
      CASE WHEN name = 'search' AND needed IS NULL THEN 'after: missing' END,
      CASE WHEN n % 5 = 0 THEN 'limit: not integer' END,
      CASE WHEN name = 'compute' AND needed IS NOT NULL THEN 'after: unknown' END,
      CASE WHEN needed IS NOT NULL AND d_turn IS NULL THEN 'no call ' || needed END) ELSE '' END AS errors,
    CASE WHEN kind = 'call' THEN
      '{"arguments":{' || CASE WHEN needed IS NOT NULL THEN '"after":"$' || needed || '",' ELSE '' END ||
      '"limit":' || CASE WHEN n % 5 = 0 THEN '"' || n || '"' ELSE n::VARCHAR END || ',"query":' ||
      to_json(text)::VARCHAR || '},"call_id":"' || call_id || '","kind":"call","name":"' || name ||
      '","role":' || to_json(role)::VARCHAR || '}'
    ELSE '{' || CASE WHEN call_id IS NOT NULL THEN '"call_id":"' || call_id || '",' ELSE '' END ||
      CASE WHEN text IS NOT NULL THEN '"content":' || to_json(text)::VARCHAR || ',' ELSE '' END ||
      '"kind":"' || kind || '","role":' || to_json(role)::VARCHAR || '}' END AS json
  FROM joined)
SELECT conv_id, turn, kind, call_id, status, errors, json,
       row_number() OVER (PARTITION BY conv_id ORDER BY turn,
         CASE kind WHEN 'call' THEN 1 WHEN 'result' THEN 2 ELSE 0 END, call_id, json) AS position
FROM written
"""

# CRC-32 of bytes ``b`` (a list of numbers), bit by bit.
_CRC = (
    "xor(list_reduce(list_prepend(4294967295::BIGINT, {bytes}), lambda c, b: "
    "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"
)


def _written(column: str) -> str:
    return f"coalesce(octet_length(encode({column}::VARCHAR)) || ':' || {column}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return f"sha256({' || '.join(map(_written, ('doc_id', 'source', 'lang', n_chars, 'text')))})"


_DIGITS = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)"
_NEXT_LEVEL = "[sha256(h[2 * i + 1] || coalesce(h[2 * i + 2], '')) FOR i IN range(0, (len(h) + 1) // 2)]"
ORACLES["op13_merkle"] = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
         CASE WHEN {_CRC.format(bytes=_DIGITS)} % 7 = 0 THEN {_leaf("(n_chars + 1)")} ELSE {_leaf("n_chars")} END AS claimed
  FROM documents),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, claimed) - 1 AS pos FROM leaves),
levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY pos) AS h FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, {_NEXT_LEVEL} FROM levels WHERE len(h) > 1),
subroots AS (
  SELECT lang, h[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(h) = 1),
top AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS h FROM subroots
  UNION ALL
  SELECT level + 1, {_NEXT_LEVEL} FROM top WHERE len(h) > 1),
climb AS (
  SELECT doc_id, lang, leaf, 0 AS level, pos, claimed AS folded, '' AS proof FROM placed
  UNION ALL
  SELECT doc_id, c.lang, leaf, c.level + 1, pos // 2,
         sha256(CASE WHEN pos % 2 = 1 THEN h[pos] || folded ELSE folded || coalesce(h[pos + 2], '') END),
         proof || CASE WHEN pos % 2 = 1 THEN h[pos] ELSE coalesce(h[pos + 2], '') END
  FROM climb c JOIN levels l ON c.level = l.level AND c.lang IS NOT DISTINCT FROM l.lang WHERE len(h) > 1),
ended AS (
  SELECT c.doc_id, c.leaf, c.folded, c.proof, s.subroot, s.place FROM climb c
  JOIN levels l ON c.level = l.level AND c.lang IS NOT DISTINCT FROM l.lang AND len(l.h) = 1
  JOIN subroots s ON c.lang IS NOT DISTINCT FROM s.lang),
upper AS (
  SELECT doc_id, leaf, subroot, 0 AS level, place AS pos, folded, proof FROM ended
  UNION ALL
  SELECT doc_id, leaf, subroot, u.level + 1, pos // 2,
         sha256(CASE WHEN pos % 2 = 1 THEN h[pos] || folded ELSE folded || coalesce(h[pos + 2], '') END),
         proof || CASE WHEN pos % 2 = 1 THEN h[pos] ELSE coalesce(h[pos + 2], '') END
  FROM upper u JOIN top t ON u.level = t.level WHERE len(h) > 1)
SELECT doc_id, leaf, subroot, h[1] AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = h[1] AS verified
FROM upper u JOIN top t ON u.level = t.level AND len(t.h) = 1
"""

# UTF-8 bytes of a text whose code points lie below 256.
_RUN_BYTES = (
    "flatten(list_transform(string_split({text}, ''), lambda y: CASE WHEN ord(y) < 128 THEN [ord(y)::BIGINT] "
    "ELSE [192 + (ord(y)::BIGINT >> 6), 128 + (ord(y)::BIGINT & 63)] END))"
)
ORACLES["op12_spelling"] = rf"""
WITH RECURSIVE runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents),
hashed AS (
  SELECT run, times, {_CRC.format(bytes=_RUN_BYTES.format(text="coalesce(doc_id::VARCHAR, '') || ':' || run"))} AS h
  FROM (SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 7 GROUP BY doc_id, run)),
words AS (
  SELECT word, sum(times)::BIGINT AS n
  FROM (SELECT times, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word
        FROM hashed)
  WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
cut AS (
  SELECT word, n, p, substr(word, 1, p - 1) || substr(word, p + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS p FROM words)),
pairs AS (
  SELECT a.word AS a, b.word AS b FROM cut a JOIN cut b ON a.p = b.p AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN words w ON c.rest = w.word),
near AS (
  SELECT a AS word, count(*) AS n_near, min((-n, b)) AS best FROM pairs JOIN words ON b = word GROUP BY a),
formed AS (
  SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best[1] >= 10 * n THEN best[2] END AS form,
         CASE WHEN -best[1] >= 10 * n THEN (-best[1])::BIGINT END AS form_n
  FROM words LEFT JOIN near USING (word)),
climb AS (
  SELECT word, word AS root, form AS up FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM climb c JOIN formed f ON c.up = f.word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN (SELECT word, root FROM climb WHERE up IS NULL) USING (word)
"""
