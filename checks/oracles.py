"""SQL twins of the registered queries, for DuckDB over the same parquet tables.

They state the rules a second time in relational form: tokens as rows, sentence state as window functions, bracket
rules as recursive queries.
"""

from __future__ import annotations

from checks.inputs import (
    ANALYSER,
    BLANKS_FROM,
    BLANKS_TO,
    BRACKETED_FROM,
    BRACKETED_TO,
    FROM,
    NUMBERED_FROM,
    NUMBERED_TO,
    TO,
)
from checks.queries import VOCAB_OVERRIDE

SPACE = (
    r"\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
)
KANA = r"\x{3040}-\x{309F}\x{30A0}-\x{30FF}\x{FF65}-\x{FF9F}"
JAPANESE = KANA + r"\x{4E00}-\x{9FFF}"
EMOJI = r"\x{2600}-\x{27BF}\x{1F300}-\x{1F6FF}\x{1F900}-\x{1F9FF}"
PAIRS = ("（）", "()", "［］", "[]", "【】", "「」", "｢｣", "＜＞", "<>")


def lit(text: str) -> str:
    special = {c: f"chr({ord(c)})" for c in text if ord(c) < 0x20}
    if not special:
        return "'" + text.replace("'", "''") + "'"
    return "(" + " || ".join(special.get(c) or lit(c) for c in text) + ")"


def any_of(values) -> str:
    return "(" + ", ".join(lit(v) for v in values) + ")"


def strip(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '^[{SPACE}]+', ''), '[{SPACE}]+$', '')"


def lstrip(x: str) -> str:
    return f"regexp_replace({x}, '^[{SPACE}]+', '')"


def rstrip(x: str) -> str:
    return f"regexp_replace({x}, '[{SPACE}]+$', '')"


def count_of(x: str, char_class: str) -> str:
    return f"len(regexp_extract_all({x}, '[{char_class}]'))"


def density(x: str) -> str:
    useful = f"({count_of(x, JAPANESE)} + {count_of(x, '、。・！？!?,.')} + {count_of(x, '0-9０-９')})"
    return f"CASE WHEN {x} = '' THEN 0.0 ELSE {useful}::DOUBLE / length({x}) END"


def starts_valid(x: str) -> str:
    bare = strip(f"regexp_replace({x}, '[{EMOJI}]', '', 'g')")
    opened = strip(f"regexp_replace({bare}, '^[＞>［\\[＜<【｢「（(：:]+', '')")
    return f"regexp_matches({opened}, '^[{JAPANESE}A-Za-zＡ-Ｚａ-ｚ0-9０-９]')"


def japanese(x: str) -> str:
    return f"translate({x}, {lit(FROM)}, {lit(TO)})"


def normalized(x: str) -> str:
    return f"translate({x}, {lit(ANALYSER.FOLD_FROM)}, {lit(ANALYSER.FOLD_TO)})"


def list_number(x: str) -> str:
    return f"regexp_replace({x}, '^[0-9０-９]+[）)．.][{SPACE}]*', '')"


def leading_marks(x: str) -> str:
    return strip(f"regexp_replace({x}, '^[＞>：:{SPACE}]+', '')")


# Building blocks: named common table expressions.

DOCS = f"docs AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, {japanese('text')} AS text FROM documents)"


def line_cte(docs: str = "docs") -> str:
    return f"""lines AS (
  SELECT doc_id, line_no, {strip('line')} AS line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
           generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no FROM {docs})
  WHERE {strip('line')} <> '')"""


def chunk_cte(max_bytes: int = 10**12, size: int = 10_000) -> str:
    return f"""pieces AS (
  SELECT doc_id, line_no, CASE WHEN strlen(line) > {max_bytes}
      THEN list_transform(range(0, length(line), {size}), lambda i: substr(line, i + 1, {size}))
      ELSE [line] END AS parts FROM lines),
chunks AS (SELECT doc_id, line_no, unnest(parts) AS chunk, generate_subscripts(parts, 1) - 1 AS chunk_no FROM pieces)"""


def token_cte(mode: str = "C") -> str:
    return f"""toks AS (
  SELECT doc_id, line_no, chunk_no, unnest(l) AS tok, generate_subscripts(l, 1) AS pos FROM (
    SELECT doc_id, line_no, chunk_no, regexp_extract_all(chunk, '{ANALYSER.PATTERNS[mode]}') AS l FROM chunks))"""


_STOPS, _COMMAS = tuple(ANALYSER.STOPS), tuple(ANALYSER.COMMAS)
TAGGED = f"""tagged AS (
  SELECT *,
    CASE WHEN regexp_matches(tok, '^[{SPACE}]$') THEN '空白'
         WHEN tok IN {any_of(_STOPS + _COMMAS + tuple(ANALYSER.SYMBOLS + "「｢」｣‥・"))} THEN '補助記号'
         WHEN regexp_matches(tok, '^[{EMOJI}]') THEN '補助記号'
         WHEN tok IN {any_of(ANALYSER.PARTICLES + ANALYSER.OTHER_PARTICLES)} THEN '助詞'
         WHEN tok IN {any_of(ANALYSER.AUXILIARIES)} THEN '助動詞'
         WHEN regexp_matches(tok, '[{ANALYSER.CONCLUSIVE_ENDINGS}{ANALYSER.CONTINUATIVE_ENDINGS}]$') THEN '動詞'
         WHEN regexp_matches(tok, '[{ANALYSER.ADJECTIVE_ENDINGS}]$') THEN '形容詞'
         ELSE '名詞' END AS class,
    CASE WHEN tok IN {any_of(_STOPS)} THEN '句点' WHEN tok IN {any_of(_COMMAS)} THEN '読点' ELSE '一般' END AS sub,
    CASE WHEN tok IN {any_of(ANALYSER.PARTICLES + ANALYSER.OTHER_PARTICLES)} THEN '*'
         WHEN tok IN {any_of(ANALYSER.AUXILIARIES)} THEN '終止形-一般'
         WHEN regexp_matches(tok, '[{ANALYSER.CONCLUSIVE_ENDINGS}{ANALYSER.ADJECTIVE_ENDINGS}]$') THEN '終止形-一般'
         WHEN regexp_matches(tok, '[{ANALYSER.CONTINUATIVE_ENDINGS}]$') THEN '連用形-一般'
         ELSE '*' END AS conj
  FROM toks)"""

SENTS = f"""flags AS (
  SELECT *, class IN ('動詞', '形容詞', '助動詞') AS pred,
    coalesce(last_value(CASE WHEN tok IN ('「', '｢') THEN true WHEN tok IN ('」', '｣') THEN false END IGNORE NULLS)
      OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), false) AS quoted,
    coalesce(lag(contains(conj, '終止形')) OVER w, false) AS after_final,
    coalesce(lag(class IN ('動詞', '形容詞', '助動詞')) OVER w, false) AS after_pred
  FROM tagged WINDOW w AS (PARTITION BY doc_id, line_no, chunk_no ORDER BY pos)),
cuts AS (
  SELECT *, NOT quoted AND (contains(sub, '句点')
      OR (contains(class, '補助記号') AND after_final) OR (contains(class, '空白') AND after_final)
      OR (regexp_matches(tok, '^[{EMOJI}]') AND after_pred)) AS cut FROM flags),
numbered AS (
  SELECT *, coalesce(sum(cut::INT) OVER (PARTITION BY doc_id, line_no, chunk_no ORDER BY pos
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS sent_no FROM cuts),
built AS (
  SELECT doc_id, line_no, chunk_no, sent_no, string_agg(tok, '' ORDER BY pos) AS whole, bool_or(pred) AS has_pred,
    arg_max({{'tok': tok, 'class': class, 'sub': sub, 'conj': conj}}, pos) AS z,
    arg_max({{'tok': tok, 'class': class, 'sub': sub, 'conj': conj}}, pos)
      FILTER (WHERE class NOT IN ('補助記号', '空白')) AS w
  FROM numbered GROUP BY ALL),
sents AS (
  SELECT doc_id, line_no, chunk_no, sent_no, {strip('whole')} AS raw,
    CASE WHEN NOT has_pred THEN 'no_predicate'
         WHEN contains(z.sub, '読点') OR z.tok IN ('、', ',') THEN 'ends_comma'
         WHEN w IS NULL THEN 'no_content'
         WHEN w.class = '助詞' AND w.tok IN ('が', 'と', 'に', 'を', 'は', 'も') THEN 'ends_particle'
         WHEN NOT contains(z.sub, '句点') AND contains(w.conj, '連用形') THEN 'ends_continuative'
         WHEN contains(whole, '[[') OR contains(whole, ']]') THEN 'markup'
         WHEN z.tok IN ('‥', '・') THEN 'ends_mark' END AS fault
  FROM built)"""


def matched_cte(source: str) -> str:
    """``source`` has distinct ``t0``; gives matched(t0, t)."""
    return f"""m(t0, t, n) AS (
  SELECT t0, t0, 0 FROM {source}
  UNION ALL
  SELECT t0, {strip('substr(t, 2, length(t) - 2)')}, n + 1 FROM m WHERE left(t, 1) || right(t, 1) IN {any_of(PAIRS)}),
matched AS (SELECT t0, arg_max(t, n) AS t FROM m GROUP BY t0)"""


def unbalanced_cte(source: str) -> str:
    """``source`` has distinct ``t0``; gives balanced(t0, t)."""

    def more(a: str, b: str) -> str:
        return f"length(replace(t, '{a}', '')) < length(replace(t, '{b}', ''))"

    head, tail = lstrip("substr(t, 2)"), rstrip("left(t, length(t) - 1)")
    rules = "\n".join(
        f"""    WHEN left(t, 1) = '{a}' AND {more(a, b)} THEN {head}
    WHEN left(t, 1) = '{b}' AND {more(b, a)} THEN {head}
    WHEN right(t, 1) = '{b}' AND {more(b, a)} THEN {tail}
    WHEN right(t, 1) = '{a}' AND {more(a, b)} THEN {tail}"""
        for a, b in PAIRS
    )
    edges = any_of("".join(PAIRS))
    return f"""u(t0, t, n) AS (
  SELECT t0, t0, 0 FROM {source}
  UNION ALL
  SELECT t0, nxt, n + 1 FROM (SELECT t0, n, CASE
{rules} END AS nxt FROM u WHERE left(t, 1) IN {edges} OR right(t, 1) IN {edges}) WHERE nxt IS NOT NULL),
balanced AS (SELECT t0, arg_max(t, n) AS t FROM u GROUP BY t0)"""


RATED = f"""early AS (
  SELECT *, coalesce(fault, CASE WHEN NOT {starts_valid('raw')} THEN 'bad_start'
    WHEN NOT regexp_matches(raw, '[{KANA}]') THEN 'no_kana' END) AS early FROM sents WHERE raw <> ''),
opened AS (SELECT *, {list_number(leading_marks('raw'))} AS opened FROM early),
todo AS (SELECT DISTINCT opened AS t0 FROM opened WHERE early IS NULL),
{matched_cte('todo')},
todo2 AS (SELECT DISTINCT t AS t0 FROM matched),
{unbalanced_cte('todo2')},
cleaned AS (
  SELECT o.*, CASE WHEN early IS NULL
      THEN regexp_replace({list_number('b.t')}, '[{SPACE}]+', '', 'g') END AS clean
  FROM opened o LEFT JOIN matched a ON o.opened = a.t0 LEFT JOIN balanced b ON a.t = b.t0),
dense AS (SELECT *, CASE WHEN clean IS NOT NULL THEN {density('clean')} END AS density FROM cleaned),
rated AS MATERIALIZED (
  SELECT doc_id, line_no, chunk_no, sent_no, raw, clean, density,
    coalesce(early, CASE WHEN density < 0.75 THEN 'low_density' END) AS reject_reason,
    CASE WHEN early IS NULL AND density >= 0.75 THEN 'accepted' ELSE 'rejected' END AS status,
    CASE WHEN early IS NULL AND density >= 0.75 THEN {count_of('clean', JAPANESE)} ELSE 0 END::BIGINT AS kept_chars
  FROM dense),
distinct_clean AS (SELECT DISTINCT clean FROM rated WHERE status = 'accepted')"""


def split_of(ratio: float = 0.1) -> str:
    bucket = "CAST('0x' || substr(md5(clean), 1, 8) AS BIGINT) % 1000"
    return f"CASE WHEN {bucket} < {ratio * 1000} THEN 'validation' ELSE 'train' END"


SPLIT = f"split_clean AS (SELECT clean, {split_of()} AS split FROM distinct_clean)"

VOCAB = f"""vocab_texts AS (
  SELECT unnest(regexp_extract_all({japanese('text')}, '{ANALYSER.PATTERNS['C']}')) AS word
  FROM (SELECT text FROM benchmark UNION ALL SELECT text FROM conversations)),
vocab AS MATERIALIZED (
  SELECT word, row_number() OVER (ORDER BY n DESC, word) - 1 AS rank, count(*) OVER () AS total,
    100.0::DOUBLE * (1.0::DOUBLE - (row_number() OVER (ORDER BY n DESC, word) - 1)::DOUBLE / count(*) OVER ()) AS percentile
  FROM (SELECT word, count(*) AS n FROM vocab_texts GROUP BY word))"""


def modes(source: str, text: str, keep: str) -> str:
    return " UNION ALL ".join(
        f"SELECT {keep} '{m}' AS mode, unnest(regexp_extract_all({text}, '{ANALYSER.PATTERNS[m]}')) AS surface FROM {source}"
        for m in "ABC"
    )


COUNTS = """count(*) FILTER (WHERE mode = 'A') AS cnt_a, count(*) FILTER (WHERE mode = 'B') AS cnt_b,
    count(*) FILTER (WHERE mode = 'C') AS cnt_c"""


def freq_cte(source: str = "split_clean") -> str:
    return f"""forms AS ({modes(source, 'clean', 'split,')}),
freq AS MATERIALIZED (SELECT split, surface, {normalized('surface')} AS normalized, {COUNTS} FROM forms GROUP BY ALL)"""


LISTED = """listed AS MATERIALIZED (
  SELECT f.*, coalesce(a.percentile, b.percentile) AS percentile
  FROM freq f LEFT JOIN vocab a ON f.surface = a.word LEFT JOIN vocab b ON f.normalized = b.word)"""

COLLAPSED = """ordered AS (
  SELECT *, row_number() OVER (PARTITION BY split, surface
    ORDER BY cnt_c DESC, cnt_b DESC, cnt_a DESC, normalized) AS rn FROM listed),
collapsed AS MATERIALIZED (
  SELECT split, surface, max(normalized) FILTER (WHERE rn = 1) AS normalized, sum(cnt_a)::BIGINT AS cnt_a,
    sum(cnt_b)::BIGINT AS cnt_b, sum(cnt_c)::BIGINT AS cnt_c, max(percentile) FILTER (WHERE rn = 1) AS percentile
  FROM ordered GROUP BY split, surface)"""

WORDS = """tw AS (SELECT surface, cnt_c, percentile FROM collapsed WHERE split = 'train' AND cnt_c > 0),
vw AS (SELECT surface, cnt_c, percentile FROM collapsed WHERE split = 'validation' AND cnt_c > 0),
words AS MATERIALIZED (
  SELECT coalesce(tw.surface, vw.surface) AS surface, coalesce(tw.cnt_c, 0) AS t, coalesce(vw.cnt_c, 0) AS v,
    tw.percentile AS pt, vw.percentile AS pv FROM tw FULL JOIN vw ON tw.surface = vw.surface)"""


def figures(vocab_size: str) -> str:
    return f"""SELECT count(*) AS union_size, count(*) FILTER (WHERE t > 0 AND v > 0) AS shared,
  count(*) FILTER (WHERE v = 0) AS only_train, count(*) FILTER (WHERE t = 0) AS only_val,
  round(count(*) FILTER (WHERE t > 0 AND v > 0)::DOUBLE / count(*), 6) AS jaccard,
  round(sum(t::DOUBLE * v) / (sqrt(sum(t::DOUBLE * t)) * sqrt(sum(v::DOUBLE * v))), 6) AS cosine,
  round(count(pt)::DOUBLE / (count(*) FILTER (WHERE t > 0) + {vocab_size} - count(pt)), 6) AS jaccard_train_vocab,
  round(count(pv)::DOUBLE / (count(*) FILTER (WHERE v > 0) + {vocab_size} - count(pv)), 6) AS jaccard_val_vocab,
  round(count(pt)::DOUBLE / count(*) FILTER (WHERE t > 0), 6) AS coverage_train,
  round(count(pv)::DOUBLE / count(*) FILTER (WHERE v > 0), 6) AS coverage_val FROM words"""


OOV = f"""clean_tokens AS (SELECT clean, unnest(regexp_extract_all(clean, '{ANALYSER.PATTERNS['C']}')) AS tok FROM distinct_clean),
oov_clean AS (
  SELECT DISTINCT clean FROM clean_tokens
  WHERE tok NOT IN (SELECT word FROM vocab) AND {normalized('tok')} NOT IN (SELECT word FROM vocab)),
flagged AS MATERIALIZED (
  SELECT clean, clean IN (SELECT clean FROM oov_clean) AS oov FROM distinct_clean)"""

POOL = """pool AS (
  SELECT raw AS text, reject_reason, 'documents:' || doc_id || ':' || line_no || ':' || chunk_no || ':' || sent_no AS place
  FROM rated WHERE status = 'rejected'
  UNION ALL SELECT clean, 'oov', '' FROM flagged WHERE oov)"""

CHUNKED = (DOCS, line_cte(), chunk_cte())
SEGMENTED = (*CHUNKED, token_cte(), TAGGED, SENTS)
EXTRACTED = (*SEGMENTED, RATED)
SPLITTED = (*EXTRACTED, SPLIT)
COUNTED = (*SPLITTED, freq_cte())
RANKED = (*COUNTED, VOCAB, LISTED)
COMPARED = (*RANKED, COLLAPSED, WORDS)
FILTERED = (*EXTRACTED, VOCAB, OOV)


def query(parts, select: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + select


SOURCES = """sources AS (
  SELECT 'documents' AS source, CAST(doc_id AS VARCHAR) AS doc_id, text FROM documents
  UNION ALL SELECT 'conversations', conv_id || ':' || turn, text FROM conversations
  UNION ALL SELECT 'pages', CAST(page_id AS VARCHAR), html FROM pages)"""


def by_hash(n: int) -> str:
    return query(
        (SOURCES,),
        f"""SELECT source, doc_id, md5(text) AS digest FROM sources WHERE text IS NOT NULL
ORDER BY digest DESC, source, doc_id LIMIT {n}""",
    )


def translated_lines(source: str, target: str) -> tuple[str, str]:
    docs = f"docs AS (SELECT doc_id, translate(text, {lit(source)}, {lit(target)}) AS text FROM documents)"
    return docs, line_cte()


def token_counts(mode: str) -> str:
    return query(
        (*CHUNKED, token_cte(mode)),
        f"SELECT tok AS surface, {normalized('tok')} AS normalized, count(*) AS cnt FROM toks GROUP BY ALL",
    )


def sample(source: str, key: str, n: int, seed: int = 0) -> str:
    return f"SELECT * FROM {source} ORDER BY md5('{seed}:' || {key}), {key} LIMIT {n}"


NUMBERED_LINES = translated_lines(NUMBERED_FROM, NUMBERED_TO)
BRACKETED_LINES = translated_lines(BRACKETED_FROM, BRACKETED_TO)
BRACKET_TODO = "todo AS (SELECT DISTINCT line AS t0 FROM lines)"
PLACE = "doc_id, line_no, chunk_no, sent_no"
SENTENCE_ROWS = f"SELECT {PLACE}, raw, fault FROM sents WHERE raw <> ''"

ORACLES = {
    "source_union": query(
        (SOURCES,),
        """SELECT source, count(*) AS docs, sum(length(text))::BIGINT AS chars, min(md5(text)) AS first_digest
FROM sources GROUP BY source""",
    ),
    "docs_by_hash": by_hash(200),
    "docs_by_hash_large": by_hash(1_200),
    "line_rows": query((DOCS, line_cte()), "SELECT doc_id, line_no, line FROM lines"),
    "long_line_chunks": query(
        (DOCS, line_cte(), chunk_cte(2_000, 500)), "SELECT doc_id, line_no, chunk_no, chunk FROM chunks"
    ),
    "character_counts": query(
        (DOCS,),
        f"""SELECT doc_id, length(text) AS chars, strlen(text) AS bytes, {count_of('text', JAPANESE)} AS japanese,
  {count_of('text', '、。・！？!?,.')} AS punctuation, {count_of('text', '0-9０-９')} AS digits,
  round({density('text')}, 6) AS density, md5(text) AS digest FROM docs""",
    ),
    "line_tests": query(
        (DOCS, line_cte()),
        f"""SELECT doc_id, line_no, {starts_valid('line')} AS starts_valid, regexp_matches(line, '[{KANA}]') AS has_kana,
  regexp_matches(line, '^[{EMOJI}]') AS emoji_first,
  contains(line, '2022') OR contains(line, '2023') OR contains(line, '⭐') OR contains(line, '▶') AS watched,
  {density('line')} >= 0.75 AS dense FROM lines""",
    ),
    "unicode_strip": f"""SELECT doc_id, piece_no, {strip('piece')} AS stripped, length({lstrip('piece')}) AS left_length,
  length({rstrip('piece')}) AS right_length, regexp_replace(piece, '[{SPACE}]', '', 'g') AS compact
FROM (SELECT doc_id, unnest(l) AS piece, generate_subscripts(l, 1) - 1 AS piece_no FROM (
  SELECT doc_id, string_split(translate(text, {lit(BLANKS_FROM)}, {lit(BLANKS_TO)}), ' ') AS l FROM documents))""",
    "token_cleaning": """SELECT doc_id,
  replace(replace(replace(replace(text, 'e', ' '), 't', ' '), 'a', ' '), chr(10), ' ') AS flat FROM documents""",
    "leading_marks": query(NUMBERED_LINES, f"SELECT doc_id, line_no, {leading_marks('line')} AS text FROM lines"),
    "list_numbers": query(NUMBERED_LINES, f"SELECT doc_id, line_no, {list_number('line')} AS text FROM lines"),
    "matched_brackets": query(
        (*BRACKETED_LINES, BRACKET_TODO, matched_cte("todo")),
        "SELECT doc_id, line_no, t AS text FROM lines JOIN matched ON line = t0",
    ),
    "unbalanced_brackets": query(
        (*BRACKETED_LINES, BRACKET_TODO, unbalanced_cte("todo")),
        "SELECT doc_id, line_no, t AS text FROM lines JOIN balanced ON line = t0",
    ),
    "tokens_mode_a": token_counts("A"),
    "tokens_mode_b": token_counts("B"),
    "tokens_mode_c": token_counts("C"),
    "token_tags": query(
        (*CHUNKED, token_cte(), TAGGED),
        f"""SELECT class AS word_class, sub AS sub_class, conj AS conjugation, count(*) AS tokens,
  count(DISTINCT tok) AS surfaces, max(pos) - 1 AS last_pos, max({normalized('tok')}) AS last_form
FROM tagged GROUP BY ALL""",
    ),
    "top_tokens": query(
        (DOCS, f"forms AS ({modes('docs', 'text', '')})"),
        f"""SELECT *, row_number() OVER (ORDER BY cnt_c DESC, cnt_b DESC, cnt_a DESC, surface, normalized) AS rank FROM (
  SELECT surface_flat AS surface, {normalized('surface_flat')} AS normalized, {COUNTS} FROM (
    SELECT mode, translate(surface, chr(8232) || chr(8233) || chr(10) || chr(13), '    ') AS surface_flat FROM forms)
  GROUP BY ALL) QUALIFY rank <= 2000""",
    ),
    "sentence_rows": query(SEGMENTED, SENTENCE_ROWS),
    "sentence_rows_in_pieces": query(SEGMENTED, SENTENCE_ROWS),
    "sentence_rows_chunked": query(
        (DOCS, line_cte(), chunk_cte(1_000, 200), token_cte(), TAGGED, SENTS), SENTENCE_ROWS
    ),
    "rated_sentences": query(
        EXTRACTED,
        f"SELECT {PLACE}, clean, round(density, 6) AS density, reject_reason, status, kept_chars FROM rated",
    ),
    "reject_reasons": query(
        EXTRACTED,
        "SELECT reject_reason, count(*) AS sentences FROM rated WHERE status = 'rejected' GROUP BY reject_reason",
    ),
    "dedup_in_document": query(
        EXTRACTED,
        f"""SELECT {PLACE}, clean FROM rated WHERE status = 'accepted'
QUALIFY row_number() OVER (PARTITION BY doc_id, clean ORDER BY line_no, chunk_no, sent_no) = 1""",
    ),
    "dedup_global": query(EXTRACTED, "SELECT clean FROM distinct_clean"),
    "dedup_first_copy": query(
        EXTRACTED,
        f"""SELECT clean, {PLACE}, count(*) OVER (PARTITION BY clean) AS copies FROM rated WHERE status = 'accepted'
QUALIFY row_number() OVER (PARTITION BY clean ORDER BY {PLACE}) = 1""",
    ),
    "hash_split": query(
        SPLITTED,
        "SELECT clean, CAST('0x' || substr(md5(clean), 1, 8) AS BIGINT) % 1000 AS bucket, split FROM split_clean",
    ),
    "split_sizes": query(
        EXTRACTED, f"SELECT {split_of(0.25)} AS split, count(*) AS sentences FROM distinct_clean GROUP BY split"
    ),
    "vocabulary_percentiles": query((VOCAB,), "SELECT word, round(percentile, 6) AS percentile FROM vocab"),
    "vocabulary_filter": query(FILTERED, "SELECT clean, oov FROM flagged"),
    "vocabulary_filter_shuffled": query(FILTERED, "SELECT clean, oov FROM flagged"),
    "percentile_lookup": query(
        RANKED, "SELECT split, surface, normalized, round(percentile, 6) AS percentile FROM listed"
    ),
    "vocabulary_absent": query(
        (*RANKED, COLLAPSED),
        """SELECT word, rank, round(percentile, 6) AS percentile FROM vocab
WHERE word NOT IN (SELECT surface FROM collapsed WHERE cnt_c > 0)
  AND word NOT IN (SELECT normalized FROM collapsed WHERE cnt_c > 0) ORDER BY rank LIMIT 50""",
    ),
    "token_frequencies": query(COUNTED, "SELECT * FROM freq"),
    "top_types": query(
        COUNTED,
        """SELECT *, row_number() OVER (PARTITION BY split
  ORDER BY cnt_c DESC, cnt_b DESC, cnt_a DESC, surface, normalized) AS rank FROM freq QUALIFY rank <= 1000""",
    ),
    "surface_counts": query(
        (*RANKED, COLLAPSED),
        """SELECT split, surface, normalized, cnt_a, cnt_b, cnt_c, round(percentile, 6) AS percentile
FROM collapsed""",
    ),
    "document_retention": query(
        EXTRACTED,
        f"""SELECT d.doc_id, {count_of('d.text', JAPANESE)} AS orig_chars,
  coalesce(k.kept_chars, 0)::BIGINT AS kept_chars
FROM docs d LEFT JOIN (SELECT doc_id, sum(kept_chars) AS kept_chars FROM rated GROUP BY doc_id) k
  ON d.doc_id = k.doc_id WHERE d.doc_id IN (SELECT doc_id FROM lines)""",
    ),
    "retention_ratio": query(
        EXTRACTED,
        f"""SELECT orig_chars::BIGINT AS orig_chars, kept_chars::BIGINT AS kept_chars,
  round(kept_chars::DOUBLE / orig_chars, 6) AS ratio
FROM (SELECT sum({count_of('text', JAPANESE)}) AS orig_chars FROM docs),
  (SELECT sum(kept_chars) AS kept_chars FROM rated)""",
    ),
    "split_metadata": query(
        SPLITTED,
        f"""SELECT split, count(*) AS sentence_count, round((SELECT sum(kept_chars) FROM rated)::DOUBLE
    / (SELECT sum({count_of('text', JAPANESE)}) FROM docs), 6) AS kanji_kana_retention_ratio,
  'documents' AS source, 'documents.parquet' AS base FROM split_clean GROUP BY split""",
    ),
    "reject_pool": query(
        (*FILTERED, POOL), "SELECT text, reject_reason, count(*) AS copies FROM pool GROUP BY text, reject_reason"
    ),
    "watched_rejects": query(
        (*FILTERED, POOL),
        sample(
            """(SELECT * FROM pool WHERE contains(text, '2022') OR contains(text, '2023')
  OR contains(text, '⭐') OR contains(text, '▶'))""",
            "place || ':' || text",
            500,
        ),
    ),
    "sampled_rejects": query((*FILTERED, POOL), sample("pool", "place || ':' || text", 100, 7)),
    "sampled_rejects_per_split": query(
        (*FILTERED, POOL),
        """SELECT text, reject_reason, place, split FROM pool, (VALUES ('train'), ('validation')) AS s(split)
WHERE contains(text, '2022') OR contains(text, '2023') OR contains(text, '⭐') OR contains(text, '▶')
QUALIFY row_number() OVER (PARTITION BY split
  ORDER BY md5('7:' || split || ':' || place || ':' || text), split, place, text) <= 100""",
    ),
    "sampled_sentences": query(
        SPLITTED,
        """SELECT clean, split FROM split_clean
QUALIFY row_number() OVER (PARTITION BY split ORDER BY md5('7:' || clean), clean) <= 100""",
    ),
    "top_sentences_by_text": query(EXTRACTED, "SELECT clean FROM distinct_clean ORDER BY clean DESC LIMIT 100"),
    "split_similarity": query(COMPARED, figures("(SELECT count(*) FROM vocab)")),
    "split_similarity_fixed_list": query(
        COMPARED,
        f"SELECT jaccard_train_vocab AS train, jaccard_val_vocab AS validation FROM ({figures(str(VOCAB_OVERRIDE))})",
    ),
    "split_topography": query(
        COMPARED,
        """SELECT count(*) AS union_size, count(*) FILTER (WHERE t > 0 AND v > 0) AS shared,
  count(*) FILTER (WHERE v = 0) AS only_train, count(*) FILTER (WHERE t = 0) AS only_val FROM words""",
    ),
    "split_word_sets": query(
        COMPARED, "SELECT surface, t > 0 AS in_train, v > 0 AS in_val, t > 0 AND v > 0 AS in_both FROM words"
    ),
    "train_only_words": query(COMPARED, "SELECT surface, t AS cnt FROM words WHERE v = 0"),
    "validation_only_top": query(
        COMPARED, "SELECT surface, v AS cnt FROM words WHERE t = 0 ORDER BY cnt DESC, surface LIMIT 50"
    ),
    "unknown_words_top": query(
        COMPARED,
        """(SELECT surface, t AS cnt, 'train' AS split FROM words WHERE t > 0 AND pt IS NULL
  ORDER BY cnt DESC, surface LIMIT 50) UNION ALL
(SELECT surface, v AS cnt, 'validation' AS split FROM words WHERE v > 0 AND pv IS NULL
  ORDER BY cnt DESC, surface LIMIT 50)""",
    ),
    "percentile_gap_outliers": query(
        RANKED,
        """SELECT surface, cnt_c, round(observed, 6) AS observed, round(listed, 6) AS listed,
  round(observed - listed, 6) AS gap, round(abs(observed - listed), 6) AS abs_gap FROM (
  SELECT surface, cnt_c, printf('%.2f', percentile)::DOUBLE AS listed, 100.0::DOUBLE * (1.0::DOUBLE - (row_number() OVER (
      ORDER BY cnt_c DESC, cnt_b DESC, cnt_a DESC, surface) - 1)::DOUBLE / count(*) OVER ()) AS observed
  FROM listed WHERE split = 'train' AND percentile IS NOT NULL AND cnt_c >= 100 AND surface = normalized)
ORDER BY abs(observed - listed) DESC, surface LIMIT 20""",
    ),
    "corpus_files": query(SPLITTED, "SELECT split, clean FROM split_clean"),
    "frequency_files": query(
        RANKED,
        """SELECT surface, normalized, cnt_a, cnt_b, cnt_c, printf('%.2f', percentile)::DOUBLE AS percentile, split FROM (
  SELECT *, row_number() OVER (PARTITION BY split
    ORDER BY cnt_c DESC, cnt_b DESC, cnt_a DESC, surface, normalized) AS rank FROM listed) WHERE rank <= 1000""",
    ),
    "corpus_build": query(
        (
            *FILTERED,
            f"split_clean AS (SELECT clean, {split_of()} AS split FROM flagged WHERE NOT oov)",
            freq_cte(),
            LISTED,
            COLLAPSED,
            WORDS,
        ),
        figures("(SELECT count(*) FROM vocab)"),
    ),
}

ORACLES |= {
    "source_switch": query(
        (SOURCES,),
        """SELECT source, count(*) AS docs, min(md5(text)) AS first_digest FROM sources
WHERE source <> 'conversations' AND text IS NOT NULL GROUP BY source""",
    ),
    "smoke_documents": query(
        (SOURCES,),
        """SELECT source, doc_id, md5(text) AS digest FROM sources WHERE source = 'documents' AND text IS NOT NULL
ORDER BY digest DESC, doc_id LIMIT 50""",
    ),
    "vocabulary_file": query(
        (VOCAB,),
        f"""SELECT word, row_number() OVER (ORDER BY rank) - 1 AS rank FROM (
  SELECT {strip('word')} AS word, rank FROM vocab WHERE {strip('word')} <> '')""",
    ),
    "outlier_file": ORACLES["percentile_gap_outliers"],
    "sample_files": ORACLES["sampled_sentences"],
    "metadata_file": ORACLES["split_metadata"],
    "train_only_file": query(COMPARED, "SELECT surface || chr(9) || t::BIGINT AS line FROM words WHERE v = 0"),
    "comparison_from_files": ORACLES["split_similarity"],
}

BUILT = (
    *FILTERED,
    f"split_clean AS (SELECT clean, {split_of()} AS split FROM flagged WHERE NOT oov)",
    freq_cte(),
    LISTED,
    COLLAPSED,
    WORDS,
    f"figures AS ({figures('(SELECT count(*) FROM vocab)')})",
)
_REPORT = [
    "'# Split comparison'", "''", "'## Similarity'",
    "printf('- Jaccard (vocabulary overlap): %.6f', jaccard)", "printf('- Cosine (mode C counts): %.6f', cosine)",
    "''", "'## Against the vocabulary'",
    "printf('- Train Jaccard: %.6f', jaccard_train_vocab)", "printf('- Validation Jaccard: %.6f', jaccard_val_vocab)",
    "printf('- Train words in the vocabulary: %.2f%%', coverage_train * 100)",
    "printf('- Validation words in the vocabulary: %.2f%%', coverage_val * 100)",
    "''", "'## Word counts'",
    "format('- Either split: {:,}', union_size)", "format('- Both splits: {:,}', shared)",
    "format('- Train only: {:,}', only_train)", "format('- Validation only: {:,}', only_val)",
]
_LISTS = {
    "Most frequent train words missing from validation": ("t", "v = 0"),
    "Most frequent validation words missing from train": ("v", "t = 0"),
    "Most frequent train words unknown to the vocabulary": ("t", "t > 0 AND pt IS NULL"),
    "Most frequent validation words unknown to the vocabulary": ("v", "v > 0 AND pv IS NULL"),
}


def _file(name: str, split: str, line: str, rest: str) -> str:
    return f"(SELECT '{name}' AS file, {split} AS split, {line} AS line {rest})"


ORACLES |= {
    "token_frequencies_from_table": ORACLES["token_frequencies"],
    "corpus_build_with_python_analyser": ORACLES["corpus_build"],
    "build_outputs": query(
        BUILT,
        " UNION ALL ".join(
            [
                _file("sentences", "split", "clean", "FROM split_clean"),
                _file(
                    "token_frequencies",
                    "split",
                    "concat_ws(chr(9), surface, normalized, cnt_a, cnt_b, cnt_c, coalesce(printf('%.2f', percentile), 'x'))",
                    "FROM listed",
                ),
                _file("token_frequencies_header", "''", "concat_ws(chr(9), 'surface', 'normalized', 'count_A', 'count_B', 'count_C', 'percentile')", ""),
                _file(
                    "sample_sentences",
                    "split",
                    "clean",
                    "FROM split_clean QUALIFY row_number() OVER (PARTITION BY split ORDER BY md5('0:' || clean), clean) <= 100",
                ),
                _file("only_train", "''", "surface || chr(9) || t::BIGINT", "FROM words WHERE v = 0"),
                _file("only_validation", "''", "surface || chr(9) || v::BIGINT", "FROM words WHERE t = 0"),
                _file("split_report", "''", f"unnest([{', '.join(_REPORT)}])", "FROM figures"),
                *(
                    _file("split_report", "''", f"unnest(['', '### {title}'])", "")
                    + " UNION ALL "
                    + _file("split_report", "''", f"'  ' || surface || ' (' || {count}::BIGINT || ')'", f"FROM words WHERE {where} ORDER BY {count} DESC, surface LIMIT 50")
                    for title, (count, where) in _LISTS.items()
                ),
                _file("split_report", "''", "unnest(['', '### First vocabulary words missing from the corpus'])", "FROM absent LIMIT 2"),
                # A listed word may be a line feed.
                _file("split_report", "''", "unnest(string_split(printf('  %s (%.2f)', word, percentile), chr(10)))", "FROM (FROM absent ORDER BY rank LIMIT 50)"),
            ]
        ),
    ).replace(
        "figures AS (",
        """absent AS (SELECT word, rank, percentile FROM vocab
  WHERE word NOT IN (SELECT surface FROM collapsed WHERE cnt_c > 0)
    AND word NOT IN (SELECT normalized FROM collapsed WHERE cnt_c > 0)),
figures AS (""",
        1,
    ),
}
