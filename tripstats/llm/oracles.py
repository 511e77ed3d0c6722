"""SQL twins (DuckDB) of the queries that SQL can express."""

from tripstats.llm.quality_rules import STOP_WORDS

_STOP_LIST = ", ".join(f"'{word}'" for word in STOP_WORDS)

QUALITY_RULES = rf"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents
), words AS (
  SELECT row_id, unnest(found) AS word, generate_subscripts(found, 1) AS place
  FROM (SELECT row_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS found FROM texts)
), per_word AS (
  SELECT row_id, count(*) AS n_words, sum(length(word)) AS word_chars,
    count(*) FILTER (lower(word) IN ({_STOP_LIST})) AS n_stop_words
  FROM words GROUP BY row_id
), windows AS (
  SELECT row_id, place,
    list(word) OVER (PARTITION BY row_id ORDER BY place ROWS BETWEEN CURRENT ROW AND 7 FOLLOWING)
      AS win
  FROM words
), twins AS (
  SELECT row_id, place,
    count(*) OVER (PARTITION BY row_id, win) AS n
  FROM windows WHERE len(win) = 8
), covered AS (
  SELECT row_id, count(DISTINCT place + step) AS n_repeat_words
  FROM twins, range(0, 8) AS steps(step) WHERE n > 1 GROUP BY row_id
), lines AS (
  SELECT row_id, unnest(string_split(text, chr(10))) AS line FROM texts
), per_line AS (
  SELECT row_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY row_id
), counts AS (
  SELECT doc_id,
    coalesce(n_words, 0)::BIGINT AS n_words,
    coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
    coalesce(n_stop_words, 0)::BIGINT AS n_stop_words,
    length(regexp_replace(text, '[^!?]', '', 'g'))::BIGINT AS n_marks,
    coalesce(n_lines, 0)::BIGINT AS n_lines
  FROM texts LEFT JOIN per_word USING (row_id) LEFT JOIN covered USING (row_id)
    LEFT JOIN per_line USING (row_id)
)
SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed,
  n_words >= 20 AND 100 * n_repeat_words <= 30 * n_words
    AND n_repeat_words / n_words <= 0.3
    AND word_chars / n_words BETWEEN 2.0 AND 14.0
    AND n_symbols / n_words <= 0.3 AND n_marks / n_words <= 0.5
    AND n_stop_words / n_words >= 0.03
    AND (n_lines = 0 OR n_dup_lines / n_lines <= 0.5) AS kept
FROM counts
"""

ARCHIVE = """
WITH records AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS response_id
  FROM pages
)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> response_id THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> response_id THEN response_id END AS refers_to
FROM records
"""

QUOTATIONS = r"""
WITH RECURSIVE messages AS (
  SELECT row_number() OVER () AS row_id, conv_id, turn, role, coalesce(text, '') AS text
  FROM conversations
), split AS (
  SELECT row_id, conv_id, turn, unnest(parts) AS line, generate_subscripts(parts, 1) AS place
  FROM (SELECT *, string_split_regex(text, '\r?\n') AS parts FROM messages)
), lines AS (
  SELECT *, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS level,
    regexp_replace(line, '^(?:[ \t]*>)+', '') AS body
  FROM split
), normed AS (
  SELECT *, trim(regexp_replace(regexp_replace(lower(body),
      '([\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}])', ' \1 ', 'g'),
      '[^\p{L}\p{N}]+', ' ', 'g')) AS norm,
    lag(level, 1, 0) OVER (PARTITION BY row_id ORDER BY place) AS level_before
  FROM lines
), numbered AS (
  SELECT *, sum((level <> level_before)::INT) OVER (PARTITION BY row_id ORDER BY place) AS run FROM normed
), passages AS (
  SELECT row_id, run, string_agg(norm, ' ' ORDER BY place) AS passage FROM numbered
  WHERE level > 0 AND norm <> '' GROUP BY ALL
), quoted AS (
  SELECT conv_id, turn, level, passage, norm AS line, count(*) AS n
  FROM numbered JOIN passages USING (row_id, run) WHERE level > 0 AND norm <> '' GROUP BY ALL
), units AS (
  SELECT conv_id, passage AS unit FROM quoted UNION SELECT conv_id, line FROM quoted
), own AS (
  SELECT row_id, conv_id, turn AS origin, list(norm ORDER BY place) AS said FROM normed
  WHERE level = 0 AND norm <> '' GROUP BY ALL
), held AS (
  -- A message holds a unit as whole lines if some of its lines one after the other make it.
  SELECT conv_id, unit, origin, bool_or(list_contains(flatten(list_transform(range(1, len(said) + 1),
      lambda i: list_transform(range(i, len(said) + 1), lambda j: array_to_string(said[i:j], ' ')))), unit)) AS whole
  FROM units JOIN own USING (conv_id)
  WHERE contains(' ' || array_to_string(said, ' ') || ' ', ' ' || unit || ' ')
  GROUP BY ALL
), found AS (
  SELECT q.*, CASE WHEN p.first < turn THEN passage WHEN l.first < turn THEN line END AS unit
  FROM quoted q
    LEFT JOIN (SELECT conv_id, unit, min(origin) AS first FROM held GROUP BY ALL) p
      ON p.conv_id = q.conv_id AND p.unit = q.passage
    LEFT JOIN (SELECT conv_id, unit, min(origin) AS first FROM held GROUP BY ALL) l
      ON l.conv_id = q.conv_id AND l.unit = q.line
), used AS (
  SELECT conv_id, turn, unit, coalesce(sum(n) FILTER (level = 1), 0) AS direct, sum(n) AS n
  FROM found WHERE unit IS NOT NULL GROUP BY ALL
), met AS (
  SELECT used.*, origin, whole, bool_or(whole) OVER (PARTITION BY conv_id, turn, unit) AS strict
  FROM used JOIN held USING (conv_id, unit) WHERE origin < turn
), votes AS (
  SELECT conv_id, turn, origin, sum(direct) AS direct, sum(n) AS n
  FROM met WHERE whole OR NOT strict GROUP BY ALL
), linked AS (
  SELECT conv_id, turn, sum(n)::BIGINT AS n_linked FROM used GROUP BY ALL
), answered AS (
  SELECT conv_id, turn, max({'d': direct, 'n': n, 'o': origin}).o AS reply_to, any_value(n_linked) AS n_linked
  FROM votes JOIN linked USING (conv_id, turn) GROUP BY conv_id, turn
), chain AS (
  SELECT conv_id, turn, reply_to AS thread, 1::BIGINT AS depth FROM answered
  UNION ALL
  SELECT chain.conv_id, chain.turn, answered.reply_to, chain.depth + 1
  FROM chain JOIN answered ON chain.conv_id = answered.conv_id AND chain.thread = answered.turn
), threads AS (
  SELECT conv_id, turn, arg_max(thread, depth) AS thread, max(depth) AS depth FROM chain GROUP BY ALL
), shown AS (
  SELECT row_id,
    trim(coalesce(string_agg(body, chr(10) ORDER BY place) FILTER (level = 0), '')) AS text,
    count(*) FILTER (level > 0 AND level <> level_before) AS n_quotes, max(level)::INT AS max_level
  FROM normed GROUP BY row_id
)
SELECT m.conv_id, m.turn, m.role, s.text, s.n_quotes, s.max_level, a.reply_to,
  coalesce(a.n_linked, 0) AS n_linked, coalesce(t.thread, m.turn) AS thread,
  coalesce(t.depth, 0) AS depth
FROM messages m JOIN shown s USING (row_id)
  LEFT JOIN answered a ON a.conv_id = m.conv_id AND a.turn = m.turn
  LEFT JOIN threads t ON t.conv_id = m.conv_id AND t.turn = m.turn
"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(
      CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
      ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END
    ) AS shingle
  FROM texts
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c
  FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes sx ON sx.doc_id = x JOIN sizes sy ON sy.doc_id = y
  WHERE 100 * c >= 85 * (sx.n + sy.n - c)
), both_ways AS (
  SELECT x, y FROM links UNION ALL SELECT y, x FROM links
), reached AS (
  SELECT doc_id, doc_id AS root FROM documents
  UNION
  SELECT y, root FROM reached JOIN both_ways ON doc_id = x
), components AS (
  SELECT doc_id, min(root) AS component_id FROM reached GROUP BY doc_id
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM components LEFT JOIN sizes USING (doc_id)
"""

HARD_NEGATIVES = """
WITH vectors AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
    list_dot_product(a.v, b.v)::BIGINT AS score
  FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0
), positives AS (
  SELECT * FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
  (row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY n.score DESC, n.other_id))::INT AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
  AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5
"""

SUBSTRINGS = r"""
WITH texts AS (
  SELECT row_number() OVER () AS row_id, doc_id,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), starts AS (
  SELECT row_id, unnest(range(1, len(w) - 33)) AS place, w FROM texts WHERE len(w) >= 35
), windows AS (
  SELECT row_id, place, md5_number(array_to_string(w[place : place + 34], ' ')) AS win FROM starts
), twins AS (
  SELECT row_id, place FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1
), covered AS (
  SELECT row_id, list(DISTINCT place + step) AS gone
  FROM twins, range(0, 35) AS steps(step) GROUP BY row_id
), words AS (
  SELECT row_id, unnest(w) AS word, generate_subscripts(w, 1) AS place FROM texts
), marked AS (
  SELECT row_id, word, words.place, c.place IS NOT NULL AS gone
  FROM words LEFT JOIN (SELECT row_id, unnest(gone) AS place FROM covered) c USING (row_id, place)
), joined AS (
  SELECT row_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
    string_agg(word, ' ' ORDER BY place) FILTER (NOT gone) AS kept
  FROM marked GROUP BY row_id
)
SELECT doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM texts LEFT JOIN joined USING (row_id)
"""

# The checksum is that of zlib; its table of 256 steps is built by rule.
SPELLING = r"""
WITH RECURSIVE steps AS (
  SELECT list(step ORDER BY i) AS table_ FROM (
    SELECT i, list_reduce([i] || range(8), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS step
    FROM range(256) AS r(i))
), runs AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT id, run, count(*) AS n, hex(encode(id || ':' || run)) AS digits
  FROM runs WHERE length(run) >= 5 GROUP BY id, run
), hashed AS (
  SELECT run, n, xor(list_reduce([4294967295] || list_transform(range(1, length(digits), 2), lambda i:
      16 * (instr('0123456789ABCDEF', digits[i]) - 1) + instr('0123456789ABCDEF', digits[i + 1]) - 1),
    lambda c, b: xor(c >> 8, table_[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM counted, steps
), words AS (
  SELECT CASE WHEN h % 97 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2)
    ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1
  HAVING length(word) >= 5 AND sum(n) >= 3
), cut AS (
  SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n
  FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
  UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), best AS (
  SELECT word, other, other_n FROM near
  QUALIFY row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) = 1
), formed AS (
  SELECT words.word, n, CASE WHEN other_n >= 2 * n THEN other END AS form,
    CASE WHEN other_n >= 2 * n THEN other_n END AS form_n
  FROM words LEFT JOIN best USING (word)
), followed AS (
  SELECT word, word AS root, form AS next FROM formed
  UNION ALL
  SELECT followed.word, formed.word, formed.form
  FROM followed JOIN formed ON followed.next = formed.word
)
SELECT word, form, root, n, coalesce(n_near, 0)::BIGINT AS n_near, form_n
FROM formed JOIN followed USING (word)
  LEFT JOIN (SELECT word, count(*) AS n_near FROM near GROUP BY word) USING (word)
WHERE next IS NULL
"""

ORACLES: dict[str, str] = {
    "op7_near_duplicates": NEAR_DUPLICATES,
    "op4_quotation_linking": QUOTATIONS,
    "op2_quality_rules": QUALITY_RULES,
    "op8_archive": ARCHIVE,
    "op11_hard_negatives": HARD_NEGATIVES,
    "op12_substring_dedup": SUBSTRINGS,
    "op13_spelling_variants": SPELLING,
}
