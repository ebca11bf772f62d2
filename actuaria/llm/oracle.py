"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

WORDS = r"list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

OP6 = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight, 3 * source_size AS cap FROM totals
), leveled AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(cap) OVER before, 0))::DOUBLE / (sum(weight) OVER onward)::DOUBLE AS level
  FROM ranked WINDOW
    before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    onward AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
  SELECT source, source_size, least(cap::DOUBLE, coalesce(
    max(level) FILTER (WHERE level <= cap::DOUBLE / weight::DOUBLE) OVER (), 0.0) * weight::DOUBLE) AS target FROM leveled
), placed AS (
  SELECT s.*, t.source_size, t.target, coalesce(sum(s.size) OVER (
    PARTITION BY s.source ORDER BY s.key, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS ahead,
    CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  (epochs * size + least(greatest(floor(target)::BIGINT - epochs * source_size - ahead, 0), size))::BIGINT AS taken
FROM placed
"""

_RULES = {
    "symbols": ("n_symbols::DOUBLE / word_chars", 0.0015),
    "lines": ("n_dup_lines::DOUBLE / n_lines", 0.025),
    "repeats": ("n_repeat_words::DOUBLE / n_words", 0.01),
    "capitals": ("n_capitals::DOUBLE / word_chars", 0.002),
    "marks": ("n_marks::DOUBLE / word_chars", 0.0075),
}
_VALUES = " UNION ALL ".join(
    f"SELECT lang, source, '{r}' AS rule, {v} AS value, {least}::DOUBLE AS least FROM judged WHERE NOT base_failed"
    for r, (v, least) in _RULES.items()
)
_GROUPS = "[{'g': 2, 'l': lang, 's': source}, {'g': 1, 'l': lang, 's': NULL}, {'g': 0, 'l': NULL, 's': NULL}]"
_BROKEN = " + ".join(
    f"coalesce(((NOT base_failed) AND {v} > (SELECT threshold FROM limits t WHERE t.rule = '{r}' "
    "AND t.lang IS NOT DISTINCT FROM j.lang AND t.source IS NOT DISTINCT FROM j.source))::BIGINT, 0)"
    for r, (v, _) in _RULES.items()
)

OP9 = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text FROM documents
), split AS (
  SELECT *, {WORDS} AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs
), windows AS (
  SELECT rid, p, (words[p] || ' ' || words[p + 1] || ' ' || words[p + 2]) AS w
  FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS p FROM split)
), twice AS (
  SELECT rid, p FROM (SELECT rid, p, count(*) OVER (PARTITION BY rid, w) AS n FROM windows) WHERE n > 1
), covered AS (
  SELECT rid, count(DISTINCT q) AS n FROM (SELECT rid, unnest([p, p + 1, p + 2]) AS q FROM twice) GROUP BY rid
), counted AS (
  SELECT s.rid, doc_id, lang, source, len(words)::BIGINT AS n_words, len(array_to_string(words, ''))::BIGINT AS word_chars,
    len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
    len(regexp_extract_all(text, '[A-Z]'))::BIGINT AS n_capitals,
    len(regexp_extract_all(text, '[!?;:]'))::BIGINT AS n_marks, coalesce(c.n, 0)::BIGINT AS n_repeat_words
  FROM split s LEFT JOIN covered c ON s.rid = c.rid
), judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counted
), vals AS ({_VALUES}), bins AS (
  SELECT lang, source, rule, least, CASE WHEN value < 0.0001 THEN 0.0
    ELSE 0.0001::DOUBLE * pow(2.0::DOUBLE, (floor(log2(value / 0.0001::DOUBLE) * 64) + 1) / 64) END AS upper FROM vals
), grouped AS (
  SELECT lang, source, rule, least, upper, unnest({_GROUPS}, recursive := true) FROM bins
), sketch AS (
  SELECT g, l, s, rule, least, count(*) AS held,
    quantile_disc(upper, 0.5) AS q50, quantile_disc(upper, 0.875) AS q875 FROM grouped GROUP BY ALL
), limits AS (
  SELECT o.l AS lang, o.s AS source, o.rule,
    CASE WHEN o.held >= 100 THEN o.q50 WHEN b.held >= 100 THEN b.q50 ELSE a.q50 END + 16.0::DOUBLE * greatest(
    CASE WHEN o.held >= 100 THEN o.q875 - o.q50 WHEN b.held >= 100 THEN b.q875 - b.q50 ELSE a.q875 - a.q50 END, o.least) AS threshold
  FROM sketch o JOIN sketch b ON b.g = 1 AND o.rule = b.rule AND o.l IS NOT DISTINCT FROM b.l
    JOIN sketch a ON a.g = 0 AND o.rule = a.rule WHERE o.g = 2
), verdict AS (
  SELECT j.*, ({_BROKEN})::BIGINT AS n_broken FROM judged j
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND n_broken = 0 AS kept, n_broken FROM verdict
"""

OP1 = r"""
WITH lines AS (
  SELECT rid, doc_id, p, line, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM (
    SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents))
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM lines WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT l.*, r.key IS NOT NULL AND l.doc_id <> r.keeper AS gone FROM lines l LEFT JOIN repeated r ON l.key = r.key
)
SELECT any_value(doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY rid
"""

OP3 = """
WITH RECURSIVE vecs AS (
  SELECT vec_id, list_transform(embedding, lambda c: c::DOUBLE) AS v FROM embeddings
), usable AS (
  SELECT vec_id, v, sqrt(list_inner_product(v, v)) AS size FROM vecs
  WHERE len(v) > 0 AND len(list_filter(v, lambda c: c IS NULL OR NOT isfinite(c))) = 0 AND len(list_filter(v, lambda c: c <> 0)) > 0
), links AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM usable x JOIN usable y ON x.vec_id <> y.vec_id AND len(x.v) = len(y.v)
  WHERE list_inner_product(x.v, y.v) / (x.size * y.size) >= 0.95
), reach AS (
  SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
)
SELECT e.vec_id, (SELECT count(*) FROM links l WHERE l.a = e.vec_id)::BIGINT AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN (SELECT a, min(b) AS component_id FROM reach GROUP BY a) c ON c.a = e.vec_id
"""

OP5 = rf"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS rid, doc_id, list_transform({WORDS}, lambda w:
    translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS ws FROM documents
), sets AS (
  SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 4 THEN [array_to_string(ws, ' ')] ELSE list_distinct(
    list_transform(range(1, len(ws) - 2), lambda p: array_to_string(list_slice(ws, p, p + 3), ' '))) END AS s FROM words
), classes AS (
  SELECT list_sort(s) AS s, min(doc_id) AS cid FROM sets WHERE len(s) > 0 GROUP BY 1
), tokens AS (
  SELECT cid, len(s) AS n, unnest(s) AS t FROM classes
), shared AS (
  SELECT a.cid AS a, b.cid AS b, a.n AS na, b.n AS nb, count(*) AS n FROM tokens a JOIN tokens b ON a.t = b.t AND a.cid <> b.cid
    AND 100 * a.n >= 85 * b.n AND 100 * b.n >= 85 * a.n GROUP BY ALL
), links AS (
  SELECT a, b FROM shared WHERE 100 * n >= 85 * (na + nb - n)
), reach AS (
  SELECT cid AS a, cid AS b FROM classes UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), roots AS (
  SELECT a, min(b) AS component_id FROM reach GROUP BY a
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(r.component_id, s.doc_id) AS component_id
FROM sets s LEFT JOIN classes c ON len(s.s) > 0 AND list_sort(s.s) = c.s LEFT JOIN roots r ON r.a = c.cid
"""

OP11 = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) ORDER BY n) AS steps
  FROM range(256) t(n)
), runs AS (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
  WHERE length(run) >= 7 GROUP BY ALL
), keyed AS (
  SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM runs
), summed AS (
  SELECT run, n, xor(4294967295, list_reduce(
    [('0x' || substr(bytes, (2 * i - 1)::INT, 2))::BIGINT for i in range(1, length(bytes) // 2 + 1)],
    lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h FROM keyed, crc
), counts AS (
  SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, sum(n)::BIGINT AS n
  FROM summed GROUP BY 1 HAVING sum(n) >= 2 AND length(word) >= 7
), cut AS (
  SELECT word, i, left(word, (i - 1)::INT) || substr(word, (i + 1)::INT) AS rest
  FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM counts)
), near AS (
  SELECT c.word AS a, w.word AS b FROM cut c JOIN counts w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cut c JOIN counts w ON c.rest = w.word
  UNION SELECT x.word, y.word FROM cut x JOIN cut y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
), told AS (
  SELECT a AS word, count(*) AS n_near, first(b ORDER BY n DESC, encode(b)) AS form, max(n) AS form_n FROM near JOIN counts ON b = word GROUP BY a
), formed AS (
  SELECT c.word, c.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 10 * c.n THEN form END AS form, CASE WHEN form_n >= 10 * c.n THEN form_n END AS form_n
  FROM counts c LEFT JOIN told t ON c.word = t.word
), followed AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT x.word, f.form FROM followed x JOIN formed f ON x.at = f.word WHERE f.form IS NOT NULL
)
SELECT f.word, f.form, x.at AS root, f.n, f.n_near, f.form_n
FROM formed f JOIN followed x ON f.word = x.word JOIN formed e ON x.at = e.word AND e.form IS NULL
"""

ORACLES = {
    "op1_line_dedup": OP1,
    "op3_embedding_dedup": OP3,
    "op5_ngram_join": OP5,
    "op6_mix_sources": OP6,
    "op9_quality_rules": OP9,
    "op11_spelling_variants": OP11,
}
