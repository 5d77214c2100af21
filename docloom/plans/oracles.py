"""DuckDB SQL of the registered queries."""

WHITE = r"[\s\x1c-\x1f\x85\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WORD = WHITE.replace("[", "[^", 1).replace(r"\s", " \\t\\n\\f\\r\\v") + "+"

BLOCKS = r"""
b0 AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
b AS (
  SELECT doc_id, pos - 1 AS block_id, ((pos - 1) // 10)::INT AS page, regexp_replace(line, '^\s+|\s+$', '', 'g') AS text
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM b0)
  WHERE regexp_replace(line, '^\s+|\s+$', '', 'g') <> ''
),
p AS (
  SELECT *, coalesce(sum(length(text) + 2) OVER (PARTITION BY doc_id ORDER BY block_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM b
)
"""

SEGMENTS = r"""
s0 AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
s AS (
  SELECT doc_id, (pos - 1)::INT AS ord, pos::INT AS question_id, ((pos - 1) // 10)::INT AS page, line AS text, ceil(length(line) * 0.5)::INT AS tokens,
    (pos - 1) * 1000 AS char_start, (pos - 1) * 1000 + length(line) AS char_end,
    row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS rn
  FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM s0) WHERE trim(line, ' ') <> ''
),
f(doc_id, rn, chunk_no, filled) AS (
  SELECT doc_id, rn, 1, CASE WHEN tokens > 200 THEN 201 ELSE tokens END FROM s WHERE rn = 1
  UNION ALL
  SELECT s.doc_id, s.rn, CASE WHEN s.tokens > 200 OR f.filled + s.tokens > 200 THEN f.chunk_no + 1 ELSE f.chunk_no END,
    CASE WHEN s.tokens > 200 THEN 201 WHEN f.filled + s.tokens > 200 THEN s.tokens ELSE f.filled + s.tokens END
  FROM f JOIN s ON s.doc_id = f.doc_id AND s.rn = f.rn + 1
),
k AS (SELECT s.*, chunk_no FROM s JOIN f USING (doc_id, rn)),
c AS (
  SELECT doc_id, printf('chunk_%03d', chunk_no) AS chunk_id, chunk_no, min(question_id) AS lo, max(question_id) AS hi, string_agg(text, chr(10) || chr(10) ORDER BY ord) AS text,
    sum(tokens)::BIGINT AS tokens, count(*) AS question_count, array_to_string(list_sort(list_distinct(list(page))), ',') AS pages,
    arg_min(char_start, ord)::BIGINT AS char_start, arg_max(char_end, ord)::BIGINT AS char_end
  FROM k GROUP BY doc_id, chunk_no
)
"""

QUESTIONS = r"""
o AS (
  SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS opos,
    CASE WHEN l_partkey % 17 = 0 THEN '' ELSE l_linenumber::VARCHAR END AS num,
    CASE WHEN l_suppkey % 19 = 0 THEN ' ' WHEN l_partkey % 3 = 0 THEN 'a longer option of part ' || l_partkey ELSE l_returnflag || l_linestatus END AS otext,
    CASE WHEN l_returnflag = 'R' THEN 'true' WHEN l_partkey % 29 = 0 THEN 'O' ELSE 'false' END AS correct, l_linestatus AS explanation
  FROM lineitem
),
q AS (
  SELECT o_orderkey, (o_orderkey // 20)::BIGINT AS chunk_id, (o_orderkey % 20)::INT AS pos, (o_custkey % 31)::BIGINT AS id,
    CASE WHEN o_custkey % 13 = 0 THEN '  ' ELSE o_orderpriority END AS text FROM orders
),
e AS (SELECT q.*, opos, num, otext, correct, explanation FROM q JOIN o ON l_orderkey = o_orderkey),
n AS (
  SELECT q.chunk_id, q.pos, q.id, q.text, count(num) AS n, count(*) FILTER (WHERE correct = 'true') AS n_right, coalesce(sum(length(otext)), 0) AS chars
  FROM q LEFT JOIN e USING (o_orderkey) GROUP BY q.o_orderkey, q.chunk_id, q.pos, q.id, q.text
),
ids AS (SELECT chunk_id, id, lead(id) OVER (PARTITION BY chunk_id ORDER BY id) AS nxt FROM (SELECT DISTINCT chunk_id, id FROM q)),
odd AS (
  SELECT e.chunk_id, e.pos, e.id AS question_id, e.num AS option_num, length(e.otext)::VARCHAR AS detail
  FROM e JOIN n USING (chunk_id, pos) WHERE n.n >= 2 AND n.chars / n.n >= 10 AND length(e.otext) < 0.3 * (n.chars / n.n)
),
issues AS (
  SELECT chunk_id, 'DUPLICATE_QUESTION' AS issue_type, 'ERROR' AS severity, id AS question_id, NULL::INT AS pos, '' AS option_num, count(*)::VARCHAR AS detail
  FROM q GROUP BY chunk_id, id HAVING count(*) > 1
  UNION ALL SELECT chunk_id, 'MISSING_QUESTION', 'ERROR', m, NULL, '', m::VARCHAR FROM (SELECT chunk_id, unnest(range(id + 1, nxt)) AS m FROM ids WHERE nxt - id > 1)
  UNION ALL SELECT chunk_id, 'OPTION_COUNT_INCONSISTENT', 'WARNING', id, pos, '', n::VARCHAR FROM n WHERE n <> 4
  UNION ALL SELECT chunk_id, 'TEXT_DUPLICATED', 'WARNING', id, pos, '', substring(trim(otext), 1, 30) FROM e
    WHERE trim(otext) <> '' GROUP BY chunk_id, pos, id, trim(otext) HAVING count(*) > 1
  UNION ALL SELECT chunk_id, 'INVALID_CORRECT_VALUE', 'ERROR', id, pos, num, correct FROM e WHERE correct NOT IN ('true', 'false')
  UNION ALL SELECT chunk_id, 'NO_CORRECT_ANSWER', 'ERROR', id, pos, '', '0' FROM n WHERE n_right = 0
  UNION ALL SELECT chunk_id, 'MULTIPLE_CORRECT_ANSWERS', 'WARNING', id, pos, '', n_right::VARCHAR FROM n WHERE n_right > 1
  UNION ALL SELECT chunk_id, 'EMPTY_QUESTION_TEXT', 'ERROR', id, pos, '', '' FROM n WHERE trim(text) = ''
  UNION ALL SELECT chunk_id, 'EMPTY_OPTIONS', 'ERROR', id, pos, '', '' FROM n WHERE n = 0
  UNION ALL SELECT chunk_id, 'EMPTY_OPTION_NUM', 'ERROR', id, pos, num, '' FROM e WHERE trim(num) = ''
  UNION ALL SELECT chunk_id, 'EMPTY_OPTION_TEXT', 'ERROR', id, pos, num, '' FROM e WHERE trim(otext) = ''
),
orig AS (SELECT chunk_id, concat_ws(' ', '① ② ③ Order chunk', max(text), '1) returned 2) options ', repeat('part option ', 30)) AS original FROM q GROUP BY chunk_id),
part AS (
  SELECT q.chunk_id, q.pos, nullif(concat_ws(' ', nullif(q.text, ''), string_agg(concat_ws(' ', nullif(otext, ''), nullif(explanation, '')), ' ' ORDER BY opos)), '') AS t, count(num) AS n
  FROM q LEFT JOIN e USING (o_orderkey) GROUP BY q.chunk_id, q.pos, q.text
),
pair AS (
  SELECT chunk_id, any_value(original) AS original, coalesce(string_agg(t, ' ' ORDER BY pos), '') AS result, sum(n) AS n_options FROM part JOIN orig USING (chunk_id) GROUP BY chunk_id
),
kw AS (SELECT *, list_distinct(regexp_extract_all(original, '[가-힣A-Za-z0-9]{3,}')) AS words FROM pair),
lost AS (SELECT *, list_sort(list_filter(words, lambda w: NOT contains(result, w))) AS gone FROM kw),
diff AS (
  SELECT chunk_id, 'TRUNCATION' AS issue_type, 'ERROR' AS severity, length(result)::VARCHAR AS detail FROM pair WHERE length(result) / length(original) < 0.5
  UNION ALL SELECT chunk_id, 'OPTION_MISSING', 'ERROR', n_options || ' of 3' FROM pair WHERE n_options / 3 < 0.8
  UNION ALL SELECT chunk_id, 'KEYWORD_LOSS', 'WARNING', array_to_string(gone[1:10], ', ') FROM lost WHERE len(gone) / len(words) > 0.3
),
fields AS (
  SELECT chunk_id, pos, id, 'text' AS field, text AS v FROM q UNION ALL SELECT chunk_id, pos, id, 'option_' || num || '_text', otext FROM e
  UNION ALL SELECT chunk_id, pos, id, 'option_' || num || '_explanation', explanation FROM e
),
terms(term, suggestion, severity, k) AS (VALUES ('optoin', 'option', 'ERROR', 1), ('RF', 'returned', 'WARNING', 2), ('art', 'part', 'WARNING', 3)),
typo AS (SELECT *, unnest(range((length(v) - length(replace(v, term, ''))) // length(term))) FROM fields, terms WHERE contains(v, term)),
few AS (
  SELECT chunk_id, issue_type, CASE severity WHEN 'ERROR' THEN 'structure_error' ELSE 'empty_field' END AS bucket, detail FROM issues
  UNION ALL SELECT chunk_id, 'LENGTH_ANOMALY', 'diff_anomaly', detail FROM odd UNION ALL SELECT chunk_id, issue_type, 'diff_anomaly', detail FROM diff
  UNION ALL SELECT chunk_id, 'TYPO_REGRESSION', 'term_typo', term FROM typo
),
weights(bucket, weight) AS (VALUES ('structure_error', 0.4::DOUBLE), ('diff_anomaly', 0.3::DOUBLE), ('empty_field', 0.2::DOUBLE), ('term_typo', 0.1::DOUBLE)),
score AS (
  SELECT chunk_id, count(bucket) FILTER (WHERE bucket = 'structure_error') AS structure_error, count(bucket) FILTER (WHERE bucket = 'diff_anomaly') AS diff_anomaly,
    count(bucket) FILTER (WHERE bucket = 'empty_field') AS empty_field, count(bucket) FILTER (WHERE bucket = 'term_typo') AS term_typo,
    greatest(0.0, round(1.0 - round(0.4 * structure_error, 4) - round(0.3 * diff_anomaly, 4) - round(0.2 * empty_field, 4) - round(0.1 * term_typo, 4), 4))::DOUBLE AS score
  FROM (SELECT DISTINCT chunk_id FROM q) LEFT JOIN few USING (chunk_id) GROUP BY chunk_id
),
flat AS (SELECT q.*, score, CASE WHEN score >= 0.95 THEN 'AUTO' ELSE 'HUMAN_REVIEW' END AS status FROM q JOIN score USING (chunk_id)),
rws AS (
  SELECT flat.chunk_id, flat.pos, coalesce(opos, 0)::INT AS option_pos, flat.id, CASE WHEN coalesce(opos, 0) = 0 THEN flat.text ELSE '동일' END AS text, coalesce(num, '') AS num,
    coalesce(otext, '') AS "option", CASE WHEN correct = 'true' THEN 'O' ELSE 'X' END AS answer, coalesce(explanation, '') AS explanation, round(score, 3) AS confidence, status
  FROM flat LEFT JOIN e USING (o_orderkey)
),
stats AS (
  SELECT count(*) AS total_problems, count(*) FILTER (WHERE status = 'AUTO') AS auto_confirmed, count(*) FILTER (WHERE status <> 'AUTO') AS human_review,
    auto_confirmed / total_problems AS auto_confirmed_ratio, human_review / total_problems AS human_review_ratio, count(DISTINCT id) AS distinct_ids,
    count(DISTINCT id) FILTER (WHERE status = 'AUTO') AS auto_ids, distinct_ids - auto_ids AS review_ids FROM flat
)
"""

EXAM = r"""
x0 AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
x1 AS (SELECT doc_id, pos - 1 AS pos, regexp_replace(line, '^\s+|\s+$', '', 'g') AS line FROM (SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM x0)),
x AS (
  SELECT doc_id, pos, (pos // 10)::INT AS page, pos % 3 = 0 AS head, (pos // 3 % 400 + 1)::INT AS num,
    CASE pos % 3 WHEN 0 THEN '문' || (pos // 3 % 400 + 1) || '. ' WHEN 1 THEN '① ' ELSE '② ' END || line AS text FROM x1 WHERE line <> ''
),
placed AS (SELECT *, coalesce(sum(length(text) + 2) OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS char_start FROM x),
heads AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM placed WHERE head),
whole AS (SELECT doc_id, string_agg(text || chr(10) || chr(10), '' ORDER BY pos) AS full_text FROM x GROUP BY doc_id)
"""

ANSWERS = r"""
c AS (
  SELECT o_orderkey // 20 AS chunk_id, o_orderkey // 20 % 9 AS manner, string_agg((o_custkey % 31)::VARCHAR, ',' ORDER BY o_orderkey) AS ids,
    '{"questions": [' || string_agg('{"id": ' || o_custkey % 31 || ', "text": "' || o_orderpriority || '", "options": []}', ', ' ORDER BY o_orderkey) || ']}' AS body
  FROM orders GROUP BY o_orderkey // 20
)
"""

STATES = r"""
log AS (
  SELECT user_id AS chunk_id, event_id, value AS duration, CASE event_type WHEN 'signup' THEN 'CHUNK_READY' WHEN 'view' THEN if(event_id % 2 = 0, 'SENT', 'CHUNK_READY')
    WHEN 'click' THEN if(event_id % 2 = 0, 'RESPONDED', 'PARSED') WHEN 'purchase' THEN if(event_id % 2 = 0, 'VALIDATED', 'COMPLETED')
    WHEN 'error' THEN if(event_id % 2 = 0, 'FAILED', 'PAUSED_LIMIT') ELSE 'SENT' END AS state,
    row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events
),
may(b, a) AS (VALUES ('PREPARED', 'TEXT_EXTRACTED'), ('PREPARED', 'CHUNK_READY'), ('TEXT_EXTRACTED', 'HINTS_GENERATED'), ('HINTS_GENERATED', 'CHUNKS_CREATED'),
  ('CHUNKS_CREATED', 'CHUNK_READY'), ('CHUNK_READY', 'SENT'), ('CHUNK_READY', 'SKIPPED'), ('SENT', 'RESPONDED'), ('SENT', 'PAUSED_LIMIT'), ('SENT', 'FAILED'),
  ('SENT', 'CHUNK_READY'), ('RESPONDED', 'PARSED'), ('RESPONDED', 'FAILED'), ('PARSED', 'VALIDATED'), ('PARSED', 'FAILED'), ('VALIDATED', 'COMPLETED'), ('VALIDATED', 'FAILED'),
  ('PAUSED_LIMIT', 'CHUNK_READY'), ('FAILED', 'CHUNK_READY'), ('FAILED', 'SKIPPED'), ('SKIPPED', 'CHUNK_READY')),
walk(chunk_id, rn, before, taken, now) AS (
  SELECT chunk_id, 0::BIGINT, NULL::VARCHAR, false, NULL::VARCHAR FROM (SELECT DISTINCT chunk_id FROM log)
  UNION ALL
  SELECT chunk_id, rn, now, ok, CASE WHEN ok THEN state ELSE now END FROM (
    SELECT l.chunk_id, l.rn, w.now, l.state, CASE WHEN w.now IS NULL THEN l.state = 'CHUNK_READY' ELSE w.now = l.state OR (w.now, l.state) IN (SELECT (b, a) FROM may) END AS ok
    FROM walk w JOIN log l ON l.chunk_id = w.chunk_id AND l.rn = w.rn + 1)
),
checked AS (SELECT log.*, before, taken FROM walk JOIN log USING (chunk_id, rn)),
cur AS (
  SELECT chunk_id, arg_max(state, rn) FILTER (WHERE taken) AS state, count(*) FILTER (WHERE taken) AS changes, count(*) FILTER (WHERE NOT taken) AS rejected,
    arg_max(duration, rn) FILTER (WHERE taken AND duration IS NOT NULL) AS duration
  FROM checked GROUP BY chunk_id HAVING count(*) FILTER (WHERE taken) > 0
)
"""

ORACLES: dict[str, str] = {
    "m0_text_metrics": rf"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS t, length(t) AS n, regexp_extract_all(t, '{WORD}') AS ws, string_split(t, chr(10)) AS ls,
    list_filter(ls, lambda x: regexp_replace(x, '{WHITE}+', '', 'g') <> '') AS full_lines,
    len(regexp_extract_all(t, '[가-힣]')) AS h, len(regexp_extract_all(t, '[0-9]')) AS d, len(regexp_extract_all(t, '[A-Za-z]')) AS l, len(regexp_extract_all(t, '{WHITE}')) AS w
  FROM documents
)
SELECT doc_id, coalesce(round(len(regexp_extract_all(t, '[□■○●◆▲△▽◇☆★�]')) / nullif(n, 0), 4), 0) AS broken_char_ratio,
  coalesce(round((n - length(regexp_replace(t, ' {{2,}}', '', 'g'))) / nullif(n, 0), 4), 0) AS excessive_space_ratio,
  coalesce(round(len(list_filter(ws, lambda x: regexp_matches(x, '[가-힣]') AND regexp_matches(x, '[A-Za-z]'))) / nullif(len(ws), 0), 4), 0) AS mixed_encoding_ratio,
  coalesce(round(list_sum(list_transform(full_lines, lambda x: length(x)))::BIGINT / nullif(len(full_lines), 0), 1), 0) AS avg_line_length,
  CASE WHEN n > 0 THEN round((len(ls) - len(full_lines)) / len(ls), 4) ELSE 0 END AS empty_lines_ratio, n::INT AS total_chars,
  len(list_distinct(string_split(t, '')))::INT AS unique_chars, coalesce(round(h / nullif(n, 0), 4), 0) AS hangul_ratio,
  coalesce(round(d / nullif(n, 0), 4), 0) AS digit_ratio, coalesce(round(greatest(0, n - h - d - l - w) / nullif(n, 0), 4), 0) AS special_char_ratio
FROM t""",
    "p1_block_offsets": f"WITH {BLOCKS} SELECT doc_id, block_id::INT AS block_id, page, char_start, char_start + length(text) AS char_end FROM p",
    "p2_full_text": f"""
WITH {BLOCKS}, w AS (SELECT doc_id, string_agg(text || chr(10) || chr(10), '' ORDER BY block_id) AS full_text FROM b GROUP BY doc_id)
SELECT doc_id, length(full_text) AS n_chars, sha256(full_text) AS sha256 FROM w""",
    "r3_page_asof": f"""
WITH {BLOCKS}, a AS (SELECT doc_id, unnest(range(0, length(coalesce(text, '')) + 1, 500)) AS "offset" FROM documents)
SELECT a.doc_id, a."offset", coalesce(
  (SELECT arg_max(page, char_start) FROM p WHERE p.doc_id = a.doc_id AND p.char_start <= a."offset"), (SELECT arg_min(page, char_start) FROM p WHERE p.doc_id = a.doc_id), 0) AS page
FROM a""",
    "c3_packed_segments": f"WITH RECURSIVE {SEGMENTS} SELECT doc_id, ord, tokens, chunk_no FROM k",
    "c4_chunks": f"WITH RECURSIVE {SEGMENTS} SELECT doc_id, chunk_id, lo, hi, sha256(text) AS sha256, tokens, question_count, pages, char_start, char_end FROM c",
    "c6_manifest": f"""
WITH RECURSIVE {SEGMENTS} SELECT doc_id, count(*) AS total_chunks, sum(tokens)::BIGINT AS total_tokens, round(avg(tokens), 1) AS avg_tokens,
  arg_max(chunk_id, (tokens, -chunk_no)) AS max_chunk, arg_min(chunk_id, (tokens, chunk_no)) AS min_chunk, sum(question_count)::BIGINT AS total_questions FROM c GROUP BY doc_id""",
    "c7_headers_in_range": f"WITH RECURSIVE {SEGMENTS} SELECT c.doc_id, chunk_id, s.question_id FROM c JOIN s ON s.doc_id = c.doc_id AND s.question_id BETWEEN c.lo AND c.hi",
    "h3_tables": r"SELECT doc_id, len(list_filter(string_split(replace(coalesce(text, ''), ',', '|'), chr(10)), lambda x: regexp_matches(x, '[|\t].*[|\t]'))) >= 2 AS has_table FROM documents",
    "d2_pre_correct": """
SELECT doc_id, (length(t) * 3 - length(replace(t, 'thre', 'thr')) - length(replace(t, 'inou', 'ino')) - length(replace(t, 'haned', 'hane')))::INT AS n,
  sha256(replace(replace(replace(t, 'thre', 'there'), 'inou', 'inyou'), 'haned', 'handed')) AS sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)""",
    "t1_term_issues": f"""
WITH {QUESTIONS} SELECT chunk_id, pos, id AS question_id, severity, 'question_' || id || ', ' || field AS location, term, suggestion FROM typo""",
    "d6_post_verify": f"""
WITH {QUESTIONS} SELECT chunk_id, pos, id AS question_id, field, term AS found, suggestion AS expected, CASE severity WHEN 'ERROR' THEN 'high' ELSE 'medium' END AS severity
FROM typo WHERE term = 'art'""",
    "d3_term_scan": """
WITH RECURSIVE w(original, corrected) AS (VALUES ('thre', 'there'), ('inou', 'inyou'), ('haned', 'handed')),
hit(doc_id, text, original, corrected, spot) AS (
  SELECT doc_id, text, original, corrected, strpos(text, original) FROM documents, w WHERE contains(text, original)
  UNION ALL SELECT doc_id, text, original, corrected, spot + length(original) - 1 + strpos(substr(text, spot + length(original)), original)
  FROM hit WHERE contains(substr(text, spot + length(original)), original)
)
SELECT doc_id, original, corrected, 'offset ' || (spot - 1) || '-' || (spot - 1 + length(original)) AS location, 'medium' AS confidence FROM hit""",
    "d10_validate_term": """
WITH t AS (SELECT DISTINCT unnest(regexp_split_to_array(text, '[ \n]')) AS term FROM documents), w(c, p) AS (VALUES ('there', 'thre'), ('inyou', 'inou'), ('handed', 'haned'))
SELECT term, p IS NULL AS valid, coalesce(c, '') AS suggestion, CASE WHEN p IS NOT NULL THEN 'medium' WHEN term IN ('there', 'inyou', 'handed') THEN 'high' ELSE 'low' END AS confidence
FROM t LEFT JOIN w ON term = p WHERE term <> ''""",
    "r1_header_detect": f"""
WITH {EXAM} SELECT doc_id, '문{{N}}.' AS format, num AS question_id, page, '문' || num || '.' AS text, char_start, char_start + length('문' || num || '. ') AS char_end FROM heads WHERE n >= 2""",
    "r2_header_sequences": f"WITH {EXAM} SELECT doc_id, 0::INT AS priority, count(*) AS n, count(*) >= 2 AS rising FROM heads GROUP BY doc_id",
    "r4_option_symbol": f"WITH {EXAM} SELECT doc_id, CASE WHEN bool_or(NOT head) THEN 'circled' ELSE 'unknown' END AS symbol FROM x GROUP BY doc_id",
    "c2_segments": f"""
WITH {EXAM}, cut AS (
  SELECT doc_id, row_number() OVER w AS ord, num AS question_id, page, char_start, coalesce(lead(char_start) OVER w, length(full_text))::BIGINT AS char_end, full_text
  FROM heads JOIN whole USING (doc_id) WHERE n >= 2 WINDOW w AS (PARTITION BY doc_id ORDER BY char_start)
), t AS (SELECT *, trim(substr(full_text, char_start + 1, char_end - char_start), chr(10)) AS text FROM cut)
SELECT doc_id, ord::INT AS ord, question_id, page, sha256(text) AS sha256, ceil(length(text) * 0.5)::INT AS tokens, char_start, char_end FROM t""",
    "c5_without_headers": f"WITH {EXAM} SELECT DISTINCT doc_id, 'NO_HEADERS' AS error FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM heads WHERE n >= 2)",
    "l9_classified_answers": f"""
WITH {ANSWERS} SELECT chunk_id, CASE manner WHEN 4 THEN 'RATE_LIMIT' WHEN 5 THEN 'AUTH' WHEN 6 THEN 'NONZERO_EXIT' WHEN 7 THEN 'ENCODING' ELSE 'OK' END AS kind,
  CASE manner WHEN 4 THEN 1700000000::DOUBLE END AS reset_at, CASE manner WHEN 8 THEN 'ok' END AS result FROM c""",
    "j1_extracted_json": f"""
WITH {ANSWERS} SELECT chunk_id, CASE WHEN manner IN (0, 1, 3) THEN sha256(body) WHEN manner = 2 THEN sha256(left(body, length(body) - 2)) WHEN manner = 8 THEN sha256('{{"result": "ok"}}') END AS sha256,
  CASE WHEN manner IN (0, 1, 3, 8) THEN false WHEN manner = 2 THEN true END AS truncated FROM c""",
    "j7_parsed_answers": f"""
WITH {ANSWERS} SELECT chunk_id, manner <= 3 AS ok, manner = 2 AS recovered, manner > 3 AS failed, CASE WHEN manner <= 3 THEN ids END AS ids FROM c""",
    "d7_canonical_terms": """
SELECT doc_id, array_to_string(list_filter(['handed', 'inyou', 'there'], lambda w: contains(coalesce(text, ''), w)), ',') AS terms FROM documents""",
    "j6_normalised": f"""
WITH {QUESTIONS}, own AS (SELECT *, nullif(trim(text), '') AS t FROM q),
prev AS (SELECT *, last_value(t IGNORE NULLS) OVER (PARTITION BY chunk_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM own)
SELECT prev.chunk_id, prev.pos, CASE WHEN t = before THEN '동일' ELSE coalesce(t, '') END AS text,
  coalesce(string_agg(trim(num) || '/' || trim(otext) || '/' || explanation, ';' ORDER BY opos), '') AS options
FROM prev LEFT JOIN e USING (o_orderkey) GROUP BY prev.chunk_id, prev.pos, t, before""",
    "v0_structure_issues": f"WITH {QUESTIONS} SELECT * FROM issues",
    "f7_odd_lengths": f"WITH {QUESTIONS} SELECT * FROM odd",
    "f0_diff_issues": f"WITH {QUESTIONS} SELECT * FROM diff",
    "k1_confidence": f"""
WITH {QUESTIONS} SELECT chunk_id, score, CASE WHEN score >= 0.95 THEN 'AUTO' ELSE 'HUMAN_REVIEW' END AS status, structure_error, diff_anomaly, empty_field, term_typo,
  empty_field + term_typo AS auto_fixable, structure_error + diff_anomaly AS manual_review FROM score""",
    "k2_deductions": f"WITH {QUESTIONS} SELECT chunk_id, bucket AS reason, weight AS amount, detail FROM few JOIN weights USING (bucket)",
    "k3_breakdown": f"""
WITH {QUESTIONS} SELECT chunk_id, bucket AS reason, count(*) AS n, weight, round(count(*) * weight, 4)::DOUBLE AS amount FROM few JOIN weights USING (bucket) GROUP BY chunk_id, bucket, weight""",
    "e2_error_breakdown": f"WITH {QUESTIONS} SELECT issue_type, count(*) AS n FROM issues GROUP BY issue_type",
    "e4_run_statistics": f"""
WITH RECURSIVE {STATES}, {QUESTIONS} SELECT *, (SELECT count(*) FROM cur WHERE state = 'FAILED') AS failed_chunks, 42.0::DOUBLE AS total_duration_seconds FROM stats""",
    "x1_option_rows": f"""
WITH {QUESTIONS} SELECT *, '' AS unit, NULL::VARCHAR AS note, CASE WHEN confidence < 0.7 THEN 'orange' WHEN confidence < 0.95 THEN 'yellow' END AS confidence_fill,
  CASE answer WHEN 'O' THEN 'green' ELSE 'red' END AS answer_fill, CASE WHEN text = '동일' THEN 'gray' END AS text_fill FROM rws""",
    "x3_review_rows": f"WITH {QUESTIONS} SELECT chunk_id, pos, option_pos, '미확인' AS checked FROM rws WHERE status = 'HUMAN_REVIEW'",
    "x4_statistics_rows": f"""
WITH RECURSIVE {STATES}, {QUESTIONS}, v AS (
  SELECT 1 AS place, '전체 문제 수' AS label, total_problems::DOUBLE AS value FROM stats UNION ALL SELECT 2, '자동 확정(AUTO) 비율', auto_confirmed_ratio FROM stats
  UNION ALL SELECT 3, '검토 필요(HUMAN_REVIEW) 비율', human_review_ratio FROM stats UNION ALL SELECT 4, '실패한 청크 수', count(*)::DOUBLE FROM cur WHERE state = 'FAILED'
  UNION ALL SELECT 5, '총 소요 시간(초)', 42.0
)
SELECT 'run' AS section, place, label, value FROM v
UNION ALL SELECT 'issues', row_number() OVER (ORDER BY count(*) DESC, issue_type), issue_type, count(*)::DOUBLE FROM few GROUP BY issue_type""",
    "x7_column_widths": f"""
WITH {QUESTIONS}, s AS (
  SELECT '' AS unit, id::VARCHAR AS id, text, num, "option", '' AS note, answer, explanation, CASE WHEN confidence = 0 THEN '0.0' ELSE confidence::VARCHAR END AS confidence, status FROM rws
), w AS (UNPIVOT s ON COLUMNS(*) INTO NAME name VALUE v)
SELECT name, least(CASE name WHEN 'option' THEN 16 ELSE 20 END, max(length(v)) + 2)::INT AS width FROM w GROUP BY name""",
    "st1_registered": f"WITH RECURSIVE {STATES} SELECT DISTINCT c_custkey AS chunk_id, 'CHUNK_READY' AS state FROM customer WHERE c_custkey NOT IN (SELECT chunk_id FROM cur)",
    "st2_forbidden_steps": f"WITH RECURSIVE {STATES} SELECT chunk_id, event_id, before, state FROM checked WHERE NOT taken",
    "st3_current_states": f"WITH RECURSIVE {STATES} SELECT * FROM cur",
    "st4_pauses": "SELECT event_id, CASE WHEN ts > TIMESTAMP '2024-01-15' THEN ts ELSE TIMESTAMP '2024-01-15 00:30:00' END AS resume_at FROM events",
    "st7_resumable": f"""
WITH RECURSIVE {STATES} SELECT chunk_id, CASE WHEN state IN ('SENT', 'FAILED') THEN 'CHUNK_READY' ELSE state END AS state FROM cur WHERE state IN ('CHUNK_READY', 'SENT', 'FAILED', 'PAUSED_LIMIT')""",
    "st8_state_of": f"WITH RECURSIVE {STATES} SELECT chunk_id, state FROM cur WHERE chunk_id = 7",
    "st9_progress": f"""
WITH RECURSIVE {STATES} SELECT count(*) AS total, count(*) FILTER (WHERE state = 'COMPLETED') AS completed, count(*) FILTER (WHERE state = 'SKIPPED') AS skipped,
  count(*) FILTER (WHERE state = 'FAILED') AS failed, count(*) FILTER (WHERE state = 'PAUSED_LIMIT') AS paused, total - completed - skipped AS remaining,
  round(100.0 * (completed + skipped) / total, 1)::DOUBLE AS percent, round(avg(duration) FILTER (WHERE state = 'COMPLETED' AND duration <> 0) * remaining, 1) AS eta_seconds FROM cur""",
    "st9_state_counts": f"WITH RECURSIVE {STATES} SELECT state, count(*) AS n FROM cur GROUP BY state",
}
