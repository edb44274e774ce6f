"""DuckDB SQL that the queries must agree with, written from the operators' definitions."""

from __future__ import annotations

_PLAIN = """plain AS (SELECT source AS book_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS page_no, text FROM documents)"""
_PAGES = _PLAIN + """, pages AS (SELECT book_id, page_no, 'The Book of ' || book_id || chr(10)
  || CASE WHEN page_no % 5 = 0 THEN ['Chapter', 'Act', 'Scene', 'Prologue', 'Epilogue', 'Part', 'Book', 'Volume', 'Section'][(page_no // 5) % 9 + 1] || ' ' || CAST(page_no // 5 + 1 AS VARCHAR) || chr(10) ELSE '' END
  || CASE WHEN page_no % 7 = 0 THEN '*****' || chr(10) ELSE '' END || coalesce(text, '') || chr(10) || 'Page ' || CAST(page_no + 1 AS VARCHAR) AS text FROM plain)"""
_LINES = _PAGES + """, arrays AS (SELECT book_id, page_no, string_split(text, chr(10)) AS ls FROM pages),
lines AS (SELECT book_id, page_no, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM arrays)"""
_NOISE = r"""(trim(line) = '' OR regexp_matches(trim(line), '^(?:(?:page\s*)?\d{1,4}|[ivxlcdm]{1,8})$', 'i') OR regexp_matches(trim(line), '^[^\p{L}\p{N}]{4,}$'))"""
_EDGES = _LINES + """, slots AS (SELECT book_id, page_no, trim(unnest(list_concat(ls[1:3], ls[greatest(len(ls) - 2, 1):len(ls)]))) AS line FROM arrays),
sizes AS (SELECT book_id, count(*) AS n_pages FROM pages GROUP BY 1),
recurring AS (SELECT book_id, line, n FROM (SELECT book_id, line, count(*) AS n FROM slots WHERE line <> '' AND len(string_split(regexp_replace(line, '\\s+', ' ', 'g'), ' ')) <= 8 GROUP BY 1, 2)
  JOIN sizes USING (book_id) WHERE n >= greatest(2, CAST(floor(n_pages * CAST(0.3 AS DOUBLE)) AS BIGINT)))""".replace("\\\\", "\\")
_KEPT = _EDGES + ", kept AS (SELECT l.* FROM lines l WHERE NOT EXISTS (SELECT 1 FROM recurring r WHERE r.book_id = l.book_id AND r.line = trim(l.line)))"
_CLEAN = _KEPT + f""", clean AS (SELECT p.book_id, p.page_no, coalesce(t.text, '') AS text FROM pages p LEFT JOIN
  (SELECT book_id, page_no, string_agg(line, chr(10) ORDER BY line_no) AS text FROM kept WHERE NOT {_NOISE} GROUP BY 1, 2) t USING (book_id, page_no))"""
_TIDY = r"""trim(regexp_replace(regexp_replace(regexp_replace({}, '[ \t]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"""
_BOOKS = _CLEAN + ", joined AS (SELECT book_id, string_agg(text, chr(10) || chr(10) ORDER BY page_no) AS text FROM clean GROUP BY 1), books AS (SELECT book_id, " + _TIDY.format("text") + " AS text FROM joined)"
_PLAIN_BOOKS = _PLAIN + ", joined AS (SELECT book_id, string_agg(text, chr(10) || chr(10) ORDER BY page_no) AS text FROM plain GROUP BY 1), books AS (SELECT book_id, " + _TIDY.format("text") + " AS text FROM joined)"
_WORDS = r"(CASE WHEN trim({0}, ' ' || chr(10)) = '' THEN 0 ELSE len(string_split_regex(trim({0}, ' ' || chr(10)), '\s+')) END)"
_HEADS = r""", arr AS (SELECT book_id, string_split(text, chr(10)) AS ls FROM books), bl AS (SELECT book_id, unnest(ls) AS line, unnest(range(len(ls))) AS line_no FROM arr),
marked AS (SELECT *, regexp_matches(line, '^(?:chapter|act|scene|prologue|epilogue|part|book|volume|section)\b.*$', 'i')
  AND NOT (NOT contains(trim(line), ' ') AND upper(trim(line)) = trim(line) AND len(trim(line)) <= 4) AS is_heading FROM bl)"""
_TYPE = r"""CASE WHEN regexp_matches(lower({0}), '^(chapter|chap)') THEN 'chapter' WHEN regexp_matches(lower({0}), '^act\b') THEN 'act' WHEN regexp_matches(lower({0}), '^scene\b') THEN 'scene'
  WHEN lower({0}) LIKE 'prologue%' THEN 'prologue' WHEN lower({0}) LIKE 'epilogue%' THEN 'epilogue' WHEN regexp_matches(lower({0}), '^(part|book|volume)') THEN 'part' ELSE 'section' END"""
_SECTIONS = (
    _HEADS
    + """, keyed AS (SELECT *, sum(CASE WHEN is_heading THEN 1 ELSE 0 END) OVER (PARTITION BY book_id ORDER BY line_no) AS k FROM marked),
bodies AS (SELECT book_id, k, max(CASE WHEN is_heading THEN trim(line) END) AS title, trim(coalesce(string_agg(CASE WHEN NOT is_heading THEN line END, chr(10) ORDER BY line_no), ''), ' ' || chr(10)) AS body FROM keyed WHERE k > 0 GROUP BY 1, 2),
counted AS (SELECT *, """
    + _WORDS.format("body")
    + """ AS word_count FROM bodies)"""
)
_BY_HEADING = "SELECT book_id, row_number() OVER (PARTITION BY book_id ORDER BY k) - 1 AS section_index, title, " + _TYPE.format("title") + " AS section_type, CAST(word_count AS BIGINT) AS word_count, body FROM counted WHERE word_count >= 50"
_PARAGRAPHS = (
    r""", ps AS (SELECT book_id, list_filter(list_transform(string_split_regex(text, '\n{2,}'), lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS a FROM books),
pn AS (SELECT book_id, unnest(a) AS p, unnest(range(len(a))) AS i FROM ps), pw AS (SELECT *, """
    + _WORDS.format("p")
    + """ AS n FROM pn),
walk AS (SELECT book_id, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS k, CAST(n AS BIGINT) AS cur FROM pw WHERE i = 0
  UNION ALL SELECT w.book_id, w.i + 1, CASE WHEN w.cur >= 2000 THEN w.k + 1 ELSE w.k END, CASE WHEN w.cur >= 2000 THEN 0 ELSE w.cur END + p.n FROM walk w JOIN pw p ON p.book_id = w.book_id AND p.i = w.i + 1),
grouped AS (SELECT w.book_id, w.k, string_agg(p.p, chr(10) || chr(10) ORDER BY w.i) AS body FROM walk w JOIN pw p ON p.book_id = w.book_id AND p.i = w.i GROUP BY 1, 2)"""
)
_BY_PARAGRAPH = "SELECT book_id, k AS section_index, 'Passage ' || CAST(k + 1 AS VARCHAR) AS title, 'prose' AS section_type, CAST(" + _WORDS.format("body") + " AS BIGINT) AS word_count, body FROM grouped"
_PAIRS = """pairs AS (SELECT * FROM (SELECT doc_id AS pair_id, CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, 1, strpos(text, chr(10)) - 1) ELSE text END AS instruction,
  CASE WHEN strpos(text, chr(10)) > 0 THEN substr(text, strpos(text, chr(10)) + 1) ELSE '' END AS response FROM documents WHERE text IS NOT NULL) WHERE trim(instruction, ' ') <> '' AND trim(response, ' ') <> '')"""
_FP = r"md5(trim(regexp_replace(lower({}), '\s+', ' ', 'g'), ' '))"
_U1 = _PAIRS + ", u1 AS (SELECT * FROM pairs QUALIFY row_number() OVER (PARTITION BY " + _FP.format("instruction") + " ORDER BY pair_id) = 1)"
_U2 = _U1 + ", u2 AS (SELECT * FROM u1 QUALIFY row_number() OVER (PARTITION BY " + _FP.format("response") + " ORDER BY pair_id) = 1)"
_GOOD = (
    ", good AS MATERIALIZED (SELECT * FROM {0} WHERE "
    + _WORDS.format("response")
    + " >= 20 AND NOT (contains(lower(response), lower(instruction)) AND "
    + _WORDS.format("instruction")
    + " > 8 AND CAST(len(instruction) AS DOUBLE) / greatest(len(response), 1) > 0.8))"
)
_U3 = _U2 + _GOOD.format("u2")
_TFIDF = """, toks AS (SELECT pair_id, unnest(regexp_extract_all(lower(instruction), '[a-z]+')) AS term FROM good), tc AS (SELECT pair_id, term, count(*) AS n FROM toks GROUP BY 1, 2),
idf AS (SELECT term, count(*) AS df, ln(CAST((SELECT greatest(count(*), 1) FROM good) AS DOUBLE) / (count(*) + 1)) + 1 AS idf FROM tc GROUP BY 1),
sizes2 AS (SELECT pair_id, sum(n) AS total FROM tc GROUP BY 1), tfidf AS MATERIALIZED (SELECT tc.pair_id, tc.term, CAST(n AS DOUBLE) / total * idf AS w FROM tc JOIN sizes2 USING (pair_id) JOIN idf USING (term)),
norms AS MATERIALIZED (SELECT pair_id, sqrt(sum(w * w)) AS norm FROM tfidf GROUP BY 1)"""
_SIM = _TFIDF + """, sim AS MATERIALIZED (SELECT a, b, s / (na.norm * nb.norm) AS similarity FROM (SELECT x.pair_id AS a, y.pair_id AS b, sum(x.w * y.w) AS s FROM tfidf x JOIN tfidf y ON x.term = y.term AND x.pair_id < y.pair_id GROUP BY 1, 2)
  JOIN norms na ON na.pair_id = a JOIN norms nb ON nb.pair_id = b WHERE s / (na.norm * nb.norm) >= 0.85)"""
_NEAR = _SIM + """, ord AS MATERIALIZED (SELECT b, list(a) AS before FROM sim GROUP BY b), rk AS MATERIALIZED (SELECT b, before, row_number() OVER (ORDER BY b) AS r FROM ord),
fold AS (SELECT CAST(0 AS BIGINT) AS r, CAST([] AS BIGINT[]) AS gone UNION ALL
  SELECT f.r + 1, CASE WHEN len(list_filter(k.before, lambda x: NOT list_contains(f.gone, x))) > 0 THEN list_append(f.gone, k.b) ELSE f.gone END FROM fold f JOIN rk k ON k.r = f.r + 1),
gone AS MATERIALIZED (SELECT unnest(gone) AS pair_id FROM (SELECT gone FROM fold ORDER BY r DESC LIMIT 1)), near AS (SELECT * FROM good WHERE pair_id NOT IN (SELECT pair_id FROM gone))"""
_JSON = (
    _PAIRS
    + r""", made AS (SELECT pair_id, CAST(to_json({'instruction': CASE WHEN pair_id % 19 = 0 THEN 'Student: ' || instruction ELSE instruction END, 'response': CASE WHEN pair_id % 17 = 0 THEN 'Too short.' ELSE response END}) AS VARCHAR) AS l0 FROM pairs),
made1 AS (SELECT pair_id, CASE WHEN pair_id % 11 = 0 THEN replace(l0, '"response":"', '"response":"\q ') ELSE l0 END AS l1 FROM made),
made2 AS (SELECT pair_id, CASE WHEN pair_id % 13 = 0 THEN left(l1, len(l1) - 1) ELSE l1 END AS l2 FROM made1),
js AS (SELECT pair_id AS line_no, CASE WHEN pair_id % 23 = 0 THEN '  ' ELSE l2 END AS value FROM made2),
fixed AS (SELECT line_no, CASE WHEN json_valid(value) THEN value ELSE regexp_replace(value, '\\([^"\\/bfnrtu]|$)', '\\\\\1', 'g') END AS value FROM js),
obj AS (SELECT line_no, json_extract_string(value, '$.instruction') AS i, json_extract_string(value, '$.response') AS r FROM fixed WHERE json_valid(value)),
texts AS (SELECT line_no, regexp_replace("""
    + _TIDY.format("i")
    + r""", '\\([^"\\/bfnrtu]|$)', '\\\\\1', 'g') AS instruction, regexp_replace("""
    + _TIDY.format("r")
    + r""", '\\([^"\\/bfnrtu]|$)', '\\\\\1', 'g') AS response FROM obj),
checked AS (SELECT *, CASE WHEN instruction = '' THEN 'empty instruction' WHEN response = '' THEN 'empty response'
  WHEN """
    + _WORDS.format("response")
    + " < 20 THEN 'response too short (' || CAST("
    + _WORDS.format("response")
    + r""" AS VARCHAR) || ' words)'
  WHEN regexp_matches(instruction, '^(student|teacher|professor|tutor|q|a|user|assistant)\s*:', 'i') THEN 'instruction has conversation prefix'
  WHEN regexp_matches(response, '^(student|teacher|professor|tutor|q|a|user|assistant)\s*:', 'i') THEN 'response has conversation prefix'
  WHEN lower(instruction) = lower(response) THEN 'instruction equals response' END AS reason FROM texts)"""
)
_CONV = """conv AS (SELECT conv_id * 1000 + turn AS pair_id, text AS instruction, next_text AS response FROM (SELECT *, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text FROM conversations) WHERE role = 'user' AND next_role = 'assistant')"""
_SENTENCES = r"""list_filter(list_transform(string_split(replace(replace(replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace({0}, '\b(Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|etc|vs|Fig)\.', '\1' || chr(1), 'g'),
  '\b(Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|etc|vs|Fig)!', '\1' || chr(2), 'g'), '\b(Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|etc|vs|Fig)\?', '\1' || chr(3), 'g'), '([.!?])\s+([A-Z"])', '\1' || chr(10) || '\2', 'g'), chr(1), '.'), chr(2), '!'), chr(3), '?'), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '')"""
# sections of paragraphs, cut into units, walked with the size of the open chunk; an end row closes each section
_CHUNKS = (
    _PLAIN_BOOKS
    + _PARAGRAPHS
    + ", secs AS ("
    + _BY_PARAGRAPH
    + r"""), sp AS (SELECT book_id, section_index, unnest(a) AS p, unnest(range(len(a))) AS i FROM (SELECT *, list_filter(list_transform(string_split_regex(body, '\n{2,}'), lambda x: trim(x, ' ' || chr(10))), lambda x: x <> '') AS a FROM secs)),
sn AS (SELECT *, """
    + _WORDS.format("p")
    + " AS n FROM sp), su AS (SELECT book_id, section_index, i, unnest(u) AS part, unnest(range(len(u))) AS j FROM (SELECT *, CASE WHEN n > 900 THEN "
    + _SENTENCES.format("p")
    + " ELSE [p] END AS u FROM sn)), items AS (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY section_index, ender, i, j) AS r FROM (SELECT book_id, section_index, i, j, part, "
    + _WORDS.format("part")
    + r""" AS n, 0 AS ender FROM su UNION ALL SELECT book_id, section_index, 0, 0, NULL, 0, 1 FROM secs)),
pack AS (SELECT DISTINCT book_id, CAST(0 AS BIGINT) AS r, CAST(0 AS BIGINT) AS size, false AS made, CAST(0 AS BIGINT) AS c, false AS tailed, CAST(NULL AS BIGINT) AS own, CAST(NULL AS BIGINT) AS dropped FROM items
  UNION ALL SELECT k.book_id, k.r + 1,
    CASE WHEN u.ender = 1 THEN CASE WHEN k.made OR k.size >= 50 THEN 50 ELSE 0 END WHEN k.size + u.n > 900 AND k.size >= 400 THEN u.n ELSE k.size + u.n END,
    u.ender = 0 AND (k.made OR (k.size + u.n > 900 AND k.size >= 400)),
    CASE WHEN u.ender = 1 OR (k.size + u.n > 900 AND k.size >= 400) THEN k.c + 1 ELSE k.c END,
    CASE WHEN u.ender = 1 THEN k.made OR k.size >= 50 WHEN k.size + u.n > 900 AND k.size >= 400 THEN false ELSE k.tailed END,
    CASE WHEN u.ender = 1 THEN NULL WHEN k.size + u.n > 900 AND k.size >= 400 THEN k.c + 1 ELSE k.c END,
    CASE WHEN u.ender = 1 AND k.size < 50 THEN k.c END
  FROM pack k JOIN items u ON u.book_id = k.book_id AND u.r = k.r + 1),
bodies2 AS (SELECT k.book_id, k.own AS c, bool_or(k.tailed) AS tailed, any_value(u.section_index) AS section_index, string_agg(u.part, chr(10) || chr(10) ORDER BY u.r) AS body FROM pack k JOIN items u USING (book_id, r) WHERE k.own IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM pack d WHERE d.book_id = k.book_id AND d.dropped = k.own) GROUP BY 1, 2),
ranked AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY book_id ORDER BY c) - 1 AS chunk_index FROM bodies2),
texts2 AS (SELECT book_id, chunk_index, body AS text FROM ranked WHERE chunk_index = 0
  UNION ALL SELECT b.book_id, b.chunk_index, CASE WHEN b.tailed THEN '[…] ' || array_to_string(string_split_regex(t.text, '\s+')[-50:], ' ') || chr(10) || chr(10) || b.body ELSE b.body END FROM texts2 t JOIN ranked b ON b.book_id = t.book_id AND b.chunk_index = t.chunk_index + 1),
ch AS MATERIALIZED (SELECT t.book_id, t.chunk_index, 'Passage ' || CAST(b.section_index + 1 AS VARCHAR) AS source_section, 'prose' AS section_type, t.text, CAST("""
    + _WORDS.format("t.text")
    + " AS BIGINT) AS word_count FROM texts2 t JOIN ranked b USING (book_id, chunk_index))"
)
_STUB = r""", sw AS (SELECT *, string_split_regex(trim(text, ' ' || chr(10)), '\s+') AS ws FROM ch), sg AS (SELECT sw.*, p, ws[p * 24 + 1 : p * 24 + 24] AS piece FROM sw, (SELECT unnest(range(80)) AS p) WHERE len(ws) > p * 24),
stub AS (SELECT book_id, chunk_index, p, 'What does part ' || CAST(p + 1 AS VARCHAR) || ' of ' || source_section || ' say?' AS instruction, array_to_string(piece, ' ') AS response FROM sg WHERE len(piece) >= 20)"""
_KEY = r"lower(trim({}, ' ' || chr(10)))"


def _template(num_pairs: str, avoid: str) -> str:
    from ..operators.generate import AVOID, TEMPLATE

    quoted = "'" + TEMPLATE.replace("'", "''") + "'"
    for name, value in (("num_pairs", num_pairs), ("source_section", "source_section"), ("section_type", "section_type"), ("chunk_text", "text")):
        quoted = quoted.replace("{" + name + "}", f"' || {value} || '")
    return quoted + " || CASE WHEN len(" + avoid + ") > 0 THEN '" + AVOID.replace("'", "''") + "' || array_to_string(list_transform(" + avoid + ", lambda x: '- ' || x), chr(10)) ELSE '' END"


_WITH = "WITH "
_RWITH = "WITH RECURSIVE "
ORACLES: dict[str, str] = {
    "word_count_by_book": _WITH + _PLAIN + " SELECT book_id, CAST(sum(" + _WORDS.format("text") + ") AS BIGINT) AS word_count, count(*) AS pages FROM plain GROUP BY 1",
    "normalise_whitespace": "WITH m AS (SELECT doc_id, regexp_replace(regexp_replace(' ' || chr(9) || replace(text, ' the ', ' ' || chr(9) || 'the' || chr(11) || ' ') || ' ' || repeat(chr(10), 4) || ' end' || chr(7) || ' ', '\\x0b', ' ', 'g'), '\\x07', '', 'g') AS t FROM documents) SELECT doc_id, md5(" + _TIDY.format("t") + ") AS clean_md5 FROM m",
    "sanitise_backslashes": r"""SELECT doc_id, md5(regexp_replace(replace(replace(text, 'a', '\a'), 'n', '\n'), '\\([^"\\/bfnrtu]|$)', '\\\\\1', 'g')) AS clean_md5 FROM documents""",
    "fingerprint_md5": "SELECT doc_id, " + _FP.format("text") + " AS fingerprint FROM documents",
    "ascii_tokens_topk": "SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS token FROM documents) GROUP BY 1 ORDER BY n DESC, token LIMIT 100",
    "noise_lines": _WITH + _LINES + f" SELECT book_id, count(*) AS n_noise FROM lines WHERE {_NOISE} GROUP BY 1",
    "boundary_lines": _WITH + _EDGES + " SELECT book_id, line, count(*) AS n FROM slots GROUP BY 1, 2 HAVING count(*) >= 3",
    "recurring_headers": _WITH + _EDGES + " SELECT book_id, line, n FROM recurring",
    "headers_removed": _WITH + _KEPT + " SELECT book_id, CAST(page_no AS INTEGER) AS page_no, count(*) AS n_lines FROM kept GROUP BY 1, 2",
    "clean_pages": _WITH + _CLEAN + " SELECT book_id, CAST(page_no AS INTEGER) AS page_no, md5(text) AS text_md5 FROM clean",
    "assembled_books": _WITH + _BOOKS + " SELECT book_id, md5(text) AS text_md5, CAST(len(text) AS BIGINT) AS n_chars FROM books",
    "headings": _WITH + _BOOKS + _HEADS + " SELECT book_id, CAST(line_no AS BIGINT) AS line_no, trim(line) AS heading, " + _TYPE.format("trim(line)") + " AS section_type FROM marked WHERE is_heading",
    "heading_types": _WITH + _BOOKS + _HEADS + " SELECT " + _TYPE.format("trim(line)") + " AS section_type, count(*) AS n FROM marked WHERE is_heading GROUP BY 1",
    "sections_by_heading": _WITH + _BOOKS + _SECTIONS + " SELECT book_id, section_index, title, section_type, word_count, md5(body) AS body_md5 FROM (" + _BY_HEADING + ")",
    "sections_by_paragraph": _RWITH + _PLAIN_BOOKS + _PARAGRAPHS + " SELECT book_id, section_index, title, section_type, word_count, md5(body) AS body_md5 FROM (" + _BY_PARAGRAPH + ")",
    "section_strategy": _RWITH + _BOOKS.replace("joined AS", "joined0 AS").replace("FROM joined)", "FROM joined0)").replace("books AS", "headed_books AS") + ", plain_joined AS (SELECT book_id, string_agg(text, chr(10) || chr(10) ORDER BY page_no) AS text FROM plain GROUP BY 1), books AS (SELECT * FROM headed_books WHERE regexp_matches(book_id, '[5-9]$') UNION ALL SELECT book_id, " + _TIDY.format("text") + " FROM plain_joined WHERE NOT regexp_matches(book_id, '[5-9]$'))" + _SECTIONS + _PARAGRAPHS + ", h AS (SELECT book_id, count(*) AS n FROM counted WHERE word_count >= 50 GROUP BY 1 HAVING count(*) >= 2) SELECT book_id, 'headings' AS strategy, n AS n_sections FROM h UNION ALL SELECT book_id, 'paragraphs', count(*) FROM grouped WHERE book_id NOT IN (SELECT book_id FROM h) GROUP BY 1",
    "sentence_split": r"""WITH s0 AS (SELECT doc_id, text, regexp_replace(regexp_replace(regexp_replace(text, '\b(Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|etc|vs|Fig)\.', '\1' || chr(1), 'g'), '\b(Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|etc|vs|Fig)!', '\1' || chr(2), 'g'), '\b(Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|etc|vs|Fig)\?', '\1' || chr(3), 'g') AS t FROM documents),
s1 AS (SELECT doc_id, text, list_filter(list_transform(string_split(replace(replace(replace(regexp_replace(t, '([.!?])\s+([A-Z"])', '\1' || chr(10) || '\2', 'g'), chr(1), '.'), chr(2), '!'), chr(3), '?'), chr(10)), lambda x: trim(x, ' ')), lambda x: x <> '') AS s FROM s0),
s2 AS (SELECT doc_id, CASE WHEN len(s) = 0 THEN [text] ELSE s END AS s FROM s1) SELECT doc_id, CAST(len(s) AS BIGINT) AS n_sentences, md5(array_to_string(s, chr(10))) AS sentences_md5 FROM s2""".replace("\\\\", "\\"),
    "chunks": _RWITH + _CHUNKS + " SELECT book_id, chunk_index, source_section, section_type, word_count, md5(text) AS text_md5 FROM ch",
    "chunk_stats": _RWITH + _CHUNKS + " SELECT book_id, count(*) AS n_chunks, CAST(sum(word_count) AS BIGINT) AS total_words, CAST(sum(word_count) AS BIGINT) // count(*) AS avg_words FROM ch GROUP BY 1",
    "batch_plan": _RWITH + _CHUNKS + " SELECT book_id, chunk_index, b AS batch_idx, least(20, 50 - b * 20) AS num_pairs FROM ch, (SELECT unnest(range(3)) AS b)",
    "run_estimate": _RWITH + _CHUNKS + " SELECT count(*) AS n_chunks, count(*) * 2 AS calls, round(count(*) * 2 * CAST(12 AS DOUBLE) / 60, 6) AS minutes FROM ch",
    "prompts": _RWITH + _CHUNKS + _STUB + ", have AS (SELECT book_id, chunk_index, count(*) AS n, list_transform(list_sort(list(DISTINCT lower(instruction)))[1:12], lambda x: left(x, 80)) AS listed FROM stub WHERE p < 20 GROUP BY 1, 2), pr AS (SELECT ch.*, coalesce(n, 0) AS n, coalesce(listed, []) AS listed FROM ch LEFT JOIN have USING (book_id, chunk_index)) SELECT book_id, chunk_index, md5(" + _template("CAST(40 - n AS VARCHAR)", "listed") + ") AS prompt_md5 FROM pr",
    "stub_pairs": _RWITH + _CHUNKS + _STUB + " SELECT book_id, chunk_index, p // 40 AS batch_idx, p % 40 AS pos, instruction, response FROM stub",
    "json_repair": _WITH + _JSON + " SELECT js.line_no, CASE WHEN js.line_no % 11 = 0 OR js.line_no % 13 = 0 OR js.line_no % 23 = 0 THEN NULL ELSE json_extract_string(value, '$.instruction') END AS instruction, CASE WHEN js.line_no % 11 = 0 OR js.line_no % 13 = 0 OR js.line_no % 23 = 0 THEN NULL ELSE json_extract_string(value, '$.response') END AS response FROM js",
    "resume_pending": _RWITH + _CHUNKS + " SELECT book_id, chunk_index, word_count FROM ch WHERE chunk_index % 3 <> 0",
    "validate_reasons": _WITH + _JSON + " SELECT coalesce(reason, 'valid') AS reason, count(*) AS n FROM checked GROUP BY 1",
    "validated_pairs": _WITH + _JSON + " SELECT line_no AS pair_id, instruction, response FROM checked WHERE reason IS NULL",
    "validation_counts": _WITH + _JSON + " SELECT (SELECT count(*) FROM js) AS total, (SELECT count(*) FROM checked WHERE reason IS NULL) AS valid",
    "dedup_instruction": _WITH + _U1 + " SELECT pair_id FROM u1",
    "dedup_response": _WITH + _U2 + " SELECT pair_id FROM u2",
    "quality_filtered": _WITH + _U3 + " SELECT pair_id FROM good",
    "idf_table": _WITH + _U3 + _TFIDF + " SELECT term, df, round(idf, 6) AS idf FROM idf",
    "tfidf_norms": _WITH + _U3 + _TFIDF + " SELECT pair_id, round(norm, 6) AS norm FROM norms",
    "similar_pairs": _WITH + _U3 + _SIM + " SELECT a, b, round(similarity, 6) AS similarity FROM sim",
    "near_dedup": _RWITH + _U3 + _NEAR + " SELECT pair_id FROM near",
    "dedup_summary": _RWITH + _U3 + _NEAR + " SELECT 'input' AS stage, count(*) AS n FROM pairs UNION ALL SELECT 'by_instruction', count(*) FROM u1 UNION ALL SELECT 'by_response', count(*) FROM u2 UNION ALL SELECT 'quality', count(*) FROM good UNION ALL SELECT 'near', count(*) FROM near",
    # pairs whose keys are no other's stay; the others are decided one after another, keys being numbers
    "part2_filtered": _RWITH + _PAIRS + ", " + _CONV.replace("SELECT conv_id * 1000 + turn AS pair_id", "SELECT turn, conv_id * 1000 + turn AS pair_id") + """, every AS (SELECT pair_id, instruction, response FROM conv UNION ALL SELECT pair_id + 500, ' ' || instruction || chr(10), response || ' more' FROM conv UNION ALL SELECT pair_id + 700, instruction || ' too', response FROM conv),
seen AS MATERIALIZED (SELECT """ + _KEY.format("instruction") + " AS ik, " + _KEY.format("response") + " AS rk FROM (SELECT instruction, response FROM pairs UNION ALL SELECT instruction, response FROM conv WHERE turn = 0)), cand AS MATERIALIZED (SELECT pair_id, dense_rank() OVER (ORDER BY " + _KEY.format("instruction") + ") AS i, dense_rank() OVER (ORDER BY " + _KEY.format("response") + ") AS r FROM every WHERE " + _KEY.format("instruction") + " NOT IN (SELECT ik FROM seen) AND " + _KEY.format("response") + """ NOT IN (SELECT rk FROM seen)),
several AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY pair_id) AS n FROM (SELECT *, count(*) OVER (PARTITION BY i) AS ni, count(*) OVER (PARTITION BY r) AS nr FROM cand) WHERE ni > 1 OR nr > 1),
fold AS (SELECT CAST(0 AS BIGINT) AS n, CAST([] AS BIGINT[]) AS gi, CAST([] AS BIGINT[]) AS gr, CAST(NULL AS BIGINT) AS kept UNION ALL
  SELECT f.n + 1, CASE WHEN list_contains(gi, s.i) OR list_contains(gr, s.r) THEN gi ELSE list_append(gi, s.i) END, CASE WHEN list_contains(gi, s.i) OR list_contains(gr, s.r) THEN gr ELSE list_append(gr, s.r) END,
    CASE WHEN list_contains(gi, s.i) OR list_contains(gr, s.r) THEN NULL ELSE s.pair_id END FROM fold f JOIN several s ON s.n = f.n + 1)
SELECT pair_id FROM cand WHERE pair_id NOT IN (SELECT pair_id FROM several) UNION ALL SELECT kept FROM fold WHERE kept IS NOT NULL""",
    "chat_export": _WITH + _CONV + """ SELECT pair_id, '{"messages":[{"role":"system","content":"You are a helpful tutor."},{"role":"user","content":' || CAST(to_json(instruction) AS VARCHAR) || '},{"role":"assistant","content":' || CAST(to_json(response) AS VARCHAR) || '}]}' AS value FROM conv""",
    "curate_end_to_end": _RWITH + _JSON + ", v AS (SELECT line_no AS pair_id, instruction, response FROM checked WHERE reason IS NULL), c1 AS (SELECT * FROM v QUALIFY row_number() OVER (PARTITION BY " + _FP.format("instruction") + " ORDER BY pair_id) = 1), c2 AS (SELECT * FROM c1 QUALIFY row_number() OVER (PARTITION BY " + _FP.format("response") + " ORDER BY pair_id) = 1)" + _GOOD.format("c2") + _NEAR + " SELECT pair_id, md5(instruction) AS instruction_md5, md5(response) AS response_md5 FROM near",
    "rejoined_hyphens": r"SELECT doc_id, md5(regexp_replace(replace(text, 'th', 't-' || chr(10) || 'h'), '(\w)-\n(\w)', '\1\2', 'g')) AS text_md5 FROM documents",
    "too_short_books": "SELECT book_id, word_count FROM (SELECT CAST(doc_id AS VARCHAR) AS book_id, CAST(" + _WORDS.format("text") + " AS BIGINT) AS word_count FROM documents) WHERE word_count < 500",
    "strict_pairs": _WITH + _JSON + " SELECT line_no AS pair_id, json_extract_string(value, '$.instruction') AS instruction, json_extract_string(value, '$.response') AS response FROM js WHERE json_valid(value)",
    "seen_keys": _WITH + _JSON + ", good AS (SELECT json_extract_string(value, '$.instruction') AS i, json_extract_string(value, '$.response') AS r FROM js WHERE json_valid(value)) SELECT DISTINCT 'instruction' AS kind, md5(" + _KEY.format("i") + ") AS key_md5 FROM good UNION ALL SELECT DISTINCT 'response', md5(" + _KEY.format("r") + ") FROM good",
    "line_count": _WITH + _JSON + " SELECT count(*) AS n FROM js WHERE trim(value) <> ''",
    "heading_rule": "WITH w AS (SELECT unnest(['Chapter', 'Act', 'Scene', 'Prologue', 'Epilogue', 'Part', 'Book', 'Volume', 'Section', 'Actor', 'Partly']) AS w), v AS (SELECT w FROM w UNION SELECT upper(w) FROM w UNION SELECT lower(w) FROM w), l AS (SELECT DISTINCT lang FROM documents), s AS (SELECT w AS line FROM v UNION SELECT w || ' ' || lang FROM v, l UNION SELECT lang || ' ' || w FROM v, l) SELECT line, regexp_matches(line, '^(?:chapter|act|scene|prologue|epilogue|part|book|volume|section)\\b.*$', 'i') AND NOT (NOT contains(line, ' ') AND upper(line) = line AND len(line) <= 4) AS is_heading, ".replace("\\\\", "\\") + _TYPE.format("line") + " AS section_type FROM s",
}
