"""DuckDB SQL that the queries must agree with, written from their contracts."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x20\x09-\x0D]+"


def _lower(x: str) -> str:
    return f"translate({x}, '{_UPPER}', '{_LOWER}')"


_LINES = rf"""WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents),
l AS (SELECT doc_id, unnest(a) AS line, unnest(range(len(a))) AS no FROM d),
k AS (SELECT *, {_lower(f"regexp_replace(regexp_replace(line, '^{_WS}+', ''), '{_WS}+$', '')")} AS key FROM l),
shared AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY 1 HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS gone FROM k LEFT JOIN shared s ON s.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM m GROUP BY 1"""

_BENCH_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LEAKS = rf"""WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_lower("coalesce(text, '')")}, '{_BENCH_WORD}') AS w FROM benchmark WHERE item_id IS NOT NULL),
bw AS (SELECT DISTINCT item, m, array_to_string(w[i : i + m - 1], ' ') AS win FROM (SELECT item, w, least(8, len(w)) AS m, unnest(range(1, len(w) - least(8, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
d AS MATERIALIZED (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_BENCH_WORD}') AS w FROM documents),
dw AS (SELECT doc_id, m, i, array_to_string(w[i : i + m - 1], ' ') AS win FROM (SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM d, (SELECT DISTINCT m FROM bw) WHERE len(w) >= m)),
hits AS MATERIALIZED (SELECT dw.doc_id, dw.m, dw.i, bw.item FROM dw JOIN bw ON bw.m = dw.m AND bw.win = dw.win),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + m)) AS p FROM hits) GROUP BY 1),
items AS (SELECT doc_id, list_sort(list(DISTINCT item)) AS found FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_hit, CAST(coalesce(len(found), 0) AS BIGINT) AS n_items, sha256(coalesce(array_to_string(found, ','), '')) AS items_sha256, coalesce(len(found), 0) >= 2 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)"""

_RULES = rf"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS win FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d WHERE len(w) >= 3)),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, win) AS n FROM g) WHERE n > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 3)) AS p FROM again) GROUP BY 1),
ls AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS a FROM d)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars, CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(len(a) - len(list_distinct(a)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words, len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed
FROM d JOIN ls USING (doc_id) LEFT JOIN covered USING (doc_id)"""

_NEAR = rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_lower("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i : i + m - 1], ' ') AS sh FROM (SELECT doc_id, w, least(5, len(w)) AS m, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
links AS MATERIALIZED (SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id GROUP BY 1, 2) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 85 * (na.n + nb.n - c)),
reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON l.a = r.b),
least_of AS (SELECT a, min(b) AS b FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id, d.doc_id <= coalesce(b, d.doc_id) AS kept FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN least_of ON a = d.doc_id"""

_DIGITS = "regexp_replace({}, '[^0-9]', '', 'g')"
_LUHN = f"""(list_sum(list_transform(range(1, length({_DIGITS.format("m")}) + 1), lambda i: CASE WHEN i % 2 = 1 THEN CAST(reverse({_DIGITS.format("m")})[i] AS INTEGER)
  ELSE (CAST(reverse({_DIGITS.format("m")})[i] AS INTEGER) * 2) % 10 + CAST(reverse({_DIGITS.format("m")})[i] AS INTEGER) // 5 END)) % 10 = 0)"""
#: kind: (pattern, test of a match m)
_KINDS = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "true"),
    "ip": (r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "len(list_filter(string_split(m, '.'), lambda p: length(ltrim(p, '0')) > 3 OR CAST('0' || ltrim(p, '0') AS HUGEINT) > 255)) = 0"),
    "card": (r"[0-9](?:[\x20-]?[0-9])+", f"(length({_DIGITS.format('m')}) BETWEEN 13 AND 19 AND {_LUHN})"),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", f"length({_DIGITS.format('m')}) BETWEEN 9 AND 15"),
}


def _pii() -> str:
    parts = []
    for k, (name, (pattern, test)) in enumerate(_KINDS.items()):
        sizes = lambda x: f"coalesce(list_sum(list_transform({x}, lambda x: length(x))), 0)"
        parts.append(
            f"""SELECT doc_id, {k} AS k, '{name}' AS kind, m, start, start + length(m) AS stop FROM (SELECT doc_id, unnest(ms) AS m, unnest(list_transform(range(1, len(ms) + 1), lambda i: {sizes("ps[1 : i]")} + {sizes("ms[1 : i - 1]")})) AS start
FROM (SELECT doc_id, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS ps FROM documents WHERE text IS NOT NULL)) WHERE {test}"""
        )
    counts = ", ".join(f"count(*) FILTER (WHERE kind = '{name}') AS n_{name}" for name in _KINDS)
    return f"""WITH found AS ({" UNION ALL ".join(parts)}) SELECT d.doc_id, {counts}, sha256(coalesce(string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY k, start), '')) AS base_sha256
FROM documents d LEFT JOIN found f ON f.doc_id = d.doc_id GROUP BY 1"""


ORACLES = {"op1_line_dedup": _LINES, "op6_decontaminate": _LEAKS, "op9_minhash": _NEAR, "quality_base": _RULES, "pii_base": _pii()}
