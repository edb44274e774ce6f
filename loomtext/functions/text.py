"""Text functions and predicates as column expressions.

Trimming and word counts go by the full Unicode white space (``WS``), not by what Spark's ``trim`` or ``\\s`` take.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# fixed values: white space, line ends, control characters, patterns
WS = r"[\t\n\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
WS_NOT_LINE = r"[\x0b\x0c\r\x1c-\x1f \x85\xa0\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
LINE_END = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\x{2028}\x{2029}]"
CONTROL = r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]"
PAGE_NUMBER = rf"(?i)^(?:(?:page{WS}*)?\p{{Nd}}{{1,4}}|[ivxlcdm]{{1,8}})$"
GARBAGE = r"^[^\p{L}\p{N}]{4,}$"
HEADING = r"(?i)^(?:chapter|act|scene|prologue|epilogue|part|book|volume|section)\b.*$"
SPEAKER = rf"(?i)^(?:student|teacher|professor|tutor|q|a|user|assistant){WS}*:"
SENTENCE_END = r"(?<!\b(?:Mr|Mrs|Ms|Dr|Prof|Sr|Jr|St|etc|vs|Fig))([.!?])\s+(?=[A-Z\"])"


def strip(s: Column) -> Column:
    return F.regexp_replace(s, rf"^{WS}+|{WS}+$", "")


def words(s: Column) -> Column:
    t = strip(s)
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, f"{WS}+"))


def count_words(s: Column) -> Column:
    """Number of white-space separated words, as long; null counts 0."""
    t = strip(F.coalesce(s, F.lit("")))
    return F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, f"{WS}+"))).cast("bigint")


@F.pandas_udf(StringType())
def _nfc(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in parts:
        yield s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def nfc(s: Column) -> Column:
    """Spark has no normaliser. Only text with characters from U+0300 on can change, so only that goes to Python."""
    changed = _nfc(F.when(s.rlike(r"[^\x00-\x{2ff}]"), s))
    return F.coalesce(changed, s)


def normalise_unicode(s: Column) -> Column:
    """NFC, then each white-space character but newline and tab to one space, then control characters out."""
    return F.regexp_replace(F.regexp_replace(nfc(s), WS_NOT_LINE, " "), CONTROL, "")


def clean_whitespace(s: Column) -> Column:
    """Blanks in a line to one space, lines trimmed, at most one blank line; for text after normalise_unicode."""
    t = F.regexp_replace(s, r"[ \t]+", " ")
    t = F.regexp_replace(t, r" ?\n ?", "\n")
    return strip(F.regexp_replace(t, r"\n{3,}", "\n\n"))


def sanitise_json_string(s: Column) -> Column:
    """Doubles backslashes that start no JSON escape, removes control characters. Not idempotent, by definition."""
    t = F.regexp_replace(s, r"""\\(?!["\\/bfnrtu])""", r"\\\\")
    return F.regexp_replace(t, r"[\x00-\x08\x0b\x0c\x0e-\x1f]", "")


def clean_string(s: Column) -> Column:
    return sanitise_json_string(clean_whitespace(normalise_unicode(s)))


def fingerprint(s: Column) -> Column:
    return F.md5(F.array_join(words(F.lower(s)), " "))


def tokens(s: Column) -> Column:
    return F.regexp_extract_all(F.lower(s), F.lit("[a-z]+"), F.lit(0))


def match_key(s: Column) -> Column:
    return F.lower(strip(F.coalesce(s, F.lit(""))))


def paragraphs(s: Column) -> Column:
    return F.filter(F.transform(F.split(s, r"\n{2,}"), strip), lambda x: x != "")


def sentences(paragraph: Column) -> Column:
    """Sentence ends before a capital or a quote split; known abbreviations don't."""
    parts = F.filter(F.transform(F.split(F.regexp_replace(paragraph, SENTENCE_END, "$1\n"), "\n"), strip), lambda x: x != "")
    return F.when(F.size(parts) == 0, F.array(paragraph)).otherwise(parts)


def lines(page: Column) -> Column:
    """Lines by any Unicode line end; a final one begins no further line."""
    t = F.regexp_replace(F.coalesce(page, F.lit("")), rf"(?:{LINE_END})\z", "")
    return F.when(F.coalesce(page, F.lit("")) == "", F.array().cast("array<string>")).otherwise(F.split(t, LINE_END, -1))


def rejoin_hyphens(page: Column) -> Column:
    return F.regexp_replace(page, r"(?U)(\w)-\n(\w)", "$1$2")


def heading_type(h: Column) -> Column:
    t = F.lower(h)
    return (
        F.when(t.rlike("^(?:chapter|chap)"), "chapter").when(t.rlike(r"^act\b"), "act").when(t.rlike(r"^scene\b"), "scene")
        .when(t.startswith("prologue"), "prologue").when(t.startswith("epilogue"), "epilogue").when(t.rlike("^(?:part|book|volume)"), "part").otherwise("section")
    )


def is_noise(line: Column) -> Column:
    t = strip(line)
    return (t == "") | t.rlike(PAGE_NUMBER) | t.rlike(GARBAGE)


def is_heading(line: Column) -> Column:
    """A heading word at the start; but not one short word all in capitals."""
    t = strip(line)
    shout = (count_words(t) == 1) & (F.upper(t) == t) & t.rlike(r"\p{Lu}") & (F.length(t) <= 4)
    return line.rlike(HEADING) & ~shout


def pair_fault(instruction: Column, response: Column, min_words: int) -> Column:
    """The first reason against a pair, or null."""
    i, r = F.coalesce(instruction, F.lit("")), F.coalesce(response, F.lit(""))
    n = count_words(r)
    return (
        F.when(strip(i) == "", "empty instruction").when(strip(r) == "", "empty response")
        .when(n < min_words, F.concat(F.lit("response too short ("), n.cast("string"), F.lit(" words)")))
        .when(strip(i).rlike(SPEAKER), "instruction has conversation prefix").when(strip(r).rlike(SPEAKER), "response has conversation prefix")
        .when(F.lower(strip(i)) == F.lower(strip(r)), "instruction equals response")
    )


def generated_ok(instruction: Column, response: Column, min_words: int = 20) -> Column:
    i, r = F.coalesce(instruction, F.lit("")), F.coalesce(response, F.lit(""))
    return (strip(i) != "") & (strip(r) != "") & (count_words(r) >= min_words) & ~strip(i).rlike(SPEAKER)


def low_quality(instruction: Column, response: Column, min_words: int) -> Column:
    """Too short a response, or one that mostly repeats a long instruction."""
    i, r = F.lower(instruction), F.lower(response)
    copied = F.contains(r, i) & (count_words(instruction) > 8) & (F.length(instruction) / F.greatest(F.length(response), F.lit(1)) > 0.8)
    return (count_words(response) < min_words) | copied
