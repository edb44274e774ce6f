from pyspark.sql import functions as F

from loomtext.functions import jsonrepair, text as T


def values(spark, texts, f):
    d = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    return [r[1] for r in d.select("k", f(F.col("t")).alias("v")).orderBy("k").collect()]


def test_noise_lines(spark):
    yes = ["12", "Page 12", "page12", "PAGE 3", "page 12", "١٢", "iv", "I", "Mild", "civic", "****", "— — —", "", "  "]
    no = ["12345", "Page xii", "***", "éééé"]
    assert values(spark, yes, T.is_noise) == [True] * len(yes)
    assert values(spark, no, T.is_noise) == [False] * len(no)


def test_headings(spark):
    yes = ["CHAPTER I", "Chapter One", "Act now, they said.", "Act", "Volume II", "Book 3", "Section 3"]
    no = ["ACT", "PART", "BOOK", "Chapters of life", "Chapman", "Partial", "Interlude", "THE BEGINNING"]
    assert values(spark, yes, T.is_heading) == [True] * len(yes)
    assert values(spark, no, T.is_heading) == [False] * len(no)
    assert values(spark, yes, T.heading_type) == ["chapter", "chapter", "act", "act", "part", "part", "section"]


def test_normalise_and_clean(spark):
    assert values(spark, ["éa b\x0bc\x07d​e"], T.normalise_unicode) == ["éa b cd​e"]
    assert values(spark, [" a \t b \n\n\n\n c "], T.clean_whitespace) == ["a b\n\nc"]
    once = values(spark, ["x  y \n z\n\n\n\nw"], lambda s: T.clean_whitespace(T.normalise_unicode(s)))
    assert values(spark, once, lambda s: T.clean_whitespace(T.normalise_unicode(s))) == once


def test_words_and_keys(spark):
    assert values(spark, ["", "  ", "a", " a b\nc ", None], T.count_words) == [0, 0, 1, 3, 0]
    assert values(spark, [" A b ", None], T.match_key) == ["a b", ""]
    assert len(set(values(spark, ["A  b", "a b ", "a B"], T.fingerprint))) == 1
    assert values(spark, ["Héllo w0rld"], T.tokens) == [["h", "llo", "w", "rld"]]


def test_backslashes(spark):
    assert values(spark, ["\\alpha", "\\beta", "a\x01b"], T.sanitise_json_string) == ["\\\\alpha", "\\beta", "ab"]


def test_sentences(spark):
    assert values(spark, ["Mr. Smith left. He ran! \"Why?\" no. yes"], T.sentences) == [["Mr. Smith left.", "He ran!", '"Why?" no. yes']]


def test_json_repair():
    assert jsonrepair.pairs('```json\n[{"instruction":"a","response":"b"},]\n```') == [{"instruction": "a", "response": "b"}]
    assert len(jsonrepair.pairs('{"instruction":"a","response":"b"}')) == 1
    assert len(jsonrepair.pairs('{"pairs":[{"instruction":"a","response":"b"}]}')) == 1
    assert len(jsonrepair.pairs('[{"instruction":"a","response":"b"},{"instruction":"c","response":"d"},{"instr')) == 2
    assert jsonrepair.pairs('[{"instruction":"what is ] here","response":"b"}]') == []
    assert jsonrepair.pairs('["x",{"instruction":"a","response":"b"}]') == [{"instruction": "a", "response": "b"}]
    assert jsonrepair.pairs(None) == []
