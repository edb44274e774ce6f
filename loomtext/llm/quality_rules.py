"""Quality rules whose cutoffs adapt to the corpus (DataFrame functions only).

Base measurements of each whole text are compared with fixed floor rules
(``base_failed``), then with cutoffs learned from the corpus: every signal is
summarised in KLL quantile sketches per (lang, source).  Sketches are mergeable, so
map tasks build partial ones, and small groups merge into their language's sketch and
that into the corpus's, instead of being judged by a handful of rows.

A cutoff is an outer fence: the median plus ``spread`` times the distance to the upper quartile or, if that is less (most
documents have none of a signal), times what one occurrence comes to in a document of the group's median length; ``least``
guards groups of very long documents. The mean word length has a fence on both sides.  Quartiles lie in the junk where that
is common, so a group's fence is held within ``SLACK`` of the typical one: the median over the fences of its language's
groups, each counted once however large it is (over the corpus's groups where a language has too few; word lengths differ
between languages and are then not held).  A clean group loses nothing and no share of rows is always cut off.

Edge cases: null or empty text has no words, all counts 0, ``base_failed`` true; null
lang or source is a group of its own; a signal that equals its cutoff passes; very long texts
are measured whole; an empty table gives an empty table; repeated rows each get their row;
extra columns are kept, whatever their names: only columns called as the measurements
(``q_words``, ``q_kept`` ...) are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .shared import few, fresh, settled

WS = r"\x20\x09-\x0D"
SYMBOLS = r"[#*$%&|<>]"

#: (signal, spread, what an occurrence is counted in, how many of these it takes up, least distance from the median, most that a cutoff may be)
SIGNALS = (
    ("symbol_rate", 10.0, "words", 1.0, 0.02, None),
    ("upper_rate", 10.0, "words", 1.0, 0.02, None),
    ("repeat_rate", 8.0, "words", 6.0, 0.05, 0.9),
    ("dup_line_rate", 4.0, "n_lines", 1.0, 0.2, 0.9),
)
LENGTH, LENGTH_SPREAD = "word_length", 10.0
SKETCHED = (*(x[0] for x in SIGNALS), LENGTH, "words", "n_lines")
CUTS = (*(x[0] for x in SIGNALS), "low_length", "high_length")
#: a group's fence against the typical one; word lengths vary far less than rates
SLACK, LENGTH_SLACK = 2.0, 1.15
#: rows that make a group's fence count for the typical one, and groups that a language needs for its own
VOTES, GROUPS = 20, 3
MIN_GROUP = 200
SKETCH_K = 200


def _repeat_words(words: Column) -> Column:
    """Words inside any 3-word window that occurs at least twice."""
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(F.get(words, i - 1), F.get(words, i), F.get(words, i + 1)))
    return F.when(n >= 4, hashes).otherwise(F.array().cast("array<bigint>"))


def _sorted_pairs(hashes: Column) -> Column:
    """(hash, position) of each window, equal hashes side by side; empty if all differ."""
    pairs = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return F.when(F.size(F.array_distinct(hashes)) < F.size(hashes), pairs).otherwise(F.array().cast("array<struct<h:bigint,i:int>>"))


def _repeated_starts(pairs: Column) -> Column:
    """Sorted positions of the windows that have an equal neighbour."""
    marked = F.transform(pairs, lambda p, k: F.when((F.get(pairs, k - 1)["h"] == p["h"]) | (F.get(pairs, k + 1)["h"] == p["h"]), p["i"]))
    return F.array_sort(F.array_compact(marked))


def _span(starts: Column) -> Column:
    """Total length of [s, s+3) over sorted starts."""
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-3).alias("last")),
        lambda acc, s: F.struct(
            (acc["n"] + F.least(F.lit(3), s - acc["last"])).cast("bigint").alias("n"), s.alias("last")
        ),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame) -> DataFrame:
    """Adds the measurements, prefixed ``q_``, to every row of docs(text, ...).

    Each step's array is referenced more than once by the next, so that the optimiser keeps
    the projections apart and evaluates it once a row.
    """
    t = F.coalesce(F.col("text"), F.lit(""))
    w, h, ls, p = fresh(docs, "q_w", "q_h", "q_lines", "q_p")
    d = docs.withColumn(w, F.regexp_extract_all(t, F.lit(f"[^{WS}]+"), F.lit(0)))
    d = d.withColumns({
        h: _repeat_words(F.col(w)),
        "q_words": F.size(w).cast("bigint"),
        "q_chars": F.length(F.array_join(w, "")).cast("bigint"),
        "q_symbols": F.regexp_count(t, F.lit(SYMBOLS)).cast("bigint"),
        "q_upper": F.regexp_count(t, F.lit(r"\p{Lu}{2,}")).cast("bigint"),
        ls: F.filter(F.split(t, "\n"), lambda x: x.rlike(f"[^{WS}]")),
    })
    d = d.withColumns({
        p: _sorted_pairs(F.col(h)),
        "q_dup_lines": (F.size(ls) - F.size(F.array_distinct(ls))).cast("bigint"),
        "q_n_lines": F.size(ls).cast("bigint"),
    })
    d = d.withColumn("q_repeat", _span(_repeated_starts(F.col(p))))
    rate = lambda a, b: F.col(a) / F.greatest(F.col(b), F.lit(1))
    return d.withColumns({
        "q_base_failed": (F.col("q_words") < 50) | (100 * F.col("q_repeat") > 50 * F.col("q_words")),
        "q_symbol_rate": rate("q_symbols", "q_words"),
        "q_upper_rate": rate("q_upper", "q_words"),
        "q_repeat_rate": rate("q_repeat", "q_words"),
        "q_dup_line_rate": rate("q_dup_lines", "q_n_lines"),
        "q_word_length": rate("q_chars", "q_words"),
    }).drop(w, h, p, ls)


def _fences(prefix: str) -> list[Column]:
    at = lambda name, q: F.expr(f"IF(n > 0, kll_sketch_get_quantile_double(k_{name}, {q}D), NULL)")
    out = []
    for name, spread, unit, takes, least, most in SIGNALS:
        m = at(name, 0.5)
        fence = m + F.greatest(F.lit(least), F.lit(spread) * F.greatest(at(name, 0.75) - m, F.lit(takes) / F.greatest(at(unit, 0.5), F.lit(1.0))))
        out.append((fence if most is None else F.least(fence, F.lit(most))).alias(f"{prefix}_{name}"))
    m = at(LENGTH, 0.5)
    out.append((m - LENGTH_SPREAD * F.greatest(m - at(LENGTH, 0.25), F.lit(0.02) * m)).alias(f"{prefix}_low_length"))
    out.append((m + LENGTH_SPREAD * F.greatest(at(LENGTH, 0.75) - m, F.lit(0.02) * m)).alias(f"{prefix}_high_length"))
    return out


def thresholds(measured: DataFrame, min_group: int = MIN_GROUP) -> DataFrame:
    """One row per (lang, source): the cutoffs of its own sketches if it has ``min_group`` documents, else those of
    its language's merged sketches, else those of the whole corpus's; all held near the typical ones."""
    # base_failed rows count as null, which sketches skip; a filter would be pushed below and measure everything again
    sketch = [F.expr(f"kll_sketch_agg_double(IF(q_base_failed, NULL, CAST(q_{s} AS DOUBLE)), {SKETCH_K})").alias(f"k_{s}") for s in SKETCHED]
    merge = [F.expr(f"kll_merge_agg_double(k_{s})").alias(f"k_{s}") for s in SKETCHED]
    group = measured.groupBy("lang", "source").agg(F.count_if(~F.col("q_base_failed")).alias("n"), *sketch)
    lang = group.groupBy("lang").agg(F.sum("n").alias("n"), *merge)
    whole = lang.groupBy().agg(F.sum("n").alias("n"), *merge)
    own = settled(group.select("lang", "source", F.col("n").alias("n_group"), *_fences("g")))
    per = lang.select(F.col("lang").alias("l_lang"), F.col("n").alias("n_lang"), *_fences("l"))
    vote = F.col("n_group") >= VOTES
    typical = lambda p: [F.median(F.when(vote, F.col(f"g_{c}"))).alias(f"{p}_{c}") for c in CUTS]
    of_lang = own.groupBy(F.col("lang").alias("t_lang_")).agg(F.count_if(vote).alias("n_votes"), *typical("tl"))
    every = whole.select(*_fences("c")).crossJoin(own.groupBy().agg(*typical("tc")))
    joined = own.join(F.broadcast(every)).join(per, F.col("lang").eqNullSafe(F.col("l_lang"))).join(of_lang, F.col("lang").eqNullSafe(F.col("t_lang_")))
    enough, cut = F.col("n_votes") >= GROUPS, []
    for c in CUTS:
        fence = F.when(F.col("n_group") >= min_group, F.col(f"g_{c}")).when(F.col("n_lang") >= min_group, F.col(f"l_{c}")).otherwise(F.col(f"c_{c}"))
        if c == "low_length":
            fence = F.greatest(fence, F.when(enough, F.col(f"tl_{c}") / LENGTH_SLACK))
        elif c == "high_length":
            fence = F.least(fence, F.when(enough, F.col(f"tl_{c}") * LENGTH_SLACK))
        else:
            fence = F.least(fence, SLACK * F.when(enough, F.col(f"tl_{c}")).otherwise(F.col(f"tc_{c}")))
        cut.append(fence.alias(f"cut_{c}"))
    return joined.select(F.col("lang").alias("t_lang"), F.col("source").alias("t_source"), *cut)


def judge(measured: DataFrame, cuts: DataFrame) -> DataFrame:
    """Adds ``q_kept``: not base_failed and within every cutoff of its (lang, source). Few groups' cutoffs go to the rows; only if
    there are more are rows shuffled to them."""
    send = few(settled(cuts), 100_000)  # one row a language and source
    own = dict(zip(cuts.columns, fresh(measured, *cuts.columns)))
    send = send.withColumnsRenamed(own)
    cut = lambda c: F.col(own[f"cut_{c}"])
    within = F.coalesce(F.col(f"q_{LENGTH}").between(cut("low_length"), cut("high_length")), F.lit(True))
    for s in SIGNALS:
        within = within & F.coalesce(F.col(f"q_{s[0]}") <= cut(s[0]), F.lit(True))
    on = F.col("lang").eqNullSafe(F.col(own["t_lang"])) & F.col("source").eqNullSafe(F.col(own["t_source"]))
    joined = measured.join(send, on, "left")
    return joined.withColumn("q_kept", ~F.col("q_base_failed") & within).drop(*own.values())
