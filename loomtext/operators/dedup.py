"""Deduplication of pairs(pair_id, instruction, response): exact by fingerprint, low quality, near by TF-IDF cosine.

The near pass is exact. Weights are all positive, so only pairs that share a term can be similar. Each normalised vector's
terms are put in order of rising document frequency, and only the shortest prefix is indexed whose remaining norm is below
the threshold: two vectors without a common prefix term cannot reach it. Terms that many instructions share come last in that
order, so the index's lists stay short. What the prefixes' common terms give, and what the rests' norms could add, leaves few
candidates; these are verified on whole vectors, an array each.

The passes before it go by fingerprints: texts are read once, and only ids, fingerprints and instructions go on.

A row is dropped if a row before it that is itself kept is similar: rounds decide all rows whose earlier neighbours are
decided.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ..config import EngineConfig
from ..functions import text as T
from ..settle import settle, stored, tidy


def _first_by(pairs: DataFrame, column: str) -> DataFrame:
    """The first pair of each fingerprint. Only fingerprints and ids are shuffled, and pre-aggregated before."""
    first = pairs.groupBy(T.fingerprint(F.coalesce(F.col(column), F.lit(""))).alias("fp")).agg(F.min("pair_id").alias("pair_id"))
    return pairs.join(first.select("pair_id"), "pair_id", "left_semi")


def by_instruction(pairs: DataFrame) -> DataFrame:
    return _first_by(pairs, "instruction")


def by_response(pairs: DataFrame) -> DataFrame:
    """The first of each response; meant for the survivors of by_instruction."""
    return _first_by(pairs, "response")


def good_pairs(pairs: DataFrame, min_words: int = 20) -> DataFrame:
    return pairs.where(~T.low_quality(F.col("instruction"), F.col("response"), min_words))


def term_counts(pairs: DataFrame) -> DataFrame:
    """(pair_id, term, n)."""
    return pairs.select("pair_id", F.explode(T.tokens(F.col("instruction"))).alias("term")).groupBy("pair_id", "term").agg(F.count("*").alias("n"))


def _idf(counts: DataFrame, pairs: DataFrame) -> DataFrame:
    total = pairs.agg(F.greatest(F.count("*"), F.lit(1)).alias("total"))
    df = counts.groupBy("term").agg(F.count("*").alias("df"))
    return df.join(F.broadcast(total)).select("term", "df", (F.log(F.col("total") / (F.col("df") + 1)) + 1).alias("idf"))


def idf(pairs: DataFrame) -> DataFrame:
    """(term, df, idf), idf = ln(N / (df + 1)) + 1 with N all pairs, those without terms too."""
    return _idf(term_counts(pairs), pairs)


def tfidf(pairs: DataFrame) -> DataFrame:
    """(pair_id, term, df, w): tf * idf."""
    counts = settle(term_counts(pairs))
    sizes = counts.groupBy("pair_id").agg(F.sum("n").alias("total"))
    return counts.join(sizes, "pair_id").join(_idf(counts, pairs), "term").select("pair_id", "term", "df", (F.col("n") / F.col("total") * F.col("idf")).alias("w"))


def _norms(weights: DataFrame) -> DataFrame:
    return weights.groupBy("pair_id").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))


def norms(pairs: DataFrame) -> DataFrame:
    return _norms(tfidf(pairs))


def unit_vectors(pairs: DataFrame) -> DataFrame:
    """(pair_id, id, w, rest, end): the normalised vectors; ids of terms stand for them. In order of rising document frequency,
    rest is the norm from a term on, itself included."""
    counts = stored(term_counts(pairs))
    terms = stored(_idf(counts, pairs).withColumn("id", F.monotonically_increasing_id()))  # stored, so that ids stay as they are
    raw = counts.join(terms, "term").select("pair_id", "id", "df", (F.col("n") * F.col("idf")).alias("w"))
    every = Window.partitionBy("pair_id")
    square = F.col("w") * F.col("w")
    d = raw.select("pair_id", "id", "w", F.sum(square).over(every.orderBy(F.col("df").desc(), F.col("id").desc())).alias("rest"), F.sum(square).over(every).alias("all"))
    unit = stored(d.where("all > 0").select("pair_id", "id", (F.col("w") / F.sqrt("all")).alias("w"), F.sqrt(F.col("rest") / F.col("all")).alias("rest")))
    tidy(unit)
    return unit


#: what sums of rounded weights may lack
EPS = 1e-9


def _candidates(unit: DataFrame, threshold: float) -> DataFrame:
    """(a, b), a < b: all pairs that can reach the threshold, and some that don't."""
    after = F.sqrt(F.greatest(F.col("rest") * F.col("rest") - F.col("w") * F.col("w"), F.lit(0.0)))
    # what is left from this term on, itself included, could still reach the threshold
    prefix = unit.where(F.col("rest") >= threshold - EPS).select("pair_id", "id", "w", after.alias("after"))
    prefix = prefix.withColumn("end", F.min("after").over(Window.partitionBy("pair_id")))
    a, b = (prefix.select(F.col("pair_id").alias(x), "id", *(F.col(c).alias(f"{c}_{x}") for c in ("w", "after", "end"))) for x in "ab")
    # the prefix that ends first leaves its end, the other at most what comes after the last common term
    rows = a.join(b, "id").where("a < b").select("a", "b", F.expr("w_a * w_b").alias("s"), F.expr("greatest(end_a * after_b, end_b * after_a)").alias("more"))
    return rows.groupBy("a", "b").agg(F.sum("s").alias("s"), F.min("more").alias("more")).where(F.col("s") + F.col("more") >= threshold - EPS).select("a", "b")


def _dots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b, similarity) of rows(a, b, va, vb)."""
    for whole in batches:
        for at in range(0, whole.num_rows, 1024):
            batch = whole.slice(at, 1024)
            rows, ids, ws = [], [], []
            for c in ("va", "vb"):
                v = batch.column(c)
                rows.append(np.repeat(np.arange(len(v)), v.value_lengths().to_numpy(zero_copy_only=False)))
                ids.append(v.flatten().field("id").to_numpy(zero_copy_only=False))
                ws.append(v.flatten().field("w").to_numpy(zero_copy_only=False))
            found, number = np.unique(np.concatenate(ids), return_inverse=True)
            key = [r * len(found) + n for r, n in zip(rows, np.split(number.ravel(), [len(ids[0])]))]
            _, i, j = np.intersect1d(*key, assume_unique=True, return_indices=True)
            dots = np.bincount(rows[0][i], ws[0][i] * ws[1][j], batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(dots)], ["a", "b", "similarity"])


def _similar(unit: DataFrame, threshold: float) -> DataFrame:
    """(a, b, similarity), a < b, of unit_vectors."""
    candidates = stored(_candidates(unit, threshold))
    tidy(unit)
    vectors = unit.groupBy("pair_id").agg(F.collect_list(F.struct("id", "w")).alias("v"))
    va, vb = (vectors.select(F.col("pair_id").alias(x), F.col("v").alias(f"v{x}")) for x in "ab")
    kind = dict(unit.dtypes)["pair_id"]
    dots = candidates.join(va, "a").join(vb, "b").select("a", "b", "va", "vb").mapInArrow(_dots, f"a {kind}, b {kind}, similarity double")
    return dots.where(F.col("similarity") >= threshold)


def similar_pairs(pairs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """(a, b, similarity), a < b, of the pairs of instructions at or above the threshold."""
    return _similar(unit_vectors(pairs), threshold)


def dropped_by(links: DataFrame) -> DataFrame:
    """(id) of the rows that go: those with a kept neighbour before them, in links(a, b), a < b. Each round decides the rows that
    have no undecided neighbour before them, so there are as many rounds as the longest chain has rows, at most."""
    links = settle(links.select("a", "b"))
    gone = []
    while True:
        # rows with no undecided neighbour before them are kept; what they are linked to goes
        later = links.select(F.col("b").alias("a")).distinct()
        kept = links.join(later, "a", "left_anti").select("a").distinct()
        out = settle(links.join(kept, "a", "left_semi").select(F.col("b").alias("id")).distinct())
        gone = _joined([*gone, out])
        ids_a, ids_b = out.select(F.col("id").alias("a")), out.select(F.col("id").alias("b"))
        links = settle(links.join(ids_a, "a", "left_anti").join(ids_b, "b", "left_anti"))
        if links.isEmpty():
            return _union(gone)


def first_kept(keys: DataFrame) -> DataFrame:
    """(id) of the rows of keys(id, kind, key) that stay when each goes that shares a key with a kept row before it. Rounds go on
    until all are decided."""
    left = settle(keys)
    kept = []
    while True:
        first = left.groupBy("kind", "key").agg(F.min("id").alias("first"))
        marked = left.join(first, ["kind", "key"])
        now = settle(marked.groupBy("id").agg(F.bool_and(F.col("first") == F.col("id")).alias("all")).where("all").select("id"))
        kept = _joined([*kept, now])
        taken = left.join(now, "id", "left_semi").select("kind", "key").distinct()
        out = left.join(taken, ["kind", "key"], "left_semi").select("id").distinct()
        left = settle(left.join(out, "id", "left_anti"))
        if left.isEmpty():
            return _union(kept)


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def _joined(parts: list[DataFrame]) -> list[DataFrame]:
    """The parts, many of them made one, so that plans stay short however many rounds there are."""
    return [settle(_union(parts))] if len(parts) >= 32 else parts


def near_dedup(pairs: DataFrame, threshold: float = 0.85) -> DataFrame:
    """Of equal vectors only the first can stay, and what is similar to one is to all, so only these firsts are compared."""
    unit = unit_vectors(pairs)
    form = F.array_sort(F.collect_list(F.struct("id", "w")))
    same = settle(unit.groupBy("pair_id").agg(F.md5(F.to_json(form)).alias("form")))
    first = settle(same.groupBy("form").agg(F.min("pair_id").alias("first")))
    copies = same.join(first, "form").where("pair_id != first").select(F.col("pair_id").alias("id"))
    firsts = unit.join(settle(copies).withColumnRenamed("id", "pair_id"), "pair_id", "left_anti")
    gone = copies.union(dropped_by(_similar(stored(firsts), threshold)))
    return pairs.join(gone.withColumnRenamed("id", "pair_id"), "pair_id", "left_anti")


def _marked(pairs: DataFrame, min_words: int) -> DataFrame:
    """(pair_id, instruction, i, r, low): all that the passes look at, fingerprints for texts."""
    i, r = (T.fingerprint(F.coalesce(F.col(c), F.lit(""))) for c in ("instruction", "response"))
    low = T.low_quality(F.col("instruction"), F.col("response"), min_words)
    return stored(pairs.select("pair_id", "instruction", i.alias("i"), r.alias("r"), low.alias("low")))


def _passes(pairs: DataFrame, min_words: int) -> dict[str, DataFrame]:
    d = _marked(pairs, min_words)
    out = {"input": d}
    for name, key in (("by_instruction", "i"), ("by_response", "r")):
        d = d.join(d.groupBy(key).agg(F.min("pair_id").alias("pair_id")).select("pair_id"), "pair_id", "left_semi")
        out[name] = d = stored(d)
    return out | {"quality": d.where(~F.col("low"))}


def survivors(pairs: DataFrame, min_words: int = 20) -> DataFrame:
    """(pair_id, instruction) of what by_instruction, by_response and good_pairs, one after another, leave."""
    return _passes(pairs, min_words)["quality"].select("pair_id", "instruction")


def stages(pairs: DataFrame, cfg: EngineConfig = EngineConfig()) -> dict[str, DataFrame]:
    """The pairs' ids and instructions after each pass; the order of the passes matters."""
    out = {name: d.select("pair_id", "instruction") for name, d in _passes(pairs, cfg.min_response_words).items()}
    return out | {"near": near_dedup(out["quality"], cfg.similarity_threshold)}


def deduplicate(pairs: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """What all passes leave; rows that share an id are judged one by one for their quality."""
    return good_pairs(pairs.join(stages(pairs, cfg)["near"].select("pair_id"), "pair_id", "left_semi"), cfg.min_response_words)


def summary(pairs: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """(stage, n) of each pass."""
    out = None
    for name, d in stages(pairs, cfg).items():
        row = d.agg(F.lit(name).alias("stage"), F.count("*").alias("n"))
        out = row if out is None else out.union(row)
    return out
