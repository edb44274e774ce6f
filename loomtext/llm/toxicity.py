"""Toxicity: a weighted lexicon matched by Aho-Corasick in folded text, normalised by length.

Folding lower-cases, turns look-alike letters and digit or sign substitutions into plain letters, and anything that is
no letter into a space.  Lexicon entries are folded words (`` idiot ``) or word beginnings (`` bomen``), each with a
weight.  A match inside an exception phrase (``trash can``) doesn't count.  A text's sum of weights, alone and per
number of words, goes through a logistic curve.

``learn`` takes the lexicon from labelled rows: an entry's weight is its smoothed log odds between toxic and clean
documents.  Exception phrases are learned too: an entry with a word before or after it that clean documents have time and
again and toxic ones don't.  The given lexicon, phrases and curve are the prior: what is learned comes beside the given
words, and the curve is fitted with a pull to the given one, so few labelled rows change little and none change nothing.
``fit`` reads at most ``max_rows`` toxic and twice as many clean rows, in the order of a hash of doc_id, and of these as
many whole texts as ``max_bytes`` hold; everything else covers all rows.

Edge cases: null or empty text scores as a text without matches; very long texts are folded and matched whole; rows without a
label or text are not learned from; of labels that repeat a doc_id any one counts if they agree, none if not; of entries that
begin together the heaviest counts; entries that are as telling are taken in falling order of their text; an empty table gives
an empty table; repeated rows and extra columns are kept, whatever their names: only columns called ``toxic_score`` or
``toxic_matches`` are replaced.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .shared import with_columns

# fixed values: look-alike letters and the digits that stand for letters
_LOOKS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "х": "x", "у": "y", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ӏ": "l", "к": "k", "м": "m", "т": "t",
    "α": "a", "ε": "e", "ο": "o", "ρ": "p", "ι": "i", "κ": "k", "ν": "v", "τ": "t", "υ": "u", "ϲ": "c",
    "ı": "i", "ɑ": "a", "ɡ": "g", "ꜱ": "s",
    "0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
}
_LOOKS |= {chr(0xFF41 + k): chr(97 + k) for k in range(26)}
_LOOKS |= {chr(0xFF10 + k): _LOOKS.get(str(k), " ") for k in range(10)}
_SIGN = re.compile(r"(?<![$@!|+*#%&])[$@!](?=[^\W\d_])")
_SIGNS = {"$": "s", "@": "a", "!": "i"}
_HIDDEN = re.compile("[" + "".join(map(chr, (0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF, *range(0x300, 0x370)))) + "]")
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "loser bracket", "white trash bag")
#: weights before any learning
GIVEN = {" idiot ": 3.0, " moron ": 3.0, " stupid ": 2.5, " scum ": 3.0, " loser ": 2.5, " pathetic ": 2.0, " worthless ": 2.5, " disgusting ": 2.0, " trash ": 1.5, " clown ": 1.5}


class _Table(dict):
    """Letters stay, look-alikes are replaced, the rest is a space; filled as characters come up."""

    def __missing__(self, code: int) -> str:
        c = chr(code)
        self[code] = out = _LOOKS.get(c, c if c.isalpha() else " ")
        return out


_FOLD = _Table()


def fold(text: str) -> str:
    t = text.lower()
    if not t.isascii():
        t = _HIDDEN.sub("", t)
    if "$" in t or "@" in t or "!" in t:
        t = _SIGN.sub(lambda m: _SIGNS[m[0]], t)
    return f" {' '.join(t.translate(_FOLD).split())} "


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=lambda: dict(GIVEN))
    exceptions: tuple[str, ...] = EXCEPTIONS
    curve: tuple[float, ...] = (-3.0, 1.2, 0.0, 0.0)

    def automaton(self):
        import ahocorasick

        a = ahocorasick.Automaton()
        for entry, w in self.weights.items():
            a.add_word(entry, (len(entry), w, False))
        for phrase in self.exceptions:
            if (folded := fold(phrase)) not in self.weights:
                a.add_word(folded, (len(folded), 0.0, True))
        if len(a):
            a.make_automaton()
        return a


def matches(folded: str, automaton) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the entries that count: the best of those that begin together, none inside an exception."""
    if not len(automaton):
        return []
    found, apart = {}, []
    for last, (size, weight, exception) in automaton.iter(folded):
        start = last + 1 - size
        if exception:
            apart.append((start, last + 1))
        elif start not in found or weight > found[start][2]:
            found[start] = (start, last + 1, weight)
    if apart:
        apart.sort()
        begins, furthest = [a for a, _ in apart], list(accumulate((b for _, b in apart), max))
        inside = lambda m: (k := bisect_right(begins, m[0])) and m[1] <= furthest[k - 1]
        found = {s: m for s, m in found.items() if not inside(m)}
    return [found[s] for s in sorted(found)]


def signals(folded: str, automaton) -> tuple[float, ...]:
    """(log of 1 + the weights' sum, the same by the square root of the length, the same by length)."""
    total = sum(m[2] for m in matches(folded, automaton))
    n = max(folded.count(" ") - 1, 1)
    return math.log1p(max(total, 0.0)), max(total, 0.0) / math.sqrt(n), math.log1p(100 * max(total, 0.0) / n)


def _entries(folded: str) -> set[str]:
    out = set()
    for w in set(folded.split()):
        if len(w) >= 3:
            out.add(f" {w} ")
        out.update(f" {w[:k]}" for k in range(3, min(len(w), 7)))
    return out


def _lexicon(data: list[tuple[str, int]], least: int, size: int) -> dict[str, float]:
    """Entries one by one: the most telling on the toxic documents that no entry before it is found in."""
    n = Counter(y for _, y in data)
    clean, toxic = Counter(), Counter()
    found: list[set[str]] = []
    for t, y in data:
        if y:
            found.append(_entries(t))
            toxic.update(found[-1])
    toxic = Counter({e: k for e, k in toxic.items() if k >= least})
    for t, y in data:
        if not y:
            clean.update(_entries(t) & toxic.keys())
    documents: dict[str, list[int]] = {e: [] for e in toxic}
    for k, entries in enumerate(found):
        for e in entries & toxic.keys():
            documents[e].append(k)
    spoken: dict[str, int] = Counter()  # by beginning: documents of its most frequent whole word
    for e, k in toxic.items():
        if e[-1] == " ":
            for end in range(4, len(e)):
                spoken[e[:end]] = max(spoken[e[:end]], k)
    left, open_docs = Counter({e: k for e, k in toxic.items() if e[-1] == " " or spoken[e] < 0.7 * k}), set(range(len(found)))
    weights: dict[str, float] = {}
    while len(weights) < size:
        best = (0.0, "", 0.0)
        for e, k in left.items():
            if k >= least:
                w = math.log((k + 0.5) / (len(open_docs) + 1)) - math.log((clean[e] + 0.5) / (n[0] + 1))
                # four standard errors of the log ratio off, as many entries are looked at
                sure = w - 4 * math.sqrt(1 / (k + 0.5) + 1 / (clean[e] + 0.5) - 1 / (len(open_docs) + 1) - 1 / (n[0] + 1)) if clean[e] else w - 4 / math.sqrt(k)
                if sure > 0.5 and (sure * math.sqrt(k), e) > best[:2]:
                    best = (sure * math.sqrt(k), e, w)
        if not best[1]:
            break
        e = best[1]
        weights[e] = round(best[2], 4)
        for k in [k for k in documents[e] if k in open_docs]:
            open_docs.discard(k)
            left.subtract(found[k] & left.keys())
        del left[e]
    # whole words that are as telling though always in company
    for e, k in sorted(toxic.items()):
        w = math.log((k + 0.5) / (n[1] + 1)) - math.log((clean[e] + 0.5) / (n[0] + 1))
        if e[-1] == " " and e not in weights and len(weights) < size and w - 4 * math.sqrt(1 / (k + 0.5) + clean[e] / (clean[e] + 0.5) ** 2) > 2.5:
            weights[e] = round(w, 4)
    return weights


def _phrases(data: list[tuple[str, int]], weights: dict[str, float], least: int) -> tuple[str, ...]:
    """Two-word phrases around an entry that at least so many clean documents have, and so few toxic ones that a phrase which is as
    common among these would be seen as seldom in one case of twenty at most (by Poisson's law)."""
    a = Model(weights=weights, exceptions=()).automaton()
    n, seen = Counter(y for _, y in data), (Counter(), Counter())
    for t, y in data:
        around = set()
        for start, end, _ in matches(t, a):
            word = t.find(" ", start + 1) + 1 or len(t)  # past the word that the entry begins
            before, after = t.rfind(" ", 0, start), t.find(" ", word)
            if before >= 0:
                around.add(t[before:word])
            if after >= 0:
                around.add(t[start : after + 1])
        seen[y].update(around)
    out = []
    for phrase, k in seen[0].items():
        if k >= least:
            expected, bad = k * n[1] / n[0], seen[1][phrase]
            if expected and sum(math.exp(i * math.log(expected) - expected - math.lgamma(i + 1)) for i in range(bad + 1)) <= 0.05:
                out.append(phrase)
    return tuple(sorted(out))


#: pull of the curve to the given one
PULL = 0.01


def learn(rows: Iterable[tuple[str, int]], least: int = 5, size: int = 200, odds: float = 1.0) -> Model:
    """A model from (text, toxic) rows. The curve is fitted on signals that each half of the rows gets from the other
    half's lexicon, so that it doesn't trust what a lexicon says of its own rows. odds: by how much toxic rows are rarer
    among all rows, relative to clean ones, than among these."""
    data = [(fold(t or ""), int(y)) for t, y in rows]

    def lexicon(part: list[tuple[str, int]], least: int) -> Model:
        weights = GIVEN | _lexicon(part, least, size)
        return Model(weights=weights, exceptions=EXCEPTIONS + _phrases(part, weights, least))

    x, y = [], []
    for half in (0, 1):
        a = lexicon(data[1 - half :: 2], max(2, least // 2)).automaton()
        x += [signals(t, a) for t, _ in data[half::2]]
        y += [label for _, label in data[half::2]]
    x, y = np.array(x, float).reshape(-1, 3), np.array(y, float)
    prior = np.array(Model.curve)
    design, beta = np.c_[np.ones(len(x)), x], prior.copy()
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - PULL * (beta - prior)
        hessian = (design * (p * (1 - p))[:, None]).T @ design + PULL * np.eye(4)
        beta = beta + np.linalg.solve(hessian, gradient)
    beta[0] += math.log(odds)
    model = lexicon(data, least)
    return Model(weights=model.weights, exceptions=model.exceptions, curve=tuple(float(b) for b in beta))


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 2000, max_bytes: int = 64 << 20) -> Model:
    """A model from docs(doc_id, text) and labels(doc_id, toxic): at most max_rows toxic and twice as many clean rows, and at
    most max_bytes of whole texts, in the order of a hash of doc_id; how rare toxic rows are comes from all of them."""
    known = labels.where(F.col("toxic").isin(0, 1)).groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other").drop("other")
    counts = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    chosen = [known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for y, n in ((0, 2 * max_rows), (1, max_rows))]
    sample = F.broadcast(chosen[0].union(chosen[1]))  # at most 3 * max_rows ids
    some = docs.join(sample, "doc_id").where(F.col("text").isNotNull() & (F.octet_length("text") <= max_bytes)).orderBy(F.xxhash64("doc_id"), "text").limit(3 * max_rows)
    upto = Window.orderBy(F.xxhash64("doc_id"), "text").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # over the limit's few rows
    rows = some.withColumn("bytes", F.sum(F.octet_length("text").cast("long")).over(upto)).where(F.col("bytes") <= max_bytes).select("text", "toxic").collect()
    odds = 1.0
    if counts.get(0) and counts.get(1):
        odds = (counts[1] / min(counts[1], max_rows)) / (counts[0] / min(counts[0], 2 * max_rows))
    return learn(((r[0], r[1]) for r in rows), odds=odds)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Adds toxic_score (0 to 1) and toxic_matches (number of entries that count) to docs(text, ...)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # at most a few hundred entries
    at = [c.lower() for c in docs.drop("toxic_score", "toxic_matches").columns].index("text")

    def start():
        m = sent.value
        a = m.automaton()

        def make(batch: pa.RecordBatch) -> list[pa.Array]:
            scores, counts = [], []
            for text in batch.column(at).to_pylist():
                folded = fold(text or "")
                z = m.curve[0] + sum(c * s for c, s in zip(m.curve[1:], signals(folded, a)))
                scores.append(1 / (1 + math.exp(-max(-30.0, min(30.0, z)))))
                counts.append(len(matches(folded, a)))
            return [pa.array(scores, pa.float64()), pa.array(counts, pa.int64())]

        return make

    return with_columns(docs, "toxic_score double, toxic_matches long", start)
