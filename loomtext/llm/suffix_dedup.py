"""Suffix dedup: bytes that a ``length``-byte string covers which also starts earlier are removed.

The named method sorts the suffixes that start in a difference cover, names them, and places the others by the nearest
cover suffix's name.  As no match has to be followed beyond ``length`` bytes, names of a cover suffix's first bytes are
enough and nothing recurses.  There are two covers, and either has what the method needs: any two equal strings of
``length`` bytes have a cover position at the same offset.

- RESIDUES: positions whose residue modulo 73 is in a difference set of nine; one suffix in eight.
- CONTENT, the one in use: a synchronizing set; one suffix in 34, and half as many of them repeat.  README (op2) has the
  figures of both.

1. Cover: by content, a position is in it if the hash of its first bytes is the least of those in some ``length``-byte string.
   At least one such position lies in every string, and where depends on the string's bytes alone.
2. Sort of the cover by name (the hash), range-partitioned; names that occur once drop out. Whole copies of a text have been
   left out before, so that their names don't count: only the smallest doc_id's stays, as all of a copy's strings start earlier.
3. Merge: each remaining cover suffix brings the bytes around it, and with them all strings for which it stands: those in
   which it is the leftmost least (by residues, all those that begin up to 72 bytes before it). Sorted by (name, document, position), equal strings at each offset are compared with the first of them; the
   offsets of a suffix that start earlier elsewhere give one interval to remove.
4. Intervals are gathered by document and cut from the text.

A name's rows meet in one task, which streams them.  A name with more than ``SHARE`` rows is dealt by document over as many
groups as it has such shares; each group cuts what it finds, and tells of each string the first place it has seen; these
places, few for a passage that many share, meet by the string's hash, and all but the first of them are cut too.  Strings in the
rows at hand are compared by their bytes; those of earlier rows of a name, and of its other groups, by 64-bit hashes beside the
name's own 64 bits.

Edge cases: null or empty texts and texts under ``length`` bytes lose nothing; a null doc_id is smaller than all others; rows
that repeat a doc_id are ordered by a hash of their text, equal rows are one document; a string that overlaps its own copy (a
run of one character) counts like any other; very long texts are cut into rows of some 170 bytes, none is shuffled whole but once;
extra columns are not read, so their names can't clash; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .minhash import _mix, _Powers
from .shared import few, settled, stored, tidy

LENGTH, BLOCK, SHARE = 100, 20_000, 20_000
#: names with so many rows in a partition are counted
LARGE = 1000
_RNG = np.random.default_rng(4711)
_CODE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_U = np.uint64


def _grams(b: np.ndarray, size: int) -> np.ndarray:
    """A hash of each string of so many bytes."""
    n = len(b) - size + 1
    up, down = _Powers.get(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_CODE[b] * up[: len(b)], out=total[1:])
    return _mix((total[size:] - total[:n]) * down[:n])


def _none() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)


@dataclass(frozen=True)
class Content:
    gram: int = 24

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(position, name, first, last) of each cover suffix; first and last are the starts of the strings it stands for, those in
        which its hash is the least, the leftmost of equal ones."""
        if len(text) < LENGTH:
            return _none()
        h = _grams(np.frombuffer(text, np.uint8), self.gram)
        value, at, span, width = h, np.arange(len(h)), LENGTH - self.gram + 1, 1
        while width < span:  # the least of each run of width values, then of up to twice as many
            step = min(width, span - width)
            right = value[step:] < value[:-step]
            value, at = np.where(right, value[step:], value[:-step]), np.where(right, at[step:], at[:-step])
            width += step
        first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))  # at never falls
        last = np.concatenate([first[1:], [len(at)]]) - 1
        return at[first], value[first], first, last


@dataclass(frozen=True)
class Residues:
    """Every number below ``modulus`` is the difference of two residues of the set, modulo it."""

    modulus: int = 73
    residues: tuple[int, ...] = (1, 2, 4, 8, 16, 32, 37, 55, 64)

    @property
    def gram(self) -> int:
        return LENGTH - self.modulus + 1

    def __call__(self, text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        if len(text) < LENGTH:
            return _none()
        h = _grams(np.frombuffer(text, np.uint8), self.gram)
        at = (np.arange(0, len(h), self.modulus)[:, None] + np.array(self.residues)).ravel()
        at = at[at < len(h)]
        return at, h[at], np.maximum(at - self.modulus + 1, 0), np.minimum(at, len(text) - LENGTH)


CONTENT, RESIDUES = Content(), Residues()


def _emit(cover: Content | Residues):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for offset in range(0, whole.num_rows, 1000):
                batch = whole.slice(offset, 1000)
                names, docs, places = [], [], []
                for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                    at, h, _, _ = cover(text or b"")
                    names.append(h)
                    docs.append(np.full(len(at), doc, np.int64))
                    places.append(at.astype(np.int32))
                if names:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(names).view(np.int64)), pa.array(np.concatenate(docs)), pa.array(np.concatenate(places))], ["name", "doc", "at"])

    return run


def _repeated(large: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows (name, doc, at) sorted by name: (doc, at) of the names that have two rows, and of the partition's first and last,
        which may go on elsewhere; and (name, n) of those with many rows."""
        kept: tuple[np.ndarray, ...] | None = None  # the first row of the name that is open
        told, before, first = False, 0, None  # that row has been given out; rows of its name in earlier batches; the first name

        def out(doc: np.ndarray, at: np.ndarray, name: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
            rows, counts = len(doc), len(name)
            columns = [pa.array(doc), pa.array(at), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64())], [pa.nulls(counts, pa.int64()), pa.nulls(counts, pa.int32()), pa.array(name), pa.array(n)]
            return pa.RecordBatch.from_arrays([pa.concat_arrays(x) for x in zip(*columns)], ["doc", "at", "name", "n"])

        for batch in batches:
            if not batch.num_rows:
                continue
            name, doc, at = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if kept is not None:
                name, doc, at = (np.concatenate([k, x]) for k, x in zip(kept, (name, doc, at)))
            first = name[0] if first is None else first
            begin = np.flatnonzero(np.concatenate([[True], name[1:] != name[:-1]]))
            size = np.diff(np.concatenate([begin, [len(name)]]))
            many = np.repeat(size > 1, size) | (name == first)
            last = int(begin[-1])
            told_last = bool(many[last]) or (last == 0 and told)
            if told:
                many[0] = False
            size[0] += before
            count = np.flatnonzero(size[:-1] >= large)
            yield out(doc[many], at[many], name[begin[count]], size[count])
            before = int(size[-1]) - 1
            kept, told = tuple(x[last : last + 1] for x in (name, doc, at)), told_last
        if kept is not None:
            end = np.array([before + 1] if before + 1 >= large else [], np.int64)
            none = slice(0, 0) if told else slice(None)
            yield out(kept[1][none], kept[2][none], kept[0][: len(end)], end)

    return run


def _contexts(cover: Content | Residues):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over (doc, fp, text, places): (name, doc, fp, at, left, around): the bytes of the strings that each place stands for,
        and how many of them are before it."""
        for whole in batches:
            for offset in range(0, whole.num_rows, 200):
                batch = whole.slice(offset, 200)
                rows: list[tuple] = []
                for doc, fp, text, places in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()).to_pylist(), batch.column(3).to_pylist()):
                    at, h, first, last = cover(text or b"")
                    wanted = np.isin(at, places)
                    cover_rows = zip(*(x[wanted].tolist() for x in (at, h.view(np.int64), first, last)))
                    rows += [(name, doc, fp, p, p - a, text[a : b + LENGTH]) for p, name, a, b in cover_rows]
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary()]
                columns = list(zip(*rows)) or [[]] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["name", "doc", "fp", "at", "left", "around"])

    return run


def _earlier(before: int, group: np.ndarray, left: np.ndarray, around: list[bytes], seen: list[np.ndarray] | None, name: np.ndarray, dealt: np.ndarray) -> tuple:
    """(least, most) offset, up to ``before``, before each row's place at which a string starts that an earlier row of its group has too (-1: none).
    seen: hashes by offset of the strings of the first row's group that were seen before; returned for the last row's group.
    And (row, offset, hash) of the strings that rows of dealt names are the first of their group to have."""
    n = len(around)
    size = np.array([len(x) for x in around])
    width = before + LENGTH
    data = np.zeros((n, width), np.uint8)
    for k, x in enumerate(around):  # the place stands in the same column in all rows
        data[k, before - left[k] : before - left[k] + len(x)] = np.frombuffer(x, np.uint8)
    up, down = _Powers.get(width + 1)
    total = np.zeros((n, width + 1), np.uint64)
    np.cumsum(_CODE[data] * up[:width], axis=1, out=total[:, 1:])
    least, most = np.full(n, -1), np.full(n, -1)
    open_group = group == group[-1]
    after, firsts = [], []
    for back in range(before + 1):
        column = before - back
        ok = np.flatnonzero((left >= back) & (size - left >= LENGTH - back))
        string = _mix((total[ok, column + LENGTH] - total[ok, column]) * down[column])
        h = string ^ group[ok].view(np.uint64)
        order = np.argsort(h, kind="stable")  # rows are in order of document and place
        s = h[order]
        new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.empty(0, bool)
        head = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(s) else order
        twin = head != order
        a, b = ok[order[twin]], ok[head[twin]]
        equal = (data[a, column : column + LENGTH] == data[b, column : column + LENGTH]).all(axis=1)
        found = [a[equal]]
        known = np.zeros(len(ok), bool)
        if seen is not None:
            known = np.isin(h, seen[back]) & (group[ok] == group[0])
            found.append(ok[known])
        hit = np.concatenate(found)
        most[hit] = back
        least[hit] = np.where(least[hit] < 0, back, least[hit])
        opening = order[new]
        opening = opening[dealt[ok[opening]] & ~known[opening]]
        if len(opening):
            firsts.append((ok[opening], np.full(len(opening), back), string[opening] ^ name[ok[opening]].view(np.uint64)))
        last = h[open_group[ok]]
        after.append(np.unique(np.concatenate([last, seen[back]])) if seen is not None and group[0] == group[-1] else np.unique(last))
    return least, most, after, firsts


def _compare(cover: Content | Residues, block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over contexts (group, name, dealt, doc, fp, at, left, around) sorted by (group, doc, fp, at): (doc, fp, start, stop) to
        remove; with a key, the first place in a group of a string whose name was dealt over several."""
        waiting: pa.Table | None = None
        seen: list[np.ndarray] | None = None
        seen_group = None

        def work(t: pa.Table) -> pa.RecordBatch:
            nonlocal seen, seen_group
            group, name, dealt, doc, fp, at, left = (t.column(k).to_numpy() for k in range(7))
            if seen_group != group[0]:
                seen = None
            least, most, after, firsts = _earlier(LENGTH - cover.gram, group, left, t.column(7).to_pylist(), seen, name, dealt)
            seen, seen_group = after, group[-1]
            hit = np.flatnonzero(most >= 0)
            rows, back, keys = (np.concatenate(x) for x in zip(*firsts)) if firsts else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64))
            every = np.concatenate([hit, rows])
            start = np.concatenate([at[hit] - most[hit], at[rows] - back]).astype(np.int32)
            stop = np.concatenate([at[hit] - least[hit], at[rows] - back]).astype(np.int32) + np.int32(LENGTH)
            key = pa.array(np.concatenate([np.zeros(len(hit), np.int64), keys.view(np.int64)]), mask=np.arange(len(every)) < len(hit))
            return pa.RecordBatch.from_arrays([pa.array(doc[every]), pa.array(fp[every]), pa.array(start), pa.array(stop), key], ["doc", "fp", "start", "stop", "key"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            waiting = t if waiting is None else pa.concat_tables([waiting, t])
            while waiting.num_rows >= block:
                group = waiting.column(0).to_numpy()
                # up to the last group that is surely whole; of one group that is larger than that, all rows there are
                whole = int(np.flatnonzero(group != group[-1])[-1]) + 1 if group[0] != group[-1] else len(group)
                yield work(waiting.slice(0, whole))
                waiting = waiting.slice(whole)
        if waiting is not None and waiting.num_rows:
            yield work(waiting)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (doc_id, text, copy, cuts): (doc_id, n_bytes, spans, kept bytes)."""
    for batch in batches:
        sizes, removed, spans, kept = [], [], [], []
        for text, copy, cuts in zip(batch.column(1).cast(pa.binary()).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            b = text or b""
            if copy:
                cuts = [{"start": 0, "stop": len(b)}]
            merged: list[list[int]] = []
            for c in sorted(cuts or (), key=lambda c: c["start"]):
                if merged and c["start"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], c["stop"])
                else:
                    merged.append([c["start"], c["stop"]])
            out, at = [], 0
            for start, stop in merged:
                out.append(b[at:start])
                at = stop
            out.append(b[at:])
            sizes.append(len(b))
            removed.append(sum(stop - start for start, stop in merged))
            spans.append(merged)
            kept.append(hashlib.sha256(b"".join(out)).hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(kept, pa.string())],
            ["doc_id", "n_bytes", "n_removed", "removed", "kept_sha256"],
        )


def dedup(docs: DataFrame, cover: Content | Residues = CONTENT, block: int = BLOCK, share: int = SHARE, large: int = LARGE) -> DataFrame:
    """(doc_id, n_bytes, n_removed, removed: array of [start, stop), kept_sha256) for each row of docs(doc_id, text). block: rows that
    a task compares at once; share: rows of a name in one group; large: rows of a name in a partition that make it counted."""
    spark = docs.sparkSession
    smallest = F.lit(-(1 << 63)).cast("long")
    d = docs.select("doc_id", "text", F.coalesce("doc_id", smallest).alias("doc"), F.xxhash64("text").alias("fp"))
    # whole copies: of equal texts only the smallest document's takes part
    long_ = d.where(F.octet_length("text") >= LENGTH)
    hashed = long_.select(F.md5(F.col("text").cast("binary")).alias("md5"), "doc", "fp")
    classes = settled(hashed.groupBy("md5").agg(F.min("doc").alias("doc"), F.first("fp").alias("fp"), F.max("doc").alias("other")))
    firsts = settled(classes.select("doc", "fp").distinct())
    several = settled(classes.where("doc != other").select("md5", F.col("doc").alias("keeper")))
    copies = settled(hashed.join(few(several), "md5").where("doc != keeper").select("doc", "fp").distinct().join(firsts, ["doc", "fp"], "left_anti"))
    own = long_.join(few(copies), ["doc", "fp"], "left_anti")
    order = [F.col("name"), F.col("doc"), F.col("at")]
    names = own.select("doc", "text").mapInArrow(_emit(cover), "name long, doc long, at int").repartitionByRange(*order).sortWithinPartitions(*order)
    repeated = stored(names.mapInArrow(_repeated(large), "doc long, at int, name long, n long"))
    del names
    tidy(spark)
    hot = settled(repeated.where("n IS NOT NULL").groupBy("name").agg(F.ceil(F.sum("n") / share).cast("int").alias("groups")).where("groups > 1"))
    places = repeated.where("at IS NOT NULL").groupBy("doc").agg(F.collect_set("at").alias("places"))
    mine = firsts.join(places, "doc")
    around = own.select("doc", "fp", "text").join(mine, ["doc", "fp"]).select("doc", "fp", "text", "places").dropDuplicates(["doc", "fp"])
    contexts = around.mapInArrow(_contexts(cover), "name long, doc long, fp long, at int, left int, around binary").join(few(hot), "name", "left")
    group = F.when(F.col("groups").isNull(), F.col("name")).otherwise(F.xxhash64("name", F.pmod(F.xxhash64("doc", "fp"), F.col("groups"))))
    contexts = contexts.select(group.alias("group"), "name", F.col("groups").isNotNull().alias("dealt"), "doc", "fp", "at", "left", "around")
    dealt = contexts.repartition("group").sortWithinPartitions("group", "doc", "fp", "at")
    found = stored(dealt.mapInArrow(_compare(cover, block), "doc long, fp long, start int, stop int, key long"))
    del around, contexts, dealt
    tidy(spark)
    places_of = F.struct("doc", "fp", "start")
    opening = found.where("key IS NOT NULL")
    later = opening.join(opening.groupBy("key").agg(F.min(places_of).alias("first")), "key").where(places_of != F.col("first"))
    columns = ["doc", "fp", "start", "stop"]
    cuts = settled(found.where("key IS NULL").select(*columns).union(later.select(*columns)).groupBy("doc", "fp").agg(F.collect_list(F.struct("start", "stop")).alias("cuts")))
    # one row for each first text: what is cut from it; texts without a row here are copies, or too short
    verdict = firsts.join(cuts, ["doc", "fp"], "left").withColumn("first", F.lit(True))
    joined = d.join(verdict, ["doc", "fp"], "left")
    copy = F.col("first").isNull() & (F.coalesce(F.octet_length("text"), F.lit(0)) >= LENGTH)
    return joined.select("doc_id", "text", copy.alias("copy"), "cuts").mapInArrow(_cut, "doc_id long, n_bytes long, n_removed long, removed array<array<int>>, kept_sha256 string")
