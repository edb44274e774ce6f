"""Benchmark decontamination: Wu-Manber multi-pattern search over words.

Texts and benchmark items become sequences of word numbers: words are runs of characters outside
``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after A-Z is lower-cased; a word that no item has is 0.  Patterns are the items'
windows of ``window`` words (a shorter item is one window).  As Wu-Manber has it, a cursor looks at the block of
``BLOCK`` words that ends its window; a shift table on the block's hash says how far it can safely go; where the shift is
0, the bucket of the window's suffix hash selects patterns, and all words are compared before a hit counts.  Cursors of
many stretches of text move side by side in numpy.

The benchmark goes out in blocks of at most ``block_bytes`` of text (a longer item is a block of its own).  The driver holds
one block at a time.  One block is searched in the pass that returns the documents.  Of several, each takes a pass over the
texts, which writes only what was found to the shared folder, by the text's hash; the finds are merged and joined once.

Edge cases: null or empty texts have no words and no hits; very long texts are searched in stretches; items without words have
no windows; a null item_id is left out; items with the same text each count, so there are no ties; an empty table gives an
empty table; repeated rows and extra columns are kept, whatever their names: only columns that are called as this operator's
own (``bench_words``, ``bench_hits``, ``bench_items``, ``bench_spans`` if asked for) are replaced.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from .shared import fresh, settled

BLOCK = 2
TABLE_BITS = 18
STRETCH = 1024
_FOLD = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c >= 128 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()  # every byte that is no part of a word has become a space


class Patterns:
    """Wu-Manber tables over patterns of one length (in words)."""

    def __init__(self, length: int, rows: dict[tuple[int, ...], list[int]]):
        self.length, self.block = length, min(BLOCK, length)
        self.table = np.array(list(rows), np.int32).reshape(-1, length)
        self.items = list(rows.values())
        self.shift = np.full(1 << TABLE_BITS, length - self.block + 1, np.int32)
        for end in range(self.block, length + 1):
            h = self._hash(self.table[:, end - self.block : end])
            np.minimum.at(self.shift, h, length - end)
        suffix = self._hash(self.table[:, length - self.block :])
        order = np.argsort(suffix, kind="stable")
        self.order = order
        self.suffix = suffix[order]
        self.first = np.searchsorted(self.suffix, np.arange((1 << TABLE_BITS) + 1)).astype(np.int32)

    def _hash(self, block: np.ndarray) -> np.ndarray:
        h = np.zeros(len(block), np.uint64)
        for k in range(block.shape[1]):
            h = (h + block[:, k].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            h ^= h >> np.uint64(29)
        return (h >> np.uint64(40)).astype(np.int64) & ((1 << TABLE_BITS) - 1)

    def search(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start of each occurrence, number of its pattern), in any order."""
        m, b = self.length, self.block
        if len(ids) < m:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        # stretches of window ends: [m, n], cut every STRETCH
        ends = np.arange(m, len(ids) + 1, STRETCH)
        stop = np.minimum(ends + STRETCH, len(ids) + 1)
        starts_found, patterns_found = [], []
        while len(ends):
            block = np.stack([ids[ends - b + k] for k in range(b)], axis=1)
            h = self._hash(block)
            shift = self.shift[h]
            here = np.flatnonzero(shift == 0)
            if len(here):
                lo, n = self.first[h[here]], self.first[h[here] + 1] - self.first[h[here]]
                which = np.repeat(here, n)
                entry = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                for part in range(0, len(which), 1 << 16):  # bounds memory
                    w, p = which[part : part + (1 << 16)], self.order[entry[part : part + (1 << 16)]]
                    at = ends[w] - m
                    same = np.ones(len(w), bool)
                    for k in range(m):
                        live = np.flatnonzero(same)
                        if not len(live):
                            break
                        same[live] = ids[at[live] + k] == self.table[p[live], k]
                    starts_found.append(at[same])
                    patterns_found.append(p[same])
            ends = ends + np.maximum(shift, 1)
            live = ends < stop
            ends, stop = ends[live], stop[live]
        if not starts_found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(starts_found), np.concatenate(patterns_found)


class Matcher:
    """The windows of a block of benchmark items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.names = [name for name, _ in items]
        by_length: dict[int, dict[tuple[int, ...], list[int]]] = defaultdict(lambda: defaultdict(list))
        for k, (_, text) in enumerate(items):
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words(text)]
            m = min(window, len(ids))
            for i in range(len(ids) - m + 1 if m else 0):
                by_length[m][tuple(ids[i : i + m])].append(k)
        self.tables = [Patterns(m, rows) for m, rows in sorted(by_length.items())]
        self.longest = max([0, *by_length])

    def match(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray, set[str]]]:
        """(number of words, which of them are hit, items with occurring windows) of each text."""
        get = self.vocabulary.get
        lists = [[get(w, 0) for w in words(t)] for t in texts]
        sizes = np.array([len(x) for x in lists], np.int64)
        gap = self.longest  # unknown words between texts, so that no window crosses
        total = int(sizes.sum() + gap * len(lists))
        ids = np.full(total, -1, np.int32)
        base = np.zeros(len(lists), np.int64)
        at = 0
        for k, x in enumerate(lists):
            base[k] = at
            ids[at : at + len(x)] = x
            at += len(x) + gap
        hit = np.zeros(total + 1, np.int32)
        found: dict[int, set[str]] = defaultdict(set)
        for p in self.tables:
            starts, which = p.search(ids)
            np.add.at(hit, starts, 1)
            np.add.at(hit, starts + p.length, -1)
            owner = np.searchsorted(base, starts, side="right") - 1
            for o, w in set(zip(owner.tolist(), which.tolist())):
                found[o].update(self.names[i] for i in p.items[w])
        covered = np.cumsum(hit) > 0
        for k in range(len(lists)):
            yield int(sizes[k]), covered[base[k] : base[k] + sizes[k]], found.get(k, set())


def _blocks(benchmark: DataFrame, block_bytes: int) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks of at most so many bytes of text, read one after another."""
    block: list[tuple[str, bytes]] = []
    size = 0
    rows = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string"), F.coalesce(F.col("text"), F.lit("")))
    for name, text in rows.toLocalIterator():
        raw = text.encode()
        if size + len(raw) > block_bytes and block:
            yield block
            block, size = [], 0
        block.append((name, raw))
        size += len(raw)
    yield block


PART = 512


def _texts(batches: Iterator[pa.RecordBatch], name: str) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for whole in batches:
        for offset in range(0, whole.num_rows, PART):
            batch = whole.slice(offset, PART)
            yield batch, [x or b"" for x in batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()]


def _runs(hit: np.ndarray) -> list[list[int]]:
    return np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]]))).reshape(-1, 2).tolist()


def _once(docs: DataFrame, block: list[tuple[str, bytes]], window: int, spans: bool) -> DataFrame:
    """docs with the results of one block."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, window)
        for batch, texts in _texts(batches, "text"):
            rows = list(matcher.match(texts))
            values = [pa.array([n for n, _, _ in rows], pa.int64()), pa.array([int(h.sum()) for _, h, _ in rows], pa.int64()), pa.array([sorted(i) for _, _, i in rows], pa.list_(pa.string()))]
            if spans:
                values.append(pa.array([_runs(h) for _, h, _ in rows], pa.list_(pa.list_(pa.int32()))))
            yield pa.RecordBatch.from_arrays([*batch.columns, *values], [*batch.schema.names, *NAMES[: len(values)]])

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *_fields(spans)]))


NAMES = ("bench_words", "bench_hits", "bench_items", "bench_spans")


def _fields(spans: bool) -> list:
    return StructType.fromDDL("bench_words long, bench_hits long, bench_items array<string>" + ", bench_spans array<array<int>>" * spans).fields


def _finds(docs: DataFrame, block: list[tuple[str, bytes]], window: int) -> DataFrame:
    """(key: hash of the text, items, mask: compressed bits of the hit words) of the texts with hits, each once."""
    sent = docs.sparkSession.sparkContext.broadcast(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(sent.value, window)
        for batch, texts in _texts(batches, "text"):
            keys, items, masks = [], [], []
            for key, (_, hit, found) in zip(batch.column(0).to_pylist(), matcher.match(texts)):
                if found:
                    keys.append(key)
                    items.append(sorted(found))
                    masks.append(zlib.compress(np.packbits(hit).tobytes(), 1))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(items, pa.list_(pa.string())), pa.array(masks, pa.binary())], ["key", "items", "mask"])

    rows = docs.select(F.md5(F.col("text").cast("binary")).alias("key"), "text").mapInArrow(run, "key string, items array<string>, mask binary")
    out = settled(rows.groupBy("key").agg(F.first("items").alias("items"), F.first("mask").alias("mask")))
    sent.destroy()
    return out


def _merged(docs: DataFrame, finds: list[DataFrame], spans: bool) -> DataFrame:
    """docs with what all blocks found; a text has one row a block at most."""
    every = finds[0]
    for x in finds[1:]:
        every = every.union(x)
    key, own, items, masks = fresh(docs, "bench_key", "bench_own", "bench_found", "bench_masks")
    every = every.groupBy(F.col("key").alias(key)).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias(items), F.collect_list("mask").alias(masks))
    joined = docs.withColumn(own, F.md5(F.col("text").cast("binary"))).join(every, F.col(own) == F.col(key), "left").drop(own, key)
    keep = [f.name for f in docs.schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _texts(batches, "text"):
            at = batch.schema.get_field_index
            sizes, hits, runs = [], [], []
            for text, packed in zip(texts, batch.column(at(masks)).to_pylist()):
                n = len(words(text))
                hit = np.zeros(n, bool)
                for x in packed or ():
                    hit |= np.unpackbits(np.frombuffer(zlib.decompress(x), np.uint8), count=n).astype(bool)
                sizes.append(n)
                hits.append(int(hit.sum()))
                runs.append(_runs(hit))
            found = pa.array([x or [] for x in batch.column(at(items)).to_pylist()], pa.list_(pa.string()))
            values = [pa.array(sizes, pa.int64()), pa.array(hits, pa.int64()), found] + [pa.array(runs, pa.list_(pa.list_(pa.int32())))] * spans
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *values], [*keep, *NAMES[: len(values)]])

    return joined.mapInArrow(run, StructType([*docs.schema.fields, *_fields(spans)]))


def search(docs: DataFrame, benchmark: DataFrame, window: int = 8, block_bytes: int = 4 << 20, spans: bool = False) -> DataFrame:
    """Adds bench_words (long), bench_hits (long), bench_items (sorted array of ids as strings) to docs, and, if asked
    for, bench_spans (array of the first and last + 1 of each run of hit words)."""
    docs = docs.drop(*NAMES[: 3 + spans])
    blocks = _blocks(benchmark, block_bytes)
    first, second = next(blocks), next(blocks, None)
    if second is None:
        return _once(docs, first, window, spans)
    finds = [_finds(docs, first, window), _finds(docs, second, window)]
    finds += [_finds(docs, block, window) for block in blocks]
    return _merged(docs, finds, spans)


def clean(docs: DataFrame, benchmark: DataFrame, window: int = 8, block_bytes: int = 4 << 20) -> DataFrame:
    """docs without the documents in which a run of ``window`` or more words is hit: those that hold a window of an item. An
    item shorter than that doesn't condemn a document by itself, as its few words also stand in clean ones."""
    own = [c for c in docs.columns if c.lower() in NAMES]
    kept = docs.withColumnsRenamed(dict(zip(own, fresh(docs, *(f"bench_own_{c}" for c in own)))))
    found = search(kept, benchmark, window, block_bytes, spans=True)
    found = found.where(~F.exists("bench_spans", lambda x: x[1] - x[0] >= window)).drop(*NAMES)
    return found.toDF(*docs.columns)
