"""Line dedup: range-partitioned line hashes, streamed in order, give each document a compressed keep bitmap.

A line's key is the line without ASCII white space at its ends and with A-Z lower-cased.  Keys of at least ``min_chars``
code points that are found in at least ``min_docs`` documents lose all their lines except those of the largest doc_id.

1. Each document emits (128-bit key hash, doc_id, text fingerprint, line number) for its long lines; no text is shuffled.
2. Rows are range-partitioned and sorted by (hash, doc_id descending, line number).  The range takes in all of these
   columns, so a key that a third of all lines share is spread over many tasks.
3. One pass over each partition streams the runs of equal hashes.  Within a run the first document keeps its lines; the
   second's wait until a third shows up; later ones go at once.  A partition's first and last run may go on in its
   neighbours: their rows come out undecided, beside a summary of at most ``min_docs`` document ids each.  The
   summaries (two a partition, so bounded by the number of partitions) are merged by hash and broadcast to settle them.
4. Dropped line numbers are gathered by document and packed into zlib-compressed bitmaps; the texts meet only these.

Edge cases: a null or empty text is one empty line, which stays; a null doc_id counts as one document, the smallest;
repeated rows (same doc_id) are one document, and each row gets its text's bitmap; a line that stands several times in the
document that keeps it stays each time; very long texts are split whole; extra columns are kept by ``apply``, whatever their
names: only columns called ``line_n`` or ``line_dropped`` are replaced; an empty table gives an empty table.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .shared import few, fresh, settled, with_columns

_WS = b" \t\n\x0b\x0c\r"
_OUT = pa.schema([("line_h1", pa.int64()), ("line_h2", pa.int64()), ("line_doc", pa.int64()), ("line_fp", pa.int64()), ("line_no", pa.int32())])
_RUNS = pa.schema([*_OUT, ("line_kind", pa.int8())])
DROP, OPEN, EDGE = 0, 1, 2


def _texts(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary() if pa.types.is_string(column.type) else pa.large_binary()).to_pylist()]


def _keys(min_chars: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, fps = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            digests, owner, numbers = [], [], []
            for k, text in enumerate(_texts(batch.column(2))):
                for no, line in enumerate(text.split(b"\n")):
                    if len(line) >= min_chars:
                        key = line.strip(_WS).lower()
                        if len(key) >= min_chars and (key.isascii() or len(key.decode("utf-8", "replace")) >= min_chars):
                            digests.append(hashlib.blake2b(key, digest_size=16).digest())
                            owner.append(k)
                            numbers.append(no)
            h = np.frombuffer(b"".join(digests), dtype="<i8").reshape(-1, 2)
            columns = [pa.array(h[:, 0]), pa.array(h[:, 1]), pa.array([docs[k] for k in owner], pa.int64()), pa.array([fps[k] for k in owner], pa.int64()), pa.array(numbers, pa.int32())]
            yield pa.RecordBatch.from_arrays(columns, schema=_OUT)

    return run


def _stream(min_docs: int):
    """Over rows sorted by (h1, h2, doc descending, fp, no): dropped rows, undecided rows of the first and the last run, and these runs' documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = True  # still in the partition's first run
        key, keeper, last, n, docs, waiting = None, None, None, 0, [], []
        out: list[tuple] = []

        def flush():
            nonlocal out
            made, out = out, []
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*made), _RUNS)] if made else [pa.array([], f.type) for f in _RUNS], schema=_RUNS)

        for batch in batches:
            for h1, h2, doc, fp, no in zip(*(c.to_pylist() for c in batch.columns)):
                if (h1, h2) != key:
                    if key is not None and first:
                        out.extend((*key, d, None, None, EDGE) for d in docs)
                        first = False
                    key, keeper, last, n, docs, waiting = (h1, h2), doc, doc, 1, [doc], []
                elif doc != last:
                    last, n = doc, n + 1
                    if n <= min_docs:
                        docs.append(doc)
                    if n == min_docs:
                        out.extend((*x, DROP) for x in waiting)
                        waiting = []
                if first:
                    out.append((h1, h2, doc, fp, no, OPEN))
                elif doc != keeper:
                    if n >= min_docs:
                        out.append((h1, h2, doc, fp, no, DROP))
                    else:
                        waiting.append((h1, h2, doc, fp, no))
                if len(out) >= 20000:
                    yield flush()
        if key is not None:
            # what the last run has dropped so far is right whatever follows; what waits may still have to go
            out.extend((*key, d, None, None, EDGE) for d in docs)
            out.extend((*x, OPEN) for x in waiting)
        yield flush()

    return run


def _bitmaps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        maps = []
        for dropped in batch.column(2).to_pylist():
            keep = np.ones((max(dropped) | 7) + 1, bool)  # whole bytes
            keep[dropped] = False
            maps.append(zlib.compress(np.packbits(keep).tobytes(), 1))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(maps, pa.binary())], ["line_doc", "line_fp", "line_keep"])


def keep_bitmaps(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(line_doc, line_fp, line_keep) of the documents that lose lines.

    line_fp: xxhash64 of the text, which tells rows of one doc_id apart; line_keep: zlib-compressed bits, 1 for each line
    that stays, up to the last one dropped (lines beyond it stay).
    """
    # kept in the shared folder: sampling the ranges would read and split every text once more
    lines = settled(docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(_keys(min_chars), "line_h1 long, line_h2 long, line_doc long, line_fp long, line_no int"))
    order = [F.col("line_h1"), F.col("line_h2"), F.col("line_doc").desc_nulls_last(), F.col("line_fp"), F.col("line_no")]
    dealt = lines.repartitionByRange(*order).sortWithinPartitions(*order)
    runs = settled(dealt.mapInArrow(_stream(min_docs), "line_h1 long, line_h2 long, line_doc long, line_fp long, line_no int, line_kind byte"))
    # ids of at most min_docs documents an edge run, and two such runs a partition
    n = F.count_distinct("line_doc") + F.max(F.when(F.col("line_doc").isNull(), 1).otherwise(0))
    edges = settled(runs.where(F.col("line_kind") == EDGE).groupBy("line_h1", "line_h2").agg(F.max("line_doc").alias("line_keeper"), n.alias("line_docs")))
    open_rows = runs.where(F.col("line_kind") == OPEN).join(few(edges), ["line_h1", "line_h2"])
    decided = open_rows.where((F.col("line_docs") >= min_docs) & ~F.col("line_doc").eqNullSafe(F.col("line_keeper")))
    columns = ["line_doc", "line_fp", "line_no"]
    dropped = runs.where(F.col("line_kind") == DROP).select(*columns).union(decided.select(*columns))
    return dropped.groupBy("line_doc", "line_fp").agg(F.collect_set("line_no").alias("line_nos")).mapInArrow(_bitmaps, "line_doc long, line_fp long, line_keep binary")


#: bitmaps that are broadcast: so many bytes at most, measured first
FEW_BYTES = 32 << 20


def apply(docs: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """docs with the dropped lines taken out of text, and line_n (lines before) and line_dropped added.

    Bitmaps of up to FEW_BYTES are broadcast, so that no text moves; more are joined by shuffling."""
    bitmaps = settled(bitmaps)
    size = bitmaps.agg(F.coalesce(F.sum(F.octet_length("line_keep") + 64), F.lit(0))).first()[0]
    docs = docs.drop("line_n", "line_dropped")
    doc, fp, keep, own = names = fresh(docs, "line_doc", "line_fp", "line_keep", "line_own")
    maps = bitmaps.toDF(doc, fp, keep)
    on = F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(fp))
    joined = docs.withColumn(own, F.xxhash64("text")).join(F.broadcast(maps) if size <= FEW_BYTES else maps, on, "left").drop(doc, fp, own)
    at, packed_at = [c.lower() for c in docs.columns].index("text"), len(docs.columns)

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        counts, drops, texts = [], [], []
        for text, packed in zip(batch.column(at).cast(pa.binary()).to_pylist(), batch.column(packed_at).to_pylist()):
            lines = (text or b"").split(b"\n")
            counts.append(len(lines))
            if packed is None:
                drops.append(0)
                texts.append(text)
                continue
            keep = np.unpackbits(np.frombuffer(zlib.decompress(packed), np.uint8)).astype(bool)[: len(lines)]
            keep = np.concatenate([keep, np.ones(len(lines) - len(keep), bool)])
            drops.append(int(len(lines) - keep.sum()))
            texts.append(b"\n".join(x for x, k in zip(lines, keep) if k))
        return [pa.array(texts, pa.binary()).cast(pa.string()), pa.array(counts, pa.int64()), pa.array(drops, pa.int64())]

    out = with_columns(joined, "text string, line_n long, line_dropped long", lambda: make, ("text", names[2]))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    return out.select(*columns, "line_n", "line_dropped")


def dedup(docs: DataFrame, min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    return apply(docs, keep_bitmaps(docs, min_chars, min_docs))
