"""JSON lines, prompts, completed chunks: sources and sinks."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions import text as T
from ..operators import validate


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (path, begin, value): adds the row's number in its piece. A task reads its pieces one after another, each in order."""
    last, n = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        path, begin = batch.column(0), batch.column(1)
        new = np.ones(batch.num_rows, bool)
        new[1:] = pc.or_(pc.not_equal(path[1:], path[:-1]), pc.not_equal(begin[1:], begin[:-1])).to_numpy(zero_copy_only=False)
        at = np.arange(batch.num_rows)
        row = at - np.maximum.accumulate(np.where(new, at, 0))
        if last == (path[0].as_py(), begin[0].as_py()):
            row[: int(np.append(np.flatnonzero(new[1:]) + 1, batch.num_rows)[0])] += n
        last, n = (path[-1].as_py(), begin[-1].as_py()), int(row[-1]) + 1
        yield pa.RecordBatch.from_arrays([path, pc.add(begin, pa.array(row)), batch.column(2)], ["path", "at", "value"])


def read_lines(spark: SparkSession, *paths: str) -> DataFrame:
    """lines(line_no, value). Only a newline ends a line. line_no rises with the files' paths and, in each, with its lines: Spark
    deals files by size, so it is made of the file's rank, the offset of the piece that a task has read, and the line in it,
    which is never more than the bytes before it."""
    path, begin = F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("begin")
    deep = {"recursiveFileLookup": "true"}
    d = spark.read.options(**deep).text(list(paths), lineSep="\n").select(path, begin, "value").mapInArrow(_counted, "path string, at long, value string")
    files = spark.read.format("binaryFile").options(**deep).load(list(paths)).select(path)  # names only, contents aren't read
    files = files.select("path", (F.row_number().over(Window.orderBy("path")) - 1).cast("bigint").alias("file"))
    numbered = d.join(files, "path")
    return numbered.select((F.shiftleft("file", OFFSET_BITS) + F.col("at")).alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))


#: a file may have so many bytes, and there may be 2 ** (63 - this) files
OFFSET_BITS = 42


def strict_pairs(lines: DataFrame) -> DataFrame:
    """pairs(pair_id, instruction, response) of the lines that are objects with both keys; others are skipped."""
    d = lines.withColumn("obj", validate.json_object(T.strip(F.col("value"))))
    d = d.where(F.col("obj").isNotNull() & F.map_contains_key("obj", "instruction") & F.map_contains_key("obj", "response"))
    return d.select(F.col("line_no").alias("pair_id"), validate.field(F.col("obj"), "instruction").alias("instruction"), validate.field(F.col("obj"), "response").alias("response"))


def seen_keys(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(keys of instructions, keys of responses) of readable lines; a missing field counts as empty."""
    d = lines.withColumn("obj", validate.json_object(T.strip(F.col("value")))).where(F.col("obj").isNotNull())
    return tuple(d.select(T.match_key(validate.field(F.col("obj"), k)).alias("key")).distinct() for k in ("instruction", "response"))


def line_count(lines: DataFrame) -> int:
    return lines.where(T.strip(F.col("value")) != "").count()


def to_json_lines(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.to_json(F.struct("instruction", "response")).alias("value"))


def to_chat(pairs: DataFrame, system: str) -> DataFrame:
    """value: {"messages": [system, user, assistant]}."""
    m = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    messages = F.array(m("system", F.lit(system)), m("user", F.col("instruction")), m("assistant", F.col("response")))
    return pairs.select("pair_id", F.to_json(F.struct(messages.alias("messages"))).alias("value"))


def write_lines(values: DataFrame, path: str, resume: bool = False) -> None:
    """Appends when resuming; else what stood there before goes. A path that is being read must not be overwritten."""
    values.select("value").write.mode("append" if resume else "overwrite").text(path)


def read_prompt(path: str) -> str:
    """A prompt file; FileNotFoundError if there is none."""
    return Path(path).read_text(encoding="utf-8")


def read_completed(spark: SparkSession, path: str) -> DataFrame:
    """completed(book_id, chunk_index); empty if there is no table yet."""
    try:
        return spark.read.schema("book_id string, chunk_index int").parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], "book_id string, chunk_index int")


def write_completed(done: DataFrame, path: str) -> None:
    done.select("book_id", "chunk_index").write.mode("append").parquet(path)


def parts(spark: SparkSession, path: str) -> list[str]:
    """The paths of the sub-folders of path, in order; none if it isn't there."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return sorted(x.getPath().toString() for x in fs.listStatus(p) if x.isDirectory()) if fs.exists(p) else []


def clear(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
