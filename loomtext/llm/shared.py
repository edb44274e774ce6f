"""What the operators share: where intermediate tables go, and names that are free."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType


def shared_folder(spark: SparkSession) -> str:
    """The folder of this session's intermediate tables, in spark.checkpoint.dir.

    The setting is read from the session. Where it is unset, a local session, as in tests, takes a temporary folder; on a
    cluster that would be a folder that executors don't share, so there it is an error.
    """
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="loomtext-"))
    return sc.getCheckpointDir()


def settled(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder; its plan starts there anew."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same as a Parquet table: compressed, and later plans read only the columns that they need. For wide rows."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


FEW = 1_000_000


def few(df: DataFrame, most: int = FEW) -> DataFrame:
    """A settled df of a few short columns, to be broadcast if it has at most so many rows; beyond, the optimiser's own choice."""
    return F.broadcast(df) if df.count() <= most else df


def with_columns(df: DataFrame, ddl: str, start: Callable[[], Callable[[pa.RecordBatch], list[pa.Array]]], instead_of: tuple[str, ...] = (), part: int = 512) -> DataFrame:
    """df with the columns of ddl, from Arrow: ``start`` is called once a task and gives the function that makes them from
    a batch of at most ``part`` rows. Columns of these names, and those that they stand in for, are left out."""
    new = StructType.fromDDL(ddl)
    gone = {c.lower() for c in instead_of}
    df = df.drop(*(c for c in new.names if c.lower() not in gone))
    kept = [k for k, f in enumerate(df.schema.fields) if f.name.lower() not in gone]
    out = StructType([*(df.schema.fields[k] for k in kept), *new.fields])

    def run(batches):
        make = start()
        for whole in batches:
            for offset in range(0, whole.num_rows, part):
                batch = whole.slice(offset, part)
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *make(batch)], out.names)

    return df.mapInArrow(run, out)


def tidy(spark: SparkSession) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more."""
    for _ in range(2):  # the first round frees Python's handles, the second what they held
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with as many underscores after it as make it no column of df (upper and lower case are alike)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out
