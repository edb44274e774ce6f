"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import gc
import tempfile
import time
import uuid

from pyspark.sql import Column, DataFrame, functions as F


def _shared(df: DataFrame) -> str:
    """spark.checkpoint.dir. Only a local session, as in tests, takes a temporary folder where that is unset; on a cluster executors
    would not share it."""
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if shared is None and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="loomtext-"))
    return sc.getCheckpointDir()


def settle(df: DataFrame) -> DataFrame:
    """df, computed once and kept in the shared folder."""
    _shared(df)
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """The same as a compressed Parquet table, of which later plans read only the columns that they need. For many or wide rows."""
    path = f"{_shared(df)}/{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(df: DataFrame) -> None:
    """Lets Spark drop the shuffle files of plans that nothing refers to any more."""
    for _ in range(2):  # the first round frees Python's handles, the second what they held
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def pinned(df: DataFrame, *columns: Column | str) -> DataFrame:
    """df.select(*columns), each column evaluated once a row: the optimiser moves neither filters nor expressions across the
    generator, so what is built on these columns doesn't repeat their expressions."""
    return df.select(F.inline(F.array(F.struct(*columns))))
