"""New JSON lines as they come in: validated, and appended if their keys are new. An extension of the batch entries.

The target is one table for all streams. Each micro-batch writes a sub-folder of its own, named by stream (its checkpoint) and
batch, so that a batch that is run again after a failure replaces what it wrote and nothing else. Its keys are compared with
those of all other folders, which stand beside the texts as hashes, so earlier texts are not read again.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import EngineConfig
from ..functions import text as T
from ..operators import generate, validate
from ..sources import jsonl

KEYS = {"instruction_key": "instruction", "response_key": "response"}


def append_pairs(spark: SparkSession, source: str, target: str, checkpoint: str, cfg: EngineConfig = EngineConfig(), once: bool = False) -> StreamingQuery:
    """The table target: pair_id (unique in its stream and batch), instruction, response, instruction_key, response_key, stream,
    batch."""
    stream = hashlib.md5(checkpoint.encode()).hexdigest()

    def hashed(d: DataFrame) -> DataFrame:
        return d.withColumns({k: F.md5(T.match_key(F.col(c))) for k, c in KEYS.items()})

    def write(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        lines = batch.select(F.monotonically_increasing_id().alias("line_no"), F.regexp_replace("value", "\r$", "").alias("value"))
        new = hashed(validate.validated(lines, cfg.min_response_words))
        if jsonl.parts(session, target):
            old = session.read.schema("instruction_key string, response_key string, stream string, batch long").parquet(target)
            old = old.where((F.col("stream") != stream) | (F.col("batch") != number))
            for k in KEYS:
                new = new.join(old.select(k).distinct(), k, "left_anti")
        none = session.createDataFrame([], "key string")
        generate.unseen(new, none, none).select("pair_id", *KEYS.values(), *KEYS).write.mode("overwrite").parquet(f"{target}/stream={stream}/batch={number}")

    lines = spark.readStream.option("lineSep", "\n").text(source)
    writer = lines.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
