"""The corpus pipeline: stages applied to documents one after another.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.

1. quality rules: documents that fail the base rules or a cutoff learned from the stage's input go.
2. line dedup: lines found in three documents or more stay only in the largest doc_id; n_chars follows the text.
3. MinHash near-dedup: the smallest doc_id of each component of links at similarity 0.8 or more stays.
4. benchmark decontamination: documents that hold eight consecutive words of a benchmark item go.
5. SentencePiece: ids of each text, and whether they decode to it.

Each stage judges rows, not ids, so rows that repeat a doc_id are told apart by their texts. Null or empty texts fail the base
rules of stage 1; given to a later stage by itself they pass it: they have one empty line, no shingles and no hits, and
encode as null or no ids. A null doc_id stays where its text does. Rows alike in doc_id and text pass stages 1 and 2 and are one
document from stage 3 on. Very long texts go through whole. Columns besides those of documents are left out, whatever their
names. Of near copies with the same smallest doc_id the one whose text's hash is smallest stays. Empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from loomtext.llm import decontaminate, line_dedup, minhash, pieces, quality_rules
from loomtext.llm.shared import stored

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    measured = stored(quality_rules.measure(docs.select(*COLUMNS)))  # the cutoffs read only the measurements, the verdicts all
    return quality_rules.judge(measured, quality_rules.thresholds(measured)).where("q_kept").select(*COLUMNS)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    d = line_dedup.dedup(docs.select(*COLUMNS))
    return d.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, limit=80).select(*COLUMNS)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(*COLUMNS)


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = pieces.load()
    d = pieces.encode_and_decode(docs.select(*COLUMNS), model)
    return d.select("doc_id", "lang", "source", "n_chars", "piece_ids", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("bigint").alias("n_pieces"), F.col("piece_text").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [("quality_rules", quality_stage), ("line_dedup", line_stage), ("minhash", near_stage), ("decontaminate", benchmark_stage), ("sentencepiece", pieces_stage)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs)  # the next stage reads its input more than once
    return docs
