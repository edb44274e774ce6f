"""The thin queries opN_<name> over the driver's tables, and the SQL that some can be held against."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .oracles import ORACLES
from .shared import settled


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _fold_of(folds: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(folds))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_dedup

    d = line_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", F.col("line_n").alias("n_lines"), F.col("line_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import suffix_dedup

    d = suffix_dedup.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return d.select("doc_id", "n_bytes", "n_removed", F.size("removed").cast("bigint").alias("n_spans"), "kept_sha256")


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_classifier as q

    vectors = settled(q.featurise(table(spark, sf_dir, "documents").select("doc_id", "text")))
    model = q.fit(vectors.where(_fold_of(5) != 0), table(spark, sf_dir, "labels").where(_fold_of(5) != 0))
    d = q.score(vectors, model)
    return d.select("doc_id", (_fold_of(5) == 0).alias("held_out"), F.col("quality_score").alias("score"), (F.col("quality_score") >= 0.3).cast("int").alias("predicted"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pieces

    model = pieces.load()
    d = pieces.encode_and_decode(table(spark, sf_dir, "documents").select("doc_id", "text"), model)
    ids = F.array_join(F.col("piece_ids").cast("array<string>"), ",")
    return d.select("doc_id", F.coalesce(F.size("piece_ids"), F.lit(0)).cast("bigint").alias("n_pieces"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.col("piece_text").eqNullSafe(F.col("text")).alias("round_trip"))


def op5_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import html_text

    d = html_text.extract(table(spark, sf_dir, "pages"))
    return d.select("page_id", "url", F.length("html_text").cast("bigint").alias("n_chars"), F.sha2(F.col("html_text").cast("binary"), 256).alias("text_sha256"), "html_text")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontaminate

    d = decontaminate.search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark")).drop("text")
    items = F.array_join("bench_items", ",")
    return d.select("doc_id", F.col("bench_words").alias("n_words"), F.col("bench_hits").alias("n_hit"), F.size("bench_items").cast("bigint").alias("n_items"), F.sha2(items.cast("binary"), 256).alias("items_sha256"), (F.size("bench_items") >= 2).alias("contaminated"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels").where(_fold_of(3) != 1))
    d = toxicity.score(docs, model)
    return d.select("doc_id", (_fold_of(3) == 1).alias("held_out"), F.col("toxic_score").alias("score"), (F.col("toxic_score") >= 0.7).cast("int").alias("predicted"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality_rules as q

    measured = settled(q.measure(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")).drop("text"))
    d = q.judge(measured, q.thresholds(measured))
    names = {"q_words": "n_words", "q_chars": "word_chars", "q_symbols": "n_symbols", "q_dup_lines": "n_dup_lines", "q_repeat": "n_repeat_words", "q_base_failed": "base_failed", "q_kept": "kept"}
    return d.select("doc_id", *[F.col(a).alias(b) for a, b in names.items()])


def op9_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import minhash

    d = minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), limit=85)
    return d.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import pii

    d = pii.find(table(spark, sf_dir, "documents").select("doc_id", "text"))
    counts = [F.size(f"pii_{k}").cast("bigint").alias(f"n_{k}") for k in pii.BASE]
    base, more = [F.col(f"pii_{k}") for k in pii.BASE], [F.col(f"pii_{k}") for k in pii.ADDED]
    added = [F.size(f"pii_{k}").cast("bigint").alias(f"n_{k}") for k in pii.ADDED]
    n_spans = sum((F.size(x) for x in [*base, *more]), F.lit(0)).cast("bigint").alias("n_spans")
    return d.select("doc_id", *counts, F.sha2(pii.digest(base).cast("binary"), 256).alias("base_sha256"), pii.digest([*base, *more]).alias("spans"), *added, n_spans)


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op8 without the learned verdict, which SQL can't express."""
    return op8_quality_rules(spark, sf_dir).drop("kept")


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op10's base kinds, which SQL can express."""
    return op10_pii(spark, sf_dir).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def queries() -> dict:
    out = {k: v for k, v in globals().items() if k.startswith("op") and k[2].isdigit()}
    return out | {"quality_base": quality_base, "pii_base": pii_base}


def oracle_sql() -> dict:
    return dict(ORACLES)
