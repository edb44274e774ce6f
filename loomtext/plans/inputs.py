"""The driver's tables as books, pages, pairs and JSON lines.

The documents have neither headings, running heads nor broken JSON, so these are put in by rules that SQL can repeat."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F


HEADINGS = ("Chapter", "Act", "Scene", "Prologue", "Epilogue", "Part", "Book", "Volume", "Section")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plain_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A source is a book, its documents in order are the pages."""
    n = F.row_number().over(Window.partitionBy("source").orderBy("doc_id")) - 1
    return table(spark, sf_dir, "documents").select(F.col("source").alias("book_id"), n.alias("page_no"), "text", "doc_id")


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """plain_pages with a running head, a page number, some garbage, and every fifth page a heading, of all kinds in turn."""
    p = plain_pages(spark, sf_dir)
    k = F.col("page_no")
    text = F.concat(
        F.lit("The Book of "), F.col("book_id"), F.lit("\n"),
        F.when(k % 5 == 0, F.concat(F.get(F.array(*map(F.lit, HEADINGS)), (F.floor(k / 5) % len(HEADINGS)).cast("int")), F.lit(" "), (F.floor(k / 5) + 1).cast("string"), F.lit("\n"))).otherwise(""),
        F.when(k % 7 == 0, F.lit("*****\n")).otherwise(""),
        F.coalesce("text", F.lit("")), F.lit("\nPage "), (k + 1).cast("string"),
    )
    return p.select("book_id", k.cast("int").alias("page_no"), text.alias("text"))


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's first line is the instruction, the rest the response."""
    d = table(spark, sf_dir, "documents")
    cut = F.instr("text", "\n")
    first = F.when(cut > 0, F.left("text", cut - 1)).otherwise(F.col("text"))
    rest = F.when(cut > 0, F.substr("text", cut + 1)).otherwise(F.lit(""))
    return d.select(F.col("doc_id").alias("pair_id"), F.coalesce(first, F.lit("")).alias("instruction"), F.coalesce(rest, F.lit("")).alias("response")).where((F.trim("instruction") != "") & (F.trim("response") != ""))


def json_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs as JSON; every 11th has a bad escape, every 13th is cut off, every 17th answers too shortly, every 19th is
    marked with a speaker, every 23rd is blank."""
    d = pairs(spark, sf_dir)
    i = F.when(F.col("pair_id") % 19 == 0, F.concat(F.lit("Student: "), F.col("instruction"))).otherwise(F.col("instruction"))
    r = F.when(F.col("pair_id") % 17 == 0, F.lit("Too short.")).otherwise(F.col("response"))
    line = F.to_json(F.struct(i.alias("instruction"), r.alias("response")))
    line = F.when(F.col("pair_id") % 11 == 0, F.replace(line, F.lit('"response":"'), F.lit('"response":"\\q '))).otherwise(line)
    line = F.when(F.col("pair_id") % 13 == 0, F.left(line, F.length(line) - 1)).otherwise(line)
    line = F.when(F.col("pair_id") % 23 == 0, F.lit("  ")).otherwise(line)
    return d.select(F.col("pair_id").alias("line_no"), line.alias("value"))


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user's turn and the assistant's next."""
    w = Window.partitionBy("conv_id").orderBy("turn")
    d = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text", F.lead("role").over(w).alias("next_role"), F.lead("text").over(w).alias("next_text"))
    d = d.where((F.col("role") == "user") & (F.col("next_role") == "assistant"))
    return d.select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"), F.col("text").alias("instruction"), F.col("next_text").alias("response"), "turn")
