"""PDF books to pages. Needs a PDF library on the executors; the engine's own input is a table of pages."""

from __future__ import annotations

import io
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import EngineConfig


def _all(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").load(path)


def files(spark: SparkSession, path: str, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """(path, length, content) of the files that are large enough."""
    return _all(spark, path).where(F.col("length") >= cfg.min_file_bytes).select("path", "length", "content")


def too_small(spark: SparkSession, path: str, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """(path, length) of the files that are not."""
    return _all(spark, path).where(F.col("length") < cfg.min_file_bytes).select("path", "length")


def pages(files: DataFrame) -> DataFrame:
    """pages(book_id, page_no, text) of PDF files; a file that can't be read raises RuntimeError."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        try:
            import pdfplumber
        except ImportError as e:
            raise RuntimeError("reading PDF files needs pdfplumber") from e
        for part in parts:
            rows = []
            for path, content in zip(part["path"], part["content"]):
                try:
                    with pdfplumber.open(io.BytesIO(content)) as book:
                        rows += [(path, k, page.extract_text(x_tolerance=2, y_tolerance=2) or "") for k, page in enumerate(book.pages)]
                except Exception as e:
                    raise RuntimeError(f"{path} can't be read") from e
            yield pd.DataFrame(rows, columns=["book_id", "page_no", "text"])

    return files.mapInPandas(run, "book_id string, page_no int, text string")
