"""Pages to clean book texts: recurring headers and footers out, noise lines out, pages joined.

Tables: pages(book_id, page_no, text) and lines(book_id, page_no, line_no, line). Order is always a column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..config import EngineConfig
from ..functions import text as T
from ..settle import pinned


def page_lines(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    t = T.rejoin_hyphens(F.col("text")) if cfg.fix_hyphenation else F.col("text")
    return pages.select("book_id", "page_no", F.posexplode(T.lines(t)).alias("line_no", "line"))


def boundary_lines(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """The first and the last lines of each page; on short pages the same line can be both, and counts twice."""
    k = cfg.boundary_lines
    ls = T.lines(F.col("text"))
    both = F.concat(F.slice("ls", 1, k), F.slice("ls", F.greatest(F.size("ls") - (k - 1), F.lit(1)), k))
    return pages.select("book_id", "page_no", ls.alias("ls")).select("book_id", "page_no", F.posexplode(both).alias("slot", "line")).withColumn("line", T.strip(F.col("line")))


def recurring_lines(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """(book_id, line, n) of short boundary lines on enough pages."""
    counts = boundary_lines(pages, cfg).where((F.col("line") != "") & (T.count_words(F.col("line")) <= cfg.header_words)).groupBy("book_id", "line").agg(F.count("*").alias("n"))
    sizes = pages.groupBy("book_id").agg(F.count("*").alias("n_pages"))
    enough = F.greatest(F.lit(cfg.header_floor).cast("bigint"), F.floor(F.col("n_pages") * F.lit(cfg.header_share)))
    return counts.join(sizes, "book_id").where(F.col("n") >= enough).select("book_id", "line", "n")


def _kept(pages: DataFrame, cfg: EngineConfig) -> DataFrame:
    """(book_id, page_no, kept: array of (line_no, line)): the pages' lines without those that recur, wherever they stand. A line
    recurs on a share of the pages and a page has few places for one, so a book has few (20 at the default share): they meet
    the pages as one array a book."""
    t = T.rejoin_hyphens(F.col("text")) if cfg.fix_hyphenation else F.col("text")
    gone = recurring_lines(pages, cfg).groupBy("book_id").agg(F.collect_set("line").alias("gone"))
    d = pinned(pages.join(gone, "book_id", "left"), "book_id", "page_no", "gone", T.lines(t).alias("ls"))
    rows = F.transform("ls", lambda x, i: F.struct(i.alias("line_no"), x.alias("line")))
    return d.select("book_id", "page_no", F.filter(rows, lambda x: ~F.coalesce(F.array_contains("gone", T.strip(x["line"])), F.lit(False))).alias("kept"))


def without_recurring(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """(book_id, page_no, line_no, line) of all pages, without the lines that recur, wherever they stand."""
    return _kept(pages, cfg).select("book_id", "page_no", F.inline("kept"))


def clean_lines(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    return without_recurring(pages, cfg).where(~T.is_noise(F.col("line")))


def _joined(rows: DataFrame, keys: list[str], order: str, value: str, by: str, name: str) -> DataFrame:
    parts = F.array_sort(F.collect_list(F.struct(order, value)))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(parts, lambda x: x[value]), by).alias(name))


def clean_pages(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """(book_id, page_no, text); a page without any line left has an empty text."""
    good = F.filter(F.transform("kept", lambda x: x["line"]), lambda x: ~T.is_noise(x))
    return _kept(pages, cfg).select("book_id", "page_no", F.array_join(good, "\n").alias("text"))


def assemble(clean: DataFrame) -> DataFrame:
    """(book_id, text): a book's pages in order, a blank line between them, normalised."""
    joined = _joined(clean, ["book_id"], "page_no", "text", "\n\n", "joined")
    return joined.select("book_id", T.clean_whitespace(T.normalise_unicode(F.col("joined"))).alias("text"))


def books(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    return assemble(clean_pages(pages, cfg))


def long_enough(books: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """Books with enough words; the rest can be reported with ``too_short``."""
    return books.where(T.count_words(F.col("text")) >= cfg.min_book_words)


def too_short(books: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    return books.select("book_id", T.count_words(F.col("text")).alias("word_count")).where(F.col("word_count") < cfg.min_book_words)
