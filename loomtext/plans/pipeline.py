"""The three entries: books to a dataset, an existing dataset curated, and a second pass over the same books."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..config import EngineConfig
from ..functions import text as T
from ..operators import chunks as C, dedup, generate, pages as P, sections as S, validate
from ..settle import settle
from ..sources import jsonl


class EmptyStage(RuntimeError):
    """A stage made nothing, so there is nothing to go on with."""


@dataclass
class Result:
    pairs: DataFrame
    counts: dict[str, int | float]
    too_short: DataFrame  # (book_id, word_count) of the books that were left out


def to_chunks(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    return C.chunks(S.sections(P.long_enough(P.books(pages, cfg), cfg), cfg), cfg)


def curate(lines: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """Raw JSON lines to validated, deduplicated pairs."""
    return dedup.deduplicate(settle(validate.validated(lines, cfg.min_response_words)), cfg)


def _ordered(pairs: DataFrame) -> DataFrame:
    """value: generated pairs as JSON lines, in files and lines ordered as books, chunks and calls are."""
    key = F.struct(*generate.PLACE)
    return pairs.withColumn("key", key).repartitionByRange("key").sortWithinPartitions("key").select(F.to_json(F.struct("instruction", "response")).alias("value"))


def _groups(todo: DataFrame, size: int) -> list[DataFrame]:
    """todo in groups of so many chunks, by order of book and chunk; in one if size is 0. Only a provider's pace makes groups
    worthwhile, so the numbered ids are few."""
    if not size:
        return [todo]
    n = F.row_number().over(Window.orderBy(*generate.CHUNK)) - 1
    ids = settle(todo.select(*generate.CHUNK).withColumn("group", F.floor(n / size)))
    top = ids.agg(F.max("group")).first()[0]
    return [todo.join(F.broadcast(ids.where(F.col("group") == k)), generate.CHUNK, "left_semi") for k in range(0 if top is None else top + 1)]


def _words(d: DataFrame, column: str) -> int:
    return d.agg(F.coalesce(F.sum(column), F.lit(0))).first()[0]


def run(
    spark: SparkSession, pages: DataFrame, out: str, cfg: EngineConfig = EngineConfig(), resume: bool = False, generator: generate.Generator | None = None,
    template: str = generate.TEMPLATE, seen: tuple[DataFrame, DataFrame] | None = None,
) -> Result:
    """Books to the final dataset in ``out``/final; raw pairs in ``out``/working, completed chunks in ``out``/completed.

    Chunks are generated in groups (``cfg.save_every``). Each group's pairs are written as a folder of their own in ``working``,
    then its chunks count as completed, unless one of their calls failed. With ``resume`` what is there stays and completed chunks
    are skipped, so a run that broke off loses one group at most.  With ``seen`` (keys of instructions, of responses) it is a
    second pass: pairs that repeat a key, or one of this pass, are left out and made up for.
    """
    begin = time.monotonic()
    books = settle(P.books(pages, cfg))
    good, short = P.long_enough(books, cfg), P.too_short(books, cfg)
    sections = settle(S.sections(good, cfg))
    chunks = settle(C.chunks(sections, cfg))
    words = good.select(T.count_words(F.col("text")).alias("n"))
    counts: dict[str, int | float] = {"books": books.count(), "too_short": short.count(), "words": _words(words, "n"), "sections": sections.count(), "chunks": chunks.count()}
    counts["words_outside_sections"] = counts["words"] - _words(sections, "word_count")  # headings among them
    if counts["books"] == counts["too_short"]:
        raise EmptyStage(f"no book of {cfg.min_book_words} words or more")
    for name in ("sections", "chunks"):
        if not counts[name]:
            raise EmptyStage(f"no {name}")
    working, completed = f"{out}/working", f"{out}/completed"
    if not resume:
        jsonl.clear(spark, completed)
        jsonl.clear(spark, working)
    todo = settle(generate.pending(chunks, settle(jsonl.read_completed(spark, completed)))) if resume else chunks
    avoid = None
    if seen is not None:  # a fixed choice of earlier instructions for the prompts
        avoid = [r.key[:100] for r in seen[0].where("key != ''").orderBy(F.xxhash64("key"), "key").limit(15).collect()]
    counts["calls"] = counts["failed_calls"] = 0
    for part in _groups(todo, cfg.save_every or int(cfg.provider != "stub")):
        known, there = seen, jsonl.parts(spark, working)
        if seen is not None and there:
            known = tuple(a.union(b) for a, b in zip(seen, jsonl.seen_keys(jsonl.read_lines(spark, *there))))
        made = generate.produce(part, cfg, generator, template, known, avoid)
        following = int(there[-1].rsplit("-", 1)[1]) + 1 if there else 0
        jsonl.write_lines(_ordered(made.pairs), f"{working}/group-{following:08d}")
        jsonl.write_completed(made.finished, completed)
        counts["calls"] += made.calls
        counts["failed_calls"] += made.failed
    there = jsonl.parts(spark, working)
    lines = jsonl.read_lines(spark, *there) if there else spark.createDataFrame([], "line_no long, value string")
    counts["generated"] = jsonl.line_count(lines)
    if not counts["generated"]:
        raise EmptyStage("no pairs")
    valid = settle(validate.validated(lines, cfg.min_response_words))
    counts["valid"] = valid.count()
    final = settle(dedup.deduplicate(valid, cfg))
    counts["final"] = final.count()
    in_order = final.repartitionByRange("pair_id").sortWithinPartitions("pair_id")
    jsonl.write_lines(jsonl.to_json_lines(in_order), f"{out}/final")
    if generate.pending(chunks, jsonl.read_completed(spark, completed)).isEmpty():
        jsonl.clear(spark, completed)
    counts["seconds"] = round(time.monotonic() - begin, 1)
    return Result(final, counts, short)


def second_pass(spark: SparkSession, pages: DataFrame, existing: list[str], out: str, cfg: EngineConfig = EngineConfig(), **more) -> Result:
    """A run over the same books whose pairs are new to the JSON lines in the existing paths."""
    keys = jsonl.seen_keys(jsonl.read_lines(spark, *existing))
    return run(spark, pages, out, cfg, seen=tuple(settle(k) for k in keys), **more)
