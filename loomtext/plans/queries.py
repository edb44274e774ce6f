"""One query for each of the engine's operators over the driver's tables; ``oracles`` has the SQL they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..config import EngineConfig
from ..functions import text as T
from ..operators import chunks as C, dedup as D, generate as G, pages as P, sections as S, validate as V
from ..settle import settle, stored, tidy
from ..sources import jsonl
from . import inputs as I

#: chunks of a size that the documents' paragraphs give several of
SMALL = EngineConfig(chunk_min_words=400, chunk_max_words=900, chunk_overlap_words=50)
ROUND = 6


def long(c: str | F.Column) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("bigint")


def word_count_by_book(spark: SparkSession, sf: str) -> DataFrame:
    d = I.plain_pages(spark, sf)
    return d.groupBy("book_id").agg(F.sum(T.count_words(F.col("text"))).alias("word_count"), F.count("*").alias("pages"))


def normalise_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    messy = F.concat(F.lit(" \t"), F.replace(F.col("text"), F.lit(" the "), F.lit(" \tthe\x0b ")), F.lit(" \n\n\n\n end\x07 "))
    return I.table(spark, sf, "documents").select("doc_id", F.md5(T.clean_whitespace(T.normalise_unicode(messy))).alias("clean_md5"))


def sanitise_backslashes(spark: SparkSession, sf: str) -> DataFrame:
    messy = F.replace(F.replace(F.col("text"), F.lit("a"), F.lit("\\a")), F.lit("n"), F.lit("\\n"))
    return I.table(spark, sf, "documents").select("doc_id", F.md5(T.sanitise_json_string(messy)).alias("clean_md5"))


def fingerprint_md5(spark: SparkSession, sf: str) -> DataFrame:
    return I.table(spark, sf, "documents").select("doc_id", T.fingerprint(F.col("text")).alias("fingerprint"))


def ascii_tokens_topk(spark: SparkSession, sf: str) -> DataFrame:
    d = I.table(spark, sf, "documents").select(F.explode(T.tokens(F.col("text"))).alias("token"))
    return d.groupBy("token").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "token").limit(100)


def noise_lines(spark: SparkSession, sf: str) -> DataFrame:
    d = P.page_lines(I.pages(spark, sf)).where(T.is_noise(F.col("line")))
    return d.groupBy("book_id").agg(F.count("*").alias("n_noise"))


def boundary_lines(spark: SparkSession, sf: str) -> DataFrame:
    d = P.boundary_lines(I.pages(spark, sf))
    return d.groupBy("book_id", F.col("line")).agg(F.count("*").alias("n")).where("n >= 3")


def recurring_headers(spark: SparkSession, sf: str) -> DataFrame:
    return P.recurring_lines(I.pages(spark, sf))


def headers_removed(spark: SparkSession, sf: str) -> DataFrame:
    return P.without_recurring(I.pages(spark, sf)).groupBy("book_id", "page_no").agg(F.count("*").alias("n_lines"))


def clean_pages(spark: SparkSession, sf: str) -> DataFrame:
    return P.clean_pages(I.pages(spark, sf)).select("book_id", "page_no", F.md5("text").alias("text_md5"))


def _books(spark: SparkSession, sf: str) -> DataFrame:
    return P.books(I.pages(spark, sf))


def _plain_books(spark: SparkSession, sf: str) -> DataFrame:
    return P.assemble(I.plain_pages(spark, sf).select("book_id", "page_no", "text"))


def assembled_books(spark: SparkSession, sf: str) -> DataFrame:
    return _books(spark, sf).select("book_id", F.md5("text").alias("text_md5"), long(F.length("text")).alias("n_chars"))


def headings(spark: SparkSession, sf: str) -> DataFrame:
    return S.headings(_books(spark, sf)).select("book_id", long("line_no").alias("line_no"), "heading", "section_type")


def heading_types(spark: SparkSession, sf: str) -> DataFrame:
    return S.headings(_books(spark, sf)).groupBy("section_type").agg(F.count("*").alias("n"))


def _section_digest(d: DataFrame) -> DataFrame:
    return d.select("book_id", long("section_index").alias("section_index"), "title", "section_type", "word_count", F.md5("body").alias("body_md5"))


def sections_by_heading(spark: SparkSession, sf: str) -> DataFrame:
    return _section_digest(S.by_headings(_books(spark, sf)))


def sections_by_paragraph(spark: SparkSession, sf: str) -> DataFrame:
    return _section_digest(S.by_paragraphs(_plain_books(spark, sf)))


def _mixed(spark: SparkSession, sf: str) -> DataFrame:
    """Books with a digit of 5 or more at the end of their name have headings, the others none."""
    headed = F.col("book_id").rlike("[5-9]$")
    return _books(spark, sf).where(headed).unionByName(_plain_books(spark, sf).where(~headed))


def section_strategy(spark: SparkSession, sf: str) -> DataFrame:
    d = S.sections(settle(_mixed(spark, sf)))
    return d.groupBy("book_id").agg(F.when(F.max("section_type") == "prose", "paragraphs").otherwise("headings").alias("strategy"), F.count("*").alias("n_sections"))


def sentence_split(spark: SparkSession, sf: str) -> DataFrame:
    d = I.table(spark, sf, "documents").select("doc_id", T.sentences(F.col("text")).alias("s"))
    return d.select("doc_id", long(F.size("s")).alias("n_sentences"), F.md5(F.array_join("s", "\n")).alias("sentences_md5"))


def _chunks(spark: SparkSession, sf: str, cfg: EngineConfig = SMALL) -> DataFrame:
    d = I.table(spark, sf, "documents").select(F.col("source").alias("book_id"), F.col("doc_id").alias("page_no"), "text")
    unclear = d.groupBy("book_id", "page_no").agg(F.count("*").alias("n")).where("n > 1 OR page_no IS NULL")
    return C.of_pages(d, cfg) if unclear.isEmpty() else C.chunks(S.by_paragraphs(_plain_books(spark, sf), cfg), cfg)


def chunks(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks(spark, sf).select("book_id", long("chunk_index").alias("chunk_index"), "source_section", "section_type", "word_count", F.md5("text").alias("text_md5"))


def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    return C.chunk_stats(_chunks(spark, sf))


#: two calls a chunk, whose slices go through all of its words
TWO_CALLS = EngineConfig(pairs_per_chunk=80, pairs_per_batch=40)


def batch_plan(spark: SparkSession, sf: str) -> DataFrame:
    d = G.batch_plan(_chunks(spark, sf), EngineConfig(pairs_per_chunk=50, pairs_per_batch=20))
    return d.select("book_id", long("chunk_index").alias("chunk_index"), long("batch_idx").alias("batch_idx"), long("num_pairs").alias("num_pairs"))


def run_estimate(spark: SparkSession, sf: str) -> DataFrame:
    d = G.run_estimate(_chunks(spark, sf), EngineConfig(pairs_per_batch=20, request_delay=12.0))
    return d.select("n_chunks", "calls", F.round("minutes", ROUND).alias("minutes"))


def _made(spark: SparkSession, sf: str, cfg: EngineConfig) -> tuple[DataFrame, DataFrame]:
    c = stored(_chunks(spark, sf))
    tidy(c)
    return c, G.produce(c, cfg, G.StubGenerator(per_batch=cfg.pairs_per_batch)).pairs


def prompts(spark: SparkSession, sf: str) -> DataFrame:
    """The prompts of a second call: what is left to make, and what the first has made to avoid."""
    c, made = _made(spark, sf, EngineConfig(pairs_per_chunk=20, pairs_per_batch=20))
    d = G.with_made(c, made)
    return d.select("book_id", long("chunk_index").alias("chunk_index"), F.md5(G.render_prompt(40 - F.col("n"), F.col("listed"))).alias("prompt_md5"))


def stub_pairs(spark: SparkSession, sf: str) -> DataFrame:
    _, d = _made(spark, sf, TWO_CALLS)
    return d.select("book_id", long("chunk_index").alias("chunk_index"), long("batch_idx").alias("batch_idx"), long("pos").alias("pos"), "instruction", "response")


def json_repair(spark: SparkSession, sf: str) -> DataFrame:
    line = F.col("value")
    raw = F.concat(F.lit("Here you are:\n```json\n["), line, F.when(F.col("line_no") % 2 == 0, ",]\n```").otherwise(""))
    d = I.json_lines(spark, sf).select("line_no", F.explode_outer(G.read_pairs(raw)).alias("p"))
    return d.select("line_no", "p.instruction", "p.response")


def resume_pending(spark: SparkSession, sf: str) -> DataFrame:
    c = settle(_chunks(spark, sf).select("book_id", "chunk_index", "word_count"))
    return G.pending(c, c.where("chunk_index % 3 = 0").select("book_id", "chunk_index")).select("book_id", long("chunk_index").alias("chunk_index"), "word_count")


def rejoined_hyphens(spark: SparkSession, sf: str) -> DataFrame:
    """The documents with a line's end put into some words."""
    broken = F.replace(F.col("text"), F.lit("th"), F.lit("t-\nh"))
    return I.table(spark, sf, "documents").select("doc_id", F.md5(T.rejoin_hyphens(broken)).alias("text_md5"))


def too_short_books(spark: SparkSession, sf: str) -> DataFrame:
    """Every document as a book."""
    return P.too_short(I.table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("book_id"), "text"))


def strict_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return jsonl.strict_pairs(I.json_lines(spark, sf))


def seen_keys(spark: SparkSession, sf: str) -> DataFrame:
    i, r = jsonl.seen_keys(I.json_lines(spark, sf))
    return i.select(F.lit("instruction").alias("kind"), F.md5("key").alias("key_md5")).union(r.select(F.lit("response"), F.md5("key")))


def line_count(spark: SparkSession, sf: str) -> DataFrame:
    return spark.createDataFrame([(jsonl.line_count(I.json_lines(spark, sf)),)], "n long")


def heading_rule(spark: SparkSession, sf: str) -> DataFrame:
    """Which of some lines are headings: heading words in all cases, alone and before each document's language."""
    words = F.explode(F.array(*(F.lit(x) for w in (*I.HEADINGS, "Actor", "Partly") for x in (w, w.upper(), w.lower()))))
    d = I.table(spark, sf, "documents").select("lang").distinct().select("lang", words.alias("word"))
    d = d.select(F.explode(F.array("word", F.concat_ws(" ", "word", "lang"), F.concat_ws(" ", "lang", "word"))).alias("line")).distinct()
    return d.select("line", T.is_heading(F.col("line")).alias("is_heading"), T.heading_type(F.col("line")).alias("section_type"))


def validate_reasons(spark: SparkSession, sf: str) -> DataFrame:
    d = V.checked(I.json_lines(spark, sf))
    return d.groupBy(F.coalesce("reason", F.lit("valid")).alias("reason")).agg(F.count("*").alias("n"))


def validated_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return V.validated(I.json_lines(spark, sf))


def validation_counts(spark: SparkSession, sf: str) -> DataFrame:
    return V.counts(I.json_lines(spark, sf))


def dedup_instruction(spark: SparkSession, sf: str) -> DataFrame:
    return D.by_instruction(I.pairs(spark, sf)).select("pair_id")


def dedup_response(spark: SparkSession, sf: str) -> DataFrame:
    return D.by_response(D.by_instruction(I.pairs(spark, sf))).select("pair_id")


def _good(spark: SparkSession, sf: str) -> DataFrame:
    return D.good_pairs(D.by_response(D.by_instruction(I.pairs(spark, sf))))


def quality_filtered(spark: SparkSession, sf: str) -> DataFrame:
    return _good(spark, sf).select("pair_id")


def idf_table(spark: SparkSession, sf: str) -> DataFrame:
    return D.idf(settle(_good(spark, sf))).select("term", "df", F.round("idf", ROUND).alias("idf"))


def tfidf_norms(spark: SparkSession, sf: str) -> DataFrame:
    return D.norms(settle(_good(spark, sf))).select("pair_id", F.round("norm", ROUND).alias("norm"))


def similar_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return D.similar_pairs(D.survivors(I.pairs(spark, sf))).select("a", "b", F.round("similarity", ROUND).alias("similarity"))


def near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return D.near_dedup(D.survivors(I.pairs(spark, sf))).select("pair_id")


def dedup_summary(spark: SparkSession, sf: str) -> DataFrame:
    return D.summary(I.pairs(spark, sf))


def part2_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """All conversation pairs, each again with blanks around and another response, and with another instruction to the same response,
    against all of the documents' pairs and every conversation's first."""
    c = I.conversation_pairs(spark, sf)
    again = c.select((F.col("pair_id") + 500).alias("pair_id"), F.concat(F.lit(" "), F.col("instruction"), F.lit("\n")).alias("instruction"), F.concat(F.col("response"), F.lit(" more")).alias("response"), "turn")
    other = c.select((F.col("pair_id") + 700).alias("pair_id"), F.concat(F.col("instruction"), F.lit(" too")).alias("instruction"), "response", "turn")
    seen = I.pairs(spark, sf).unionByName(c.where("turn = 0").drop("turn"))
    keys = [seen.select(T.match_key(F.col(k)).alias("key")).distinct() for k in ("instruction", "response")]
    return G.unseen(c.unionByName(again).unionByName(other), *keys).select("pair_id")


def chat_export(spark: SparkSession, sf: str) -> DataFrame:
    return jsonl.to_chat(I.conversation_pairs(spark, sf), "You are a helpful tutor.")


def curate_end_to_end(spark: SparkSession, sf: str) -> DataFrame:
    from .pipeline import curate

    return curate(I.json_lines(spark, sf)).select("pair_id", F.md5("instruction").alias("instruction_md5"), F.md5("response").alias("response_md5"))


NAMES = """word_count_by_book normalise_whitespace sanitise_backslashes fingerprint_md5 ascii_tokens_topk noise_lines boundary_lines
recurring_headers headers_removed clean_pages assembled_books headings heading_types sections_by_heading sections_by_paragraph
section_strategy sentence_split chunks chunk_stats batch_plan run_estimate prompts stub_pairs json_repair resume_pending
validate_reasons validated_pairs validation_counts dedup_instruction dedup_response quality_filtered idf_table tfidf_norms
similar_pairs near_dedup dedup_summary part2_filtered chat_export curate_end_to_end rejoined_hyphens too_short_books strict_pairs seen_keys
line_count heading_rule""".split()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in NAMES}
