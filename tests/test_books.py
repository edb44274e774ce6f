"""Books cut into chunks, against the SQL, and page by page against the walk over whole books."""

import random

import duckdb

from loomtext.config import EngineConfig
from loomtext.operators import chunks as C, pages as P, sections as S
from loomtext.plans import oracles, queries as Q

COLUMNS = ["book_id", "chunk_index", "source_section", "section_type", "text", "word_count"]


def w(n, word="word"):
    return " ".join([word] * n)


def against_sql(spark, tmp_path, rows, *names):
    """Each query over documents of these (doc_id, source, text) equals its SQL."""
    docs = [(i, text, "en", source, len(text or "")) for i, source, text in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    for name in names:
        got = getattr(Q, name)(spark, str(tmp_path))
        want = con.sql(oracles.ORACLES[name])
        assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(want.fetchall()), name
        assert want.fetchall()




def test_words_of_a_short_last_chunk_are_one_blank_apart(spark, tmp_path):
    """A section of 1050, 900, 20 and 30 words: its last chunk has just the 50 words that the next section begins with."""
    rows = [(1, "b", w(1050, "long")), (2, "b", w(900, "more")), (3, "b", w(20, "few") + "\n\n" + w(15, "and") + "\n" + w(15, "last")), (4, "b", w(300, "next"))]
    against_sql(spark, tmp_path, rows, "chunks", "prompts")


def test_brackets_and_fences_in_a_chunk_lose_no_pairs(spark, tmp_path):
    """Calls' answers hold the chunk's text; what looks like an answer's structure there ends no answer."""
    odd = [w(30) + " a] " + w(200), w(30) + " [b " + w(200) + "\n\nc]] " + w(300), w(30) + " ```python " + w(200) + " ```" * 6 + " " + w(300), w(30) + ' {"d": 1,} ,] \\ "e" ' + w(200)]
    against_sql(spark, tmp_path, [(k, f"b{k}", text) for k, text in enumerate(odd)], "chunks", "prompts", "stub_pairs")


def test_prompts_of_a_book_without_a_name(spark, tmp_path):
    """The second prompt counts and lists the first call's pairs there too; prompts don't hold the book's name."""
    docs = [(k, w(500), "en", source, 0) for k, source in enumerate([None, "b"])]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    got = Q.prompts(spark, str(tmp_path)).collect()
    assert {r.book_id for r in got} == {None, "b"} and len(got) == 2 and len({r.prompt_md5 for r in got}) == 1


def test_pages_are_cut_as_books_are(spark, tmp_path):
    """Chunks of pages against those of whole books: sections and chunks over pages, tails of tails, dropped leftovers, long
    paragraphs of sentences, pages without text, several books."""
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abc") for _ in range(3))
    rows = []
    for k in range(260):
        sizes = [rng.choice([1, 3, 10, 40]) for _ in range(rng.randrange(6))]
        ps = [" ".join(word().capitalize() + rng.choice(["", ".", " \n"]) for _ in range(n)) for n in sizes]
        rows.append((f"b{k % 3}" if k % 9 else None, k, rng.choice(["\n\n", " \n \n\n\t"]).join(ps) if k % 13 else None))
    pages = spark.createDataFrame(rows, "book_id string, page_no long, text string").repartition(5)
    for cfg in (EngineConfig(chunk_min_words=20, chunk_max_words=32, chunk_overlap_words=5, passage_words=70, leftover_words=5), EngineConfig(chunk_min_words=30, chunk_max_words=60, chunk_overlap_words=25, passage_words=31, leftover_words=6), EngineConfig(chunk_min_words=10, chunk_max_words=12, chunk_overlap_words=0, passage_words=40, leftover_words=11)):
        want = {tuple(r) for r in C.chunks(S.by_paragraphs(P.assemble(pages), cfg), cfg).select(*COLUMNS).collect()}
        got = [tuple(r) for r in C.of_pages(pages, cfg).select(*COLUMNS).collect()]
        assert len(got) == len(want) > 60 and set(got) == want


def test_no_task_holds_a_book(spark, tmp_path):
    """A book is not one group of rows any more, and repeated ids are still taken."""
    rows = [(k, "b", w(300, f"w{k}") + "\n\n" + w(200, "more")) for k in range(30)]
    against_sql(spark, tmp_path / "one", rows, "chunk_stats", "stub_pairs")
    assert "FlatMapGroupsInArrow" not in Q.chunk_stats(spark, str(tmp_path / "one"))._jdf.queryExecution().toString()
    against_sql(spark, tmp_path / "two", [*rows, (3, "b", rows[3][2])], "chunk_stats")
