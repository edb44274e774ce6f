import json

from loomtext.config import EngineConfig
from loomtext.operators import chunks as C, dedup as D, generate as G, pages as P, sections as S, validate as V
from loomtext.plans import pipeline
from loomtext.settle import settle
from loomtext.sources import jsonl


def w(n, word="word"):
    return " ".join([word] * n)


def book(spark, text, name="b"):
    return spark.createDataFrame([(name, text)], "book_id string, text string")


def test_recurring_lines(spark):
    body = [f"this is line {k} of a page that has more than eight words in it" for k in range(6)]
    rows = [("b", k, "\n".join(["Head", *body] if k < 3 else body)) for k in range(10)] + [("s", 0, "one\ntwo\nthree")]
    found = {(r.book_id, r.line) for r in P.recurring_lines(spark.createDataFrame(rows, "book_id string, page_no int, text string")).collect()}
    assert found == {("b", "Head"), ("s", "one"), ("s", "two"), ("s", "three")}
    five = spark.createDataFrame([("b", 0, "a\nb\nc\nd\ne")], "book_id string, page_no int, text string")
    assert [r.line for r in P.recurring_lines(five).collect()] == ["c"]


def test_sections(spark):
    text = f"lost\nChapter 1\n{w(60)}\nChapter 2\n{w(40)}\nChapter 3\n{w(60)}"
    rows = S.sections(book(spark, text)).orderBy("section_index").collect()
    assert [(r.section_index, r.title, r.word_count) for r in rows] == [(0, "Chapter 1", 60), (1, "Chapter 3", 60)]
    few = S.sections(book(spark, f"Chapter 1\n{w(60)}\nChapter 2\n{w(40)}")).collect()
    assert [(r.title, r.section_type, r.word_count) for r in few] == [("Passage 1", "prose", 104)]
    runs = S.by_paragraphs(book(spark, "\n\n".join([w(900), w(900), w(900), w(100)]))).orderBy("section_index").collect()
    assert [(r.title, r.word_count) for r in runs] == [("Passage 1", 2700), ("Passage 2", 100)]


def packed(spark, *sections):
    rows = [("b", k, f"S{k}", "\n\n".join(w(n) for n in sizes), "prose", sum(sizes)) for k, sizes in enumerate(sections)]
    cfg = EngineConfig(chunk_min_words=60, chunk_max_words=100, chunk_overlap_words=10)
    d = C.chunks(spark.createDataFrame(rows, "book_id string, section_index int, title string, body string, section_type string, word_count long"), cfg)
    return [r.word_count for r in d.orderBy("chunk_index").collect()]


def test_chunks(spark):
    assert packed(spark, (40, 40, 40, 30), (30, 30)) == [80, 70, 71]
    assert packed(spark, (50, 90)) == [140]
    assert packed(spark, (80, 30)) == [80]
    assert packed(spark, (40,), (60,)) == [60]
    assert packed(spark, (60,), (40,)) == [60, 51]


def test_prompt_is_not_filled_twice(spark):
    from pyspark.sql import functions as F

    d = spark.createDataFrame([("T", "prose", "about {num_pairs} {chunk_text}")], "source_section string, section_type string, text string")
    assert "about {num_pairs} {chunk_text}" in d.select(G.render_prompt(F.lit(3))).first()[0]


def test_validation(spark):
    long = w(20)
    values = ['{"instruction":"i","response":"%s"}' % long, "", "{} trailing", '{"instruction":"i"}{"response":"x"}', "{'instruction':'i'}", "[1]", "nope",
              '{"instruction":"a\\q","response":"%s"}' % long, '{"instruction":" ","response":"x"}', '{"instruction":"i","response":null}', '{"instruction":"i","response":"%s"}' % w(19),
              '{"instruction":"Q: what","response":"%s"}' % long, '{"instruction":"i","response":"Assistant : %s"}' % long, '{"instruction":"A study in scarlet","response":"%s"}' % long,
              '{"instruction":"%s","response":"%s"}' % (long.upper(), long), '{"instruction":"x","instruction":"y","response":"%s","more":1}' % long,
              '{"instruction":"i"}}x{', '{"instruction":"i"},"response":{"a":1}', '{"instruction":"i"}] x [', '{"instruction":"i"},{"response":"r"}', '{"instruction":{"a":{"b":[1,2]}},"response":"r"}']
    lines = spark.createDataFrame(list(enumerate(values)), "line_no long, value string")
    rows = {r.line_no: r for r in V.checked(lines).collect()}
    assert {k: r.reason for k, r in rows.items()} == {
        0: None, 7: None, 8: "empty instruction", 9: "empty response", 10: "response too short (19 words)", 11: "instruction has conversation prefix",
        12: "response has conversation prefix", 13: None, 14: "instruction equals response", 15: None, 20: "response too short (1 words)",
    }
    assert rows[15].instruction == "y"
    assert tuple(V.counts(lines).first()) == (21, 4)


def pairs(spark, *rows):
    return spark.createDataFrame([(k, i, r) for k, (i, r) in enumerate(rows)], "pair_id long, instruction string, response string")


def test_exact_dedup(spark):
    d = pairs(spark, ("i1", "r1"), ("I1 ", "r2"), ("i2", "r2"))
    assert sorted(r.pair_id for r in D.by_response(D.by_instruction(d)).collect()) == [0, 2]


def test_low_quality(spark):
    ten, eight = w(10, "abcdefgh"), w(8, "abcdefgh")
    d = pairs(spark, (ten, ten + " x"), (eight, eight + " x"), ("q", "too short"))
    assert sorted(r.pair_id for r in D.good_pairs(d, 3).collect()) == [1]


A = "alpha bravo charlie delta echo foxtrot golf hotel india juliet kilo lima mike november oscar papa quebec romeo sierra tango"


def test_near_dedup_is_greedy(spark):
    b = A.replace("tango", "xray")
    c = b.replace("alpha ", "") + " yankee"
    d = pairs(spark, (A, w(20, "x")), (b, w(20, "y")), (c, w(20, "z")))
    assert sorted(r.pair_id for r in D.near_dedup(d).collect()) == [0, 2]


def test_unseen_is_greedy(spark):
    empty = spark.createDataFrame([], "key string")
    d = pairs(spark, ("i1", "r1"), ("i2", "r1"), ("i2", "r3"))
    assert sorted(r.pair_id for r in G.unseen(d, empty, empty).collect()) == [0, 2]
    seen = spark.createDataFrame([("i1",)], "key string")
    assert sorted(r.pair_id for r in G.unseen(d, seen, empty).collect()) == [1]


def test_pacing_and_retries():
    now, waits = [0.0], []

    def sleep(s):
        waits.append(s)
        now[0] += s

    answers = iter([ValueError(), G.QuotaExhausted(3), "ok", G.QuotaExhausted(500)])

    def send(_):
        x = next(answers)
        if isinstance(x, Exception):
            raise x
        return x

    g = G.Paced(send, delay=1.0, backoff=2.0, clock=lambda: now[0], sleep=sleep)
    assert g("", {}, 1, 0) == "ok" and waits == [2.0, 5.0]
    assert g("", {}, 1, 0) is None
    assert G.healthy(G.StubGenerator())


def test_pipeline_end_to_end(spark, tmp_path):
    text = "\n".join(f"Line {k} tells of item{k} and thing{k} and place{k} with many a word{k} more." for k in range(120))
    pages = spark.createDataFrame([("b", k, f"Chapter {k + 1}\n{text.replace('item', f'item{k}x')}") for k in range(3)], "book_id string, page_no int, text string")
    cfg = EngineConfig(pairs_per_chunk=4, pairs_per_batch=2, chunk_min_words=100, chunk_max_words=3000)
    out = str(tmp_path / "out")
    result = pipeline.run(spark, pages, out, cfg)
    assert result.counts["sections"] == 3 and 0 < result.counts["final"] <= result.counts["valid"] <= result.counts["generated"]
    assert jsonl.line_count(jsonl.read_lines(spark, out + "/final")) == result.counts["final"]
    again = pipeline.curate(jsonl.read_lines(spark, out + "/final"), cfg)
    assert again.count() == result.counts["final"]


def test_chat_and_config(spark):
    d = pairs(spark, ("q é", "a"))
    assert [m["role"] for m in json.loads(jsonl.to_chat(d, "s").first().value)["messages"]] == ["system", "user", "assistant"]
    cfg = EngineConfig.from_env({"GROQ_API_KEY": "k", "OPENAI_API_KEY": "o", "CHUNK_MIN_WORDS": "5"})
    assert (cfg.provider, cfg.pairs_per_batch, cfg.request_delay, cfg.chunk_min_words) == ("groq", 20, 12.0, 5)


def test_streaming_append(spark, tmp_path):
    from loomtext.streaming.append import append_pairs

    src = tmp_path / "in"
    src.mkdir()
    (src / "a.jsonl").write_text(json.dumps({"instruction": "i1", "response": w(20, "a")}) + "\n")
    q = append_pairs(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    q.awaitTermination()
    (src / "b.jsonl").write_text("\n".join(json.dumps({"instruction": i, "response": w(20, r)}) for i, r in (("I1", "z"), ("i2", "b"))))
    q = append_pairs(spark, str(src), str(tmp_path / "out"), str(tmp_path / "cp"), once=True)
    q.awaitTermination()
    assert sorted(r.instruction for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["i1", "i2"]
    # another stream into the same table: its first batch replaces nothing and repeats nothing
    (src / "c.jsonl").write_text(json.dumps({"instruction": "i3", "response": w(20, "c")}) + "\n")
    append_pairs(spark, str(src), str(tmp_path / "out"), str(tmp_path / "other"), once=True).awaitTermination()
    assert sorted(r.instruction for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["i1", "i2", "i3"]


def test_candidates_of_the_near_pass(spark):
    """Rows that share a rare term or two are no candidates; all similar pairs are, and their similarity is that of whole vectors."""
    import random
    from collections import Counter
    from math import log

    rng = random.Random(5)
    letters = lambda: "".join(rng.choice("abcdefgh") for _ in range(5))
    texts = [" ".join(["rare", *(letters() for _ in range(rng.choice([12, 30])))]) for _ in range(60)]
    for t in texts[:15]:
        ts = t.split()
        texts += [" ".join(x if rng.random() < 0.9 else letters() for x in ts), f"{t} {ts[1]} {ts[2]}", " ".join(ts[: len(ts) * 5 // 6])]
    texts += ["solo", "solo solo pair", "1 2 3"]
    d = settle(spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "pair_id long, instruction string"))
    counts = [Counter(x for x in t.split() if x.isalpha()) for t in texts]
    df = Counter(x for c in counts for x in c)
    vectors = [{x: n * (log(len(texts) / (df[x] + 1)) + 1) for x, n in c.items()} for c in counts]
    norms = [sum(x * x for x in v.values()) ** 0.5 for v in vectors]
    every = {(a, b): sum(x * vectors[b].get(k, 0) for k, x in vectors[a].items()) / (norms[a] * norms[b]) for b in range(len(texts)) for a in range(b) if norms[a] and norms[b]}
    unit = D.unit_vectors(d)
    for threshold in (0.85, 0.5):
        want = {p: s for p, s in every.items() if s >= threshold}
        got = {(r.a, r.b): r.similarity for r in D.similar_pairs(d, threshold).collect()}
        assert got.keys() == want.keys() and want and all(abs(got[p] - want[p]) < 1e-9 for p in want)
    found = {(r.a, r.b) for r in D._candidates(unit, 0.85).collect()}
    assert {p for p, s in every.items() if s >= 0.85} <= found and not any(every[p] < 0.5 for p in found)


def test_passes_go_by_rows(spark):
    """Of rows that share an id each is judged by itself, and only ids and instructions go on to the near pass."""
    d = spark.createDataFrame([(0, A, w(20, "x")), (1, "another", w(20, "y")), (1, "more", "short"), (2, A + " x", w(20, "z")), (3, None, w(20)), (4, "q", None)], "pair_id long, instruction string, response string")
    assert sorted((r.pair_id, r.instruction) for r in D.deduplicate(d).collect() if r.pair_id < 3) == [(0, A), (1, "another")]
    assert all(x.columns == ["pair_id", "instruction"] for x in D.stages(d).values())
    assert {r.stage: r.n for r in D.summary(d).collect()}["input"] == 6
