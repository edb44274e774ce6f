"""Order of lines, generation in rounds and groups, resuming, the second pass, settings."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle

from loomtext import __main__ as cli
from loomtext.config import EngineConfig, env_file
from loomtext.functions import jsonrepair
from loomtext.operators import generate as G, validate as V
from loomtext.plans import pipeline
from loomtext.settle import settle
from loomtext.sources import jsonl

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers can't import this module
CHUNKS = "book_id string, chunk_index int, source_section string, section_type string, text string"


def w(n, word="word"):
    return " ".join([word] * n)


def test_lines_keep_the_order_of_files_and_lines(spark, tmp_path):
    """Files of unlike sizes, one of them read in pieces."""
    sizes = [3, 20000, 1, 500, 0, 7]
    want = []
    for k, n in enumerate(sizes):
        rows = [f"{k}-{i}-{'x' * (i % 7)}" for i in range(n)]
        want += rows
        (tmp_path / f"part-{k:05d}.txt").write_text("".join(r + "\n" for r in rows))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "30000")
    try:
        got = jsonl.read_lines(spark, str(tmp_path)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert len({r.line_no for r in got}) == len(got)
    assert [r.value for r in sorted(got, key=lambda r: r.line_no)] == want


def pages(spark, n=3):
    text = "\n".join(f"Line {k} tells of item{k} and thing{k} and place{k} with many a word{k} more." for k in range(120))
    return spark.createDataFrame([("b", k, f"Chapter {k + 1}\n{text.replace('item', f'item{k}x')}") for k in range(n)], "book_id string, page_no int, text string")


SMALL = EngineConfig(pairs_per_chunk=4, pairs_per_batch=2, chunk_min_words=100, chunk_max_words=3000)


def test_run_does_not_depend_on_partitions(spark, tmp_path):
    got = []
    for n in (1, 7):
        spark.conf.set("spark.sql.shuffle.partitions", str(n))
        try:
            pipeline.run(spark, pages(spark), str(tmp_path / str(n)), SMALL)
            rows = jsonl.read_lines(spark, str(tmp_path / str(n) / "final")).orderBy("line_no").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
        got.append([r.value for r in rows])
    assert got[0] == got[1] and got[0]


class Failing(G.StubGenerator):
    """Breaks off at a chunk until a file is there; notes its calls in a folder."""

    def __init__(self, folder, at):
        super().__init__(per_batch=2)
        self.folder, self.at = folder, at

    def __call__(self, prompt, chunk, num_pairs, batch_idx):
        if chunk["chunk_index"] == self.at and not os.path.exists(f"{self.folder}/go"):
            raise RuntimeError("broken off")
        with open(f"{self.folder}/calls", "a") as f:
            f.write(f"{chunk['chunk_index']}-{batch_idx}\n")
        return super().__call__(prompt, chunk, num_pairs, batch_idx)


def test_resume_repeats_no_call(spark, tmp_path):
    out, calls = str(tmp_path / "out"), str(tmp_path)
    cfg = EngineConfig(**{**SMALL.__dict__, "save_every": 1})
    gen = Failing(calls, 2)
    with pytest.raises(Exception, match="broken off"):
        pipeline.run(spark, pages(spark), out, cfg, generator=gen)
    done = {(r.book_id, r.chunk_index) for r in jsonl.read_completed(spark, f"{out}/completed").collect()}
    assert done == {("b", 0), ("b", 1)}
    open(f"{calls}/go", "w").close()
    result = pipeline.run(spark, pages(spark), out, cfg, resume=True, generator=gen)
    lines = open(f"{calls}/calls").read().split()
    assert sorted(lines) == ["0-0", "0-1", "1-0", "1-1", "2-0", "2-1"]
    assert result.counts["calls"] == 2 and result.counts["generated"] == 12
    assert not os.path.exists(f"{out}/completed")  # all are done
    whole = pipeline.run(spark, pages(spark), str(tmp_path / "whole"), SMALL)
    assert sorted(tuple(r)[1:] for r in whole.pairs.collect()) == sorted(tuple(r)[1:] for r in result.pairs.collect())


class Scripted:
    """Answers by batch, and keeps the prompts in a folder."""

    def __init__(self, folder, *answers):
        self.folder, self.answers = folder, answers

    def __call__(self, prompt, chunk, num_pairs, batch_idx):
        with open(f"{self.folder}/prompt{batch_idx}", "w") as f:
            f.write(f"{num_pairs}\n{prompt}")
        return self.answers[batch_idx]


def answer(*pairs):
    return json.dumps([{"instruction": i, "response": r} for i, r in pairs])


def test_rounds_make_up_for_rejects(spark, tmp_path):
    chunks = settle(spark.createDataFrame([("b", 0, "S {x}", "prose", "some {num_pairs} text")], CHUNKS))
    good = [(f"q{k}", w(20, f"r{k}")) for k in range(6)]
    gen = Scripted(str(tmp_path), answer(good[0], ("short", "no"), ("Q: x", w(20)), ("Q0 ", w(20))), answer(good[0], good[1], good[2]), answer(good[3], good[4]))
    made = G.produce(chunks, EngineConfig(pairs_per_chunk=5, pairs_per_batch=2), gen, template="{{{num_pairs}}} {source_section} {chunk_text} {other}")
    assert sorted(r.instruction for r in made.pairs.collect()) == ["q0", "q1", "q2", "q3", "q4"]
    assert (made.calls, made.failed, made.finished.count()) == (3, 0, 1)
    read = lambda k: open(f"{tmp_path}/prompt{k}").read()
    assert read(0) == "2\n{2} S {x} some {num_pairs} text {other}"
    assert read(1) == "2\n{2} S {x} some {num_pairs} text {other}" + G.AVOID + "- q0"
    assert read(2) == "2\n{2} S {x} some {num_pairs} text {other}" + G.AVOID + "- q0\n- q1\n- q2"


def test_failed_calls_leave_a_chunk_unfinished(spark):
    chunks = settle(spark.createDataFrame([("b", 0, "S", "prose", w(200)), ("b", 1, "S", "prose", w(200))], CHUNKS))

    def gen(prompt, chunk, num_pairs, batch_idx):
        return None if chunk["chunk_index"] else answer(("q", w(20)))

    made = G.produce(chunks, EngineConfig(pairs_per_chunk=2, pairs_per_batch=1), gen)
    assert [r.chunk_index for r in made.finished.collect()] == [0] and made.failed == 2 and made.pairs.count() == 1


def test_second_pass(spark, tmp_path):
    """Pairs that the first pass has are left out, whatever their case, and prompts list its instructions."""
    first = pipeline.run(spark, pages(spark), str(tmp_path / "one"), SMALL)
    assert first.counts["too_short"] == 0 and first.counts["words"] > first.counts["words_outside_sections"] > 0
    old = first.pairs.first()
    gen = Scripted(str(tmp_path), answer((old.instruction.upper(), w(20, "z")), ("new one", old.response), ("new two", w(20, "y"))), answer(("new two", w(20, "x")), ("new three", w(20, "v"))))
    again = pipeline.second_pass(spark, pages(spark), [str(tmp_path / "one" / "final")], str(tmp_path / "two"), SMALL, generator=gen)
    assert sorted(r.instruction for r in again.pairs.collect()) == ["new three", "new two"]
    prompt = open(f"{tmp_path}/prompt0").read()
    assert G.AVOID_EARLIER in prompt and prompt.count("\n- what does part") == min(15, first.counts["final"])


def test_cli(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.chdir(tmp_path)
    (tmp_path / ".env").write_text("# settings\nexport PAIRS_PER_CHUNK=2\nPAIRS_PER_BATCH = '2'\nCHUNK_MIN_WORDS=\"100\"  # words\nLOG_LEVEL=ERROR\n")
    assert env_file() == {"PAIRS_PER_CHUNK": "2", "PAIRS_PER_BATCH": "2", "CHUNK_MIN_WORDS": "100", "LOG_LEVEL": "ERROR"}
    for v in ("GROQ_API_KEY", "OPENAI_API_KEY"):
        monkeypatch.delenv(v, raising=False)
    d = pages(spark).unionByName(spark.createDataFrame([("tiny", 0, "few words")], "book_id string, page_no int, text string"))
    d.write.parquet(str(tmp_path / "pages"))
    at = lambda name: str(tmp_path / name)
    (tmp_path / "p.txt").write_text("{num_pairs} of {chunk_text}")
    assert cli.main(["run", at("pages"), at("one"), "--prompt", "p.txt", "--probe"]) == 0
    said = capsys.readouterr().out.strip().splitlines()
    assert "left out: tiny has 0 words" in said and json.loads(said[-1])["generated"] == 6 and json.loads(said[-1])["seconds"] > 0
    assert cli.main(["more", at("pages"), at("one/working"), at("two")]) == 1  # the stub has nothing new to say
    assert cli.main(["curate", at("one/final"), at("three")]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == {"final": 1}
    with pytest.raises(FileNotFoundError):
        cli.main(["run", at("pages"), at("one"), "--prompt", "none.txt"])


def test_values_that_are_no_strings(spark):
    long = w(20)
    values = ['{"instruction": true, "response": "%s"}' % long, '{"instruction": ["a", 1.0, null], "response": "%s"}' % long, '{"instruction": {"a": false}, "response": "%s"}' % long, '{"instruction": 1e5, "response": "%s"}' % long,
              '{"instruction": "true", "response": "[x] %s"}' % long, '{"instruction": null, "response": "%s"}' % long, '{"instruction": 7, "response": "a\\q %s"}' % long]
    lines = spark.createDataFrame(list(enumerate(values)), "line_no long, value string")
    got = [r.instruction for r in V.checked(lines).orderBy("line_no").collect()]
    assert got == ["True", "['a', 1.0, None]", "{'a': False}", "100000.0", "true", "", "7"]


def test_flat_objects_come_from_the_text_as_it_is():
    raw = '[{"instruction": "a, } b", "response": "r"}, {"instruction": "x", "response": "[1,]"}, oops'
    assert jsonrepair.pairs(raw) == [{"instruction": "x", "response": "[1,]"}]
    assert jsonrepair.pairs('[{"a": 1,}, {"b": "c"},]') == [{"a": 1}, {"b": "c"}]


def test_seen_keys_of_files(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"instruction": " A ", "response": "B"}\nnot json\n\n{"response": 1}\n{"instruction": "a"}')
    i, r = jsonl.seen_keys(jsonl.read_lines(spark, str(tmp_path)))
    assert sorted(x.key for x in i.collect()) == ["", "a"] and sorted(x.key for x in r.collect()) == ["", "1", "b"]
    strict = jsonl.strict_pairs(jsonl.read_lines(spark, str(tmp_path))).collect()
    assert [(x.instruction, x.response) for x in strict] == [(" A ", "B")]
