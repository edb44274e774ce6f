"""Held-out accuracy, exact round trips, layout, the pipeline, and operators with clashing columns."""

import random
import sys

import pytest
from pyspark.sql import functions as F

from loomtext.llm import decontaminate, html_text, line_dedup, minhash, pieces, quality_rules, queries as Q, suffix_dedup, toxicity

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, label", [("op3_quality_classifier", "quality"), ("op7_toxicity", "toxic")])
def test_held_out_accuracy(spark, name, label):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", label)
    d = Q.queries()[name](spark, SF).join(labels, "doc_id").where("held_out")
    rows = d.select("predicted", label).collect()
    assert sum(r[0] == r[1] for r in rows) >= 0.93 * len(rows)


def test_quality_rules_keep_clean_documents(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "quality")
    rows = Q.op8_quality_rules(spark, SF).where("not base_failed").join(labels, "doc_id").select("kept", "quality").collect()
    assert sum(r.kept for r in rows if r.quality == 1) >= 0.97 * sum(r.quality == 1 for r in rows)
    assert sum(r.kept for r in rows if r.quality == 0) <= 0.1 * max(1, sum(r.quality == 0 for r in rows))


def test_pieces_round_trip_and_best_score():
    codec = pieces.Codec(pieces.load())
    rng = random.Random(1)
    for _ in range(500):
        t = "".join(rng.choice("abc ▁é\n\t\U0001f600\x00  ñ字.,") for _ in range(rng.randint(0, 14)))
        assert codec.decode(codec.encode(t)) == t
    table = {p: (s, i) for i, (p, s, kind) in enumerate(pieces.load()) if kind == "normal"}
    for word in ("reading", "unthinkable", "xyzzy"):
        s = "▁" + word
        best = [(0.0, [])] + [None] * len(s)
        for e in range(1, len(s) + 1):
            ways = [(best[b][0] + table[s[b:e]][0], best[b][1] + [table[s[b:e]][1]]) for b in range(e) if best[b] and s[b:e] in table]
            best[e] = max(ways, default=None)
        assert sum(table[pieces.load()[i][0]][0] for i in codec.encode(word)) == best[-1][0]


def test_pieces_best_score_of_whole_texts():
    """The segmentation's score is the best of all by a plain walk over every prefix; of pieces that tie the longest ends it."""
    model = pieces.load()
    codec = pieces.Codec(model)
    table = {p: (s, i) for i, (p, s, kind) in enumerate(model) if kind == "normal"}
    longest = max(map(len, table))
    rng = random.Random(12)
    words = ["reading", "a", "Über", "naïve", "x1,y2", "don't", "...", "http://a.b/c?d=e", "ﬁ", "12345", "the", "quick-brown", "(see)", "\u00a0"]
    for _ in range(60):
        t = "".join(rng.choice(words) + rng.choice([" ", " ", "", "  "]) for _ in range(rng.randrange(1, 12)))
        s = pieces.MARK + t.replace(" ", pieces.MARK)
        best = [(0.0, ())] + [None] * len(s)
        for e in range(1, len(s) + 1):
            for b in range(max(0, e - longest), e):  # from the longest piece on
                if best[b] and s[b:e] in table and (best[e] is None or best[b][0] + table[s[b:e]][0] > best[e][0]):
                    best[e] = best[b][0] + table[s[b:e]][0], (*best[b][1], table[s[b:e]][1])
            if best[e] is None or best[e][0] < pieces.BYTE_COST / 2:
                value = best[e - 1][0] + pieces.BYTE_COST * len(s[e - 1].encode())
                if best[e] is None or value > best[e][0]:
                    best[e] = value, (*best[e - 1][1], *(codec.byte[x] for x in s[e - 1].encode()))
        assert codec.encode(t) == list(best[-1][1]), t


def test_encode_then_decode(spark):
    docs = spark.createDataFrame([(1, "a b  c"), (2, None), (3, ""), (4, "▁ x")], "doc_id long, text string")
    model = pieces.load()
    assert {r.doc_id: r.piece_text for r in pieces.decode(pieces.encode(docs, model), model).collect()} == {1: "a b  c", 2: None, 3: "", 4: "▁ x"}


def test_html():
    text = html_text.render(
        "<html><head><title>t</title><style>.no{display:none} p{margin:0}</style></head><body><h1>Head &amp; tail</h1><p>One<p>Two <b>bold<br>line</b>"
        "<ul><li>a<li>b<ul><li>c</ul><li>d</ul><ol start=3><li>x<li>y</ol><table><tr><th>Name<th>Value<tr><td>alpha<td>1<tr><td rowspan=2>r<td>2<tr><td>3</table>"
        "<div class=no>gone</div><div hidden>gone</div><script>var t='</p>';</script><pre>\n a\n   b</pre><span style='visibility:hidden'>gone</span>end"
    )
    assert text == "Head & tail\n\nOne\n\nTwo bold\nline\n\n- a\n- b\n  - c\n- d\n\n3. x\n4. y\n\nName   Value\nalpha  1\nr      2\n       3\n\n a\n   b\n\nend"
    assert html_text.render("<div>" * 30000 + "x") == "x"
    for broken in ("", "<", "<a href='", "</p>", "<td>a<td>b", "<!-- x", "<script>x", "a<b", "&#0;&bogus;"):
        html_text.render(broken)


def test_folding_and_exceptions():
    assert toxicity.fold("1D10T! ѕtupіd $cum ido$$$") == " idiot stupid scum ido "
    a = toxicity.Model().automaton()
    assert [m[2] for m in toxicity.matches(toxicity.fold("trash can, trash"), a)] == [1.5]


def test_line_runs_across_partitions(spark):
    rows = [(k, "a line that everyone has in common\nown line of document %d here" % k) for k in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = {r.doc_id: r.line_dropped for r in line_dedup.dedup(docs).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == {k: int(k != 399) for k in range(400)}


def test_large_bucket_with_strays(spark):
    rng = random.Random(3)
    base = [f"w{k}" for k in range(120)]
    rows = []
    for k in range(60):
        w = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 3])):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    sys.path.insert(0, __file__.rsplit("/", 1)[0])
    import brute

    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted(tuple(r) for r in minhash.near_duplicates(docs, 85).collect()) == sorted(brute.op9(rows))


@pytest.mark.parametrize("cover", [suffix_dedup.CONTENT, suffix_dedup.RESIDUES])
def test_long_runs_and_many_occurrences(spark, cover):
    """Names with more rows than a task holds at once, dealt over several groups; whole copies; a text that repeats itself."""
    import brute

    rng = random.Random(4)
    passage = "".join(rng.choice("abcdef ") for _ in range(300))
    rows = [(k, "".join(rng.choice("ghij") for _ in range(50)) + passage[rng.randrange(60) :] + "tail%d" % k) for k in range(150)]
    rows += [(k + 1000, rows[k % 7][1]) for k in range(40)] + [(2000, "x" * 900), (2001, "xy" * 400), (2002, passage * 20), (2003, "é" * 120)]
    rng.shuffle(rows)
    got = suffix_dedup.dedup(spark.createDataFrame(rows, "doc_id long, text string"), cover, block=64, share=50, large=5).collect()
    assert sorted((r.doc_id, r.n_bytes, r.n_removed, len(r.removed), r.kept_sha256) for r in got) == sorted(brute.op2(rows))


def test_every_difference_has_a_cover_position():
    c = suffix_dedup.RESIDUES
    assert {(a - b) % c.modulus for a in c.residues for b in c.residues} == set(range(c.modulus))


def test_benchmark_in_blocks(spark):
    docs = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog today")], "doc_id long, text string")
    bench = spark.createDataFrame([(k, f"filler{k} words that are not there at all ok") for k in range(20)] + [(77, "quick brown fox jumps over the lazy dog")], "item_id long, text string")
    a = decontaminate.search(docs, bench, block_bytes=100, spans=True).first()
    b = decontaminate.search(docs, bench, spans=True).first()
    assert a == b and a.bench_items == ["77"] and a.bench_hits == 8 and a.bench_spans == [[1, 9]]


def test_operators_keep_other_columns(spark):
    docs = spark.createDataFrame([(1, "x y", "doc", 2.5, [1])], "doc_id long, text string, doc string, rep double, at array<int>")
    for out in (line_dedup.dedup(docs), minhash.keep_one(docs), decontaminate.search(docs, docs.select(F.col("doc_id").alias("item_id"), "text")), toxicity.score(docs, toxicity.Model())):
        assert set(docs.columns) <= set(out.columns) and out.count() == 1
    measured = quality_rules.measure(docs.withColumn("lang", F.lit("en")).withColumn("source", F.lit(None).cast("string")))
    assert quality_rules.judge(measured, quality_rules.thresholds(measured)).count() == 1


def test_pipeline(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    n = docs.count()
    for name, stage in C.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF).toPandas(), docs.schema)
        assert docs.columns == C.COLUMNS and 0.7 * n <= docs.count() <= n, name
    last = C.STAGES[-1][1](spark, docs, SF)
    assert last.where("round_trip").count() == docs.count()
