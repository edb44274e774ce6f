"""The pipeline's stages on odd rows, columns with clashing names, learned cutoffs by brute force, secrets, exceptions."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from loomtext.llm import decontaminate, html_text, line_dedup, minhash, pieces, pii, quality_classifier, quality_rules as R, toxicity


def passage(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))


def test_stages_on_odd_rows(spark, tmp_path):
    import corpus_pipeline as C

    rng = random.Random(8)
    item, short = passage(rng, 20), "just three words"
    spark.createDataFrame([(1, item), (2, short), (3, None), (None, passage(rng, 9))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    plain = [passage(rng, 90) for _ in range(12)]
    line = "this very line stands in many of the documents"
    leak = f"{passage(rng, 60)} {' '.join(item.split()[5:14])} {passage(rng, 30)}"
    near = plain[0].split()
    near[40] = "changed"
    rows = [(k, t) for k, t in enumerate(plain)] + [(20, " ".join(near)), (21, plain[1]), (22, leak), (23, f"{plain[2]} {short} {passage(rng, 80)}"), (3, plain[3]), (3, passage(rng, 70))]
    rows += [(30 + k, f"{passage(rng, 80)}\n{line}\n{passage(rng, 5)}") for k in range(3)] + [(40, None), (41, ""), (42, " \n"), (None, passage(rng, 80)), (50, passage(rng, 20000)), (51, "one two " * 60)]
    docs = spark.createDataFrame([(d, t, "en" if d else None, "s", None if t is None else len(t), "x", 1) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long, q_kept string, line_doc int")
    ids = lambda d: sorted((r.doc_id for r in d.collect()), key=str)
    one = C.quality_stage(spark, docs, str(tmp_path)).cache()
    assert one.columns == C.COLUMNS and ids(one) == sorted([d for d, _ in rows if d not in (40, 41, 42, 51)], key=str)
    two = C.line_stage(spark, one, str(tmp_path)).cache()
    got = {r.doc_id: r for r in two.collect() if r.doc_id in (30, 31, 32)}
    assert [line in got[k].text for k in (30, 31, 32)] == [False, False, True] and all(r.n_chars == len(r.text) for r in got.values())
    three = C.near_stage(spark, two, str(tmp_path)).cache()
    assert ids(three) == sorted([x for x in ids(two) if x not in (20, 21, 3)] + [3, 3], key=str)  # of the rows of 3, two are alike
    four = C.benchmark_stage(spark, three, str(tmp_path)).cache()
    assert ids(four) == [x for x in ids(three) if x != 22]
    five = C.pieces_stage(spark, four, str(tmp_path)).collect()
    assert len(five) == len(ids(four)) and all(r.round_trip and r.n_pieces == len(r.piece_ids) for r in five)
    # each stage by itself on rows that the first would have dropped, and on nothing
    for name, stage in C.STAGES:
        assert stage(spark, docs.limit(0), str(tmp_path)).count() == 0, name
        if name != "quality_rules":
            assert stage(spark, docs.where("doc_id IN (40, 41)"), str(tmp_path)).count() == 2, name


CLASHING = "line_doc line_fp line_keep line_own line_n toxic_score toxic_matches piece_ids piece_text bench_items bench_hits bench_own bench_key pii_email pii_email_m pii_iban_a m_email q_w q_words q_kept q_p cut_low_length t_lang k nd_doc nd_kept nd_own quality_x quality_score html_text n rows key node".split()


def test_clashing_columns(spark):
    """Columns that are called as an operator's own results are replaced, all others stay as they are."""
    base = {"doc_id": 1, "text": "mail a@b.co " + "word " * 60, "html": "<p>x", "lang": "en", "source": "s", "quality": 1}
    docs = spark.createDataFrame([tuple([*base.values(), *range(len(CLASHING))])], ", ".join(f"{c} {'long' if isinstance(v, int) else 'string'}" for c, v in base.items()) + ", " + ", ".join(f"{c} int" for c in CLASHING))
    bench = spark.createDataFrame([(1, "nothing"), (2, "like it")], "item_id long, text string")
    model = pieces.load()
    measured = R.measure(docs)
    for out, own in (
        (line_dedup.dedup(docs), {"line_n", "line_dropped"}),
        (minhash.keep_one(docs), set()),
        (decontaminate.search(docs, bench, spans=True), {"bench_words", "bench_hits", "bench_items", "bench_spans"}),
        (decontaminate.search(docs, bench, block_bytes=1), {"bench_words", "bench_hits", "bench_items"}),
        (decontaminate.clean(docs, bench), set()),
        (toxicity.score(docs, toxicity.Model()), {"toxic_score", "toxic_matches"}),
        (pieces.encode_and_decode(docs, model), {"piece_ids", "piece_text"}),
        (html_text.extract(docs).withColumn("html", F.lit("<p>x")), {"html_text"}),
        (pii.find(docs), {f"pii_{k.name}" for k in pii.KINDS}),
        (pii.redact(docs), set()),
        (R.judge(measured, R.thresholds(measured)), {c for c in measured.columns if c.startswith("q_") and c not in ("q_w", "q_p")} | {"q_kept"}),
        (quality_classifier.score(quality_classifier.featurise(docs).withColumn("text", F.lit(base["text"])), None), {"quality_x", "quality_score"}),
    ):
        row = out.first().asDict()
        kept = [c for c in docs.columns if c not in own]
        assert {c: row[c] for c in kept if c != "text"} == {c: v for c, v in docs.first().asDict().items() if c in kept and c != "text"}
        assert own - {"quality_x"} <= set(row) and len(row) == len(out.columns)


def test_cutoffs_by_brute_force(spark):
    """Quartiles of few enough rows are exact in a sketch."""
    rng = random.Random(9)
    rows = []
    for g, (source, n) in enumerate([("a", 50), ("b", 45), ("c", 40), ("d", 35), ("e", 8)]):
        for i in range(n):
            w = passage(rng, 60 + 7 * g).split()
            for k in range(0, len(w), rng.choice([2, 9, 40, 1000])):
                w[k] = rng.choice(["#", "$", "ABC", w[k], w[k] * 3])
            if rng.random() < 0.3:
                w += w[:12] * rng.randrange(3)
            text = "\n".join(" ".join(w[j : j + 15]) for j in range(0, len(w), 15))
            rows.append((len(rows), text + ("\n" + text.split("\n")[0]) * rng.choice([0, 0, 1, 3]), "en", source))
    measured = R.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).cache()
    data = [r.asDict() for r in measured.collect()]
    at = lambda x, q: sorted(x)[max(math.ceil(q * len(x)) - 1, 0)]

    def fences(part):
        part = [r for r in part if not r["q_base_failed"]]
        out = {}
        for name, spread, unit, takes, least, most in R.SIGNALS:
            x = [r[f"q_{name}"] for r in part]
            m = at(x, 0.5)
            out[name] = min(m + max(least, spread * max(at(x, 0.75) - m, takes / max(at([r[f"q_{unit}"] for r in part], 0.5), 1))), most or math.inf)
        x = [r[f"q_{R.LENGTH}"] for r in part]
        m = at(x, 0.5)
        out["low_length"], out["high_length"] = m - R.LENGTH_SPREAD * max(m - at(x, 0.25), 0.02 * m), m + R.LENGTH_SPREAD * max(at(x, 0.75) - m, 0.02 * m)
        return out, len(part)

    groups = {s: fences([r for r in data if r["source"] == s]) for s in "abcde"}
    lang = fences(data)[0]
    want = {}
    for s, (own, n) in groups.items():
        cut = dict(own if n >= 30 else lang)
        for c in cut:
            typical = statistics.median(f[c] for f, k in groups.values() if k >= R.VOTES)
            cut[c] = max(cut[c], typical / R.LENGTH_SLACK) if c == "low_length" else min(cut[c], typical * (R.LENGTH_SLACK if c == "high_length" else R.SLACK))
        want[s] = cut
    cuts = R.thresholds(measured, min_group=30)
    got = {r.t_source: {c: r[f"cut_{c}"] for c in R.CUTS} for r in cuts.collect()}
    for s in want:
        assert got[s] == pytest.approx(want[s]), s
    assert len({tuple(v.values()) for v in got.values()}) >= 4  # groups differ
    kept = {r.doc_id: r.q_kept for r in R.judge(measured, cuts).collect()}
    for r in data:
        cut = want[r["source"]]
        fine = not r["q_base_failed"] and all(r[f"q_{x[0]}"] <= cut[x[0]] + 1e-12 for x in R.SIGNALS) and cut["low_length"] - 1e-12 <= r["q_word_length"] <= cut["high_length"] + 1e-12
        assert kept[r["doc_id"]] == fine
    assert 0 < sum(kept.values()) < len(kept)


def test_secrets_need_context(spark):
    key = "9f3a7c21b8e04d5566aa01bc9d2e7f3344"
    want = {f'token = "{key}"': [key], f"api_key: {key}": [key], f"see {key}": [], f"token = {'a' * 40}": [], "key word " + "x" * 30: [], f"tokens and others far away from here: {key}": [], f"monkey {key}": []}
    d = spark.createDataFrame([(k, t) for k, t in enumerate(want)], "doc_id long, text string")
    assert {r.text: [s.value for s in r.pii_secret] for r in pii.find(d).collect()} == want


def test_offsets_of_many_matches(spark):
    """More matches than are summed up in one go."""
    text = " ".join(f"é{k}@b{k}.co" if k % 3 else "1.2.3.4" for k in range(1500))
    r = pii.find(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert len(r.pii_email) == 1000 and len(r.pii_ip) == 500
    assert all(text[s.start : s.end] == s.value for s in [*r.pii_email, *r.pii_ip])


def test_toxicity_learns_phrases_and_takes_few_labels():
    assert toxicity.learn([]).curve == pytest.approx(toxicity.Model.curve) and toxicity.learn([]).weights == toxicity.GIVEN
    one = toxicity.learn([("you idiot", 1), ("fine words", 0)])
    assert one.weights == toxicity.GIVEN and toxicity.Model.curve != one.curve
    rng = random.Random(10)
    rows = [(f"{passage(rng, 20)} blargh {passage(rng, 20)}", 1) for _ in range(60)] + [(passage(rng, 40), 0) for _ in range(200)] + [(f"{passage(rng, 20)} sea blargh {passage(rng, 20)}", 0) for _ in range(12)]
    rng.shuffle(rows)
    m = toxicity.learn(rows)
    assert " blargh " in m.weights and " sea blargh " in m.exceptions
    a = m.automaton()
    assert toxicity.matches(toxicity.fold("a sea blargh"), a) == [] and len(toxicity.matches(toxicity.fold("a blargh"), a)) == 1
    plain = [x for x in toxicity.matches(" trash trash can trash ", toxicity.Model().automaton())]
    assert [x[0] for x in plain] == [0, 16]
