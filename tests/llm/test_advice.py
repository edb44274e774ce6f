"""Cases from the review of round 1."""

import numpy as np

from loomtext.llm import html_text, minhash, pii, quality_classifier, quality_rules


def test_near_stage_links_at_080(spark):
    import corpus_pipeline as C

    base = [f"w{k}" for k in range(204)]  # 200 shingles
    other = list(base)
    for k in (20, 60, 100, 140):  # 20 shingles differ: 180 of 220, similarity 0.818
        other[k] = f"x{k}"
    a, b = (minhash.shingles(" ".join(w).encode()) for w in (base, other))
    both = len(set(a.tolist()) & set(b.tolist()))
    assert 0.8 <= both / (len(a) + len(b) - both) < 0.85
    docs = spark.createDataFrame([(1, " ".join(base), "en", "s", 1), (2, " ".join(other), "en", "s", 1)], "doc_id long, text string, lang string, source string, n_chars long")
    assert [r.doc_id for r in C.near_stage(spark, docs, "").collect()] == [1]


def test_classifier_merges_no_rounded_vectors(spark):
    rng = np.random.default_rng(1)
    x = np.unique(rng.integers(0, 9, (20000, len(quality_classifier.FEATURES))), axis=0) / quality_classifier.STEPS
    vectors = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "doc_id long, quality_x array<float>")
    got = quality_classifier.cells(vectors)
    n = got.count() if hasattr(got, "count") and not isinstance(got, tuple) else len(got[0])
    assert n == len(x) > 1 << 14


def test_classifier_in_shares_is_the_whole_fit(spark):
    """Trained by several tasks, one of them perhaps without rows, the model is that of all cells in one place."""
    rng = np.random.default_rng(2)
    for n in (3, 400):
        x = np.round(rng.random((n, len(quality_classifier.FEATURES))) * 8) / 8
        vectors = spark.createDataFrame([(k, v) for k, v in enumerate(x.tolist())], "doc_id long, quality_x array<float>")
        good = [(k, 1) for k in range(n) if x[k, 0] > 0.5 or k == 0]
        model = quality_classifier.fit(vectors, spark.createDataFrame(good, "doc_id long, quality int"), steps=30)
        p, u = x[[k for k, _ in good]], x
        whole = quality_classifier._learn(p, np.ones(len(p)), u, np.ones(n), 30, lambda a, most=False: a)
        assert np.allclose(model.score(x), whole.score(x), atol=1e-6)


def test_a_dirty_group_does_not_keep_its_junk(spark):
    """One source is the largest and 40 % junk of two kinds: symbols, and words of an odd length."""
    rows, k = [], 0
    for source, n in (("a", 30), ("b", 30), ("c", 30), ("hot", 300)):
        for i in range(n):
            words = [f"w{(i * 7 + j) % 90}{'x' * (j % 5)}" for j in range(100)]
            junk = source == "hot" and i % 5 < 2
            if junk:
                words = [f"{w} #" for w in words[:50]] if i % 5 else [w + "y" * 20 for w in words]
            rows.append((k, " ".join(words), "en", source, junk))
            k += 1
    measured = quality_rules.measure(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, junk boolean")).localCheckpoint()
    got = quality_rules.judge(measured, quality_rules.thresholds(measured)).select("q_kept", "junk").collect()
    assert not any(r.q_kept for r in got if r.junk) and all(r.q_kept for r in got if not r.junk)


def test_ibans_before_capitals_and_digits(spark):
    de, gb = "DE89370400440532013000", "GB82WEST12345698765432"
    odd = next(f"ZZ{k:02d}ABCD12345678901" for k in range(100) if int("".join(str(int(c, 36)) for c in f"ABCD12345678901ZZ{k:02d}")) % 97 == 1)
    want = {
        f"{de} BIC COBADEFFXXX": [de], f"{de} 12 EUR": [de], f"{gb} I paid": [gb], f"{de} {gb}": [de, gb], f"{gb} {gb} {de} 1": [gb, gb, de], f"AB12 {de}": [de],
        "DE89 3704 0044 0532 0130 00 Bank": ["DE89 3704 0044 0532 0130 00"], f"{de}1": [], f"no {odd}": [], f"account {odd} 12 AB": [odd],
    }
    d = spark.createDataFrame([(k, t) for k, t in enumerate(want)], "doc_id long, text string")
    got = {r.text: [(s.value, r.text[s.start : s.end]) for s in r.pii_iban] for r in pii.find(d).collect()}
    assert got == {t: [(v, v) for v in x] for t, x in want.items()}


def test_html_that_is_shown_stays():
    css = "@charset 'x';@media print{.np{display:none}} @media (max-width:1px){.mq{display:none}} .tab{display:none} .tab.active{display:block} #a .low{display:block} .low{display:none} @media screen{.gone{display:none}} .no{display:none!important} .v{visibility:hidden} .w{visibility:visible}"
    show = lambda body: html_text.render(f"<style>{css}</style><body>{body}")
    for shown in ("<p class=np>x", "<p class=mq>x", "<p class='tab active'>x", "<p class=tab style='display:block'>x", "<p class=low>x", "<p hidden style='display:block'>x", "<div class=v><b class=w>x</b></div>"):
        assert show(shown) == "x", shown
    for hidden in ("<p class=tab>x", "<p class=gone>x", "<p class=no style='display:block'>x", "<p class=v>x", "<p hidden>x", "<p style='display:block;display:none'>x"):
        assert show(hidden) == "", hidden
    assert html_text.render("<style media=print>p{display:none}</style><p>x") == "x"
    assert html_text.render("a <svg><defs/><title>t</title><circle r=1 /><text>b</text><desc>d</desc></svg> <math><mi>c</mi><mo>=</mo><mn>2</mn></math> e") == "a b c=2 e"


def test_html_tables_and_lists():
    cells = "<table><tr><td>a<td><ul><li>x<li>y</ul><td>z<tr><td>bb<td>line<br>two<td><table><tr><td>n<td>1<tr><td>mm<td>2</table></table>"
    assert html_text.render(cells) == "a   - x   z\n    - y\nbb  line  n   1\n    two   mm  2"
    spans = "<table><tr><td colspan=2>a wide one<td>x<tr><td>p<td>q<td>y<tr><td rowspan=2>r<td>s<td>t<tr><td>u<td>v</table>"
    assert html_text.render(spans) == "a wide one  x\np  q        y\nr  s        t\n   u        v"
    long = " ".join(f"word{k}" for k in range(30))
    lines = html_text.render(f"<table><tr><td>{long}<td>right<tr><td>short<td>below</table>").split("\n")
    assert lines[0].index("right") == lines[-1].index("below") <= 62 and " ".join(x.replace("right", "").strip() for x in lines[:-1]) == long
    assert html_text.render(f"<table><tr><td>k<td>{long}</table>") == f"k  {long}"
    assert html_text.render("<ol start=-1><li>a<li>b<li>c</ol>") == "-1. a\n0. b\n1. c"
    assert html_text.render("<ol type=a start=26><li>a<li>b</ol><ol type=I><li>a<li value=9>b</ol><ol reversed><li>a<li>b</ol>") == "z. a\naa. b\n\nI. a\nIX. b\n\n2. a\n1. b"


def test_html_long_attributes_and_broken_quotes():
    assert html_text.render(f"<p title=\"{'a > b ' * 5000}\">x</p><img alt='{'<p>y</p>' * 3000}'>z") == "x\n\nz"
    assert html_text.render("<p title=\"x>a</p><b>b</b>c").replace("\n", "") == "abc"  # the quote is closed nowhere
    html_text.render("<p class='x>" * 20001 + "end")
