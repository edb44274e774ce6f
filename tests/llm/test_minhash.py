import sys, os; sys.path.insert(0, os.path.dirname(__file__))
"""Near-dedup: repeated ids, chains, large groups of near copies, clashing columns."""

import random

import numpy as np
import pyarrow as pa
import pytest

import brute
from loomtext.llm import minhash
from loomtext.llm.components import components

SCHEMA = "doc_id long, text string"


def words(rng, n):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def changed(rng, w, n):
    out = list(w)
    for k in rng.sample(range(len(w)), n):
        out[k] = f"x{rng.randrange(10**6)}"
    return " ".join(out)


@pytest.mark.parametrize("turn", [1, -1])
def test_rows_that_repeat_an_id_keep_all_their_links(spark, turn):
    rng = random.Random(1)
    a, b, c = (words(rng, 150) for _ in range(3))
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, changed(rng, a, 1)), (3, changed(rng, b, 1)), (0, changed(rng, c, 1)), (4, " ".join(c)), (4, "something else"), (5, "something else")]
    got = minhash.near_duplicates(spark.createDataFrame(rows[::turn], SCHEMA).coalesce(1), 85).collect()
    assert sorted(map(tuple, got)) == sorted(brute.op9(rows))


def test_a_thousand_near_copies(spark):
    """Links that hold only between some of them, through buckets that lie across partitions, and outliers."""
    rng = random.Random(2)
    base = words(rng, 110)
    rows = [(k, changed(rng, base, rng.choice([0, 1, 1, 2, 2, 3, 4, 5]))) for k in range(1000)]
    rows += [(2000 + k, changed(rng, base, 12)) for k in range(40)] + [(3000, None), (3001, ""), (None, " ".join(base))]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        got = sorted(map(tuple, minhash.near_duplicates(docs, 85).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == sorted(brute.op9(rows), key=str)


def test_meetings_in_batches():
    """Pairs of small buckets, members of large ones and of those at the edges, each once, whatever the batches' borders."""
    rng = np.random.default_rng(3)
    for spread in (3, 9, 60, 400):
        key = np.sort(rng.integers(0, spread, 150))
        node = np.arange(150)
        for step in (1, 2, 7, 150):
            batches = [pa.RecordBatch.from_arrays([pa.array(key[i : i + step]), pa.array(node[i : i + step])], ["key", "node"]) for i in range(0, 150, step)]
            got = sorted((r["kind"], r["key"], r["node"], r["pivot"]) for b in minhash._meet(iter(batches)) for r in b.to_pylist())
            want = []
            for k in set(key.tolist()):
                of = node[key == k].tolist()
                edge = k in (key[0], key[-1])
                want += [(minhash.EDGE, k, of[0], of[0])] * edge * (1 + (key[0] == key[-1]))
                if edge or len(of) > minhash.SMALL:
                    want += [(minhash.MEMBER, k, n, of[0]) for n in of]
                else:
                    want += [(minhash.PAIR, k, n, m) for n in of for m in of if m < n]
            assert got == sorted(want)


def test_keep_one_keeps_one_row(spark):
    t = " ".join(f"w{k}" for k in range(60))
    rows = [(1, t, 1, "a"), (1, t, 1, "a"), (2, t, 2, "b"), (3, None, 3, None), (3, None, 3, None), (None, t, 4, None), (None, t, 4, None), (5, "", 5, "c"), (6, "other text", 6, "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, nd_doc int, `nd.Row` string")
    got = minhash.keep_one(docs, 80)
    assert got.columns == docs.columns
    assert sorted([r[0] for r in got.collect()], key=str) == sorted([1, 3, 3, None, None, 5, 6], key=str)
    assert minhash.keep_one(docs.limit(0)).collect() == []


def test_a_long_chain_settles(spark):
    n = 3000
    ids = list(range(n))
    random.Random(4).shuffle(ids)
    links = spark.createDataFrame(list(zip(ids, ids[1:])) + [(7, 7)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(k, 0) for k in range(n)}
