"""MinHash near-dedup with tensored banding.

Two collections of ``COLLECTION`` sub-hashes (``ROWS`` minhashes each) are computed for each set of shingles.  Every pair
of a sub-hash from the first and one from the second is the key of a table, so ``COLLECTION ** 2`` tables of
``2 * ROWS`` rows need only ``2 * COLLECTION * ROWS`` minhashes, about the square root of what separate tables would.
Documents that meet in a bucket of a table are candidates, and every link is confirmed on full sets.  With 12 and 3, a
pair at similarity 0.8 meets with probability 0.9996, at 0.85 with 0.99998, at 0.9 with 0.9999997.

Equal sets are collapsed to one node first.  Tables are range-partitioned by (key, node), so a bucket that a third of all
documents share is spread over many tasks.  No pair is left out, but most are settled without being compared:

1. Each node is compared with a few others: of those that come first in its buckets, the ones it shares most buckets with.  The
   links are contracted.
2. Pairs that share a small bucket (up to ``SMALL`` nodes) and are in unlike components are compared.  In large buckets that still
   hold several components, nodes outside the main one (that with most nodes there) meet a few of it.  The links are
   contracted again.
3. What is then still outside the main component of a large bucket meets all nodes there, in blocks.

So all pairs that share a bucket are in one component, or have been compared.

Edge cases: null or empty text, or text without words, has an empty set and is linked with nothing; fewer words than a
shingle make one shingle; a null doc_id is linked with nothing and kept; rows that repeat a doc_id are linked by their
own texts, and rows alike in both are one document; very long texts are hashed in parts; of a component with several texts
of the smallest doc_id the one with the smallest hash stays; extra columns of any name are kept by ``keep_one``; an empty
table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .components import components
from .shared import few, fresh, settled, tidy

SHINGLE, COLLECTION, ROWS, SMALL = 5, 12, 3, 9
_MAP = bytes(c + 32 if 65 <= c < 91 else c for c in range(256))
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_RNG = np.random.default_rng(20240229)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _U = 0x9E3779B97F4A7C15, np.uint64
_PLACE = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A = _RNG.integers(0, 1 << 63, 2 * COLLECTION * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, 2 * COLLECTION * ROWS, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class _Powers:
    """base ** i and its inverse modulo 2 ** 64, for i up to the longest buffer so far."""

    up, down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            inverse = pow(_BASE, -1, 1 << 64)
            up, down = np.full(n, _BASE, np.uint64), np.full(n, inverse, np.uint64)
            up[0] = down[0] = 1
            cls.up, cls.down = np.cumprod(up), np.cumprod(down)
        return cls.up, cls.down


def word_hashes(text: bytes) -> np.ndarray:
    """A 64-bit hash of each word (run of characters other than ASCII white space), A-Z lower-cased."""
    b = np.frombuffer(text.translate(_MAP), np.uint8)
    if not len(b):
        return np.empty(0, np.uint64)
    space = _SPACE[b]
    edge = np.flatnonzero(np.diff(np.concatenate([[True], space, [True]]).view(np.int8)))
    starts, ends = edge[::2], edge[1::2]
    up, down = _Powers.get(len(b) + 1)
    total = np.zeros(len(b) + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[: len(b)], out=total[1:])
    return _mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def shingles(text: bytes) -> np.ndarray:
    """The sorted distinct hashes of the text's shingles."""
    w = word_hashes(text)
    n = min(SHINGLE, len(w))
    if not n:
        return w
    size = len(w) - n + 1
    h = np.full(size, n, np.uint64)
    for k in range(n):
        h += w[k : k + size] * _PLACE[k]
    return np.unique(_mix(h))


def _signature(x: np.ndarray) -> np.ndarray:
    low = np.full(len(_A), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(x), 4096):
        part = x[at : at + 4096]
        np.minimum(low, (np.multiply.outer(_A, part) + _B[:, None]).min(axis=1), out=low)
    rows = low.reshape(2 * COLLECTION, ROWS)
    h = np.zeros(2 * COLLECTION, np.uint64)
    for k in range(ROWS):
        h = _mix(h * _U(3) + rows[:, k])
    return h


_SIGNED = "nd_doc long, nd_text long, nd_n long, nd_f1 long, nd_f2 long, nd_sig array<long>"


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        n, f1, f2, sig = [], [], [], []
        for text in batch.column(2).cast(pa.binary()).to_pylist():
            x = shingles(text or b"")
            n.append(len(x))
            f1.append(_mix(x).sum(dtype=np.uint64))
            f2.append(_mix(x ^ _U(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
            if len(x):
                sig.append(_signature(x))
        flat = np.concatenate(sig).view(np.int64) if sig else np.empty(0, np.int64)
        offsets = np.concatenate([[0], np.cumsum(np.array(n) > 0) * 2 * COLLECTION]).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), *(pa.array(np.array(f, np.uint64).view(np.int64)) for f in (f1, f2)), pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))],
            ["nd_doc", "nd_text", "nd_n", "nd_f1", "nd_f2", "nd_sig"],
        )


def sign(docs: DataFrame) -> DataFrame:
    """(nd_doc, nd_text: hash of the text, nd_n: size of the set, nd_f1 and nd_f2: its fingerprint, nd_sig: its sub-hashes) of
    docs(doc_id, text)."""
    return docs.select("doc_id", F.xxhash64("text"), "text").mapInArrow(_sign, _SIGNED)


_MET = pa.schema([("key", pa.int64()), ("node", pa.int64()), ("pivot", pa.int64()), ("kind", pa.int8())])
MEMBER, EDGE, PAIR = 0, 1, 2


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over rows (key, node) sorted by both: all pairs of small buckets, pivot being the smaller; the members of large ones, and
    of the partition's first and last, which may go on in its neighbours, pivot being the first of them here; and that one as an
    edge. A bucket of one in between gives nothing."""

    def out(kind: int, key: np.ndarray, node: np.ndarray, pivot: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(key), pa.array(node), pa.array(pivot), pa.array(np.full(len(key), kind, np.int8))], schema=_MET)

    kept = None  # of the bucket that is open: its first row if it has been given out, else all of its rows
    told, first = False, None
    for batch in batches:
        if not batch.num_rows:
            continue
        key, node = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        if kept is None:
            first = key[0]
            yield out(EDGE, key[:1], node[:1], node[:1])
        else:
            key, node = (np.concatenate([k, x]) for k, x in zip(kept, (key, node)))
        begin = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        size = np.diff(np.concatenate([begin, [len(key)]]))
        large = (size > SMALL) | (key[begin] == first)
        large[0] |= told
        last = int(begin[-1])
        whole = np.ones(len(begin), bool)
        whole[-1] = False  # may go on
        tell, pivot = np.repeat(large, size), np.repeat(node[begin], size)
        tell[0] &= not told
        yield out(MEMBER, key[tell], node[tell], pivot[tell])
        few, start = np.repeat(whole & ~large & (size > 1), size), np.repeat(begin, size)
        at = np.flatnonzero(few)
        for u in range(1, SMALL):
            at = at[at - u >= start[at]]
            if not len(at):
                break
            yield out(PAIR, key[at], node[at], node[at - u])
        told = bool(large[-1])
        stop = last + 1 if told else len(key)
        kept = key[last:stop], node[last:stop]
    if kept is not None:
        if not told:
            yield out(MEMBER, kept[0], kept[1], np.repeat(kept[1][:1], len(kept[1])))
        yield out(EDGE, kept[0][:1], kept[1][:1], kept[1][:1])


def _tables(classes: DataFrame) -> DataFrame:
    """(key, node) for each pair of a sub-hash of the first collection and one of the second."""
    first, second = F.slice("nd_sig", 1, COLLECTION), F.slice("nd_sig", COLLECTION + 1, COLLECTION)
    keys = F.flatten(F.transform(F.col("nd_x"), lambda x, i: F.transform(F.col("nd_y"), lambda y, j: F.xxhash64(i, j, x, y))))
    return classes.withColumns({"nd_x": first, "nd_y": second}).select(F.explode(keys).alias("key"), "node")


def meetings(classes: DataFrame) -> DataFrame:
    """(key, node, pivot, kind) of the nodes that share a bucket with others."""
    order = [F.col("key"), F.col("node")]
    return settled(_tables(classes).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_meet, "key long, node long, pivot long, kind byte"))


#: pivots that a node meets first
FIRST = 3


def _first_pairs(met: DataFrame) -> DataFrame:
    """(a, b): for each node those that it shares most buckets with, which it is most like, of all in small buckets and of the
    pivots of large ones; and the pivots of a bucket that lies across partitions."""
    shared = met.where((F.col("kind") != EDGE) & (F.col("pivot") != F.col("node"))).groupBy("node", "pivot").agg(F.count("*").alias("n"))
    most = shared.groupBy("node").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("n"), "pivot"))), 1, FIRST).alias("as"))
    star = most.select(F.explode("as.pivot").alias("a"), F.col("node").alias("b"))
    edges = met.where(F.col("kind") == EDGE).select("key", "pivot").distinct()  # two rows a partition at most
    across = edges.groupBy("key").agg(F.min("pivot").alias("a"), F.collect_list("pivot").alias("bs")).select("a", F.explode("bs").alias("b")).where("a != b")
    return star.union(across).distinct()


def _several(rows: DataFrame, found: DataFrame) -> DataFrame:
    """(key, node, c: its component, main, pick) over rows (key, node): those that are in a bucket with several components, but not
    in the one with most nodes there, which is main; pick is some node of that."""
    known = settled(rows.join(found, "node", "left").select("key", "node", F.coalesce("component", "node").alias("c")))
    share = known.groupBy("key", "c").agg(F.count("*").alias("m"), F.min_by("node", F.xxhash64("node", "key")).alias("pick"))
    spans = share.groupBy("key").agg(F.count("*").alias("cs"), F.max(F.struct("m", "c", "pick")).alias("top")).where("cs > 1")
    spans = spans.select(F.col("key").alias("k"), F.col("top.c").alias("main"), F.col("top.pick").alias("pick"))
    return known.join(spans, (F.col("key") == F.col("k")) & (F.col("c") != F.col("main"))).drop("k")


#: nodes of the main component that one outside meets before it meets all
FEW = 16


def _next_pairs(small: DataFrame, strays: DataFrame, found: DataFrame) -> DataFrame:
    """(a, b) to compare next: the pairs (a, b) of small buckets that are in unlike components, and a few for each stray (node,
    pick)."""
    of = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"c{x}"))
    apart = small.join(of("a"), "a", "left").join(of("b"), "b", "left").where(F.coalesce("ca", "a") != F.coalesce("cb", "b")).select("a", "b")
    meets = strays.select(F.col("pick").alias("a"), F.col("node").alias("b")).distinct()  # another pick in each bucket
    some = meets.groupBy("b").agg(F.slice(F.array_sort(F.collect_list(F.struct(F.xxhash64("a", "b").alias("h"), "a"))), 1, FEW).alias("as"))
    return apart.union(some.select(F.explode("as.a").alias("a"), "b")).distinct()


def _confirm(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows (pivot, salt, doc, text), a pivot's own row first in each of its salts: the confirmed pairs."""
        pivot, own = None, np.empty(0, np.uint64)
        for whole in batches:
            for offset in range(0, whole.num_rows, 512):
                batch = whole.slice(offset, 512)
                a, b = [], []
                for p, doc, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()).to_pylist()):
                    x = shingles(text or b"")
                    if p == doc:
                        pivot, own = p, x
                        continue
                    if p != pivot:
                        raise RuntimeError(f"the pivot {p} is missing")
                    both = len(np.intersect1d(own, x, assume_unique=True))
                    if 100 * both >= limit * (len(own) + len(x) - both):
                        a.append(p)
                        b.append(doc)
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return run


SHARE = 2000


def confirm(pairs: DataFrame, texts: DataFrame, limit: int = 80) -> DataFrame:
    """The pairs (a, b) whose sets' similarity is limit / 100 or more, texts(node, text) having one row a node. Texts, not sets,
    are shuffled: they are smaller.

    A pivot's partners are dealt over as many salts as it has thousands of them, each with a copy of the pivot.
    """
    pivots = pairs.groupBy("a").agg(F.ceil(F.count("*") / SHARE).cast("int").alias("salts"))
    of = pairs.join(pivots, "a").select(F.col("b").alias("node"), F.col("a").alias("pivot"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"))
    own = pivots.select(F.col("a").alias("node"), F.col("a").alias("pivot"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    got = of.union(own).join(texts, "node").select("pivot", "salt", "node", (F.col("node") != F.col("pivot")).alias("other"), "text")
    dealt = got.repartition("pivot", "salt").sortWithinPartitions("pivot", "salt", "other")
    return dealt.drop("other").mapInArrow(_confirm(limit), "a long, b long")


STRAYS, MEMBERS = 256, 2000


def _against(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over rows (main, block, salt, member, node, c, text), the strays of each (main, block, salt) first: for each stray and
        component, one confirmed pair if there is any. Only the strays' sets, STRAYS about, are held."""
        group, held, inside, told = None, [], False, set()
        hashes = owners = sizes = ids = homes = None
        for whole in batches:
            for offset in range(0, whole.num_rows, 512):
                batch = whole.slice(offset, 512)
                out_a, out_b = [], []
                texts = batch.column(6).cast(pa.binary()).to_pylist()
                for main, block, salt, member, node, c, text in zip(*(batch.column(k).to_pylist() for k in range(6)), texts):
                    x = shingles(text or b"")
                    if (main, block, salt) != group:
                        group, held, inside, told = (main, block, salt), [], False, set()
                    if not member:
                        held.append((node, c, x))
                        continue
                    if not inside:
                        inside = True
                        owners = np.repeat(np.arange(len(held)), [len(h[2]) for h in held])
                        hashes = np.concatenate([h[2] for h in held])
                        order = np.argsort(hashes, kind="stable")
                        hashes, owners = hashes[order], owners[order]
                        sizes, ids, homes = (np.array(v, np.int64) for v in ([len(h[2]) for h in held], [h[0] for h in held], [h[1] for h in held]))
                    low, high = np.searchsorted(hashes, x, "left"), np.searchsorted(hashes, x, "right")
                    n = high - low
                    at = np.repeat(low - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    both = np.bincount(owners[at], minlength=len(ids))
                    for k in np.flatnonzero((100 * both >= limit * (sizes + len(x) - both)) & (homes != c) & (ids != node)).tolist():
                        if (k, c) not in told:  # one link joins a stray to a whole component
                            told.add((k, c))
                            out_a.append(min(node, int(ids[k])))
                            out_b.append(max(node, int(ids[k])))
                yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], ["a", "b"])

    return run


def _stray_links(strays: DataFrame, found: DataFrame, texts: DataFrame, limit: int) -> DataFrame:
    """Links between strays (main, node, c), which stand outside the main component of a large bucket, and all nodes of that
    component and other strays of it.

    Around each main component, the strays are dealt into blocks and the members into salts; every member meets every block,
    and pairs that are no links are never written out.
    """
    mains = settled(strays.groupBy("main").agg(F.ceil(F.count("*") / STRAYS).cast("int").alias("blocks")))
    inside = mains.join(found, F.col("component") == F.col("main")).select("main", "node").union(mains.select("main", F.col("main").alias("node"))).distinct()
    members = inside.withColumn("c", F.col("main")).union(strays.select("main", "node", "c"))
    sizes = settled(members.groupBy("main").agg(F.ceil(F.count("*") / MEMBERS).cast("int").alias("salts")).join(mains, "main"))
    block, salt = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("node", F.lit(1)), F.col("salts")).cast("int")
    upto = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    of_strays = strays.join(sizes, "main").select("main", block.alias("block"), upto("salts").alias("salt"), F.lit(0).alias("member"), "node", "c")
    of_members = members.join(sizes, "main").select("main", upto("blocks").alias("block"), salt.alias("salt"), F.lit(1).alias("member"), "node", "c")
    order = ["main", "block", "salt", "member", "node"]
    full = of_strays.union(of_members).join(texts, "node").select(*order, "c", "text")
    return full.repartition("main", "block", "salt").sortWithinPartitions(*order).mapInArrow(_against(limit), "a long, b long").distinct()


def _texts_of(met: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """(node, text) of the nodes that share a bucket, one row each. Up to a million of them (24 MB) are broadcast, so that only
    their texts move; more are joined by shuffling."""
    nodes = settled(classes.join(met.select(F.explode(F.array("node", "pivot")).alias("node")).distinct(), "node", "left_semi").select("node", F.col("first.nd_doc").alias("doc_id"), F.col("first.nd_text").alias("nd_text")))
    own = docs.select("doc_id", F.xxhash64("text").alias("nd_text"), "text")
    return settled(own.join(few(nodes), ["doc_id", "nd_text"]).select("node", "text").dropDuplicates(["node"]))


def _links(classes: DataFrame, docs: DataFrame, limit: int) -> DataFrame:
    """(node, component) of the nodes that are linked with others."""
    met = meetings(classes)
    tidy(docs.sparkSession)
    texts = _texts_of(met, classes, docs)
    members = met.where(F.col("kind") == MEMBER).select("key", "node")
    small = met.where(F.col("kind") == PAIR).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    found = components(confirm(settled(_first_pairs(met)), texts, limit))
    strays = settled(_several(members, found))
    more = settled(_next_pairs(small, strays, found))
    tidy(docs.sparkSession)
    if more.isEmpty():
        return found
    as_links = lambda d: d.select(F.col("node").alias("a"), F.col("component").alias("b"))
    found = components(as_links(found).union(confirm(more, texts, limit)))
    # what a stray's component and its main one have become; members of the main one are in that still
    now = lambda x: found.select(F.col("node").alias(x), F.col("component").alias(f"{x}_now"))
    apart = strays.select("main", "node", "c").distinct().join(now("c"), "c", "left").join(now("main"), "main", "left")
    apart = apart.select(F.coalesce("main_now", "main").alias("main"), "node", F.coalesce("c_now", "c").alias("c"))
    strays = settled(apart.where("c != main").distinct())
    if strays.isEmpty():
        return found
    return components(as_links(found).union(_stray_links(strays, found, texts, limit)))


def _judged(docs: DataFrame, limit: int) -> DataFrame:
    """(nd_doc, nd_text, nd_n, component_id, first: (nd_doc, nd_text) of the component's first text) for each row of docs; the
    last is null for rows that are linked with nothing because they have no words or no doc_id."""
    signed = settled(sign(docs))
    sets = signed.where((F.col("nd_n") > 0) & F.col("nd_doc").isNotNull())
    fp = ["nd_n", "nd_f1", "nd_f2"]
    classes = sets.groupBy(*fp).agg(F.min(F.struct("nd_doc", "nd_text")).alias("first"), F.first("nd_sig").alias("nd_sig"))
    classes = settled(classes.withColumn("node", F.monotonically_increasing_id()))
    found = settled(_links(classes, docs, limit))
    tidy(docs.sparkSession)
    home = classes.select(*fp, "node", "first").join(found, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = home.groupBy("component").agg(F.min("first").alias("first"))
    of_class = home.drop("first", "node").join(least, "component").drop("component")
    out = signed.drop("nd_sig").join(of_class, fp, "left")
    first = F.when((F.col("nd_n") > 0) & F.col("nd_doc").isNotNull(), F.col("first"))
    return out.select("nd_doc", "nd_text", "nd_n", F.coalesce(first["nd_doc"], "nd_doc").alias("component_id"), first.alias("first"))


def near_duplicates(docs: DataFrame, limit: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs(doc_id, text)."""
    return _judged(docs.select("doc_id", "text"), limit).select(F.col("nd_doc").alias("doc_id"), F.col("nd_n").alias("n_shingles"), "component_id")


def keep_one(docs: DataFrame, limit: int = 80) -> DataFrame:
    """docs with one row of each component: that of its smallest doc_id. Rows without words or doc_id all stay."""
    judged = _judged(docs.select("doc_id", "text"), limit)
    doc, text, stays, own, row = fresh(docs, "nd_doc", "nd_text", "nd_stays", "nd_own", "nd_row")
    stay = F.col("first") == F.struct("nd_doc", "nd_text")
    verdict = judged.where(F.col("first").isNotNull()).groupBy(F.col("nd_doc").alias(doc), F.col("nd_text").alias(text)).agg(F.bool_and(stay).alias(stays))
    marked = docs.withColumn(own, F.xxhash64("text")).join(verdict, (F.col("doc_id") == F.col(doc)) & (F.col(own) == F.col(text)), "left").where(F.coalesce(F.col(stays), F.lit(True)))
    # rows that are alike in doc_id and text are one document; the join has brought them together
    one = marked.withColumn(row, F.when(F.col(stays).isNull(), F.monotonically_increasing_id()).otherwise(-1)).dropDuplicates(["doc_id", own, row])
    return one.drop(doc, text, stays, own, row)
