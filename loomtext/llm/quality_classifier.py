"""A quality classifier learned from positives and unlabelled text (non-negative PU learning).

Each whole text gives a vector of shape features (signs, capitals, repetition, word and line lengths ...).  Trusted
positives are the rows labelled 1; the unlabelled sample is all web text; labels of 0 are never read.  A small network
minimises the non-negative unbiased risk  pi * R_p+  +  max(0, R_u- - pi * R_p-),  where pi, the share of positives among
unlabelled text, is estimated as the least ratio of the two score distributions' upper tails.

Nothing is sampled: both sides are summed up by the rounded feature vector (each cell with its number of rows and sum of
vectors; different rounded vectors are never merged, so the number of cells grows with the corpus).  The cells stay on the
executors: tasks that run together (a barrier stage) hold a share each and add up every step's risk and gradient, so the
driver gets the finished model only, whatever the corpus's size.

Edge cases: a null or empty text has the vector of a text without words and gets a score like any other; null labels count
as unlabelled; without positives every score is 0.5; very long texts are measured whole; equal vectors get equal scores; an
empty table gives an empty table; repeated rows and extra columns are kept, whatever their names: only columns called
``quality_x`` or ``quality_score`` are replaced.
"""

from __future__ import annotations

import secrets
import socket
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from .minhash import word_hashes
from .shared import settled, with_columns

FEATURES = ("signs", "capitals", "digits", "bars", "exclaim", "points", "high", "breaks", "adjacent", "distinct", "triples", "lines", "word", "long", "size", "dominant")
#: features are in 0..1 or so; cells round them to so many steps
STEPS = 8
#: tasks that train together at most
MOST_TASKS = 64
_CLASS = np.zeros((6, 256), bool)
_CLASS[0, [ord(c) for c in "#*$%&<>^~=_{}[]\\@+"]] = True
_CLASS[1, 65:91] = True
_CLASS[2, 48:58] = True
_CLASS[3, ord("|")] = True
_CLASS[4, [ord("!"), ord("?")]] = True
_CLASS[5, [ord(c) for c in ".,;:"]] = True


def features(text: bytes) -> np.ndarray:
    """The vector of one text."""
    x = np.zeros(len(FEATURES), np.float64)
    if not text:
        return x
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    share = np.array([counts[c].sum() for c in _CLASS]) / len(text)
    x[:6] = np.minimum(1, np.array([4, 1.5, 3, 10, 8, 4]) * share) ** 0.5
    x[6] = min(1, 2 * counts[128:].sum() / len(text)) ** 0.5
    x[7] = min(1, 20 * counts[10] / len(text)) ** 0.5
    w = word_hashes(text)
    n = len(w)
    if n:
        _, each = np.unique(w, return_counts=True)
        x[8] = float((w[1:] == w[:-1]).mean()) if n > 1 else 0.0
        x[9] = min(1.0, len(each) / n ** 0.85)
        x[15] = min(1.0, 2 * each.max() / n) if n >= 10 else 0.0
        if n > 3:
            t = w[:-2] * np.uint64(3) + w[1:-1] * np.uint64(0x9E3779B97F4A7C15) + w[2:] * np.uint64(0xBF58476D1CE4E5B9)
            x[10] = 1 - len(np.unique(t)) / len(t)
        letters = len(text) - counts[[9, 10, 11, 12, 13, 32]].sum()
        x[12] = min(1.0, letters / n / 16)
        x[14] = min(1.0, np.log10(n + 1) / 4)
    lines = [s for s in text.split(b"\n") if s.strip()]
    if lines:
        x[11] = 1 - len(set(lines)) / len(lines)
        x[13] = min(1.0, len(text) / len(lines) / 2000)
    return x


def featurise(docs: DataFrame) -> DataFrame:
    """Replaces text by quality_x array<float>."""
    at = [c.lower() for c in docs.drop("quality_x").columns].index("text")

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        x = [features(t or b"") for t in batch.column(at).cast(pa.binary()).to_pylist()]
        flat = np.array(x, np.float32).reshape(-1)
        return [pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES)), pa.array(flat))]

    return with_columns(docs, "quality_x array<float>", lambda: make, ("text",))


def cells(vectors: DataFrame) -> DataFrame:
    """(n, s0, s1, ...: number of rows and sums of vectors) of each distinct rounded vector; no two are merged."""
    rounded = F.transform("quality_x", lambda v: F.round(v * STEPS).cast("int"))
    sums = [F.sum(F.get("quality_x", k)).alias(f"s{k}") for k in range(len(FEATURES))]
    return vectors.groupBy(rounded.alias("cell")).agg(F.count("*").cast("double").alias("n"), *sums).drop("cell")


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    layers: list[np.ndarray]
    prior: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.mean) / self.scale @ w1 + b1) @ w2 + b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def _train(p: np.ndarray, wp: np.ndarray, u: np.ndarray, wu: np.ndarray, prior: float, steps: int, add: Callable[[np.ndarray], np.ndarray], seed: int = 7) -> Model:
    """Adam on the non-negative risk with the sigmoid loss; where the second part is below zero, its ascent.

    p and u are this task's share of the cells; ``add`` sums an array over all tasks, so that every task takes the same steps."""
    total = add(np.concatenate([[wp.sum()], [wu.sum()], wu @ u]))
    wp, wu, mean = wp / total[0], wu / total[1], total[2:] / total[1]
    scale = np.sqrt(np.maximum(add(wu @ (u - mean) ** 2), 1e-4))
    rng = np.random.default_rng(seed)
    layers = [rng.normal(0, 0.3, (len(mean), 16)), np.zeros(16), rng.normal(0, 0.3, 16), np.zeros(1)]
    model = Model(mean, scale, layers, prior)
    zp, zu = (p - mean) / scale, (u - mean) / scale
    first, second = [np.zeros_like(v) for v in layers], [np.zeros_like(v) for v in layers]

    def part(z: np.ndarray, w: np.ndarray) -> np.ndarray:
        """The share's loss of calling z negative, sigmoid(g), and its gradient."""
        h = np.tanh(z @ layers[0] + layers[1])
        s = 1 / (1 + np.exp(-np.clip(h @ layers[2] + layers[3], -30, 30)))
        d = w * s * (1 - s)
        dh = d[:, None] * layers[2] * (1 - h * h)
        return np.concatenate([[w @ s], (z.T @ dh).ravel(), dh.sum(0), h.T @ d, [d.sum()]])

    ends = np.cumsum([v.size for v in layers])[:-1]
    for t in range(1, steps + 1):
        of_p, of_u = np.split(add(np.concatenate([part(zp, wp), part(zu, wu)])), 2)
        # the loss of calling x positive is sigmoid(-g), so its gradient is the negative one
        flat = of_u[1:] - 2 * prior * of_p[1:] if of_u[0] >= prior * of_p[0] else prior * of_p[1:] - of_u[1:]
        for k, g in enumerate(np.split(flat, ends)):
            g = g.reshape(layers[k].shape)
            g = g + 1e-4 * layers[k] if k in (0, 2) else g
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            layers[k] -= 0.02 * (first[k] / (1 - 0.9**t)) / (np.sqrt(second[k] / (1 - 0.999**t)) + 1e-8)
    return model


#: scores at which the two tails are compared: so many equal steps of the logit
TAILS = 1 << 12


def estimate_prior(gp: np.ndarray, wp: np.ndarray, gu: np.ndarray, wu: np.ndarray, add: Callable[[np.ndarray], np.ndarray]) -> float:
    """The least ratio of unlabelled to positive mass above a threshold that leaves at least half of the positives (less would pick chance)."""
    low, high = -add(-np.array([min(gp.min(initial=0), gu.min(initial=0))]), True)[0], add(np.array([max(gp.max(initial=0), gu.max(initial=0))]), True)[0]
    at = lambda g: np.clip((g - low) / max(high - low, 1e-9) * TAILS, 0, TAILS - 1).astype(int)
    positive, unlabelled = np.split(add(np.concatenate([np.bincount(at(g), w, TAILS) for g, w in ((gp, wp), (gu, wu))])), 2)
    n = positive.sum()
    positive, unlabelled = positive[::-1].cumsum() / n, unlabelled[::-1].cumsum() / unlabelled.sum()
    far = positive >= 0.5
    slack = np.sqrt(1 / np.maximum(positive[far] * n, 1))
    return float(np.clip((unlabelled[far] / positive[far] * (1 + slack)).min(), 0.05, 0.98))


def _learn(p: np.ndarray, wp: np.ndarray, u: np.ndarray, wu: np.ndarray, steps: int, add: Callable[[np.ndarray], np.ndarray]) -> Model:
    first = _train(p, wp, u, wu, 0.5, steps // 3, add)  # ranks well for any prior
    return _train(p, wp, u, wu, estimate_prior(first.logit(p), wp, first.logit(u), wu, add), steps, add)


class _Circle:
    """Sums over the tasks of a barrier stage. Spark's allGather takes a second a call, so it only tells where the first
    task listens and a password; then each step's arrays go there and their sum comes back, over sockets."""

    WAIT_S = 600

    def __init__(self) -> None:
        from pyspark import BarrierTaskContext

        task = BarrierTaskContext.get()
        infos = task.getTaskInfos()
        self.first, self.others, n = task.partitionId() == 0, [], len(infos)
        if self.first:
            listening = socket.create_server(("", 0), backlog=n)
            listening.settimeout(self.WAIT_S)
            word = secrets.token_hex(16)
        told = [m for m in task.allGather(f"{listening.getsockname()[1]} {word}" if self.first else "") if m][0].split()
        if not self.first:
            s = socket.create_connection((infos[0].address.rpartition(":")[0] or infos[0].address, int(told[0])), self.WAIT_S)
            s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
            s.sendall(told[1].encode() + task.partitionId().to_bytes(4, "big"))
            self.others = [s]
            return
        met: dict[int, socket.socket] = {}
        while len(met) < n - 1:
            s, _ = listening.accept()
            s.settimeout(self.WAIT_S)
            s.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
            hello = self._read(s, 36)
            if not secrets.compare_digest(hello[:32], word.encode()):
                s.close()
                continue
            met[int.from_bytes(hello[32:], "big")] = s
        listening.close()
        self.others = [met[k] for k in sorted(met)]

    @staticmethod
    def _read(s: socket.socket, size: int) -> bytes:
        out = bytearray()
        while len(out) < size:
            part = s.recv(size - len(out))
            if not part:
                raise ConnectionError("a task of the fit has gone")
            out += part
        return bytes(out)

    def add(self, x: np.ndarray, most: bool = False) -> np.ndarray:
        """The sum, or the maximum, of all tasks' x; in a fixed order, so that every run gives the same."""
        x = np.ascontiguousarray(x, np.float64)
        if not self.first:
            self.others[0].sendall(x.tobytes())
            return np.frombuffer(self._read(self.others[0], x.nbytes))
        every = np.stack([x, *(np.frombuffer(self._read(s, x.nbytes)) for s in self.others)])
        out = every.max(0) if most else every.sum(0)
        for s in self.others:
            s.sendall(out.tobytes())
        return out

    def close(self) -> None:
        for s in self.others:
            s.close()


def _fit_share(steps: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Over this task's rows (positive, n, s0, ...): the model, from the first task. All tasks run at once."""
        got = [np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in b.columns], 1) for b in batches if b.num_rows]
        data = np.concatenate(got) if got else np.empty((0, 2 + len(FEATURES)))
        data = data[np.lexsort(data.T)]
        x, w, positive = data[:, 2:] / data[:, 1:2], data[:, 1], data[:, 0] > 0
        circle = _Circle()
        model = _learn(x[positive], w[positive], x[~positive], w[~positive], steps, circle.add)
        circle.close()
        if circle.first:
            flat = np.concatenate([model.mean, model.scale, *(v.ravel() for v in model.layers), [model.prior]])
            yield pa.RecordBatch.from_arrays([pa.array([flat.tolist()])], ["model"])

    return run


def _slots(spark: SparkSession) -> int:
    """How many tasks can run at once."""
    sc = spark.sparkContext._jsc.sc()
    return max(1, sc.maxNumConcurrentTasks(sc.resourceProfileManager().defaultResourceProfile()))


def fit(vectors: DataFrame, labels: DataFrame, steps: int = 600) -> Model | None:
    """A model from vectors(doc_id, quality_x) and labels(doc_id, quality); None without positives.

    The cells stay on the executors: one task a slot holds its share, and each step's sums go around between them."""
    trusted = labels.where(F.col("quality") == 1).select("doc_id").distinct()
    sides = [cells(v).select(F.lit(k).cast("double").alias("positive"), "*") for k, v in ((1, vectors.join(trusted, "doc_id", "left_semi")), (0, vectors))]
    rows = settled(sides[0].union(sides[1]))
    if rows.where("positive = 1").isEmpty():
        return None
    n = min(_slots(vectors.sparkSession), MOST_TASKS)
    flat = np.array(rows.repartition(n).mapInArrow(_fit_share(steps), "model array<double>", barrier=True).collect()[0].model)
    k = len(FEATURES)
    mean, scale, w1, b1, w2, b2, prior = np.split(flat, np.cumsum([k, k, 16 * k, 16, 16, 1]))
    return Model(mean, scale, [w1.reshape(k, 16), b1, w2, b2], float(prior[0]))


def score(vectors: DataFrame, model: Model | None) -> DataFrame:
    """Replaces quality_x by quality_score."""
    at = [c.lower() for c in vectors.drop("quality_score").columns].index("quality_x")

    def make(batch: pa.RecordBatch) -> list[pa.Array]:
        x = batch.column(at).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, len(FEATURES))
        return [pa.array(model.score(x) if model is not None else np.full(len(x), 0.5))]

    return with_columns(vectors, "quality_score double", lambda: make, ("quality_x",), part=10_000)
