"""Quality classifier: random-indexing word vectors pooled per document, then a two-layer network in numpy.

Random indexing (Kanerva et al., 2000): every hashed word and every hashed word shape has a fixed sparse ternary index vector;
its word vector is the sum of the index vectors of its neighbours over the whole corpus, gathered by partial sums in every
task. A document is the mean and spread of its word vectors and the mean step from word to word. The network learns from a
bounded sample (TRAIN_ROWS labelled rows, drawn by hash of the id); a temperature fitted on held-back rows calibrates it.

Defined cases: null text counts as empty; empty texts score as a document of zero features; repeated rows give repeated
results; of the rows of one labelled doc_id the network learns from one, that of the smallest text; several labels of one doc_id count as the largest; with no labels of both kinds every score is 0.5.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE, Words, added_up, cut_at_space, sampled, slices
from .langid import softmax

BITS = 14
BUCKETS = 1 << BITS
DIM = 32
ONES = 4
WINDOW = 2
SLICE = 512
HIDDEN = 32
TRAIN_ROWS = 6000
#: Words whose contexts are summed, and whose vectors are pooled, at once.
AT_ONCE, PIECE = 1 << 17, 1 << 11
#: Characters hashed together; a text of more than LONG is read in parts.
PART, LONG = 100_000, 1_000_000


def index_vectors(seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    out = np.zeros((BUCKETS + 1, DIM), dtype=np.int8)  # the last row, zero, stands between documents
    for j in range(ONES):
        at = (rng.integers(0, DIM // ONES, BUCKETS) + j * (DIM // ONES)).astype(int)
        out[np.arange(BUCKETS), at] = rng.choice(np.array([-1, 1], dtype=np.int8), BUCKETS)
    return out


#: Shapes: lower-case ASCII letters and all bytes from 128 on as a, upper-case as A, digits as 0, white space as one sign.
KINDS = np.arange(256, dtype=np.uint8)
KINDS[[*range(ord("a"), ord("z") + 1), *range(128, 256)]] = ord("a")
KINDS[ord("A") : ord("Z") + 1] = ord("A")
KINDS[ord("0") : ord("9") + 1] = ord("0")
KINDS[SPACE] = ord(" ")


def shape(text: bytes) -> bytes:
    """The kinds of the signs, runs as one; words stay words."""
    k = KINDS[np.frombuffer(text, dtype=np.uint8)]
    keep = np.ones(len(k), dtype=bool)
    np.not_equal(k[1:], k[:-1], out=keep[1:])
    return k[keep].tobytes()


class Tokens:
    """Of the words of some texts: hash, bucket of the word and of its shape, text (owner), and each text's first word (begin)."""

    def __init__(self, texts: list[str | None]):
        w = Words(texts)
        self.hash, self.owner, self.begin = w.hash, w.owner, np.append(w.begin, len(w.hash))
        self.word = (w.hash >> np.uint64(64 - BITS)).astype(np.intp)
        self.shape = (Words([shape(w.data)]).hash >> np.uint64(64 - BITS)).astype(np.intp)


def context_sums(w: np.ndarray, index: np.ndarray, into: np.ndarray) -> None:
    """Add to each bucket of the sequence w the index vectors of its neighbours."""
    c = np.zeros((len(w), DIM), dtype=np.int8)  # at most 2 * WINDOW in size
    for d in range(1, WINDOW + 1):
        c[d:] += index[w[:-d]]
        c[:-d] += index[w[d:]]
    order = np.argsort(w.astype(np.uint16), kind="stable")
    sorted_w = w[order]
    starts = np.flatnonzero(np.concatenate(([True], sorted_w[1:] != sorted_w[:-1])))
    into[sorted_w[starts]] += np.add.reduceat(c[order], starts, axis=0, dtype=np.int64)


def few_context_sums(w: np.ndarray, index: np.ndarray, into: np.ndarray) -> None:
    """The same for sequences of few distinct buckets, by counting pairs first."""
    for d in range(1, WINDOW + 1):
        pair, n = np.unique(w[:-d] * (BUCKETS + 1) + w[d:], return_counts=True)
        a, b = np.divmod(pair, BUCKETS + 1)
        np.add.at(into, a, index[b] * n[:, None])
        np.add.at(into, b, index[a] * n[:, None])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(2, BUCKETS, DIM): unit vectors of hashed words and of hashed shapes, from every row of docs."""
    index = (index_vectors(71), index_vectors(72))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((2, BUCKETS + 1, DIM), dtype=np.int64)
        held: list[Tokens] = []
        n = 0

        def flush() -> None:
            for k, add_, name in ((0, context_sums, "word"), (1, few_context_sums, "shape")):
                rows = []
                for t in held:
                    x = np.full(len(t.owner) + WINDOW * len(t.begin), BUCKETS)
                    x[np.arange(len(t.owner)) + WINDOW * t.owner] = getattr(t, name)
                    rows.append(x)
                add_(np.concatenate(rows), index[k], sums[k])

        for batch in batches:
            for texts in groups(batch):
                held.append(Tokens(texts))
                n += len(held[-1].owner)
                if n >= AT_ONCE:
                    flush()
                    held, n = [], 0
        if held:
            flush()
        flat = sums[:, :BUCKETS].reshape(-1, SLICE * DIM)
        part = np.full(len(flat), TaskContext.get().partitionId(), dtype=np.int32)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat), dtype=np.int32)), pa.array(part), pa.array([x.astype("<i8").tobytes() for x in flat], pa.binary())], ["slice", "part", "sums"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros(SLICE * DIM, dtype=np.int64)
        for b in pdf["sums"]:
            total += np.frombuffer(b, dtype="<i8")
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "part": pdf["part"].iloc[:1], "sums": [total.tobytes()]})

    kind = "slice int, part int, sums binary"
    texts = docs.select("text")
    rows = added_up(texts.mapInArrow(run, kind), texts.rdd.getNumPartitions(), add, kind).collect()
    sums = np.zeros((2 * BUCKETS // SLICE, SLICE * DIM))
    for r in rows:
        sums[r.slice] = np.frombuffer(r.sums, dtype="<i8")
    v = sums.reshape(2, BUCKETS, DIM)
    v = v / np.maximum(np.linalg.norm(v, axis=2, keepdims=True), 1)
    v -= v.mean(axis=1, keepdims=True)
    return v.astype(np.float32)


def groups(batch: pa.RecordBatch) -> Iterator[list[str | None]]:
    """The texts of a batch, about PART characters at a time; a longer text comes in parts, each a list of its own."""
    for part in slices(batch, PART):
        texts = part["text"].to_pylist()
        if len(texts) == 1 and len(texts[0] or "") > LONG:
            yield from ([x] for x in cut_at_space(texts[0], LONG))
        else:
            yield texts


class Pool:
    """Sums over the words of one text, which come piece by piece."""

    def __init__(self):
        self.n, self.same, self.sums, self.last = 0, 0, np.zeros((3, 2 * DIM)), None

    def add(self, x: np.ndarray, h: np.ndarray) -> None:
        self.n += len(h)
        self.sums[0] += x.sum(axis=0)
        if self.last is not None:
            self.sums[2] += np.abs(x[0] - self.last[0])
            self.same += int(h[0] == self.last[1])
        self.last = x[-1].copy(), h[-1]
        self.same += int((h[1:] == h[:-1]).sum())
        step = x[1:] - x[:-1]
        np.abs(step, out=step)
        self.sums[2] += step.sum(axis=0)
        x *= x
        self.sums[1] += x.sum(axis=0)

    def row(self, chars: int) -> np.ndarray:
        if not self.n:
            return np.zeros(Features.SIZE)
        mean, steps = self.sums[0] / self.n, max(self.n - 1, 1)
        spread = np.sqrt(np.maximum(self.sums[1] / self.n - mean * mean, 0))
        return np.concatenate((mean, spread, self.sums[2] / steps, [self.same / steps, np.log1p(self.n) / 10, min(chars / self.n, 40) / 10]))


class Features:
    """Pooled vectors of whole texts."""

    SIZE = 6 * DIM + 3

    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors

    def pool(self, into: Pool, t: Tokens, begin: int, end: int) -> None:
        for at in range(begin, end, PIECE):
            some = slice(at, min(end, at + PIECE))
            x = np.empty((some.stop - at, 2 * DIM), dtype=np.float32)
            x[:, :DIM] = self.vectors[0].take(t.word[some], axis=0)
            x[:, DIM:] = self.vectors[1].take(t.shape[some], axis=0)
            into.add(x, t.hash[some])

    def all(self, texts: list[str | None]) -> np.ndarray:
        """A row for each text; short texts are hashed together, very long ones part by part."""
        out = np.zeros((len(texts), self.SIZE))
        chars = np.array([len(t or "") for t in texts], dtype=np.int64)
        total, at = np.cumsum(chars), 0
        while at < len(texts):
            to = max(at + 1, int(np.searchsorted(total, total[at] - chars[at] + PART)))
            if to == at + 1 and chars[at] > LONG:
                pool = Pool()
                for part in cut_at_space(texts[at], LONG):
                    t = Tokens([part])
                    self.pool(pool, t, 0, len(t.hash))
                out[at] = pool.row(chars[at])
            else:
                t = Tokens(texts[at:to])
                for i in range(at, to):
                    pool = Pool()
                    self.pool(pool, t, int(t.begin[i - at]), int(t.begin[i - at + 1]))
                    out[i] = pool.row(chars[i])
            at = to
        return out


class Network:
    def __init__(self, center, scale, w1, b1, w2, b2, temperature=1.0):
        self.center, self.scale, self.w1, self.b1, self.w2, self.b2, self.temperature = center, scale, w1, b1, w2, b2, temperature

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.maximum(((x - self.center) / self.scale) @ self.w1 + self.b1, 0) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return softmax(self.logits(x) / self.temperature)[:, 1]


def train(x: np.ndarray, y: np.ndarray, epochs: int = 40, rate: float = 2e-3, seed: int = 7) -> Network:
    """Two layers, by Adam on minibatches; a fifth of the rows is held back for the temperature."""
    rng = np.random.default_rng(seed)
    if len(set(y.tolist())) < 2:
        return Network(0.0, 1.0, np.zeros((Features.SIZE, HIDDEN)), np.zeros(HIDDEN), np.zeros((HIDDEN, 2)), np.zeros(2))
    held = rng.random(len(y)) < 0.2
    if not held.any() or held.all():
        held[:] = False
    a, t = x[~held], y[~held]
    net = Network(a.mean(axis=0), a.std(axis=0) + 1e-3, rng.normal(0, np.sqrt(2 / x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 0.1, (HIDDEN, 2)), np.zeros(2))
    a = (a - net.center) / net.scale
    names = ("w1", "b1", "w2", "b2")
    m, v, step = {k: 0 * getattr(net, k) for k in names}, {k: 0 * getattr(net, k) for k in names}, 0
    for _ in range(epochs):
        order = rng.permutation(len(t))
        for at in range(0, len(t), 64):
            i = order[at : at + 64]
            h = np.maximum(a[i] @ net.w1 + net.b1, 0)
            g = softmax(h @ net.w2 + net.b2)
            g[np.arange(len(i)), t[i]] -= 1
            g /= len(i)
            back = (g @ net.w2.T) * (h > 0)
            grads = {"w1": a[i].T @ back + 1e-4 * net.w1, "b1": back.sum(axis=0), "w2": h.T @ g + 1e-4 * net.w2, "b2": g.sum(axis=0)}
            step += 1
            for k in names:
                m[k] = 0.9 * m[k] + 0.1 * grads[k]
                v[k] = 0.999 * v[k] + 0.001 * grads[k] ** 2
                setattr(net, k, getattr(net, k) - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8))
    if held.any():
        z, t = net.logits(x[held]), y[held]
        nll = {q: -np.log(softmax(z / q)[np.arange(len(t)), t] + 1e-12).mean() for q in (0.5, 0.7, 1, 1.4, 2, 3, 4, 6)}
        net.temperature = min(nll, key=nll.get)
    return net


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from every row of docs; the network from a sample of docs with labels(doc_id, quality)."""
    vectors = word_vectors(docs)
    known = labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    counts = known.groupBy("quality").agg(F.count("*").alias("n"))
    few = sampled(known, counts, "quality", train_rows // 2, 7, ["doc_id"])
    # at most about train_rows rows by construction, hence the broadcast; an id of several rows counts with one of its texts
    rows = docs.select("doc_id", "text").join(F.broadcast(few), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).collect()
    rows.sort(key=lambda r: (r.doc_id, r.text or ""))
    return vectors, train(Features(vectors).all([r.text for r in rows]), np.array([r.quality for r in rows], dtype=int))


def score(docs: DataFrame, vectors: np.ndarray, net: Network) -> DataFrame:
    """Rows (doc_id, score, predicted) for every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = Features(vectors)
        for batch in batches:
            s = net.score(features.all(batch["text"].to_pylist())) if len(batch) else np.empty(0)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(s), pa.array((s >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, score double, predicted int")
