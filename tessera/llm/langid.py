"""Language identification: averaged hashed subword embeddings with a linear softmax (Joulin et al., 2016), in numpy.

A document is the mean of the embeddings of the hashed character n-grams of its words. Embeddings and softmax are trained
together by stochastic gradient descent on a bounded sample (TRAIN_ROWS documents a language, drawn by hash of the id);
temperature and rejection threshold come from a part of it that the training doesn't see. For prediction the two linear
layers fold into one score a bucket and language, summed over whole texts.

Defined cases: null text or a text without a letter is `und` with score 0 and rejected; ties go to the first language in
sorted order; repeated rows give repeated results; with nothing to learn from, every text is `und`.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TokenTable, has_letter, sampled

BUCKETS = 1 << 15
DIM = 16
SIZES = (1, 2, 3, 4)
TRAIN_ROWS = 500
#: Words of the random windows of a training text that the training sees beside the whole text.
WINDOWS = (30, 6, 1)
#: Share of calibration texts that the threshold may reject, and the highest threshold.
REJECT, HIGHEST = 0.001, 0.5
#: Words looked up at once.
AT_ONCE = 1 << 15
LETTERS = re.compile(r"[^\W\d_]+")


def subwords(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every n-gram of the tokens' words (lower case, between < and >) and the number of n-grams of each token."""
    marked = ["".join(f"<{w}>" for w in LETTERS.findall(t.lower())) for t in tokens]
    size = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    c = np.frombuffer("".join(marked).encode("utf-32-le", "replace"), dtype="<u4").astype(np.uint64)
    owner = np.repeat(np.arange(len(tokens)), size)
    word = np.cumsum(c == ord("<"))
    grams, owners = [], []
    h = np.zeros(len(c), dtype=np.uint64)
    for n in range(1, max(SIZES) + 1):
        m = len(c) - n + 1
        if m <= 0:
            break
        h = (h[:m] ^ c[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        if n in SIZES:
            whole = word[:m] == word[n - 1 :]
            if n == 1:
                whole &= (c != ord("<")) & (c != ord(">"))
            grams.append((h[whole] % np.uint64(BUCKETS)).astype(np.int64))
            owners.append(owner[:m][whole])
    if not grams:
        return np.empty(0, np.int64), np.zeros(len(tokens), np.int64)
    at = np.concatenate(owners)
    order = np.argsort(at, kind="stable")
    return np.concatenate(grams)[order], np.bincount(at, minlength=len(tokens))


def summed(rows: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive groups of rows."""
    total = np.concatenate((np.zeros((1, rows.shape[1])), np.cumsum(rows, axis=0, dtype=np.float64)))
    end = np.cumsum(counts)
    return total[end] - total[end - counts]


class Model:
    """languages in sorted order; table: score of each bucket and language; bias, temperature, threshold."""

    def __init__(self, languages: list[str], table: np.ndarray, bias: np.ndarray, temperature: float = 1.0, threshold: float = 0.0):
        self.languages, self.table, self.bias = languages, table, bias
        self.temperature, self.threshold = temperature, threshold

    def token_table(self) -> TokenTable:
        def values(tokens: list[str]) -> np.ndarray:
            grams, counts = subwords(tokens)
            return np.column_stack((summed(self.table[grams], counts), counts))

        return TokenTable(values)

    def logits(self, texts: list[str], tokens: TokenTable) -> np.ndarray:
        tokens.begin()
        out = np.tile(self.bias, (len(texts), 1))
        held: list[tuple[int, list[str]]] = []

        def add() -> None:
            ids = tokens.look_up([w for _, words in held for w in words])
            starts = np.cumsum([0, *(len(words) for _, words in held[:-1])])
            total = np.add.reduceat(tokens.rows[ids], starts, axis=0)
            for (i, _), t in zip(held, total, strict=True):
                if t[-1]:
                    out[i] += t[:-1] / t[-1]

        n = 0
        for i, t in enumerate(texts):
            if words := t.split():
                held.append((i, words))
                n += len(words)
                if n > AT_ONCE:
                    add()
                    held, n = [], 0
        if held:
            add()
        return out

    def predict(self, texts: list[str | None], tokens: TokenTable) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated score and rejection of each text."""
        has = np.fromiter(map(has_letter, texts), dtype=bool, count=len(texts))
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), dtype=bool)
        p = softmax(self.logits([t or "" for t in texts], tokens) / self.temperature)
        best = p.argmax(axis=1)
        score = np.where(has, p[np.arange(len(p)), best], 0.0)
        return [self.languages[b] if h else "und" for b, h in zip(best, has, strict=True)], score, ~has | (score < self.threshold)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(texts: list[str], labels: list[str], epochs: int = 4, rate: float = 0.5, seed: int = 3) -> Model:
    """Fit on the whole texts and on short random windows of them, so that short texts are known as well as long ones."""
    languages = sorted(set(labels))
    if not languages:
        return Model([], np.zeros((BUCKETS, 0)), np.zeros(0))
    rng = np.random.default_rng(seed)
    bags, y = [], []
    for text, label in zip(texts, labels, strict=True):
        words = text.split()
        for n in (len(words), *WINDOWS):
            at = int(rng.integers(0, max(1, len(words) - n + 1)))
            count = np.zeros(BUCKETS, dtype=np.int64)
            for part in range(at, min(len(words), at + n), AT_ONCE):
                count += np.bincount(subwords(words[part : min(at + n, part + AT_ONCE)])[0], minlength=BUCKETS)
            bag = np.flatnonzero(count)
            count = count[bag]
            if len(bag):
                bags.append((bag, (count / count.sum()).astype(np.float32)))
                y.append(languages.index(label))
    y = np.array(y, dtype=int)
    held = rng.random(len(y)) < 0.2
    weight = 1 / np.maximum(np.bincount(y, minlength=len(languages)), 1)
    weight = weight[y] / weight[y].mean() if len(y) else weight
    emb = rng.uniform(-1, 1, (BUCKETS, DIM)).astype(np.float32) / DIM
    out, bias = np.zeros((DIM, len(languages)), dtype=np.float32), np.zeros(len(languages), dtype=np.float32)
    order = np.flatnonzero(~held)
    steps, total = 0, max(1, epochs * len(order))
    for _ in range(epochs):
        rng.shuffle(order)
        for i in order:
            bag, share = bags[i]
            x = share @ emb[bag]
            z = x @ out + bias
            g = np.exp(z - z.max())
            g /= g.sum()
            g[y[i]] -= 1
            g *= rate * (1 - steps / total) * min(4.0, weight[i])
            emb[bag] -= share[:, None] * ((out @ g) * 20)[None, :]
            out -= np.outer(x, g)
            bias -= g * 0.01
            steps += 1
    table = emb @ out
    model = Model(languages, table.astype(np.float32), bias.astype(np.float64))
    at = np.flatnonzero(held)
    if len(at):
        z = np.array([bags[i][1] @ table[bags[i][0]] + bias for i in at])
        nll = {t: -np.log(softmax(z / t)[np.arange(len(at)), y[at]] + 1e-12).mean() for t in (0.1, 0.2, 0.35, 0.5, 0.7, 1, 1.4, 2, 3)}
        model.temperature = min(nll, key=nll.get)
        p = softmax(z / model.temperature)
        right = p.argmax(axis=1) == y[at]
        model.threshold = float(min(HIGHEST, np.quantile(p.max(axis=1)[right], REJECT))) if right.any() else 0.0
    return model


def fit(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Train on a sample of the rows with a text with letters and a lang."""
    usable = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    counts = usable.groupBy("lang").agg(F.count("*").alias("n"))
    drawn = sampled(usable, counts, "lang", train_rows, 3, ["doc_id", "text", "lang"]).collect()
    rows = [r for r in drawn if has_letter(r.text)]
    rows.sort(key=lambda r: (str(r.doc_id), r.text, r.lang))
    return train([r.text for r in rows], [r.lang for r in rows])


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Rows (doc_id, lang_pred, score, rejected) for every row of docs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = model.token_table()
        for batch in batches:
            lang, score, rejected = model.predict(batch["text"].to_pylist(), tokens)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(lang, pa.string()), pa.array(score), pa.array(rejected)], ["doc_id", "lang_pred", "score", "rejected"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def keep_identified(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of docs, all columns, whose text the model doesn't reject."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = model.token_table()
        for batch in batches:
            yield batch.filter(pa.array(~model.predict(batch["text"].to_pylist(), tokens)[2]))

    return docs.mapInArrow(run, docs.schema)
