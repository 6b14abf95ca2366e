"""LM scoring: a hashed maximum-entropy model with a class-factored softmax, beside an exact unigram base.

P(word | history) = P(class | history) P(leaf | class, history) P(word | leaf). The TOP most frequent tokens of the corpus are
classes of their own, the others share REST classes by the hash of their ending. P(class | history) is a maximum-entropy model
over hashed features: the previous word, the previous two, and the one before the previous (a skip). Below a class its words are
the leaves of a binary tree by bits of their hash; each inner node is a two-way maximum-entropy model over the same features,
whose bias is the exact share of its sides, so that P(leaf | class, history) is a trained, normalised factor too. Words of one leaf
share it by their add-one counts. Leaves, weights and class buckets grow with the cube root of the tokens (Shape), so that what a
task holds stays within memory: 2^21 weights at 30 GB, 2^25 at 100 TB.

The weights are trained by distributed gradient updates: in every round each task runs minibatch Adagrad over its training
documents from the common weights and returns its change; a weight's changes, weighted by tokens, are averaged over the tasks that
moved it (iterative parameter mixing), in a tree of groups of tasks. A training task holds the weights once, Adagrad's sums and
one minibatch; the common weights travel from the second round on (the first begins at zero), changes leave a slice at a time, and
blocks come a few at a time.

Texts are read once: every task turns its documents into blocks of about BLOCK characters (the block's distinct words as 64-bit
hashes, each token as a place among them), which are written and then serve counting, training and scoring. Counts are exact over
all training documents but for words of equal hash (among 10^9 distinct words, 3 in 100 corpora have such a pair). Words meet by
hash once, and only totals of words that occur in several blocks travel back, so nothing of the vocabulary's size is ever
broadcast or collected.

Defined cases: null text counts as empty: one token, the end; ties among top words go to the smaller hash; repeated rows, equal ids
and null ids are scored and counted each; a text longer than a block is a block of its own; with nothing to learn from, N and V
are 0 and both scores follow the same formulas.
"""

from __future__ import annotations

from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Words, added_up, crc_fold, cut_at_space, materialize, slices

TOP, REST = 4, 12
CLASSES = TOP + REST
FEATURES = 3
ROUNDS = 1
RATE = 0.2
#: Tokens of a minibatch at least, and tokens handled at once.
BATCH, AT_ONCE = 1 << 16, 1 << 12
#: Characters of text a block holds about.
BLOCK = 4_000_000
#: A text of more characters is read in parts.
LONG = 1_000_000
#: Weights in a row of a change.
SLICE = 1 << 15
#: Bytes of blocks, texts or changes that travel to Python at once, about; a larger row travels alone.
AT_ONCE_BYTES = 1 << 22
END = np.uint64(0x5851F42D4C957F2D)
M1, M2 = np.uint32(0x9E3779B1), np.uint32(0x85EBCA77)


class Shape:
    """Sizes that follow the number of tokens."""

    def __init__(self, tokens: int):
        root = round(max(tokens, 0) ** (1 / 3))
        self.levels = max(0, (32 * root // REST).bit_length() - 1)
        self.weight_bits = max(16, (2048 * root).bit_length() - 1)
        self.bucket_bits = max(14, (128 * root).bit_length() - 1)
        self.leaves = REST << self.levels

    def leaf(self, h: np.ndarray, k: np.ndarray) -> np.ndarray:
        """Leaf of words of the REST classes k with hashes h."""
        code = (h >> np.uint64(64 - self.levels)).astype(np.int64) if self.levels else np.zeros(len(h), dtype=np.int64)
        return ((k.astype(np.int64) - TOP) << self.levels) + code


def rest_class(word: bytes) -> int:
    return TOP + crc32(word[-2:]) % REST


def ending_classes() -> np.ndarray:
    """rest_class by the last byte and, times 256, the byte before; the second half is for words of one byte."""
    two = [rest_class(bytes((c >> 8, c & 255))) for c in range(1 << 16)]
    return np.array(two + [rest_class(bytes((c,))) for c in range(256)], dtype=np.uint8)


class Tree:
    """The way from the root of its class to each leaf: hash, bias (log odds of the side taken) and side (1 or -1) of the nodes."""

    def __init__(self, leaf_mass: np.ndarray, shape: Shape):
        code = np.arange(shape.leaves)
        within, tree = code & ((1 << shape.levels) - 1), (code >> shape.levels) << shape.levels
        n = (shape.leaves, shape.levels)
        self.hash, self.bias, self.side = np.empty(n, np.uint32), np.empty(n, np.float32), np.empty(n, np.float32)
        mass = leaf_mass.reshape(REST, -1).astype(np.float64)
        for d in range(shape.levels - 1, -1, -1):
            left, right = mass[:, 0::2], mass[:, 1::2]
            odds = np.zeros((REST, 1 << shape.levels))
            odds[:, 1 << d : 2 << d] = np.log(right / left)
            mass = left + right
            at = tree + ((1 << d) | (within >> (shape.levels - d)))
            self.hash[:, d] = at.astype(np.uint32) * M2
            self.side[:, d] = (within >> (shape.levels - d - 1) & 1) * 2 - 1
            self.bias[:, d] = odds.ravel()[at] * self.side[:, d]


def histories(t: np.ndarray, first: np.ndarray) -> np.ndarray:
    """(FEATURES, n) hashes of each token's history; t: 32-bit hashes of documents on end, first: where a document begins."""
    n = len(t)
    one, two = np.ones(n, dtype=np.uint32), np.full(n, 2, dtype=np.uint32)
    one[1:] = t[:-1]
    two[2:] = t[:-2]
    one[first] = 1
    two[first] = 2
    two[1:][first[:-1]] = 2
    x = np.empty((FEATURES, n), dtype=np.uint32)
    x[0] = one * M1
    x[1] = ((two * M2) ^ one) * M1
    x[2] = (two + np.uint32(3)) * M2
    x ^= x >> np.uint32(15)
    return x


def node_places(x: np.ndarray, tree: Tree, leaf: np.ndarray, shape: Shape) -> list[np.ndarray]:
    """For each feature the (n, levels) places of the weights on the way to the leaves."""
    way, shift = tree.hash[leaf], np.uint32(32 - shape.weight_bits)
    return [(((h[:, None] ^ way) * M1) >> shift).astype(np.intp) for h in x]


def side_odds(nodes: np.ndarray, tree: Tree, leaf: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
    """(n, levels) log odds of the sides taken."""
    z = nodes.take(places[0])
    for p in places[1:]:
        z += nodes.take(p)
    z *= tree.side[leaf]
    z += tree.bias[leaf]
    return z


def log_leaves(nodes: np.ndarray, tree: Tree, shape: Shape, x: np.ndarray, leaf: np.ndarray) -> np.ndarray:
    """Natural log-probabilities of the leaves within their classes after histories x."""
    z = side_odds(nodes, tree, leaf, node_places(x, tree, leaf, shape))
    return -np.log1p(np.exp(np.minimum(-z, 80))).sum(axis=1, dtype=np.float64)


def shares(weights: np.ndarray, bias: np.ndarray, f: np.ndarray) -> np.ndarray:
    """(n, CLASSES) probabilities of the classes after histories in buckets f."""
    z = weights.take(f[0], axis=0)
    for j in range(1, FEATURES):
        z += weights.take(f[j], axis=0)
    z += bias
    np.minimum(z, 60, out=z)
    np.exp(z, out=z)
    z /= (z @ np.ones(CLASSES, dtype=z.dtype))[:, None]
    return z


def parted(flat: np.ndarray, shape: Shape) -> tuple[np.ndarray, np.ndarray]:
    """Class weights and node weights, views of all weights on end."""
    classes = CLASSES << shape.bucket_bits
    return flat[:classes].reshape(-1, CLASSES), flat[classes:]


class Trainer:
    """Minibatch Adagrad from given weights."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray, nodes: np.ndarray, tree: Tree, shape: Shape):
        self.flat = np.empty(weights.size + nodes.size, dtype=np.float32)
        self.weights, self.nodes = parted(self.flat, shape)
        self.weights[:], self.nodes[:] = weights, nodes
        self.bias, self.tree, self.shape = bias.copy(), tree, shape
        self.seen, self.seen_nodes = np.ones(len(weights), dtype=np.float32), np.ones(len(nodes), dtype=np.float32)
        self.sums = np.zeros(len(nodes), dtype=np.float32)
        self.batch = max(BATCH, len(weights), len(nodes) >> 5)
        self.f = np.empty((FEATURES, self.batch + AT_ONCE), dtype=np.intp)
        self.g = np.empty((CLASSES, self.batch + AT_ONCE), dtype=np.float32)
        self.n = self.waiting = 0

    def add(self, x: np.ndarray, c: np.ndarray, leaf: np.ndarray) -> None:
        """Gradients of some tokens, AT_ONCE at most; an update once a minibatch is full."""
        f = (x >> np.uint32(32 - self.shape.bucket_bits)).astype(np.intp)
        g = shares(self.weights, self.bias, f)
        g[np.arange(len(c)), c] -= 1
        to = slice(self.waiting, self.waiting + len(c))
        self.f[:, to], self.g[:, to] = f, g.T
        own = c >= TOP
        if self.shape.levels and own.any():
            x, leaf = x[:, own], leaf[own]
            places = node_places(x, self.tree, leaf, self.shape)
            z = side_odds(self.nodes, self.tree, leaf, places)
            up = (self.tree.side[leaf] / (-1 - np.exp(np.minimum(z, 80)))).ravel()
            for p in places:
                np.add.at(self.sums, p.ravel(), up)
        self.n += len(c)
        self.waiting += len(c)
        if self.waiting >= self.batch:
            self.update()

    def update(self) -> None:
        if not self.waiting:
            return
        f, g = self.f[:, : self.waiting], self.g[:, : self.waiting]
        total = np.empty((CLASSES, len(self.weights)), dtype=np.float32)
        for k in range(CLASSES):
            own = g[k].astype(np.float64)
            total[k] = sum(np.bincount(f[j], weights=own, minlength=len(self.weights)) for j in range(FEATURES))
        self.seen += np.einsum("ij,ij->j", total, total) / CLASSES
        total *= RATE / np.sqrt(self.seen)
        self.weights -= total.T
        self.bias -= 0.02 * g.mean(axis=1)
        for at in range(0, len(self.nodes), SLICE):
            some = slice(at, at + SLICE)
            sums = self.sums[some]
            self.seen_nodes[some] += sums * sums
            self.nodes[some] -= RATE * sums / np.sqrt(self.seen_nodes[some])
        self.sums[:] = 0
        self.waiting = 0


class Block:
    """Some documents' tokens: hashes and classes of the distinct words, and for each token its word and whether a document begins."""

    @classmethod
    def of(cls, batch: pa.RecordBatch, i: int, top: np.ndarray, shape: Shape) -> Block:
        vocab, kind, at = (batch[c][i].as_py() for c in ("vocab", "kind", "at"))
        return cls(vocab, kind, at, batch["sizes"][i].values.to_numpy(), top, shape)

    def __init__(self, vocab: bytes, kind: bytes, at: bytes, size: np.ndarray, top: np.ndarray, shape: Shape):
        h = np.frombuffer(vocab, dtype="<u8")
        self.kind, self.at, self.size = np.frombuffer(kind, dtype=np.uint8).astype(np.intp), np.frombuffer(at, dtype="<u4").astype(np.intp), size
        self.leaf = shape.leaf(h, self.kind)
        for k, t in enumerate(top):
            self.kind[h == t] = k
        self.short = (h >> np.uint64(16)).astype(np.uint32)
        self.first = np.zeros(len(self.at), dtype=bool)
        self.first[np.cumsum(size) - size] = True

    def pieces(self) -> Iterator[tuple[slice, np.ndarray]]:
        """(tokens, histories) about AT_ONCE tokens at a time."""
        for at in range(0, len(self.at), AT_ONCE):
            lead, to = min(at, 2), min(len(self.at), at + AT_ONCE)
            yield slice(at, to), histories(self.short[self.at[at - lead : to]], self.first[at - lead : to])[:, lead:]


def hashed(texts: list[str | None], endings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes and classes by ending of the tokens of some texts, each with its end, and each text's number of tokens."""
    w = Words([(t or "").encode("utf-8", "surrogatepass").lower() for t in texts])
    data = np.frombuffer(w.data, dtype=np.uint8)
    code = data[w.end - 1].astype(np.int64)
    code += np.where(w.end - w.start > 1, data[np.maximum(w.end - 2, 0)].astype(np.int64) << 8, 1 << 16)
    size = np.bincount(w.owner, minlength=len(texts)) + 1
    is_end = np.zeros(int(size.sum()), dtype=bool)
    is_end[np.cumsum(size) - 1] = True
    h, k = np.full(len(is_end), END), np.full(len(is_end), rest_class(b""), dtype=np.uint8)
    h[~is_end], k[~is_end] = w.hash, endings[code]
    return h, k, size


def hashed_long(text: str, endings: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same of one long text, in parts of about LONG characters cut at white space."""
    h, k = [], []
    for part in cut_at_space(text, LONG):
        a, b, _ = hashed([part], endings)
        h.append(a[:-1]), k.append(b[:-1])
    h.append(a[-1:]), k.append(b[-1:])
    h = np.concatenate(h)
    return h, np.concatenate(k), np.array([len(h)])


def coded(docs: DataFrame, modulus: int, held: int) -> DataFrame:
    """docs(doc_id, text) as blocks: ids, sizes in tokens and held_out of their documents; vocab (hashes), kind (classes by ending)
    and n (training count) of their distinct words; at: each token's place among these."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        endings, block = ending_classes(), TaskContext.get().partitionId() << 32
        ids, parts, chars = [], [], 0

        def full() -> pa.RecordBatch:
            who = pa.concat_arrays(ids)
            out = np.array([crc_fold(i, modulus) == held for i in who.to_pylist()], dtype=bool)
            size = np.concatenate([p[2] for p in parts])
            codes, vocab = pd.factorize(np.concatenate([p[0] for p in parts]))
            by = np.empty(len(vocab), dtype=np.uint8)
            by[codes] = np.concatenate([p[1] for p in parts])
            n = np.bincount(codes[np.repeat(~out, size)], minlength=len(vocab))
            lists = [pa.ListArray.from_arrays(pa.array([0, len(who)], pa.int32()), x) for x in (who, pa.array(size), pa.array(out))]
            data = [pa.array([x.tobytes()], pa.binary()) for x in (vocab.astype("<u8"), by, n.astype("<i8"), codes.astype("<u4"))]
            return pa.RecordBatch.from_arrays([pa.array([block]), *lists, *data], ["block", "ids", "sizes", "held_out", "vocab", "kind", "n", "at"])

        for batch in batches:
            for part in slices(batch, AT_ONCE * 32):
                texts = part["text"].to_pylist()
                parts.append(hashed_long(texts[0], endings) if len(texts) == 1 and len(texts[0] or "") > LONG else hashed(texts, endings))
                ids.append(part["doc_id"])
                chars += sum(len(t or "") for t in texts)
                if chars >= BLOCK:
                    yield full()
                    ids, parts, chars, block = [], [], 0, block + 1
        if ids:
            yield full()

    return docs.select("doc_id", "text").mapInArrow(run, f"block long, ids array<{kind}>, sizes array<long>, held_out array<boolean>, vocab binary, kind binary, n binary, at binary")


def gather(blocks: DataFrame) -> tuple[DataFrame, int, int, np.ndarray, np.ndarray, np.ndarray, Shape]:
    """(totals, N, V, top, class masses, leaf masses, shape): totals(block, place, total) for the words that several blocks have."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, vocab, kind, n in zip(b["block"].to_pylist(), b["vocab"].to_pylist(), b["kind"].to_pylist(), b["n"].to_pylist(), strict=True):
                h = np.frombuffer(vocab, dtype="<i8")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h), pa.array(np.frombuffer(kind, dtype=np.int8)), pa.array(np.full(len(h), block)), pa.array(np.arange(len(h), dtype=np.int32)), pa.array(np.frombuffer(n, dtype="<i8"))], ["h", "kind", "block", "place", "n"]
                )

    each = blocks.select("block", "vocab", "kind", "n").mapInArrow(words, "h long, kind byte, block long, place int, n long")
    by_word = Window.partitionBy("h")
    met = each.select("*", F.sum("n").over(by_word).alias("total"), F.count("*").over(by_word).alias("blocks"), F.min("block").over(by_word).alias("least"))
    first = F.col("block") == F.col("least")  # a word's hash is kept once
    met = met.select(F.when(first, F.col("h")).alias("h"), F.when(first, F.col("kind")).alias("kind"), "block", "place", "total", (F.col("blocks") > 1).alias("many"), first.alias("first"))
    met = materialize(met, "totals", compression="zstd", batch_bytes=AT_ONCE_BYTES)
    shape = Shape(blocks.select(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0)
    known = met.where("first and total > 0")
    code = F.shiftrightunsigned("h", 64 - shape.levels) if shape.levels else F.lit(0).cast("long")
    leaf = F.shiftleft(F.col("kind").cast("long") - TOP, shape.levels) + code
    sums = known.groupBy(leaf.alias("leaf")).agg(F.sum("total").alias("n"), F.count("*").alias("v")).toArrow()
    n, v = (sums[c].to_numpy().astype(np.int64) for c in ("n", "v"))
    leaf_mass = np.ones(shape.leaves)  # the unknown word of each leaf
    leaf_mass[sums["leaf"].to_numpy()] += n + v
    most = known.orderBy(F.desc("total"), "h").select("h", "kind", "total").limit(TOP).collect()
    top, mass = np.array([r.h for r in most], dtype=np.int64).view(np.uint64), np.zeros(CLASSES)
    for k, r in enumerate(most):
        mass[k] = r.total + 1
        leaf_mass[shape.leaf(top[k : k + 1], np.array([r.kind]))] -= r.total + 1
    mass[TOP:] = leaf_mass.reshape(REST, -1).sum(axis=1)
    return met.where("many").select("block", "place", "total"), int(n.sum()), int(v.sum()), top, mass, leaf_mass, shape


def train(blocks: DataFrame, top: np.ndarray, mass: np.ndarray, leaf_mass: np.ndarray, shape: Shape, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class weights, class bias and node weights after some rounds over every training document."""
    size = (CLASSES << shape.bucket_bits) + (1 << shape.weight_bits)
    flat = None  # zeros
    bias = np.log(np.maximum(mass, 1e-3) / max(mass.sum(), 1)).astype(np.float32)
    slices_ = max(1, size // SLICE)
    per = size // slices_
    kind = "slice int, part int, n long, total binary, weight binary"
    blocks = blocks.select("sizes", "held_out", "vocab", "kind", "at")

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        """Sums of changes times tokens and of the tokens behind them; a row without weight is a task's own change."""
        total = weight = None
        for n, a, b in sorted(zip(pdf["n"], pdf["total"], pdf["weight"], strict=True)):
            x = np.frombuffer(a, dtype="<f4" if b == b"" else "<f8")
            if total is None:
                total, weight = np.zeros(len(x)), np.zeros(len(x))
            total += x * float(n) if b == b"" else x
            weight += (x != 0) * float(n) if b == b"" else np.frombuffer(b, dtype="<f8")
        return pd.DataFrame({"slice": pdf["slice"].iloc[:1], "part": pdf["part"].iloc[:1], "n": [int(pdf["n"].sum())], "total": [total.tobytes()], "weight": [weight.tobytes()]})

    for _ in range(rounds):

        def run(batches: Iterator[pa.RecordBatch], start: np.ndarray | None = flat, b0: np.ndarray = bias) -> Iterator[pa.RecordBatch]:
            start = np.broadcast_to(np.float32(0), size) if start is None else start
            w0, v0 = parted(start, shape)
            t = Trainer(w0, b0, v0, Tree(leaf_mass, shape), shape)
            for batch in batches:
                for i in range(len(batch)):
                    block = Block.of(batch, i, top, shape)
                    learn = np.repeat(~batch["held_out"][i].values.to_numpy(zero_copy_only=False), block.size)
                    for some, x in block.pieces():
                        own = learn[some]
                        if own.any():
                            at = block.at[some][own]
                            t.add(x[:, own], block.kind[at], block.leaf[at])
            t.update()
            n, new, shift, part = t.n, t.flat, t.bias - b0, TaskContext.get().partitionId()
            del t
            for k in range(slices_ if n else 0):
                own = slice(k * per, (k + 1) * per)
                change = np.concatenate((new[own] - start[own], shift)).astype("<f4").tobytes()
                columns = [pa.array([k], pa.int32()), pa.array([part], pa.int32()), pa.array([n]), pa.array([change], pa.binary()), pa.array([b""], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["slice", "part", "n", "total", "weight"])

        rows = added_up(blocks.mapInArrow(run, kind), blocks.rdd.getNumPartitions(), add_up, kind)
        rows = materialize(rows.select("slice", "total", "weight"), "changes", batch_bytes=AT_ONCE_BYTES).collect()
        flat, bias = np.zeros(size, dtype=np.float32) if flat is None else flat.copy(), bias.copy()
        for r in rows:
            x = np.frombuffer(r.total, dtype="<f8") / np.maximum(np.frombuffer(r.weight, dtype="<f8"), 1)
            flat[r.slice * per : (r.slice + 1) * per] += x[:per]
            if r.slice == 0:
                bias += x[per:]
    weights, nodes = parted(np.zeros(size, dtype=np.float32) if flat is None else flat, shape)
    return weights, bias, nodes


class Model:
    def __init__(self, top: np.ndarray, leaf_mass: np.ndarray, n: int, v: int, shape: Shape, weights: np.ndarray, bias: np.ndarray, nodes: np.ndarray):
        """top: hashes of the most frequent tokens; leaf_mass: sum of count + 1 in each leaf; n, v: training tokens, distinct."""
        self.top, self.leaf_mass, self.n, self.v, self.shape = top, leaf_mass, n, v, shape
        self.weights, self.bias, self.nodes = weights, bias, nodes


def score_block(block: Block, count: np.ndarray, model: Model, tree: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(known tokens, base score, score) of a block's documents; count: of each word of the block."""
    own, log_leaf = np.log10(count + 1.0), np.log10(model.leaf_mass)
    base = own - np.log10(model.n + model.v + 1)
    inside = own - log_leaf[np.clip(block.leaf, 0, len(log_leaf) - 1)]
    score = np.empty(len(block.at))
    for some, x in block.pieces():
        at = block.at[some]
        k = block.kind[at]
        f = (x >> np.uint32(32 - model.shape.bucket_bits)).astype(np.intp)
        p = np.log(shares(model.weights, model.bias, f)[np.arange(len(k)), k] + 1e-30).astype(np.float64)
        rest = np.flatnonzero(k >= TOP)
        if model.shape.levels:
            p[rest] += log_leaves(model.nodes, tree, model.shape, x[:, rest], block.leaf[at[rest]])
        p /= np.log(10)
        p[rest] += inside[at[rest]]
        score[some] = p
    begin = np.cumsum(block.size) - block.size
    return np.add.reduceat((count > 0).astype(np.int64)[block.at], begin), np.add.reduceat(base[block.at], begin), np.add.reduceat(score, begin)


def score(docs: DataFrame, modulus: int = 7, held: int = 2) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of docs. Learns from the rows
    whose crc32 of the id modulo modulus is not held."""
    docs = docs.select("doc_id", "text")
    blocks = materialize(coded(docs, modulus, held), "blocks", compression="zstd", batch_bytes=AT_ONCE_BYTES)
    totals, n, v, top, mass, leaf_mass, shape = gather(blocks)
    model = Model(top, leaf_mass, n, v, shape, *train(blocks, top, mass, leaf_mass, shape))
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    names = [f.split()[0] for f in out.split(", ")]

    def run(own: pa.Table, answers: pa.Table) -> pa.Table:
        tree, done = Tree(model.leaf_mass, model.shape), []
        for batch in own.combine_chunks().to_batches():
            for i in range(len(batch)):  # one
                block = Block.of(batch, i, model.top, model.shape)
                count = np.frombuffer(batch["n"][i].as_py(), dtype="<i8").copy()
                count[answers["place"].to_numpy()] = answers["total"].to_numpy()
                known, base, s = score_block(block, count, model, tree)
                columns = [batch["ids"][i].values, batch["held_out"][i].values, batch["sizes"][i].values, known, np.full(len(s), model.n), base, s]
                done.append(pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns], names))
        return pa.Table.from_batches(done)

    return blocks.groupBy("block").cogroup(totals.groupBy("block")).applyInArrow(run, out)
