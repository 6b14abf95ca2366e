"""The epoch loop over the heads: mini-batch AdamW with warm-up, clipping, dropout and class weights, a history row an epoch, the best
weights kept on improvement, early stopping, and evaluation of what was kept.

The encoder's vectors are fixed, so the heads are the model. An update's batch is a share of the training rows by hash; its gradient
is summed in Arrow batches on the executors, added up before the shuffle's end by place, and only the sums, one number a
parameter, come to the driver. Rows are read once an update, so the table should be cached or small columns of Parquet.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ACCUMULATION, CLIP, DROPOUT, EPOCHS, LEARNING_RATE, MAX_LENGTH, PATIENCE, SEED, WARMUP, WEIGHT_DECAY
from ..sources.tables import append, write_json, write_table
from . import metrics
from .encode import class_weights
from .model import Head, batch_mean_loss, head_rows, heads_of, score
from .tokens import batched


@dataclass
class Settings:
    """updates: optimizer updates an epoch, each over a batch of that share of the rows, in ACCUMULATION parts."""

    epochs: int = EPOCHS
    patience: int = PATIENCE
    updates: int = 4
    rate: float = LEARNING_RATE
    decay: float = WEIGHT_DECAY
    warmup: float = WARMUP
    dropout: float = DROPOUT
    clip: float = CLIP
    accumulation: int = ACCUMULATION
    seed: int = SEED


@dataclass
class AdamW:
    """Decoupled weight decay (Loshchilov and Hutter, 2019)."""

    size: int
    settings: Settings
    step: int = 0
    m: np.ndarray = field(init=False)
    v: np.ndarray = field(init=False)

    def __post_init__(self):
        self.m, self.v = np.zeros(self.size), np.zeros(self.size)

    def update(self, w: np.ndarray, g: np.ndarray, rate: float) -> np.ndarray:
        self.step += 1
        self.m = 0.9 * self.m + 0.1 * g
        self.v = 0.999 * self.v + 0.001 * g * g
        w = w * (1 - rate * self.settings.decay)
        return w - rate * (self.m / (1 - 0.9**self.step)) / (np.sqrt(self.v / (1 - 0.999**self.step)) + 1e-8)


def factor(step: int, total: int, warm: int) -> float:
    """Of the rate: up over the warm-up, then down to zero."""
    return step / max(1, warm) if step < warm else max(0.0, (total - step) / max(1, total - warm))


def clipped(g: np.ndarray, most: float) -> np.ndarray:
    norm = float(np.linalg.norm(g))
    return g * (most / (norm + 1e-6)) if norm > most else g


def flat(heads: Mapping[str, Head]) -> np.ndarray:
    return np.concatenate([np.concatenate((np.array(h.weights, dtype=float), np.array(h.bias, dtype=float)[:, None]), axis=1).ravel() for h in heads.values()])


def unflat(w: np.ndarray, tasks: Mapping[str, Sequence[str]], width: int) -> dict[str, Head]:
    out, at = {}, 0
    for t, classes in tasks.items():
        part = w[at : at + len(classes) * (width + 1)].reshape(len(classes), width + 1)
        out[t] = Head(list(classes), part[:, :-1].tolist(), part[:, -1].tolist())
        at += part.size
    return out


def gradient(rows: DataFrame, key: str, features: str, tasks: Mapping[str, Sequence[str]], weights: Mapping[str, Sequence[float]], w: np.ndarray, width: int, dropout: float, seed: int) -> tuple[np.ndarray, float]:
    """(gradient, loss) of the sum over tasks of the class-weighted cross-entropy on rows(key, features, <task>_id), with inverted
    dropout of the features by a hash of key, place and seed."""
    sizes = [len(c) * (width + 1) for c in tasks.values()]
    starts = np.cumsum([0, *sizes])
    n_out = int(starts[-1]) + 2 * len(tasks)  # then loss and weight of each task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_out)
        for b in batches:
            if not len(b):
                continue
            x = np.array(b[features].to_pylist(), dtype=float)
            if dropout:
                h = b["__drop"].to_numpy().astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, width + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                h ^= h >> np.uint64(31)
                h *= np.uint64(0xBF58476D1CE4E5B9)
                x = np.where((h >> np.uint64(11)).astype(float) / (1 << 53) < dropout, 0, x / (1 - dropout))
            x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
            for k, (t, classes) in enumerate(tasks.items()):
                y = b[f"{t}_id"].to_numpy().astype(int)
                z = x @ w[starts[k] : starts[k + 1]].reshape(len(classes), width + 1).T
                z -= z.max(axis=1, keepdims=True)
                p = np.exp(z)
                p /= p.sum(axis=1, keepdims=True)
                own = np.array(weights[t], dtype=float)[y]
                total[n_out - 2 * len(tasks) + 2 * k] -= (own * np.log(p[np.arange(len(y)), y])).sum()
                total[n_out - 2 * len(tasks) + 2 * k + 1] += own.sum()
                p[np.arange(len(y)), y] -= 1
                total[starts[k] : starts[k + 1]] += ((p * own[:, None]).T @ x).ravel()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n_out, dtype=np.int32)), pa.array(total)], ["place", "value"])

    some = rows.select(features, *(f"{t}_id" for t in tasks), F.xxhash64(F.col(key), F.lit(seed)).alias("__drop"))
    sums = np.zeros(n_out)
    for r in some.mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect():
        sums[r.place] = r.value
    loss = 0.0
    for k in range(len(tasks)):
        a, n = sums[n_out - 2 * len(tasks) + 2 * k :][:2]
        loss += a / n if n else 0.0
        sums[starts[k] : starts[k + 1]] /= n or 1.0
    return sums[: starts[-1]], float(loss)


def evaluate(df: DataFrame, features: str, key: str, heads: Mapping[str, Head], weights: Mapping[str, Sequence[float]]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(one row loss: the mean of the batches' losses; rows (task, macro_f1); rows (task, y, p)) of the heads on df."""
    scored = score(df, features, heads)
    yp = metrics.pairs(scored, list(heads))
    classes = {t: h.classes for t, h in heads.items()}
    loss = batch_mean_loss(batched(scored, key), weights)
    return loss, metrics.macro_f1_observed(metrics.per_class(yp, classes)), yp


def checkpoint_record(epoch: int, best: float, tasks: Mapping[str, Sequence[str]], name: str) -> dict:
    return {"epoch": epoch, "best_val_macro_f1": best, "config": {"model_name": name, "max_length": MAX_LENGTH, "tasks": {t: list(c) for t, c in tasks.items()}}}


def production_record(best: float, tasks: Mapping[str, Sequence[str]], name: str, dropout: float = DROPOUT) -> dict:
    """What a service needs beside the weights."""
    return {"base_model": name, "max_length": MAX_LENGTH, "dropout": dropout, "tasks": {t: list(c) for t, c in tasks.items()}, "selection_metric": "mean_validation_macro_f1", "best_validation_macro_f1": best}


def fit(train: DataFrame, val: DataFrame, key: str, features: str, tasks: Mapping[str, Sequence[str]], folder: str, settings: Settings | None = None, name: str = "heads") -> tuple[dict[str, Head], list[dict]]:
    """Train on df(key, features, <task>, <task>_id); (the best heads as read back from folder, history). folder gets best (weights),
    best_metadata, history and production."""
    s, spark = settings or Settings(), train.sparkSession
    first = train.select(F.size(features).alias("n")).first()
    if first is None:
        raise ValueError("nothing to train on")
    width = first.n
    table = {(r.task, r.label): r.weight for r in class_weights(train, tasks).collect()}
    weights = {t: [table[t, c] for c in cs] for t, cs in tasks.items()}
    w = np.random.default_rng(s.seed).normal(0, 0.02, sum(len(c) * (width + 1) for c in tasks.values()))
    total = s.updates * s.epochs
    warm, step, adam = int(total * s.warmup), 0, AdamW(len(w), s)
    best, bad, history = -np.inf, 0, []
    for epoch in range(1, s.epochs + 1):
        losses = []
        for k in range(s.updates):
            g, loss = np.zeros(len(w)), 0.0
            for part in range(s.accumulation):
                at = F.pmod(F.xxhash64(F.col(key), F.lit(s.seed + epoch)), F.lit(s.updates * s.accumulation)) == k * s.accumulation + part
                own, cost = gradient(train.where(at), key, features, tasks, weights, w, width, s.dropout, s.seed + 1000 * epoch)
                g, loss = g + own / s.accumulation, loss + cost / s.accumulation
            w = adam.update(w, clipped(g, s.clip), s.rate * factor(step, total, warm))
            step += 1
            losses.append(loss)
        heads = unflat(w, tasks, width)
        loss, f1, _ = evaluate(val, features, key, heads, weights)
        by = {r.task: r.macro_f1 for r in f1.collect()}
        mean = float(np.mean([by.get(t, 0.0) for t in tasks]))
        row = {"epoch": epoch, "train_loss": float(np.mean(losses)), "val_loss": loss.first()[0], "mean_macro_f1": mean, **{f"{t}_macro_f1": by.get(t, 0.0) for t in tasks}}
        history.append(row)
        kind = "epoch int, " + ", ".join(f"`{c}` double" for c in row if c != "epoch")
        append(spark.createDataFrame([tuple(row.values())], kind), f"{folder}/history")
        if mean > best:
            best, bad = mean, 0
            write_table(head_rows(spark, heads), f"{folder}/best")
            write_json(spark, checkpoint_record(epoch, best, tasks, name), f"{folder}/best_metadata")
        else:
            bad += 1
            if bad >= s.patience:
                break
    write_json(spark, production_record(best, tasks, name, s.dropout), f"{folder}/production")
    kept = heads_of(spark.read.parquet(f"{folder}/best"))
    return {t: kept[t] for t in tasks}, history
