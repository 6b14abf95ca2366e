"""Heads over a shared feature vector: scoring, loss, schedule, history, and training with MLlib.

Fine-tuning a text encoder isn't reproduced: each task is a multinomial logistic regression on fixed vectors.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..config import ACCUMULATION, EPOCHS, PATIENCE, WARMUP
from ..functions.arrays import argmax, label_of, linear, softmax
from .encode import class_weights


@dataclass(frozen=True)
class Head:
    classes: Sequence[str]
    weights: Sequence[Sequence[float]]
    bias: Sequence[float]

    @property
    def size(self) -> int:
        """Number of parameters."""
        return sum(map(len, self.weights)) + len(self.bias)


def score(df: DataFrame, features: str, heads: Mapping[str, Head]) -> DataFrame:
    """df with <task>_logits, <task>_probs and <task>_pred for every head, in one pass."""
    out = df.withColumns({f"{t}_logits": linear(F.col(features), h.weights, h.bias) for t, h in heads.items()})
    out = out.withColumns({f"{t}_probs": softmax(F.col(f"{t}_logits")) for t in heads})
    return out.withColumns({f"{t}_pred": argmax(F.col(f"{t}_logits")) for t in heads})


def prediction(probs: Column, classes: Sequence[str]) -> Column:
    """(label, confidence, probabilities) of one task."""
    return F.struct(
        label_of(argmax(probs), classes).alias("label"), F.array_max(probs).alias("confidence"),
        F.map_from_arrays(F.array(*map(F.lit, classes)), probs).alias("probabilities"),
    )


def predictions(scored: DataFrame, heads: Mapping[str, Head], name: str = "prediction") -> DataFrame:
    """scored with a map: task -> (label, confidence, probabilities). Heads may differ in their classes."""
    pairs = [x for t, h in heads.items() for x in (F.lit(t), prediction(F.col(f"{t}_probs"), h.classes))]
    return scored.withColumn(name, F.create_map(*pairs))


def weighted_loss(truth: Column, probs: Column, weights: Sequence[float]) -> tuple[Column, Column]:
    """Weighted negative log-likelihood of a row, and its weight; a group's loss is the ratio of their sums."""
    w = F.element_at(F.array(*(F.lit(float(x)) for x in weights)), truth.cast("int") + 1)
    return -F.log(F.element_at(probs, truth.cast("int") + 1)) * w, w


def losses(scored: DataFrame, tasks: Mapping[str, Sequence[float]], *by: str) -> DataFrame:
    """Rows (by..., one loss a task, loss: their plain sum); tasks: class weights. truth is <task>_id, scores <task>_probs."""
    parts = {t: weighted_loss(F.col(f"{t}_id"), F.col(f"{t}_probs"), w) for t, w in tasks.items()}
    out = scored.groupBy(*by).agg(*((F.sum(a) / F.sum(b)).alias(t) for t, (a, b) in parts.items()))
    total = F.lit(0.0)
    for t in tasks:
        total = total + F.col(t)
    return out.withColumn("loss", total)


def batch_mean_loss(scored: DataFrame, tasks: Mapping[str, Sequence[float]], batch: str = "batch") -> DataFrame:
    """One row: the plain mean of the batches' losses; a short last batch weighs as much as a full one."""
    return losses(scored, tasks, batch).agg(F.avg("loss").alias("loss_batch_mean"))


def updates(batches: int, epochs: int = EPOCHS, accumulation: int = ACCUMULATION, warmup: float = WARMUP) -> tuple[int, int]:
    """Optimizer updates in all, and those of the warm-up."""
    total = -(-batches // accumulation) * epochs
    return total, int(total * warmup)


def schedule(spark: SparkSession, total: int, warm: int) -> DataFrame:
    """Rows (step, factor): the rate rises linearly over the warm-up, then falls linearly to zero."""
    u = F.col("step").cast("double")
    fall = F.greatest(F.lit(0.0), (total - u) / F.lit(float(max(1, total - warm))))
    return spark.range(total + 1).select(F.col("id").alias("step")).withColumn("factor", F.when(u < warm, u / float(max(1, warm))).otherwise(fall))


def marked_history(history: DataFrame, score_column: str = "mean_macro_f1", patience: int = PATIENCE) -> DataFrame:
    """history(epoch, score) with best_before, improved (strictly), bad_epochs in a row and stopped: the run ends at the first
    epoch with patience bad epochs. A history has one row an epoch, so one task orders it."""
    order = W.partitionBy().orderBy("epoch")
    out = history.withColumn("best_before", F.max(score_column).over(order.rowsBetween(W.unboundedPreceding, -1)))
    out = out.withColumn("improved", F.col("best_before").isNull() | (F.col(score_column) > F.col("best_before")))
    out = out.withColumn("__run", F.sum(F.col("improved").cast("int")).over(order))
    out = out.withColumn("bad_epochs", F.sum((~F.col("improved")).cast("int")).over(W.partitionBy("__run").orderBy("epoch")))
    stop = F.min(F.when(F.col("bad_epochs") >= patience, F.col("epoch"))).over(W.partitionBy())
    return out.withColumn("stop_epoch", stop).drop("__run")


def best_epoch(history: DataFrame, score_column: str = "mean_macro_f1", patience: int = PATIENCE) -> DataFrame:
    """One row (best_epoch, best_score, last_epoch): the first best of the epochs that the run came to."""
    run = marked_history(history, score_column, patience).where("stop_epoch is null or epoch <= stop_epoch")
    best = F.max(F.struct(F.col(score_column).alias("s"), (-F.col("epoch")).alias("e"))).alias("best")
    return run.agg(best, F.max("epoch").alias("last_epoch")).select((-F.col("best.e")).alias("best_epoch"), F.col("best.s").alias("best_score"), "last_epoch")


def train_heads(df: DataFrame, features: str, tasks: Mapping[str, Sequence[str]], regularization: float = 0.01, iterations: int = 50) -> dict[str, Head]:
    """One class-weighted multinomial logistic regression a task, on df(<features> array, <task>, <task>_id)."""
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector

    weights = {(r.task, r.label): r.weight for r in class_weights(df, tasks).collect()}
    rows = df.withColumn("__x", array_to_vector(F.transform(features, lambda v: v.cast("double"))))
    out = {}
    for t, classes in tasks.items():
        w = F.element_at(F.array(*(F.lit(float(weights[t, c])) for c in classes)), F.col(f"{t}_id").cast("int") + 1)
        fit = LogisticRegression(featuresCol="__x", labelCol="__y", weightCol="__w", family="multinomial", regParam=regularization, maxIter=iterations, standardization=False)
        model = fit.fit(rows.select("__x", F.col(f"{t}_id").cast("double").alias("__y"), w.alias("__w")))
        matrix, bias = model.coefficientMatrix.toArray().tolist(), model.interceptVector.toArray().tolist()
        gone = len(classes) - len(matrix)  # classes after the last one seen never win
        out[t] = Head(classes, matrix + [[0.0] * len(matrix[0])] * gone, bias + [-1e9] * gone)
    return out


def head_rows(spark: SparkSession, heads: Mapping[str, Head]) -> DataFrame:
    """Heads as rows (task, place, label, weights, bias), for saving."""
    rows = [(t, i, c, [float(x) for x in w], float(b)) for t, h in heads.items() for i, (c, w, b) in enumerate(zip(h.classes, h.weights, h.bias, strict=True))]
    return spark.createDataFrame(rows, "task string, place int, label string, weights array<double>, bias double")


def heads_of(rows: DataFrame) -> dict[str, Head]:
    """What head_rows stored; a model's heads are few."""
    by: dict[str, list] = {}
    for r in sorted(rows.collect(), key=lambda r: (r.task, r.place)):
        by.setdefault(r.task, []).append(r)
    return {t: Head([r.label for r in rs], [list(r.weights) for r in rs], [r.bias for r in rs]) for t, rs in by.items()}
