"""Scores over arrays, inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def doubles(values: Sequence[float]) -> Column:
    return F.array(*(F.lit(float(v)) for v in values))


def linear(features: Column, weights: Sequence[Sequence[float]], bias: Sequence[float]) -> Column:
    """Logits of a dense head: one weight row and bias a class."""
    x = F.transform(features, lambda v: v.cast("double"))
    dot = lambda w: F.aggregate(F.zip_with(x, doubles(w), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    return F.array(*(dot(w) + F.lit(float(b)) for w, b in zip(weights, bias, strict=True)))


def softmax(logits: Column) -> Column:
    """Shifted by the maximum, so large logits don't overflow."""
    e = F.transform(logits, lambda z: F.exp(z - F.array_max(logits)))
    return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def argmax(values: Column) -> Column:
    """Index of the first largest value, from 0."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def label_id(label: Column, classes: Sequence[str], strict: bool = True) -> Column:
    """Index of a label among the classes; null and unknown labels fail if strict, else give null."""
    at = F.array_position(F.array(*map(F.lit, classes)), label)
    known = F.when(at > 0, at - 1)
    if strict:
        known = F.coalesce(known, F.raise_error(F.concat(F.lit("no such label: "), F.coalesce(label, F.lit("null")))).cast("long"))
    return known.cast("long")


def label_of(index: Column, classes: Sequence[str]) -> Column:
    return F.element_at(F.array(*map(F.lit, classes)), index.cast("int") + 1)


def one_hot(index: Column, size: int) -> Column:
    return F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: (i == index).cast("int"))
