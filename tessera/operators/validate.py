"""Checks that return the offending rows, and raise only if asked to."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import NOT_FEATURES
from ..functions.text import trimmed


def missing_columns(df: DataFrame, required: Sequence[str]) -> set[str]:
    return set(required) - set(df.columns)


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows (key, n) of keys that occur more than once."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def unknown_labels(df: DataFrame, tasks: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (task, label, n): labels outside their domain after trimming; nulls are no labels."""
    long = df.select(*(trimmed(F.col(t).cast("string")).alias(t) for t in tasks)).unpivot([], list(tasks), "task", "label")
    outside = F.lit(False)
    for t, classes in tasks.items():
        outside = outside | ((F.col("task") == t) & ~F.col("label").isin(list(classes)))
    return long.where(F.col("label").isNotNull() & outside).groupBy("task", "label").agg(F.count("*").alias("n"))


def shared_keys(df: DataFrame, key: str, split: str = "split") -> DataFrame:
    """Rows (key, n_splits) of keys in more than one split; one pass for all pairs of splits."""
    return df.groupBy(key).agg(F.count_distinct(split).alias("n_splits")).where("n_splits > 1")


def overlap(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of a that b has too."""
    return a.select(key).join(b.select(key), key, "left_semi").distinct()


def leaked_columns(df: DataFrame, forbidden: Sequence[str] = NOT_FEATURES) -> set[str]:
    """Columns that may never be inputs of a model."""
    return set(df.columns) & set(forbidden)


def validate(df: DataFrame, required: Sequence[str], key: str, tasks: Mapping[str, Sequence[str]]) -> None:
    """Raise ValueError on missing columns, repeated keys or unknown labels."""
    if gone := missing_columns(df, required):
        raise ValueError(f"missing columns: {sorted(gone)}")
    if twice := repeated_keys(df, key).limit(5).collect():
        raise ValueError(f"repeated keys: {[r[0] for r in twice]}")
    if odd := unknown_labels(df, tasks).limit(5).collect():
        raise ValueError(f"unknown labels: {[(r.task, r.label) for r in odd]}")
