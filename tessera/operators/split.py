"""Stratified splits over several tasks at once."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import SEED, SPLITS
from .profile import label_counts
from .ranking import hash_rank

#: Rows of the quota table up to which it is broadcast; a larger one is joined by its labels.
QUOTA_ROWS = 100_000


def quotas(sets: dict[tuple, int], splits: Sequence[tuple[str, float]]) -> dict[tuple, list[int]]:
    """How many rows of each label set go to each split: the rounded-down share, then the rest, from the rarest set on, to the
    split that wants it most, by its size and by the labels of the set."""
    n = sum(sets.values())
    want = [n * share for _, share in splits]
    labels: dict[tuple, list[float]] = {}
    for s, count in sets.items():
        for place, label in enumerate(s):
            at = labels.setdefault((place, label), [0.0] * len(splits))
            for k, (_, share) in enumerate(splits):
                at[k] += count * share
    out = {}

    def give(s: tuple, k: int, rows: int) -> None:
        out[s][k] += rows
        want[k] -= rows
        for place, label in enumerate(s):
            labels[place, label][k] -= rows

    for s, count in sets.items():
        out[s] = [0] * len(splits)
        for k, (_, share) in enumerate(splits):
            give(s, k, int(count * share))
    for s in sorted(sets, key=lambda s: (sets[s], str(s))):
        for _ in range(sets[s] - sum(out[s])):
            give(s, max(range(len(splits)), key=lambda k: (want[k] + sum(labels[p, x][k] for p, x in enumerate(s)), -k)), 1)
    return out


def stratified_split(df: DataFrame, key: str, tasks: Sequence[str], splits: Sequence[tuple[str, float]] = SPLITS, seed: int = SEED) -> DataFrame:
    """df with split. Label sets are counted (as many rows as there are combinations of classes), quotas set, and rows
    assigned by their place in a hash order within their set; the same key always falls the same way."""
    counts = {tuple(r)[:-1]: r["n"] for r in df.groupBy(*tasks).agg(F.count("*").alias("n")).collect()}
    if not counts:
        return df.withColumn("split", F.lit(splits[0][0]))
    schema = ", ".join(f"`q_{t}` {df.schema[t].dataType.simpleString()}" for t in tasks)
    rows = []
    for s, q in quotas(counts, splits).items():
        low = 0
        for (name, _), k in zip(splits, q, strict=True):
            rows.append((*s, name, low, low + k))
            low += k
    plan = df.sparkSession.createDataFrame(rows, f"{schema}, split string, low long, high long")
    if len(rows) <= QUOTA_ROWS:
        plan = F.broadcast(plan)
    ranked = hash_rank(df, tasks, key, seed, "__rank", n=sum(counts.values()))
    on = (F.col("__rank") >= F.col("low")) & (F.col("__rank") < F.col("high"))
    for t in tasks:
        on = on & F.col(t).eqNullSafe(F.col(f"q_{t}"))
    return ranked.join(plan, on).select(*df.columns, "split")


def split_distribution(df: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """Rows (split, task, label, n)."""
    return label_counts(df, tasks, "split")
