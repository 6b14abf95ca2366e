"""Label ids, one-hot blocks and class weights."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import label_id, one_hot
from .profile import class_counts


def mappings(tasks: Mapping[str, Sequence[str]]) -> dict:
    """label2id and id2label of every task."""
    return {"label2id": {t: {c: i for i, c in enumerate(cs)} for t, cs in tasks.items()}, "id2label": {t: dict(enumerate(cs)) for t, cs in tasks.items()}}


def mapping_rows(spark: SparkSession, tasks: Mapping[str, Sequence[str]]) -> DataFrame:
    return spark.createDataFrame([(t, i, c) for t, cs in tasks.items() for i, c in enumerate(cs)], "task string, id int, label string")


def encode(df: DataFrame, tasks: Mapping[str, Sequence[str]], strict: bool = True) -> DataFrame:
    """Add <task>_id to every row; null or unknown labels fail if strict."""
    return df.withColumns({f"{t}_id": label_id(F.col(t), cs, strict) for t, cs in tasks.items()})


def one_hot_columns(df: DataFrame, tasks: Mapping[str, Sequence[str]]) -> DataFrame:
    """Add <task>_<class> for each class: 1 where the id is the class's, else 0."""
    return df.withColumns({f"{t}_{c}": F.coalesce((F.col(f"{t}_id") == i).cast("int"), F.lit(0)) for t, cs in tasks.items() for i, c in enumerate(cs)})


def one_hot_arrays(df: DataFrame, tasks: Mapping[str, Sequence[str]]) -> DataFrame:
    return df.withColumns({f"{t}_hot": one_hot(F.col(f"{t}_id"), len(cs)) for t, cs in tasks.items()})


def class_weights(df: DataFrame, tasks: Mapping[str, Sequence[str]]) -> DataFrame:
    """Rows (task, label, n, weight): weight = rows / (classes * max(n, 1)), over all rows given: pass the training split."""
    total = df.agg(F.count("*")).scalar()
    out = None
    for t, cs in tasks.items():
        w = class_counts(df, t, cs).select(F.lit(t).alias("task"), "label", "n", (total / (len(cs) * F.greatest("n", F.lit(1)))).alias("weight"))
        out = w if out is None else out.unionByName(w)
    return out
