"""Batch and single-article prediction: the training's own cleaning, then features, heads and a nested record."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_text
from .model import Head, predictions, score
from .tokens import words


def hashed_features(tokens: Column, size: int = 64) -> Column:
    """The default features of a text: shares of its tokens in hashed buckets, counted inside the JVM. Any function of the
    tokens may stand in."""
    buckets = F.sequence(F.lit(0), F.lit(size - 1))
    # a transform over one element, so that what the inner functions use again is computed once
    let = lambda value, f: F.element_at(F.transform(F.array(value), f), 1)
    codes = F.transform(F.array_compact(F.coalesce(tokens, F.array().cast("array<string>"))), lambda w: F.pmod(F.crc32(w.cast("binary")), F.lit(size)).cast("int"))
    # with every bucket added once and sorted, bucket b's run is the b-th
    starts = lambda a: F.concat(F.filter(F.sequence(F.lit(0), F.size(a) - 1), lambda i: ~F.get(a, i).eqNullSafe(F.get(a, i - 1))), F.array(F.size(a)))
    share = lambda a, s, b: (F.get(s, b + 1) - F.get(s, b) - 1) / F.greatest(F.size(a) - size, F.lit(1))
    return let(F.sort_array(F.concat(codes, buckets)), lambda a: let(starts(a), lambda s: F.transform(buckets, lambda b: share(a, s, b))))


def predict(df: DataFrame, heads: Mapping[str, Head], title: str = "title", content: str = "content", features: Callable[[Column], Column] = hashed_features, normalize: bool = True) -> DataFrame:
    """df with prediction: task -> (label, confidence, probabilities)."""
    # the cleaned texts get columns of their own: a Python function can't stand inside a higher-order one
    texts = df.withColumns({"__title": clean_text(F.col(title), normalize), "__content": clean_text(F.col(content), normalize)})
    texts = texts.withColumn("__tokens", F.concat(words(F.col("__title")), words(F.col("__content"))))
    scored = score(texts.withColumn("__x", features(F.col("__tokens"))), "__x", heads)
    return predictions(scored, heads).select(*df.columns, "prediction")


def predict_article(spark: SparkSession, title: str, content: str, heads: Mapping[str, Head], **more) -> dict:
    """The same for one article."""
    row = predict(spark.createDataFrame([(title, content)], "title string, content string"), heads, **more).first()
    return {t: p.asDict(recursive=True) for t, p in row.prediction.items()}


def as_json(column: str = "prediction", places: int | None = None) -> Column:
    """The record as JSON; places: decimals of its numbers."""
    if places is None:
        return F.to_json(F.col(column))
    kind = f"decimal({places + 3}, {places})"
    short = lambda _, v: F.struct(v["label"].alias("label"), v["confidence"].cast(kind).alias("confidence"), F.transform_values(v["probabilities"], lambda _, p: p.cast(kind)).alias("probabilities"))
    return F.to_json(F.transform_values(F.col(column), short))
