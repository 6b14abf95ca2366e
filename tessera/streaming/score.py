"""Structured Streaming around the batch operators: cleaning and scoring are row-wise, so they need no state.

An extension: the batch workflow has no stream of its own.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.model import Head
from ..operators.predict import predict


def predict_stream(articles: DataFrame, heads: Mapping[str, Head], **more) -> DataFrame:
    return predict(articles, heads, **more)


def label_rates(predicted: DataFrame, task: str, time: str, late: str = "10 minutes", window: str = "5 minutes") -> DataFrame:
    """Rows (start, label, n) for each closed window of event time."""
    label = F.element_at("prediction", F.lit(task)).getField("label").alias("label")
    rows = predicted.withWatermark(time, late).groupBy(F.window(time, window), label).agg(F.count("*").alias("n"))
    return rows.select(F.col("window.start").alias("start"), "label", "n")


def to_parquet(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Write all that is there, exactly once, and stop."""
    return stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
