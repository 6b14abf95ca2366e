"""Readers and writers: CSV with missing-value tokens and row order, Parquet, JSON artefacts, models."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import NA_TOKENS


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], order: str | None = "ord", na_tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """A CSV with header, quoted newlines and doubled quotes, all columns strings, missing tokens as null.

    order adds the row's place in the file: such a file is one partition, so the id is monotonic in file order.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    df = spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)
    df = df.select(*(F.when(~F.col(f"`{c}`").isin(list(na_tokens)), F.col(f"`{c}`")).alias(c) for c in columns))
    return df.withColumn(order, F.monotonically_increasing_id()) if order else df


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, quote='"', escape='"')


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def write_vocabulary(tokens: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The tokens(token array) that occur, with how often, as Parquet (token, n)."""
    write_table(tokens.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n")), path, mode)


def write_splits(df: DataFrame, path: str, column: str = "split", mode: str = "overwrite") -> None:
    """One folder a split, so that a reader of one split prunes the others."""
    df.write.mode(mode).partitionBy(column).parquet(path)


def write_json(spark: SparkSession, record: Mapping, path: str, mode: str = "overwrite") -> None:
    """One record as JSON text, e.g. label mappings, checkpoint metadata or a model's configuration."""
    import json

    spark.createDataFrame([(json.dumps(record, ensure_ascii=False),)], "value string").coalesce(1).write.mode(mode).text(path)


def read_json(spark: SparkSession, path: str) -> dict:
    import json

    return json.loads("\n".join(r.value for r in spark.read.text(path).collect()))


def append(df: DataFrame, path: str) -> None:
    """Append rows, e.g. an epoch to a training history."""
    df.write.mode("append").parquet(path)
