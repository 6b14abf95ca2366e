"""Profiles of a table. Summaries that look at every column share one pass; results are small DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ranking import numbered_sums


def missing(df: DataFrame) -> DataFrame:
    """Rows (column, n_missing), one pass over all columns."""
    one = df.agg(*(F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns))
    return one.unpivot([], df.columns, "column", "n_missing")


def schema_profile(df: DataFrame) -> DataFrame:
    """Rows (column, dtype, n_filled)."""
    one = df.agg(*(F.count(F.col(f"`{c}`")).alias(c) for c in df.columns)).unpivot([], df.columns, "column", "n_filled")
    kinds = F.create_map(*(F.lit(x) for pair in df.dtypes for x in pair))
    return one.select("column", F.element_at(kinds, F.col("column")).alias("dtype"), "n_filled")


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))


def duplicate_count(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows beyond the first of each distinct combination; nulls are equal to each other."""
    by = df.groupBy(*(columns or df.columns)).agg(F.count("*").alias("n"))
    return by.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("long").alias("n_duplicates"))


def duplicates_by_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    parts = [duplicate_count(df, [c]).select(F.lit(c).alias("column"), "n_duplicates") for c in columns]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def duplicate_rows(df: DataFrame, columns: Sequence[str], order: str) -> DataFrame:
    """All rows but the first by order of each combination of columns. order must be unique; firsts are pre-aggregated, so a
    value that a third of all rows share doesn't meet in one task."""
    first = df.groupBy(*columns).agg(F.min(order).alias(order)).select(order)
    return df.join(first, order, "left_anti")


def distinct_first_seen(df: DataFrame, column: str, order: str) -> DataFrame:
    """Rows (value, first_seen): distinct values, null included; sort by first_seen for the order of appearance."""
    return df.groupBy(F.col(column).alias("value")).agg(F.min(order).alias("first_seen"))


def value_counts(df: DataFrame, *columns: str, keep_null: bool = False) -> DataFrame:
    rows = df if keep_null else df.na.drop("any", subset=list(columns))
    return rows.groupBy(*columns).agg(F.count("*").alias("n"))


def ranked_counts(df: DataFrame, *columns: str) -> DataFrame:
    """value_counts, most frequent first, ties by value."""
    return value_counts(df, *columns).orderBy(F.desc("n"), *columns)


def shares(counts: DataFrame, n: str = "n") -> DataFrame:
    """counts with share_pct, the percentage of the total."""
    total = counts.agg(F.sum(n)).scalar()
    return counts.withColumn("share_pct", 100 * F.col(n) / total)


def label_matrix(df: DataFrame, tasks: Sequence[str]) -> DataFrame:
    """Rows (label, one count column a task); a label that a task never has is null there, null labels are counted."""
    long = df.select(*(F.col(t).cast("string").alias(t) for t in tasks)).unpivot([], list(tasks), "task", "label")
    return long.groupBy("label").pivot("task", list(tasks)).agg(F.count(F.lit(1)))


def label_counts(df: DataFrame, tasks: Sequence[str], *by: str) -> DataFrame:
    """Rows (by..., task, label, n)."""
    long = df.select(*by, *(F.col(t).cast("string").alias(t) for t in tasks)).unpivot(list(by), list(tasks), "task", "label")
    return long.where("label is not null").groupBy(*by, "task", "label").agg(F.count("*").alias("n"))


def describe(df: DataFrame, column: str, percentiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """One row: count, mean, std, min, exact percentiles (p25, ...), max."""
    x = F.col(column).cast("double")
    out = df.agg(F.count(x).alias("count"), F.avg(x).alias("mean"), F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"))
    names = [f"p{p * 100:g}".replace(".", "_") for p in percentiles]
    out = out.withColumn("at", exact_percentiles(df, x, percentiles).scalar())
    return out.select("count", "mean", "std", "min", *(F.col("at")[i].alias(n) for i, n in enumerate(names)), "max")


def exact_percentiles(df: DataFrame, x: Column, percentiles: Sequence[float]) -> DataFrame:
    """One row (at: array): exact percentiles with linear interpolation. Values are counted first, then numbered in value order by
    buckets with pre-aggregated offsets, so that no task holds all distinct values."""
    counts = df.select(x.alias("x")).where("x is not null").groupBy("x").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    ends = numbered_sums(counts, "x", "n", "end")
    aim = lambda f: F.array(*(f((total - 1) * F.lit(float(p))) for p in percentiles))
    # the value at place k (from 0) is the least whose running count is over k
    low, high, part = aim(F.floor), aim(F.ceil), aim(lambda v: v - F.floor(v))
    rows = ends.withColumns({"__low": low, "__high": high, "__part": part})
    lows = [F.min(F.when(F.col("end") > F.col("__low")[i], F.col("x"))) for i in range(len(percentiles))]
    highs = [F.min(F.when(F.col("end") > F.col("__high")[i], F.col("x"))) for i in range(len(percentiles))]
    parts = [F.first(F.col("__part")[i], ignorenulls=True) for i in range(len(percentiles))]
    return rows.agg(F.array(*(a + (b - a) * c for a, b, c in zip(lows, highs, parts, strict=True))).alias("at"))


def describe_text(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (column, count, unique, top, freq); top is the smallest of the most frequent values."""
    out = None
    for c in columns:
        counts = value_counts(df.select(F.col(c).cast("string").alias("value")), "value")
        part = counts.agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("count"), F.count("*").alias("unique"),
            F.min(F.struct((-F.col("n")).alias("n"), "value")).alias("top"),
        ).select(F.lit(c).alias("column"), "count", "unique", F.col("top.value").alias("top"), (-F.col("top.n")).alias("freq"))
        out = part if out is None else out.unionByName(part)
    return out


def around_mean(df: DataFrame, value: Column) -> DataFrame:
    """One row: mean, and how many values lie strictly above and strictly below it."""
    x = df.select(value.cast("double").alias("x"))
    mean = x.agg(F.avg("x")).scalar()
    return x.agg(F.avg("x").alias("mean"), F.count_if(F.col("x") > mean).alias("n_above"), F.count_if(F.col("x") < mean).alias("n_below"))


def histogram(df: DataFrame, value: Column, bins: int = 10) -> DataFrame:
    """Rows (bin, low, high, n): equal widths between the extremes, the last bin closed; a constant column gets a width of 1
    around its value. Empty bins are there too."""
    x = df.select(value.cast("double").alias("x")).where("x is not null")
    one = x.agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    edge = one.select(F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"), F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"))
    lo, hi = edge.select("lo").scalar(), edge.select("hi").scalar()
    at = F.least(F.floor((F.col("x") - lo) / (hi - lo) * bins), F.lit(bins - 1)).cast("int")
    counts = x.groupBy(at.alias("bin")).agg(F.count("*").alias("n"))
    frame = edge.where("lo is not null").select("lo", "hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("hi") - F.col("lo")) / bins
    rows = frame.join(counts, "bin", "left")
    return rows.select("bin", (F.col("lo") + F.col("bin") * width).alias("low"), (F.col("lo") + (F.col("bin") + 1) * width).alias("high"), F.coalesce("n", F.lit(0)).alias("n"))


def class_counts(df: DataFrame, column: str, classes: Sequence[str]) -> DataFrame:
    """Rows (place, label, n) for every class in its order, zero if absent. A bounded dimension, hence the broadcast."""
    frame = df.sparkSession.createDataFrame([(i, c) for i, c in enumerate(classes)], "place int, label string")
    counts = df.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n"))
    return frame.join(counts.where(F.col("label").isin(list(classes))), "label", "left").select("place", "label", F.coalesce("n", F.lit(0)).alias("n"))


def head(df: DataFrame, order: str, n: int = 5) -> DataFrame:
    """The first n rows by order."""
    return df.orderBy(order).limit(n)
