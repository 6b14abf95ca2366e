"""Row numbers over a whole table without bringing it into one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: Rows of a bucket, about; a bucket's rows are numbered in one task.
ROWS = 1 << 18
#: Ranges that quantiles cut; each is cut further at equal widths where the table is large.
RANGES = 256


def hash_rank(df: DataFrame, by: Sequence[str], key: str, seed: int, name: str = "rank", rows: int = ROWS, n: int | None = None) -> DataFrame:
    """df with name: 0, 1, ... within each combination of by, in the order of a hash of key.

    The hash's range is cut in buckets, as many as the table's rows ask for; counts of (by, bucket) give each bucket's offset, and
    rows are numbered within theirs, so that a group that holds most rows is spread over tasks. n: the table's rows, if known.
    """
    n = df.count() if n is None else n
    bits = max(1, math.ceil(math.log2(max(1, n / rows))))
    hashed = df.withColumn("__hash", F.xxhash64(F.col(key), F.lit(seed)))
    # shifted with its sign, so that buckets stand in the order of the hash
    hashed = hashed.withColumn("__bucket", F.shiftright("__hash", 64 - bits))
    return numbered(hashed, by, "__bucket", [F.col("__hash"), F.col(key)], name).drop("__hash", "__bucket")


def key_rank(df: DataFrame, key: str, name: str = "rank", rows: int = ROWS) -> DataFrame:
    """df with name: 0, 1, ... in the order of a numeric key, over the whole table."""
    return numbered(df.withColumn("__bucket", range_bucket(df, key, rows)), [], "__bucket", [F.col(key)], name).drop("__bucket")


def range_bucket(df: DataFrame, key: str, rows: int) -> Column:
    """Number of the range that a numeric key falls in: approximate quantiles, and equal widths within each, so that a bucket has
    about so many rows at any size of the table unless its keys are very uneven between two quantiles."""
    x = F.col(key).cast("double")
    one = df.agg(F.percentile_approx(x, [i / RANGES for i in range(RANGES + 1)], 10_000), F.count(x)).first()
    edges = sorted({e for e in one[0] or [] if math.isfinite(e)})
    if len(edges) < 2:
        return F.lit(0).cast("long")
    at = F.size(F.filter(F.array(*map(F.lit, edges)), lambda e: e < x))
    widths = math.ceil(one[1] / rows / RANGES)
    if widths == 1:
        return at.cast("long")
    low, high = (F.element_at(F.array(*map(F.lit, edges)), F.greatest(F.least(at + d, F.lit(len(edges))), F.lit(1))) for d in (0, 1))
    # beyond the outer edges low and high are equal
    within = F.when(high > low, F.least(F.floor((x - low) / (high - low) * widths), F.lit(widths - 1))).otherwise(0)
    return at.cast("long") * widths + F.coalesce(within, F.lit(0))


def numbered_sums(df: DataFrame, key: str, n: str, name: str, rows: int = ROWS) -> DataFrame:
    """df with name: the sum of n over the rows up to this one in the order of a numeric key that doesn't repeat."""
    ranged = df.withColumn("__bucket", range_bucket(df, key, rows))
    sums = ranged.groupBy("__bucket").agg(F.sum(n).alias("__n"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy().orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    within = F.sum(n).over(W.partitionBy("__bucket").orderBy(key))
    return ranged.withColumn("__within", within).join(sums.select("__bucket", before.alias("__before")), "__bucket").withColumn(name, F.col("__within") + F.col("__before")).drop("__bucket", "__within", "__before")


def numbered(rows: DataFrame, by: Sequence[str], bucket: str, order: Sequence[Column], name: str) -> DataFrame:
    counts = rows.groupBy(*by, bucket).agg(F.count("*").alias("__n"))
    # a bounded number of rows a group
    before = counts.withColumn("__before", F.coalesce(F.sum("__n").over(W.partitionBy(*by).orderBy(bucket).rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    left, right = rows.alias("l"), before.drop("__n").alias("r")
    on = F.col(f"l.{bucket}") == F.col(f"r.{bucket}")
    for b in by:
        on = on & F.col(f"l.{b}").eqNullSafe(F.col(f"r.{b}"))
    within = F.row_number().over(W.partitionBy(*(f"l.{b}" for b in by), f"l.{bucket}").orderBy(*order))
    return left.join(right, on).withColumn(name, within - 1 + F.col("__before")).select("l.*", name)
