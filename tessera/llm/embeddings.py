"""Embedding near-duplicates by Euclidean p-stable hashing, followed by exact cosine checks.

Vectors are normalised, so cosine c means distance sqrt(2 - 2c). A table's bucket is the tuple of floor((a.x + b) / w) over
k Gaussian projections a (the 2-stable case of Datar et al., 2004). k grows with the logarithm of the number of distinct
vectors, so that unrelated vectors meet in about EXPECTED others a bucket at any size; the number of tables follows from
k so that a pair at the threshold itself meets in some table with probability `recall`, closer pairs almost surely.
Equal vectors are one class with a weight. A pair that meets in several tables counts in the first one only, so links are
counted without writing pairs out; each bucket yields one row a vector: its links there and a parent in a spanning forest.
A bucket of over BUCKET rows is split in chunks that meet pairwise in tasks of their own.

Defined cases: a vector that is null, empty, zero, or holds null or non-finite components links with nothing; vectors of
different lengths never link; every row is a vector of its own, so that exact repeats of a row are links of each other and all have
the same result; rows of one id with different vectors are different nodes, and links lead on by vectors, not by ids; a null
vec_id is a row of its own that links with nothing and is not kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, materialize, roots_of, run_starts, sorted_groups

WIDTH = 2.0
EXPECTED = 256
BUCKET = 2048


def collision(distance: float, width: float = WIDTH) -> float:
    """Probability that one quantised projection agrees for two vectors at this distance."""
    r = width / distance
    tail = math.erfc(r / math.sqrt(2))
    return 1 - tail - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))


def plan(n: int, cosine: float, recall: float) -> tuple[int, int]:
    """Projections a table and number of tables for n distinct vectors."""
    k = max(2, math.ceil(math.log(max(n / EXPECTED, 2)) / -math.log(collision(math.sqrt(2)))))
    p = collision(math.sqrt(2 - 2 * cosine)) ** k
    return k, math.ceil(math.log(1 - recall) / math.log(1 - p))


def bucket_keys(x: np.ndarray, k: int, tables: int, seed: int = 4) -> np.ndarray:
    """Rows of normalised x: a 64-bit key for each table."""
    rng = np.random.default_rng([seed, x.shape[1]])
    a, b = rng.standard_normal((x.shape[1], tables * k)), rng.uniform(0, WIDTH, tables * k)
    mix = rng.integers(1, 2**63, size=k, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    out = np.empty((len(x), tables), dtype=np.int64)
    for at in range(0, len(x), 1024):
        # one row a product, so a vector's key does not hang on the rows beside it
        q = np.floor((np.einsum("nd,dt->nt", x[at : at + 1024], a) + b) / WIDTH).astype(np.int64).view(np.uint64)
        h = (q.reshape(-1, tables, k) * mix).sum(axis=2)
        out[at : at + 1024] = (h ^ (h >> np.uint64(31))).view(np.int64)
    return out


def unit(rows: list) -> np.ndarray:
    x = np.array([np.asarray(r, dtype=np.float64) for r in rows])
    x = x / np.abs(x).max(axis=1, keepdims=True)  # squares of large or tiny components stay finite
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def links_in_bucket(x: np.ndarray, k: int, tables: int, weight: np.ndarray, side: np.ndarray, tab: int, cosine: float):
    """Links first met in this table among the rows: (weights linked to each row, pairs). Keys of the tables before are made anew for
    the rows of links only."""
    n = len(x)
    linked, pairs = np.zeros(n, dtype=np.int64), []
    two = side[0] != side[-1]
    for at in range(0, n, 256):
        rows = np.arange(at, min(n, at + 256))
        i, j = np.nonzero(x[rows] @ x[at:].T >= cosine - 1e-9)
        a, b = rows[i], j + at
        ok = (a < b) & (side[a] != side[b] if two else True)
        a, b = a[ok], b[ok]
        exact = np.einsum("ij,ij->i", x[a], x[b]) >= cosine
        a, b = a[exact], b[exact]
        if tab and len(a):
            some, at_ = np.unique(np.concatenate((a, b)), return_inverse=True)
            keys = bucket_keys(x[some], k, tables)[:, :tab]
            first = (keys[at_[: len(a)]] != keys[at_[len(a) :]]).all(axis=1)
            a, b = a[first], b[first]
        np.add.at(linked, a, weight[b])
        np.add.at(linked, b, weight[a])
        pairs.append((a, b))
    return linked, np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])


def near_duplicates(
    vectors: DataFrame, cosine: float = 0.9, recall: float = 0.995, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """Rows (id, n_links, component_id, kept), one for each row of vectors."""
    v = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).alias("x"))
    norm = F.aggregate("x", F.lit(0.0), lambda s, e: s + F.abs(e.cast("double")))
    fine = F.coalesce(norm, F.lit(0.0))
    valid = F.col("id").isNotNull() & (fine > 0) & (fine < float("inf"))
    v = v.withColumn("valid", F.coalesce(valid, F.lit(False)))
    classes = v.where("valid").groupBy("x").agg(F.min("id").alias("least"), F.count("*").alias("weight"))
    classes = materialize(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
    n = classes.count()
    k, tables = plan(n, cosine, recall)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for size, part in pdf.groupby(pdf["x"].map(len)):
                key = bucket_keys(unit(part["x"].tolist()), k, tables)
                yield pd.DataFrame({
                    "rep": np.repeat(part["rep"].to_numpy(), tables),
                    "tab": np.tile(np.arange(tables, dtype=np.int32), len(part)),
                    "dim": np.full(len(part) * tables, size, dtype=np.int32),
                    "key": key.ravel(),
                })

    placed = classes.mapInPandas(place, "rep long, tab int, dim int, key long")
    bucket = ["tab", "dim", "key"]
    full = placed.groupBy(*bucket).agg(F.count("*").alias("n")).where("n > 1")
    met = placed.join(full, bucket).withColumn("chunks", F.ceil(F.col("n") / BUCKET).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64("rep"), F.col("chunks")).cast("int"))
    met = met.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    met = met.select(*bucket, F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "rep")
    met = met.join(classes, "rep")
    keys = [*bucket, "lo", "hi"]

    def check(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in sorted_groups(batches, keys, 20_000):
            starts = run_starts(*(pdf[c].to_numpy() for c in keys))
            for s, e in zip(starts, np.append(starts[1:], len(pdf)), strict=True):
                if e - s < 2:
                    continue
                part = pdf.iloc[s:e]
                x = unit(part["x"].tolist())
                weight = part["weight"].to_numpy()
                linked, a, b = links_in_bucket(x, k, tables, weight, part["own"].to_numpy(), int(part["tab"].iloc[0]), cosine)
                at = np.flatnonzero(linked)
                root = roots_of(len(x), a, b)
                reps = part["rep"].to_numpy()
                yield pd.DataFrame({"rep": reps[at], "links": linked[at], "parent": reps[root[at]]})

    shuffle = int(met.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = materialize(
        met.repartition(shuffle, *keys).sortWithinPartitions(*keys, "own").mapInPandas(check, "rep long, links long, parent long"), "links"
    )
    roots = connected_components(found.select(F.col("rep").alias("src"), F.col("parent").alias("dst")))
    linked = found.groupBy("rep").agg(F.sum("links").alias("links"))
    rooted = classes.join(linked, "rep", "left").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
    rooted = rooted.select("x", "least", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("links"), F.coalesce("component", "rep").alias("class"))
    smallest = rooted.groupBy("class").agg(F.min("least").alias("root"))
    named = rooted.join(smallest, "class").select("x", "links", "root")
    out = v.withColumn("x", F.when(F.col("valid"), F.col("x"))).join(named, "x", "left")
    root = F.coalesce("root", "id")
    return out.select(
        F.col("id").alias(id_column), F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), root.alias("component_id"),
        F.coalesce(F.col("id") == root, F.lit(False)).alias("kept"),
    )
