"""SimHash near-duplicates by pivot distance tables.

A fingerprint's Hamming distances to many fixed reference fingerprints (pivots) are its coordinates. By the triangle
inequality two fingerprints that differ in at most r bits differ by at most r in every coordinate, so a pair with a larger
coordinate difference is discarded unseen; survivors are verified by popcount. To deal the work out, fingerprints meet in
cells: the 64 bits are cut in five parts, and at most three differing bits leave two parts equal, so each fingerprint
enters the ten cells of its pairs of parts and no link is lost. A cell of over CELL rows is split in chunks that meet
pairwise in tasks of their own. Within a cell only a spanning forest of the links leaves the task, never all pairs.

Defined cases: null and empty text, or white space only, have fingerprint zero and are linked like any other; repeated rows
give repeated results; a null doc_id keeps its row and takes its class's smallest id, null if there is none.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import connected_components, fresh, materialize, roots_of, run_starts, sorted_groups

RADIUS = 3
PARTS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))  # first bit, width
CELL = 2048
PIVOTS = np.random.default_rng(64).integers(0, 2**64, size=24, dtype=np.uint64)
#: Shingles whose bits are unpacked at once, a multiple of 128.
AT_ONCE = 16384


def simhash(text: str | None, width: int = 3) -> int:
    """64-bit fingerprint: XXH64 (seed 42) of every word shingle, A-Z lower-cased; a bit is 1 if set in over half."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    s, n = b" ".join(words), len(words)
    if n < width:
        return xxh64_intdigest(s, 42)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=n) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    m = n - width + 1
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, m, AT_ONCE):
        to = min(m, at + AT_ONCE)
        pairs = zip(starts[at:to].tolist(), ends[at + width - 1 : to + width - 1].tolist(), strict=True)
        h = np.fromiter([xxh64_intdigest(s[a:b], 42) for a, b in pairs], dtype="<u8", count=to - at)
        h = np.concatenate((h, np.zeros(-len(h) % 128, dtype="<u8")))
        bits = np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 128, 64)
        ones += np.add.reduce(bits, axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > m, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", digest: str | None = None) -> DataFrame:
    """Rows (id, fp long, digest long) for every row of docs; digest: a long column that is passed on, if named."""
    kind = docs.schema[id_column].dataType.simpleString()
    own = (F.col(digest) if digest else F.lit(None).cast("long")).alias("digest")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((simhash(t) for t in b["t"].to_pylist()), dtype=np.uint64, count=len(b))
            yield pa.RecordBatch.from_arrays([b["id"], pa.array(fp.view(np.int64)), b["digest"]], ["id", "fp", "digest"])

    return docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("t"), own).mapInArrow(run, f"id {kind}, fp long, digest long")


def coordinates(fp: np.ndarray) -> np.ndarray:
    """The pivot distance table: a row of distances for each fingerprint."""
    return np.bitwise_count(fp[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def close(fp: np.ndarray, table: np.ndarray, a: np.ndarray, b: np.ndarray, radius: int) -> np.ndarray:
    """Which of the pairs a-b differ in at most radius bits: pivots discard in three steps, popcount decides."""
    at = np.arange(len(a))
    for lo, hi in ((0, 4), (4, 12), (12, table.shape[1])):
        near = np.abs(table[a[at], lo:hi] - table[b[at], lo:hi]).max(axis=1) <= radius
        at = at[near]
    at = at[np.bitwise_count(fp[a[at]] ^ fp[b[at]]) <= radius]
    return at


def links_in_cells(fp: np.ndarray, side: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs within radius inside each run; where a run has two sides, only across them."""
    n = len(fp)
    sizes = np.diff(np.append(starts, n))
    ends = np.repeat(starts + sizes, sizes)
    table = coordinates(fp)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    small = np.repeat(sizes <= 64, sizes)
    for shift in range(1, int(min(64, sizes.max(initial=0)))):
        a = np.flatnonzero(small[: n - shift] & (np.arange(n - shift) + shift < ends[: n - shift]))
        if not len(a):
            break
        ok = close(fp, table, a, a + shift, radius)
        found.append((a[ok], a[ok] + shift))
    for s, m in zip(starts[sizes > 64].tolist(), sizes[sizes > 64].tolist(), strict=True):
        cols = np.arange(s, s + m)
        two = side[s] != side[s + m - 1]
        for at in range(s, s + m, 128):
            rows = np.arange(at, min(at + 128, s + m))
            alive = np.abs(table[rows, 0][:, None] - table[cols, 0][None, :]) <= radius
            alive &= rows[:, None] < cols[None, :]
            if two:
                alive &= side[rows][:, None] != side[cols][None, :]
            i, j = np.nonzero(alive)
            a, b = rows[i], cols[j]
            ok = close(fp, table, a, b, radius)
            found.append((a[ok], b[ok]))
    if not found:
        return np.empty(0, int), np.empty(0, int)
    return np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found])


def fingerprint_links(fps: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Edges (src, dst) of a spanning forest of the links among distinct fingerprints, given as fps(fp long)."""
    if radius > RADIUS:
        raise ValueError(f"cells are lossless up to {RADIUS} bits")
    cells = []
    for c, (i, j) in enumerate(combinations(range(len(PARTS)), 2)):
        (s, w), (t, v) = PARTS[i], PARTS[j]
        left = F.shiftrightunsigned("fp", s).bitwiseAND(F.lit((1 << w) - 1))
        right = F.shiftrightunsigned("fp", t).bitwiseAND(F.lit((1 << v) - 1))
        cells.append(F.lit(c << 26).cast("long").bitwiseOR(F.shiftleft(left, 13)).bitwiseOR(right))
    placed = fps.select("fp", F.explode(F.array(*cells)).alias("cell"))
    full = placed.groupBy("cell").agg(F.count("*").alias("n")).where("n > 1")
    met = placed.join(full, "cell").withColumn("chunks", F.ceil(F.col("n") / CELL).cast("int"))
    met = met.withColumn("own", F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int"))
    met = met.withColumn("other", F.explode(F.expr("sequence(0, chunks - 1)")))
    met = met.select("cell", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "fp")
    keys = ["cell", "lo", "hi"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in sorted_groups(batches, keys):
            fp = pdf["fp"].to_numpy().view(np.uint64)
            starts = run_starts(*(pdf[k].to_numpy() for k in keys))
            a, b = links_in_cells(fp, pdf["own"].to_numpy(), starts, radius)
            root = roots_of(len(fp), a, b)
            at = np.flatnonzero(root != np.arange(len(fp)))
            signed = fp.view(np.int64)
            yield pd.DataFrame({"src": signed[at], "dst": signed[root[at]]})

    n = met.sparkSession.conf.get("spark.sql.shuffle.partitions")
    return met.repartition(int(n), *keys).sortWithinPartitions(*keys, "own").mapInPandas(run, "src long, dst long")


def classes_of(prints: DataFrame) -> DataFrame:
    """prints(id, fp) to rows (fp, root, component_id): every fingerprint with its component's least fingerprint and smallest id."""
    classes = prints.groupBy("fp").agg(F.min("id").alias("least"))
    edges = fingerprint_links(classes.select("fp"))
    roots = connected_components(edges).select(F.col("node").alias("fp"), F.col("component").alias("root"))
    rooted = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "root", "component_id")


def simhash_components(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Rows (id, fingerprint, component_id) for every row: component_id is the smallest id reachable over links."""
    prints = materialize(with_fingerprint(docs, id_column, text_column), "simhash")
    return prints.join(classes_of(prints).drop("root"), "fp").select(
        F.col("id").alias(id_column), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def simhash_dedup(docs: DataFrame) -> DataFrame:
    """docs with one row of each component: that of the smallest doc_id (a null doc_id comes last), of several rows of this id the one
    with the least hash of all its columns, of rows equal in all columns one. So the row that stays is a member of its component
    even where ids repeat or are null."""
    digest, keep, own = fresh(docs, "digest"), fresh(docs, "keep"), fresh(docs, "own")
    marked = docs.withColumn(digest, F.xxhash64(*docs.columns))
    prints = materialize(with_fingerprint(marked, "doc_id", "text", digest), "simhash")
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("first")
    kept = prints.join(classes_of(prints), "fp").groupBy("root").agg(first).select("first.id", "first.digest")
    kept = materialize(kept, "kept")
    several = prints.join(kept.select(F.col("id").alias("i"), F.col("digest").alias("d")), F.col("id").eqNullSafe(F.col("i")) & (F.col("digest") == F.col("d")))
    several = not several.groupBy("id", "digest").agg(F.count("*").alias("n")).where("n > 1").isEmpty()
    out = marked.join(kept.select(F.col("id").alias(keep), F.col("digest").alias(own)), marked["doc_id"].eqNullSafe(F.col(keep)) & (marked[digest] == F.col(own)), "left_semi")
    return (out.dropDuplicates(["doc_id", digest]) if several else out).drop(digest)
