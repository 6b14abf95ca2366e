"""What the operators of this subpackage share: materialised cuts, column hygiene, graph components."""

from __future__ import annotations

import re
import tempfile
import uuid
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Removes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of rows that travel to Python at once, about.
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where that is unset a temporary folder serves on one machine; on a
    cluster that is an error, as executors wouldn't see each other's files."""
    set_dir = spark.conf.get("spark.checkpoint.dir", None)
    if set_dir:
        return set_dir.rstrip("/")
    at = spark.sparkContext.getCheckpointDir()
    if at is None:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="tessera-checkpoint-"))
        at = spark.sparkContext.getCheckpointDir()
    return at.rstrip("/")


def materialize(df: DataFrame, name: str, compression: str | None = None, batch_bytes: int | None = None) -> DataFrame:
    """Cut the lineage: write df as Parquet in the shared folder and read it back.

    Unlike a local checkpoint the files outlive any executor. They stay until discard() or the owner of the folder removes them.
    The shuffle files of the plan that is cut off here aren't needed again and go when it has run. batch_bytes: of rows that
    travel to Python at once, for plans whose rows are large.
    """
    conf, path = df.sparkSession.conf, f"{shared_dir(df.sparkSession)}/tessera/{name}-{uuid.uuid4().hex}"
    settings = {CLEANUP: "true"} | ({} if batch_bytes is None else {BATCH_BYTES: str(batch_bytes)})
    before = {k: conf.get(k, None) for k in settings}
    for k, v in settings.items():
        conf.set(k, v)
    try:
        df.write.parquet(path, compression=compression)
    finally:
        for k, v in before.items():
            conf.unset(k) if v is None else conf.set(k, v)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written = path
    return out


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that materialize returned, once nothing will read it."""
    jvm = df.sparkSession.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(df.written)
    path.getFileSystem(df.sparkSession.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def crc_mod(id_column: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo; null ids count as the empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % modulus


def crc_fold(value, modulus: int) -> int:
    """What crc_mod gives for one id."""
    return zlib.crc32(b"" if value is None else str(value).encode()) % modulus


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def sorted_groups(batches: Iterator[pd.DataFrame], keys: list[str], target: int = 50_000) -> Iterator[pd.DataFrame]:
    """Frames of whole key groups out of batches sorted by the keys; each has about target rows or one group more.

    A group must be small enough for memory: callers bound it by chunking hot keys first.
    """
    held: list[pd.DataFrame] = []
    rows = 0
    for pdf in batches:
        if not len(pdf):
            continue
        held.append(pdf)
        rows += len(pdf)
        if rows < target:
            continue
        whole = pd.concat(held, ignore_index=True) if len(held) > 1 else held[0]
        last = np.ones(len(whole), dtype=bool)
        for k in keys:
            last &= (whole[k] == whole[k].iloc[-1]).to_numpy()
        cut = len(whole) - int(last.sum())
        if cut:
            yield whole.iloc[:cut].reset_index(drop=True)
        held = [whole.iloc[cut:].reset_index(drop=True)]
        rows = len(held[0])
    if rows:
        yield pd.concat(held, ignore_index=True)


def run_starts(*columns: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal rows in sorted columns."""
    n = len(columns[0])
    new = np.zeros(n, dtype=bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def roots_of(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n nodes over the links a-b, by label propagation with pointer jumping."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        low = np.minimum(la, lb)
        before = label.copy()
        np.minimum.at(label, la, low)
        np.minimum.at(label, lb, low)
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up
        if (before == label).all():
            break
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
    return label


def connected_components(edges: DataFrame) -> DataFrame:
    """Components of an undirected graph given as edges(src long, dst long): rows (node, component), component the
    smallest node; nodes without edges are absent.

    Alternating large-star and small-star steps (Kiveris et al., 2014), each a pre-aggregated minimum and an equi-join,
    so a hub's edges are spread over tasks. Every round is written to the shared folder; rounds grow with the logarithm
    of the longest path.
    """
    e = materialize(
        edges.where("src != dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges"
    )
    sign = None
    while True:
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if not now.n or (now.n, now.s) == sign:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component")).union(
                e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        sign = (now.n, now.s)
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        large = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        old, e = e, materialize(small.select(F.col("x.u").alias("u"), F.col("x.m").alias("v")).where("u != v").distinct(), "edges")
        discard(old)


class TokenTable:
    """A growing cache: token -> row of a value matrix. values(tokens) gives the rows of new tokens.

    At most about cap tokens stay: the table starts anew when a batch begins with more.
    """

    class Ids(dict):
        """Numbers tokens as they come; new: those since the last look."""

        def __init__(self):
            self.new = []

        def __missing__(self, token):
            i = self[token] = len(self)
            self.new.append(token)
            return i

    def __init__(self, values, cap: int = 300_000):
        self.values, self.cap = values, cap
        self.ids, self.rows = self.Ids(), None

    def begin(self) -> None:
        if len(self.ids) > self.cap:
            self.ids, self.rows = self.Ids(), None

    def look_up(self, words: list) -> np.ndarray:
        """Ids of the words; rows[ids] are then their values."""
        known = len(self.ids)
        out = np.fromiter(map(self.ids.__getitem__, words), dtype=np.int64, count=len(words))
        if self.ids.new:
            new, self.ids.new = self.values(self.ids.new), []
            if self.rows is None:
                self.rows = new
            else:
                if len(self.ids) > len(self.rows):
                    bigger = np.empty((max(2 * len(self.rows), len(self.ids)), *self.rows.shape[1:]), dtype=self.rows.dtype)
                    bigger[:known] = self.rows[:known]
                    self.rows = bigger
                self.rows[known : len(self.ids)] = new
        return out


def sampled(df: DataFrame, of: DataFrame, label: str, most: int, seed: int, by: Sequence[str]) -> DataFrame:
    """Distinct rows of df whose columns `by` hash below a share that keeps about `most` rows of each label value; of has its counts
    n. Rows equal in `by` are drawn together, so these columns should be all that df has, and equal rows count once."""
    share = of.select(F.col(label), F.least(F.lit(1.0), F.lit(float(most)) / F.col("n")).alias("share")).collect()
    draw = F.pmod(F.xxhash64(*by, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
    picked = F.lit(False)
    for r in share:
        picked = picked | ((F.col(label) == r[0]) & (draw < r[1]))
    return df.where(picked).distinct()


#: Rows of which one group is added up at most.
FAN = 64


def added_up(rows: DataFrame, parts: int, add, kind: str) -> DataFrame:
    """rows(slice, part, ...), one for each slice and each of the parts, added up to one a slice, in a tree of groups of FAN parts.
    add: a frame of equal slices to one row of the schema kind."""
    while parts > FAN:
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("slice", "part").applyInPandas(add, kind)
        parts = -(-parts // FAN)
    return rows.groupBy("slice").applyInPandas(add, kind)


def mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    out = (a * np.uint64(0x9E3779B97F4A7C15)) ^ b
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out


#: Bytes between words: ASCII white space, and everything but letters, digits and what isn't ASCII.
SPACE, SIGNS = np.zeros(256, dtype=bool), np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SIGNS[[i for i in range(128) if not chr(i).isalnum()]] = True
BASE = 0x9E3779B97F4A7C15


class Powers(dict):
    """base ** 0, 1, ... modulo 2 ** 64 by base. Travels empty: every process makes its own."""

    def __reduce__(self):
        return Powers, ()

    def of(self, base: int, n: int) -> np.ndarray:
        """At least n of them."""
        if base not in self or len(self[base]) < n:
            x = np.full(max(n, 1 << 17), base, dtype=np.uint64)
            x[0] = 1
            self[base] = np.multiply.accumulate(x)
        return self[base]


POWERS = Powers()


class Words:
    """The words of some texts: where each begins and ends in data, its hash, its text (owner), and each text's first word.

    Hashes are polynomials taken from one running sum over all bytes, so that no word is touched by itself.
    """

    def __init__(self, texts: Sequence[str | bytes | None], between: np.ndarray = SPACE):
        raw = [t if isinstance(t, bytes) else (t or "").encode("utf-8", "surrogatepass") for t in texts]
        self.data = b" ".join(raw) + b" "
        b = np.frombuffer(self.data, dtype=np.uint8)
        space = np.concatenate(([True], between[b]))
        self.start = np.flatnonzero(space[:-1] & ~space[1:])
        self.end = np.flatnonzero(~space[:-1] & space[1:])
        total = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum((b.astype(np.uint64) + np.uint64(1)) * POWERS.of(BASE, len(b))[: len(b)])))
        h = (total[self.end] - total[self.start]) * POWERS.of(pow(BASE, -1, 1 << 64), len(b))[self.start]
        self.hash = mixed(h, h >> np.uint64(32))
        size = np.fromiter(map(len, raw), dtype=np.int64, count=len(raw)) + 1
        text = np.cumsum(size) - size
        self.begin = np.searchsorted(self.start, text)
        self.owner = np.repeat(np.arange(len(raw)), np.diff(np.append(self.begin, len(self.start))))


def slices(batch: pa.RecordBatch, characters: int = 1_000_000) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch of about so many characters of text, whole rows each."""
    size = np.cumsum([len(t or "") for t in batch["text"].to_pylist()])
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + characters)))
        yield batch.slice(at, to - at)
        at = to


WHITE = re.compile(r"[\x20\x09-\x0D]")


def cut_at_space(text: str, characters: int) -> Iterator[str]:
    """Parts of a text of about so many characters; no word is cut."""
    at = 0
    while at < len(text):
        m = WHITE.search(text, at + characters)
        to = m.end() if m else len(text)
        yield text[at:to]
        at = to
