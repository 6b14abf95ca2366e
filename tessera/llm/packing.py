"""Best-fit packing by a grouping genetic algorithm on islands.

Documents become token ids (the 50k byte-level BPE vocabulary) and an end id; longer ones are cut into full sequences, their
remainder first. What is shorter than a sequence is packed. Items are numbered and dealt by the hash of their number into blocks of
about BLOCK, so that equal rows spread, and every block
is evolved on ISLANDS islands, each a task of its own with its own seed. A chromosome is a set of bins (Falkenauer, 1996):
crossover injects whole well-filled bins of one parent into the other, drops the bins that hold an item twice, and
best-fits the displaced items, largest first; mutation empties the worst bins. After each epoch every island's elite migrates to
its neighbour; the best island of a block decides. Bins that are still not nearly full after the first round, from all
blocks, are packed again together, so that the blocks' borders cost nothing.

Defined cases: null text counts as empty and gives the end id alone; a text of exactly one sequence is not cut; equal items
are interchangeable; repeated rows are packed each; the strings of special tokens get their ids, as the library gives them.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

LENGTH = 1024
END = 2
BLOCK = 8192
ISLANDS = 3
EPOCHS = 2
GENERATIONS = 4
POPULATION = 4
#: A bin filled to this share is done; the others are packed again across blocks.
NEARLY = 0.97
LONG_SPACE = 10_000
RUN = re.compile(rf"\s{{{LONG_SPACE}}}")


def vocabulary(path: str | None = None):
    """The byte-level vocabulary by the tokenizers library, from path or byte_bpe_50k.json."""
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path or public_tokenizers.path("byte_bpe_50k.json"))


class Encoder:
    """The ids that the tokenizers library gives for a text of byte_bpe_50k.json, add_special_tokens=False (tests compare them).

    Its ranks and pattern in tiktoken give the same ids in a sixth of the time. What that can't do is left to the library itself:
    strings of special tokens, and runs of white space of over LONG_SPACE, on which its pattern overflows the stack.
    """

    def __init__(self):
        import public_tokenizers
        import tiktoken

        with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.library = vocabulary()
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]

    def ids(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or len(text) > LONG_SPACE and RUN.search(text):
            return self.library.encode(text, add_special_tokens=False).ids
        return self.fast.encode_ordinary(text)


def pieces(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32) of all documents. path: another vocabulary of the tokenizers library."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path is None:
            encode = Encoder().ids
        else:
            own = vocabulary(path)
            encode = lambda t: own.encode(t, add_special_tokens=False).ids
        for batch in batches:
            at, piece, start, size, crc = [], [], [], [], []
            for i, t in enumerate(batch["text"].to_pylist()):
                ids = np.array([*encode(t or ""), END], dtype="<u4")
                first = (len(ids) - 1) % length + 1
                for k, s in enumerate([0, *range(first, len(ids), length)]):
                    part = ids[s : first if k == 0 else s + length]
                    at.append(i), piece.append(k), start.append(s), size.append(len(part)), crc.append(zlib.crc32(part.tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"].take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()), *(pa.array(x, pa.int64()) for x in (start, size, crc))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Bins:
    """Open bins of a chromosome, found by their free room."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.free = capacity, [], []
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.rooms = 0  # bit r is set if some bin has r free

    def add(self, items: list[int], free: int) -> None:
        self._file(len(self.bins), free)
        self.bins.append(items)
        self.free.append(free)

    def _file(self, k: int, free: int) -> None:
        self.by_free[free].append(k)
        self.rooms |= 1 << free

    def best_fit(self, item: int, size: int) -> None:
        room = self.rooms >> size
        if not room:
            self.add([item], self.capacity - size)
            return
        r = size + (room & -room).bit_length() - 1
        stack = self.by_free[r]
        k = stack.pop()
        if not stack:
            self.rooms &= ~(1 << r)
        self.bins[k].append(item)
        self.free[k] = r - size
        self._file(k, r - size)


def filled(sizes: list[int], order, capacity: int) -> Bins:
    out = Bins(capacity)
    for i in order:
        out.best_fit(i, sizes[i])
    return out


def fitness(b: Bins) -> float:
    """Fewer bins first, then the mean square of the filling (Falkenauer)."""
    n = len(b.bins)
    return -n + sum((1 - f / b.capacity) ** 2 for f in b.free) / max(n, 1)


def crossover(a: Bins, b: Bins, sizes: list[int], rng: np.random.Generator) -> Bins:
    """Inject about half of a's well-filled bins into b; bins of b that hold an injected item dissolve."""
    rank = np.argsort(np.array(a.free), kind="stable")
    well = rank[: max(1, len(rank) * 3 // 4)]
    injected = well[rng.random(len(well)) < 0.5]
    taken = set()
    child = Bins(a.capacity)
    for k in injected.tolist():
        child.add(list(a.bins[k]), a.free[k])
        taken.update(a.bins[k])
    displaced = []
    for items, free in zip(b.bins, b.free, strict=True):
        if taken.isdisjoint(items):
            child.add(list(items), free)
        else:
            displaced += [i for i in items if i not in taken]
    displaced.sort(key=sizes.__getitem__, reverse=True)
    for i in displaced:
        child.best_fit(i, sizes[i])
    return child


def mutated(b: Bins, sizes: list[int], rng: np.random.Generator) -> Bins:
    """Empty the worst bins and a few others, and best-fit their items, largest first."""
    n = len(b.bins)
    worst = set(np.argsort(-np.array(b.free), kind="stable")[: max(2, n // 50)].tolist())
    worst.update(rng.integers(0, n, max(1, n // 50)).tolist())
    child, loose = Bins(b.capacity), []
    for k, (items, free) in enumerate(zip(b.bins, b.free, strict=True)):
        if k in worst:
            loose += items
        else:
            child.add(list(items), free)
    loose.sort(key=sizes.__getitem__, reverse=True)
    for i in loose:
        child.best_fit(i, sizes[i])
    return child


def decoded(data: bytes, sizes: list[int], capacity: int) -> Bins:
    """The chromosome stored as the bin of each item."""
    of = np.frombuffer(data, dtype="<i4")
    out = Bins(capacity)
    order = np.argsort(of, kind="stable")
    for items in np.split(order, np.flatnonzero(np.diff(of[order])) + 1):
        if len(items):
            out.add(items.tolist(), capacity - sum(sizes[i] for i in items))
    return out


def encoded(b: Bins) -> bytes:
    of = np.empty(sum(map(len, b.bins)), dtype="<i4")
    for k, items in enumerate(b.bins):
        of[items] = k
    return of.tobytes()


def evolve(sizes: list[int], capacity: int, seed: list[int], elites: list[Bins], generations: int = GENERATIONS) -> Bins:
    """The fittest chromosome of one island after some generations, starting from elites and fresh ones. Ends early where the
    bins reach the lower bound."""
    rng = np.random.default_rng(seed)
    least = -(-sum(sizes) // capacity)
    s = np.array(sizes)
    people = list(elites)
    while len(people) < POPULATION:
        noise = rng.normal(0, 0.01 * capacity * len(people), len(s))
        people.append(filled(sizes, np.argsort(-(s + noise), kind="stable").tolist(), capacity))
    people.sort(key=fitness, reverse=True)
    for _ in range(generations):
        if len(people[0].bins) <= least:
            break
        i, j = sorted(rng.choice(len(people), 2, replace=False).tolist())
        children = [crossover(people[i], people[j], sizes, rng), crossover(people[j], people[i], sizes, rng), mutated(people[0], sizes, rng)]
        people = sorted([*people, *children], key=fitness, reverse=True)[:POPULATION]
    return people[0]


ELITE = "block long, island int, fitness double, bins binary"


def in_order(pdf: pd.DataFrame) -> pd.DataFrame:
    """The same order of a block's items in every task."""
    return pdf.sort_values(["length", "row"], ignore_index=True)


def alone(f):
    return lambda key, pdf: f(key, pdf, None)


def joined(f):
    return lambda key, pdf, moved: f(key, pdf, moved)


def packed_once(items: DataFrame, round_: int, length: int) -> DataFrame:
    """items(row, length, ...) with (block, sequence_id, offset, fill): one round over blocks by the hash of the unique row."""
    n = max(1, round(items.count() / BLOCK))
    placed = items.withColumn("block", F.pmod(F.xxhash64(F.lit(round_), "row"), F.lit(n)))
    light = placed.select("block", "row", "length", F.explode(F.array(*map(F.lit, range(ISLANDS)))).alias("island"))
    elites = None
    for epoch in range(EPOCHS):

        def island(key, pdf: pd.DataFrame, moved: pd.DataFrame | None, epoch: int = epoch) -> pd.DataFrame:
            block, isle = int(key[0]), int(key[1])
            sizes = in_order(pdf)["length"].tolist()
            known = [decoded(b, sizes, length) for b in (moved.sort_values("island")["bins"] if moved is not None else ()) if len(b)]
            best = evolve(sizes, length, [round_, block % 2**31, isle, epoch], known)
            return pd.DataFrame({"block": [block], "island": [isle], "fitness": [fitness(best)], "bins": [encoded(best)]})

        groups = light.groupBy("block", "island")
        if elites is None:
            elites = groups.applyInPandas(alone(island), ELITE)
        else:
            ring = F.explode(F.array("island", F.pmod(F.col("island") + 1, F.lit(ISLANDS)))).alias("to")
            moved = elites.select("block", ring, "island", "fitness", "bins").groupBy("block", F.col("to").alias("island_to"))
            elites = groups.cogroup(moved).applyInPandas(joined(island), ELITE)
        elites = materialize(elites, "elites")
    best = elites.groupBy("block").agg(F.max_by("bins", F.struct("fitness", "island")).alias("bins"))

    def place(pdf: pd.DataFrame, won: pd.DataFrame) -> pd.DataFrame:
        pdf = in_order(pdf)
        pdf["bin"] = np.frombuffer(won["bins"].iloc[0], dtype="<i4").astype(np.int64)
        pdf = pdf.sort_values(["bin", "row"])
        by = pdf.groupby("bin", sort=False)
        pdf["sequence_id"] = by["row"].transform("min")  # rows are unique, so are these
        pdf["offset"] = by["length"].cumsum() - pdf["length"]
        pdf["fill"] = by["length"].transform("sum")
        return pdf.drop(columns="bin")

    return placed.groupBy("block").cogroup(best.groupBy("block")).applyInPandas(
        place, f"{items.schema.simpleString()[7:-1]}, block bigint, sequence_id bigint, offset bigint, fill bigint".replace(":", " ")
    )


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset): every piece in its sequence."""
    cut = materialize(pieces(docs, path, length).withColumn("row", F.monotonically_increasing_id()), "pieces")
    names = cut.columns
    full = cut.where(F.col("length") == length).withColumns({"sequence_id": F.col("row"), "offset": F.lit(0).cast("long")})
    first = materialize(packed_once(cut.where(F.col("length") < length), 1, length), "packed")
    done = first.where(F.col("fill") >= NEARLY * length)
    loose = first.where(F.col("fill") < NEARLY * length).select(*names)
    second = packed_once(loose, 2, length)
    out = full.unionByName(done.select(full.columns)).unionByName(second.select(full.columns))
    return out.drop("row")
