"""Substring dedup: a compressed FM-index per shard, searched backward for the matching statistics of streamed documents.

Windows of WINDOW words that two documents share must meet in one shard without sending every document to every shard. A
window's anchor is the least hash among its runs of GRAM words, so equal windows have equal anchors, and the windows of a
document fall into short segments of one anchor each. Anchors that only one document has can't repeat and go no further. The
segments of the others are dealt by anchor; equal segments are merged first and keep their smallest document. In a shard an
FM-index over all its segments (wavelet matrix of the Burrows-Wheeler transform, bits packed with block counts; neither the suffix
array nor the words are kept) is searched backward with every segment: each step prepends a word and, once WINDOW words match, drops
the last one by widening the interval to the rows that share WINDOW words. A bit marks the first row of each such run, and only runs
know the smallest document that has the window. Anchors of over HOT documents are split further by the window's own hash, so that no
shard holds an unbounded group.

Defined cases: null and empty text have no words; a null doc_id is neither smaller nor larger than any other and loses nothing;
rows that share a doc_id don't count against each other; a window that only repeats within one document stays.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import TokenTable, Words, materialize, mixed, run_starts, slices, sorted_groups

WINDOW = 13
GRAM = 7
#: An anchor of more documents is split by window.
HOT = 2048
#: Distinct segments indexed together, about; a shard's groups stay whole.
SEGMENTS = 16384


class Bits:
    """A packed bit sequence and a count of ones for each 64 of them."""

    def __init__(self, bit: np.ndarray):
        padded = np.zeros((len(bit) // 64 + 1) * 64, dtype=bool)
        padded[: len(bit)] = bit
        self.words = np.packbits(padded, bitorder="little").view("<u8")
        self.counts = np.concatenate(([0], np.cumsum(np.bitwise_count(self.words), dtype=np.int32)[:-1])).astype(np.int32)

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before position at."""
        block = at >> 6
        below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[block] + np.bitwise_count(self.words[block] & below)


class WaveletMatrix:
    """Rank of symbols in a sequence, a bit plane a level."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.planes, self.zeros = [], []
        s = symbols
        for level in reversed(range(self.levels)):
            bit = (s >> level & 1).astype(bool)
            self.planes.append(Bits(bit))
            self.zeros.append(len(s) - int(bit.sum()))
            s = np.concatenate((s[~bit], s[bit]))
        self.first = self.down(np.arange(sigma), np.zeros(sigma, dtype=np.int64))

    def down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where position at of the sequence lands among the occurrences of symbol, from the start of the last level."""
        for k, level in enumerate(reversed(range(self.levels))):
            ones = self.planes[k].rank(at)
            at = np.where(symbol >> level & 1, self.zeros[k] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol occurs before position at."""
        return self.down(symbol, at) - self.first[symbol]


def ranked(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Dense ranks of the keys, and the order that sorts them."""
    order = np.argsort(key, kind="stable")
    k = key[order]
    r = np.empty(len(key), dtype=np.int64)
    r[order] = np.cumsum(np.concatenate(([0], k[1:] != k[:-1])))
    return r, order


class FMIndex:
    """Index of word sequences, each with an owner. Sorted by the first 16 words, which patterns of at most 16 don't exceed.
    foreign: queries may hold what no sequence does."""

    def __init__(self, sequences: list[np.ndarray], owners: np.ndarray, sigma: int, window: int = WINDOW, foreign: bool = True):
        if window > 15:
            raise ValueError("windows of at most 15 words")
        text = np.concatenate([x for s in sequences for x in (s, [0])])  # words count from 1, 0 ends a sequence
        n, self.window = len(text), window
        owner = np.repeat(owners, [len(s) + 1 for s in sequences])
        shifted = lambda r, d: np.concatenate((r[d:], np.zeros(min(d, n), dtype=np.int64)))[:n]
        r = text.astype(np.int64) + 1  # 0 stands past the end
        by = {1: r}
        for d in (1, 2, 4):
            r = by[2 * d] = ranked(r * (n + 2) + shifted(r, d))[0] + 1
        _, sa = ranked(r * (n + 2) + shifted(r, 8))
        self.bwt = WaveletMatrix(text[sa - 1], sigma)
        self.before = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))[:sigma]
        # rows that share the first `window` words: the widened interval, and its smallest owner
        a = r[sa]
        b = shifted(r, window - 8)[sa] if window >= 8 else ranked(text)[0][sa]
        starts = run_starts(a, b)
        self.n, self.runs, self.bounds = n, Bits(np.bincount(starts, minlength=n)), np.append(starts, n).astype(np.int32)
        self.least = np.minimum.reduceat(owner[sa], starts)
        self.depths = {}
        if foreign:
            # words that each row shares with the row before, up to the window: a pattern that fails drops words by them
            self.common, same = np.zeros(n, dtype=np.uint8), np.arange(n) > 0
            for d in range(window):
                x = text[np.minimum(sa + d, n - 1)]
                x[sa + d >= n] = -1
                same[1:] &= x[1:] == x[:-1]
                self.common += same

    def run(self, row: np.ndarray) -> np.ndarray:
        """Number of the run of rows that share the first `window` words with each row."""
        return self.runs.rank(row + 1) - 1

    def extend(self, word: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward step: the intervals of word + pattern."""
        return self.before[word] + self.bwt.rank(word, low), self.before[word] + self.bwt.rank(word, high)

    def widened(self, row: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
        """The intervals of the rows that share their first depth words with the given rows."""
        if depth not in self.depths:
            first = self.common < depth
            first[0] = True
            self.depths[depth] = Bits(first), np.append(np.flatnonzero(first), self.n).astype(np.int32)
        marks, bounds = self.depths[depth]
        run = marks.rank(row + 1) - 1
        return bounds[run], bounds[run + 1]

    def statistics(self, queries: list[np.ndarray], none: int) -> list[np.ndarray]:
        """For each query and each of its windows the smallest owner of a sequence that holds the window; none if none does.

        All queries advance together from their ends; a failed step drops words from the end of the match until it succeeds.
        """
        size = np.array([len(q) for q in queries])
        order = np.argsort(-size, kind="stable")
        flat = np.concatenate([queries[i] for i in order])
        end = np.cumsum(size[order])
        sorted_size = size[order]
        low, high = np.zeros(len(queries), dtype=np.int64), np.full(len(queries), self.n)
        matched = np.zeros(len(queries), dtype=np.int64)
        out = np.full(len(flat), none, dtype=np.int64)
        for step in range(1, int(sorted_size[0]) + 1 if len(queries) else 0):
            m = int(np.searchsorted(-sorted_size, -step, side="right"))
            at = end[:m] - step
            was = low[:m].copy(), high[:m].copy()
            low[:m], high[:m] = self.extend(flat[at], *was)
            matched[:m] += 1
            lost = np.flatnonzero(low[:m] >= high[:m])
            while len(lost):
                # no sequence holds word + pattern: drop the pattern's last word and try again
                matched[lost] -= 1
                gone = lost[matched[lost] == 0]
                low[gone], high[gone] = 0, self.n
                lost = lost[matched[lost] > 0]
                for depth in np.unique(matched[lost]) - 1:
                    some = lost[matched[lost] == depth + 1]
                    was[0][some], was[1][some] = self.widened(was[0][some], int(depth))
                low[lost], high[lost] = self.extend(flat[at[lost]], was[0][lost], was[1][lost])
                lost = lost[low[lost] >= high[lost]]
            full = np.flatnonzero(matched[:m] >= self.window)
            if len(full):
                run = self.run(low[full])
                low[full], high[full] = self.bounds[run], self.bounds[run + 1]
                matched[full] = self.window
                out[at[full]] = self.least[run]
        begin = end - sorted_size
        result: list[np.ndarray] = [out[:0]] * len(queries)
        for k, i in enumerate(order.tolist()):
            result[i] = out[begin[k] : begin[k] + max(0, size[i] - self.window + 1)]
        return result


def gram_hashes(h: np.ndarray) -> np.ndarray:
    """Hash of each run of GRAM words, by overlapping halves."""
    two = mixed(h[:-1], h[1:])
    four = mixed(two[:-2], two[2:])
    return mixed(four[:-3], four[3:])


def window_anchors(g: np.ndarray) -> np.ndarray:
    """The anchor of each window: the least hash among its runs of GRAM words."""
    two = np.minimum(g[:-1], g[1:])
    four = np.minimum(two[:-2], two[2:])
    return np.minimum(four[:-3], four[3:]).view(np.int64)


def split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


def runs_of_anchors(w: Words):
    """(gram hashes, owner, from, to and anchor of each run of windows)."""
    none = np.empty(0, dtype=np.int64)
    if len(w.hash) < WINDOW:
        return none, none, none, none, none
    g = gram_hashes(w.hash)
    a = window_anchors(g)
    owner = w.owner[: len(a)]
    inside = owner == w.owner[WINDOW - 1 :]
    new = inside.copy()
    new[1:] &= (a[1:] != a[:-1]) | ~inside[:-1]  # a window that crosses texts ends a run
    start = np.flatnonzero(new)
    stops = np.flatnonzero(np.append(new | ~inside, True))
    end = stops[np.searchsorted(stops, start, side="right")]
    return g, owner[start], start, end, a[start]


def anchors(docs: DataFrame) -> DataFrame:
    """Rows (mark, anchor) of each document's segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chain.from_iterable(map(slices, batches)):
            _, owner, _, _, anchor = runs_of_anchors(Words(part["text"].to_pylist()))
            yield pa.RecordBatch.from_arrays([part["mark"].take(pa.array(owner)), pa.array(anchor)], ["mark", "anchor"])

    return docs.select("mark", "text").mapInArrow(run, "mark long, anchor long")


def segments(candidates: DataFrame) -> DataFrame:
    """candidates(doc_id, text, mark, shared: array of (anchor, parts)) to rows (anchor, part, segment, doc_id, mark, start)."""
    kind = candidates.schema["doc_id"].dataType.simpleString()
    names = ["anchor", "part", "segment", "doc_id", "mark", "start"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in chain.from_iterable(map(slices, batches)):
            words = Words(part["text"].to_pylist())
            g, owner, start, end, anchor = runs_of_anchors(words)
            size = part["shared"].value_lengths().to_numpy(zero_copy_only=False)
            flat = part["shared"].flatten()
            pair = lambda who, a: a.view(np.uint64) ^ ((who.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15))
            wanted = pair(np.repeat(np.arange(len(part)), size), flat.field("anchor").to_numpy(zero_copy_only=False))
            order = np.argsort(wanted)
            wanted, parts = wanted[order], flat.field("parts").to_numpy(zero_copy_only=False).astype(np.int64)[order]
            if not len(start) or not len(wanted):
                continue
            have = pair(owner, anchor)
            at = np.minimum(np.searchsorted(wanted, have), len(wanted) - 1)
            ok = wanted[at] == have
            owner, start, end, anchor, n = owner[ok], start[ok], end[ok], anchor[ok], parts[at[ok]]
            hot = n > 1
            count = np.where(hot, end - start, 1)  # windows of a hot anchor go one by one
            rank = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
            owner, anchor, n, hot = (np.repeat(x, count) for x in (owner, anchor, n, hot))
            start = np.repeat(start, count) + rank
            end = np.where(hot, start + 1, np.repeat(end, count))
            deal = np.zeros(len(start), dtype=np.int32)
            if hot.any():
                w = start[hot]
                deal[hot] = (mixed(g[w], g[w + WINDOW - GRAM]) >> np.uint64(8)) % n[hot].astype(np.uint64)
            ends = words.end[end + WINDOW - 2]
            segment = [words.data[a:b] for a, b in zip(words.start[start].tolist(), ends.tolist(), strict=True)]
            take = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchor), pa.array(deal), pa.array(segment, pa.binary()), part["doc_id"].take(take), part["mark"].take(take), pa.array((start - words.begin[owner]).astype(np.int32))], names
            )

    return candidates.select("doc_id", "text", "mark", "shared").mapInArrow(run, f"anchor long, part int, segment binary, doc_id {kind}, mark long, start int")


def least_owners(segments: Sequence[bytes], owners: np.ndarray) -> list[np.ndarray]:
    """For each window of each segment the smallest owner among all segments that hold it.

    A window with a word that occurs once in the shard occurs once, so segments are cut at such words and only pieces of a
    window and more are indexed and searched.
    """
    ids = TokenTable.Ids()
    ids[b""] = 0
    each = [s.split() for s in segments]
    size = np.fromiter(map(len, each), dtype=np.int64, count=len(each))
    flat = np.fromiter(map(ids.__getitem__, chain.from_iterable(each)), dtype=np.int64, count=int(size.sum()))
    begin = np.cumsum(size) - size
    windows = np.maximum(size - WINDOW + 1, 0)
    at = np.cumsum(windows) - windows
    out = np.repeat(owners, windows)
    common = np.bincount(flat, minlength=len(ids))[flat] > 1
    new = common.copy()
    new[1:] &= ~common[:-1]
    new[begin[size > 0]] = common[begin[size > 0]]
    edges = np.append(np.flatnonzero(new | ~common), len(flat))
    start = np.flatnonzero(new)
    end = edges[np.searchsorted(edges, start, side="right")]
    long = end - start >= WINDOW
    start, end = start[long], end[long]
    if len(start):
        seen, number = np.unique(np.concatenate([flat[a:b] for a, b in zip(start, end, strict=True)]), return_inverse=True)
        pieces = np.split(number + 1, np.cumsum(end - start)[:-1])
        of = np.searchsorted(begin, start, side="right") - 1
        found = FMIndex(pieces, owners[of], len(seen) + 1, foreign=False).statistics(pieces, np.iinfo(np.int64).max)
        to = at[of] + start - begin[of]
        spread = np.repeat(to - np.cumsum([0, *map(len, found[:-1])]), [len(f) for f in found]) + np.arange(sum(map(len, found)))
        out[spread] = np.concatenate(found)
    return np.split(out, np.cumsum(windows)[:-1]) if len(windows) else []


def search(distinct: DataFrame) -> DataFrame:
    """distinct(anchor, part, segment, least, n) to rows (anchor, sid, mins): for each segment that may matter the smallest document of
    each of its windows."""
    keys = ["anchor", "part"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in sorted_groups(batches, keys, SEGMENTS):
            mins = least_owners(pdf["segment"], pdf["least"].to_numpy().astype(np.int64))
            owners = pdf["least"].to_numpy()
            keep = [i for i, (m, d, n) in enumerate(zip(mins, owners, pdf["n"], strict=True)) if n > 1 or (m < d).any()]
            yield pd.DataFrame({"anchor": pdf["anchor"].iloc[keep], "sid": pdf["sid"].iloc[keep], "mins": pd.Series([mins[i] for i in keep], index=pdf.index[keep], dtype=object)})

    shuffle = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = distinct.repartition(shuffle, *keys).sortWithinPartitions(*keys)
    return dealt.mapInPandas(run, "anchor long, sid long, mins array<long>")


def repeated_windows(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, mark, found: sets of starts): the starts of windows that a smaller doc_id has; mark tells apart rows of one doc_id,
    and what is gathered is at most one text's."""
    known = docs.where("doc_id is not null and text is not null").select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
    light = anchors(known)
    shared = light.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1")
    shared = shared.select("anchor", F.ceil(F.col("n") / HOT).cast("int").alias("parts"))
    own = light.join(shared, "anchor").groupBy("mark").agg(F.collect_set(F.struct("anchor", "parts")).alias("shared"))
    candidates = known.join(own, "mark")
    placed = materialize(segments(candidates).withColumn("sid", F.xxhash64("segment")), "segments", compression="zstd")
    distinct = placed.groupBy("anchor", "part", "segment", "sid").agg(F.min("doc_id").alias("least"), F.count("*").alias("n"))
    hit = materialize(search(distinct), "matches", compression="zstd")
    met = placed.select("anchor", "sid", "doc_id", "mark", "start").join(hit, ["anchor", "sid"])
    starts = F.filter(F.transform("mins", lambda m, j: F.when(m < F.col("doc_id"), F.col("start") + j)), lambda x: x.isNotNull())
    met = met.select("doc_id", "mark", starts.alias("starts")).where(F.size("starts") > 0)
    return met.groupBy("doc_id", "mark").agg(F.collect_set("starts").alias("found"))


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, ...) with n_words, n_removed and kept (text of the kept words, joined by one space) in place of text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = repeated_windows(docs)
    rows = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"))
    rows = rows.join(found, ["doc_id", "mark"], "left").select("doc_id", "text", "found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, kept = [], [], []
            for t, hits in zip(b["text"].to_pylist(), b["found"].to_pylist(), strict=True):
                words = split(t)
                starts = [s for x in hits or () for s in x]
                n_words.append(len(words))
                if starts:
                    edge = np.zeros(len(words) + 1, dtype=np.int64)
                    s = np.unique(np.array(starts, dtype=np.int64))
                    np.add.at(edge, s, 1)
                    np.add.at(edge, s + WINDOW, -1)
                    stay = np.flatnonzero(np.cumsum(edge[:-1]) == 0)
                    n_removed.append(len(words) - len(stay))
                    words = [words[i] for i in stay.tolist()]
                else:
                    n_removed.append(0)
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays([b["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary())], ["doc_id", "n_words", "n_removed", "kept"])

    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept binary")


def digest(kept: DataFrame) -> DataFrame:
    """kept as its SHA-256 in lower-case hexadecimal."""
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))
