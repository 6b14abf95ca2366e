"""Benchmark decontamination: rare n-gram seeds join passages to test items, Smith-Waterman alignment scores them.

Words are lower-case runs of letters and digits, split at Unicode separators and punctuation too; each sign of a script without
spaces is a word, so that word trigrams are character trigrams there. A first pass counts, over the whole corpus, in how many documents
each word trigram of the test items occurs. Of every SPAN consecutive trigrams of an item the rarest becomes a seed, so rarity
never leaves a stretch of an item unseeded: any run of N + SPAN - 1 equal words holds a seed. A second pass finds the seeds in
whole documents; hits of one item on near diagonals open a region, and a region that shares so many words with the item that it
could be reported is aligned (match 2, mismatch -1, gap -1). A pair's score is the best local alignment over that of a perfect copy;
pairs are reported from a score of THRESHOLD, and below it where the alignment is worth LONG matched words (CHARACTERS in scripts
without spaces).

The test items are the stated query set: they are taken in blocks of at most ITEMS items, each small enough to travel with the
tasks, and items longer than PIECE words are aligned in pieces, whose scores add up to the item's; a piece of 2 LONG words over each
cut makes sure that a passage across it is found. An item of fewer than N words matches where all its words stand on end, if they have
SHORT characters at least.

Defined cases: null or empty texts on either side match nothing; so does an item of fewer than N words and SHORT characters; ties keep the smallest
item id; repeated documents give repeated pairs; repeated items with one id count as one item (its best text).
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SIGNS, Words, mixed, run_starts, slices

N = 3
SPAN = 3
THRESHOLD = 0.5
ITEMS = 5000
PIECE = 256
BITS = 22
#: Matched words (characters in scripts without spaces) that tell a copy of a part, however long the item.
LONG, CHARACTERS = 20, 60
#: Least characters of an item of fewer than N words.
SHORT = 10


#: Signs from 128 up that separate words: Unicode separators and punctuation.
BREAKS = np.array([c for c in range(128, sys.maxunicode + 1) if unicodedata.category(chr(c))[0] in "ZP"])
SINGLE = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30fa\u30fc-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff]")


class Signs:
    """What a sign is by its code point: 0 part of a word, 1 a break, 2 a word of its own. Travels empty."""

    def __init__(self):
        self.table = None

    def __reduce__(self):
        return Signs, ()

    def of(self, code: np.ndarray) -> np.ndarray:
        if self.table is None:
            self.table = np.zeros(sys.maxunicode + 1, dtype=np.uint8)
            for a, b in re.findall(r"(.)-(.)", SINGLE.pattern[1:-1]):
                self.table[ord(a) : ord(b) + 1] = 2
            self.table[BREAKS] = 1
        return self.table[code]


SIGN_KINDS = Signs()


def split(text: str | None) -> str:
    """Lower-case text with white space wherever a word ends or begins that ASCII signs don't show."""
    text = (text or "").lower()
    if text.isascii():
        return text
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    kind = SIGN_KINDS.of(code)
    if not kind.any():
        return text
    alone = kind == 2
    size = np.where(alone, 3, 1)
    out = np.repeat(np.where(kind == 1, ord(" "), code).astype("<u4"), size)
    at = (np.cumsum(size) - size)[alone]
    out[at] = out[at + 2] = ord(" ")
    return out.tobytes().decode("utf-32-le", "surrogatepass")


def words_of(texts: list[str | None]) -> Words:
    """Lower-case runs of letters and digits, their hashes at least 2."""
    w = Words([split(t) for t in texts], SIGNS)
    np.maximum(w.hash, np.uint64(2), out=w.hash)
    return w


def grams(h: np.ndarray, size: int = N) -> np.ndarray:
    """Hash of each run of so many words."""
    m = len(h) - size + 1
    if m <= 0:
        return np.empty(0, dtype=np.uint64)
    out = h[:m]
    for i in range(1, size):
        out = mixed(out, h[i : i + m])
    return out


def seeds_in(w: Words, lookup: Lookup) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, word place in it, key) of the known grams in some texts."""
    at, key = lookup.find(grams(w.hash))
    inside = w.owner[at] == w.owner[at + N - 1]
    at, key = at[inside], key[inside]
    return w.owner[at], at - w.begin[w.owner[at]], key


class Lookup:
    """Membership and place in a sorted set of hashes, behind a bitmap."""

    def __init__(self, keys: np.ndarray):
        self.keys = np.unique(keys)
        self.bitmap = np.zeros(1 << BITS, dtype=bool)
        self.bitmap[(self.keys >> np.uint64(64 - BITS)).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in h that hold keys, and which."""
        at = np.flatnonzero(self.bitmap[(h >> np.uint64(64 - BITS)).astype(np.int64)])
        if not len(at) or not len(self.keys):
            return at[:0], at[:0]
        k = np.minimum(np.searchsorted(self.keys, h[at]), len(self.keys) - 1)
        ok = self.keys[k] == h[at]
        return at[ok], k[ok]


def smith_waterman(items: list[np.ndarray], regions: list[np.ndarray]) -> np.ndarray:
    """Best local alignment score of each item with its region; all pairs advance together, an item's word at a time."""
    rows, cols = max(map(len, items)), max(map(len, regions))
    a = np.zeros((len(items), rows), dtype=np.uint64)
    b = np.ones((len(items), cols), dtype=np.uint64)
    for i, (x, y) in enumerate(zip(items, regions, strict=True)):
        a[i, : len(x)] = x
        b[i, : len(y)] = y
    ramp = np.arange(cols + 1, dtype=np.int32)
    h = np.zeros((len(items), cols + 1), dtype=np.int32)
    best = np.zeros(len(items), dtype=np.int32)
    for i in range(rows):
        t = np.zeros_like(h)
        np.maximum(h[:, :-1] + np.where(a[:, i : i + 1] == b, 2, -1), h[:, 1:] - 1, out=t[:, 1:])
        np.maximum(t, 0, out=t)
        h = np.maximum.accumulate(t + ramp, axis=1) - ramp  # gaps along the region
        np.maximum(best, h.max(axis=1), out=best)
    return best


class Piece(NamedTuple):
    """Some words of a test item."""

    item: int
    words: np.ndarray
    tell: int  #: matched words that tell, however long the item
    whole: int  #: words of the item
    text: int  #: number of the item's text
    part: int  #: place in the item, -1 over a cut


class Matcher:
    """Scores documents against one block of test items, given the document frequency of each trigram."""

    def __init__(self, items: list[Piece], frequency: dict[int, int]):
        self.short: dict[int, dict[int, set[int]]] = {}
        for x in items:
            if len(x.words) < N:
                self.short.setdefault(len(x.words), defaultdict(set))[int(grams(x.words, len(x.words))[0])].add(x.item)
        items = [x for x in items if len(x.words) >= N]
        self.items = items
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for k, x in enumerate(items):
            g = grams(x.words)
            df = np.array([frequency.get(int(y), 0) for y in g])
            picked = {s + int(df[s : s + SPAN].argmin()) for s in range(max(1, len(g) - SPAN + 1))} if len(g) else set()
            for j in picked:
                seeds[int(g[j])].append((k, j))
        self.lookup = Lookup(np.array(list(seeds), dtype=np.uint64))
        self.places = [np.array(seeds[int(x)], dtype=np.int64) for x in self.lookup.keys]
        self.memo: dict[tuple[int, bytes], int] = {}

    def regions(self, n_words: int, at: np.ndarray, key: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, from, to) for the candidate regions of a document with these seeds."""
        size = np.array([len(self.places[k]) for k in key])
        hit = np.concatenate([self.places[k] for k in key])
        item, diagonal = hit[:, 0], np.repeat(at, size) - hit[:, 1]
        order = np.lexsort((diagonal, item))
        item, diagonal = item[order], diagonal[order]
        length = np.array([len(self.items[k].words) for k in item])
        new = np.concatenate(([True], (item[1:] != item[:-1]) | (np.diff(diagonal) > length[1:] // 2)))
        starts = np.flatnonzero(new)
        for s, e in zip(starts.tolist(), np.append(starts[1:], len(item)).tolist(), strict=True):
            n = int(length[s])
            yield int(item[s]), max(0, int(diagonal[s]) - n // 2), min(n_words, int(diagonal[e - 1]) + n + n // 2)

    def match(self, texts: list[str | None]) -> list[dict[int, float]]:
        """For each text: item id -> score, where it reaches THRESHOLD."""
        if len(self.memo) > 50_000:
            self.memo = {}
        w = words_of(texts)
        owner, place, key = seeds_in(w, self.lookup)
        asked: list[tuple[int, int, tuple[int, bytes]]] = []
        open_: dict[tuple[int, bytes], np.ndarray] = {}
        starts = run_starts(owner)
        ends = np.append(w.begin[1:], len(w.hash))
        for a, b in zip(starts.tolist(), np.append(starts[1:], len(owner))[: len(starts)].tolist(), strict=True):
            i = int(owner[a])
            words = w.hash[w.begin[i] : ends[i]]
            for k, s, e in self.regions(len(words), place[a:b], key[a:b]):
                part = words[s:e]
                own = self.items[k]
                if np.isin(own.words, part).sum() < min(THRESHOLD * len(own.words), own.tell):  # a word found is worth 2 at most
                    continue
                at = (k, part.tobytes())
                asked.append((i, k, at))
                if at not in self.memo:
                    open_[at] = part
        todo = sorted(open_, key=lambda x: len(x[1]))
        for at in range(0, len(todo), 128):
            some = todo[at : at + 128]
            score = smith_waterman([self.items[k].words for k, _ in some], [open_[x] for x in some])
            self.memo.update(zip(some, map(int, score), strict=True))
        best: dict[tuple[int, int], dict[int, int]] = defaultdict(dict)  # of each document, item text and piece
        of: dict[int, Piece] = {}
        for d, k, key in asked:
            own = of[self.items[k].text] = self.items[k]
            parts = best[d, own.text]
            parts[own.part] = max(self.memo[key], parts.get(own.part, 0))
        out: list[dict[int, float]] = [{} for _ in texts]
        for (d, text), parts in best.items():
            own, most = of[text], max(parts.values())
            s = max(most, sum(x for k, x in parts.items() if k >= 0)) / (2 * own.whole)
            if s >= THRESHOLD or most >= 2 * own.tell:
                out[d][own.item] = max(s, out[d].get(own.item, 0.0))
        for size, known in self.short.items():
            g = grams(w.hash, size)
            for at in np.flatnonzero(np.isin(g, np.array(list(known), dtype=np.uint64))).tolist():
                if w.owner[at] == w.owner[at + size - 1]:
                    out[w.owner[at]].update(dict.fromkeys(known[int(g[at])], 1.0))
        return out


def blocks(benchmark: DataFrame) -> Iterator[list[Piece]]:
    """The test items in blocks of about ITEMS, as word hashes in pieces of at most PIECE words."""
    known = benchmark.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    n = max(1, -(-known.count() // ITEMS))
    for k in range(n):
        rows = known.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        out = []
        for i, r in enumerate(sorted(rows, key=lambda r: (r.item_id, r.text))):
            h = words_of([r.text]).hash
            if len(h) < N:
                if len(h) and sum(map(str.isalnum, r.text)) >= SHORT:
                    out.append(Piece(r.item_id, h, len(h), len(h), i, 0))
                continue
            tell = CHARACTERS if 2 * len(SINGLE.findall(r.text)) > len(h) else LONG
            pieces = np.array_split(h, -(-len(h) // PIECE))
            out += [Piece(r.item_id, p, tell, len(h), i, k) for k, p in enumerate(pieces)]
            for at in np.cumsum([len(p) for p in pieces[:-1]]).tolist():
                out.append(Piece(r.item_id, h[max(0, at - tell) : at + tell], tell, len(h), i, -1))
        yield out


def frequencies(docs: DataFrame, items: list[Piece]) -> dict[int, int]:
    """In how many rows of docs each trigram of the items occurs; at most one row a trigram comes back."""
    lookup = Lookup(np.concatenate([grams(x.words) for x in items]) if items else np.empty(0, dtype=np.uint64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(lookup.keys), dtype=np.int64)
        for part in chain.from_iterable(map(slices, batches)):
            owner, _, key = seeds_in(words_of(part["text"].to_pylist()), lookup)
            if len(key):
                n += np.bincount(np.unique(owner * len(n) + key) % len(n), minlength=len(n))
        at = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(n[at])], ["k", "n"])

    rows = docs.select("text").mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect()
    return {int(lookup.keys[r.k]): r.n for r in rows}


def matches(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Rows (doc_id, item_id long, score): every document with every test item that it holds a copy of."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    out = None
    for items in blocks(benchmark):
        matcher = Matcher(items, frequencies(docs, items))

        def run(batches: Iterator[pa.RecordBatch], matcher: Matcher = matcher) -> Iterator[pa.RecordBatch]:
            for batch in chain.from_iterable(map(slices, batches)):
                found = matcher.match(batch["text"].to_pylist())
                at = pa.array([i for i, x in enumerate(found) for _ in x], pa.int64())
                item = pa.array([int(k) for x in found for k in sorted(x)], pa.int64())
                score = pa.array([x[k] for x in found for k in sorted(x)], pa.float64())
                yield pa.RecordBatch.from_arrays([batch["doc_id"].take(at), item, score], ["doc_id", "item_id", "score"])

        part = docs.mapInArrow(run, f"doc_id {kind}, item_id long, score double")
        out = part if out is None else out.unionByName(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], f"doc_id {kind}, item_id long, score double")


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs, all columns, that hold no copy of a test item."""
    for items in blocks(benchmark):
        matcher = Matcher(items, frequencies(docs, items))

        def run(batches: Iterator[pa.RecordBatch], matcher: Matcher = matcher) -> Iterator[pa.RecordBatch]:
            for batch in chain.from_iterable(map(slices, batches)):
                found = matcher.match(batch["text"].to_pylist())
                yield batch.filter(pa.array([not x for x in found], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
