"""SimHash, embeddings and substrings against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tessera.llm import embeddings, simhash, substrings
from tessera.llm.common import connected_components

from .conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def ascii_lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def plain_simhash(text):
    words = WORDS.findall(ascii_lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [" ".join(words)]
    ones = [0] * 64
    for s in shingles:
        h = xxh64_intdigest(s.encode(), 42)
        for k in range(64):
            ones[k] += h >> k & 1
    return sum(1 << k for k in range(64) if 2 * ones[k] > len(shingles))


def plain_components(keys, linked):
    parent = list(range(len(keys)))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i in range(len(keys)):
        for j in range(i):
            if linked(i, j):
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(keys))]


def simhash_brute(rows):
    fps = [plain_simhash(t) for _, t in rows]
    comp = plain_components(fps, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    least = {}
    for (d, _), c in zip(rows, comp, strict=True):
        if d is not None:
            least[c] = min(d, least.get(c, d))
    return Counter((d, f"{f:016x}", least.get(c)) for (d, _), f, c in zip(rows, fps, comp, strict=True))


def test_simhash_odd_rows(odd_clash, odd_rows):
    got = Counter(map(tuple, simhash.simhash_components(odd_clash).collect()))
    assert got == simhash_brute([r[:2] for r in odd_rows])


def test_simhash_near_copies(spark):
    rng = random.Random(1)
    base = [prose(rng, 400) for _ in range(30)]
    rows = []
    for i in range(400):
        words = base[i % 30].split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(len(words))] = "edited"
        rows.append((i, " ".join(words)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = Counter(map(tuple, simhash.simhash_components(df).collect()))
    want = simhash_brute(rows)
    assert got == want and len({c for _, _, c in want}) < 300


def test_simhash_hot_cells(spark, monkeypatch):
    """Cells beyond their bound are split in chunks and lose no link."""
    rng = np.random.default_rng(2)
    center = rng.integers(0, 2**64, dtype=np.uint64)
    fps = {int(center)}
    while len(fps) < 400:
        fps.add(int(center) ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 5), replace=False)))
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "CELL", 50)
    df = spark.createDataFrame([(f - (1 << 64) if f >> 63 else f,) for f in fps], "fp long")
    roots = {r.node % 2**64: r.component for r in connected_components(simhash.fingerprint_links(df)).collect()}
    comp = plain_components(fps, lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 3)
    mine = [roots.get(f, f) for f in fps]
    assert len(set(zip(comp, mine, strict=True))) == len(set(comp)) == len(set(mine))


def test_simhash_dedup_keeps_one_of_each(odd_clash, empty):
    kept = simhash.simhash_dedup(odd_clash)
    assert kept.columns == odd_clash.columns
    ids = [r.doc_id for r in kept.select("doc_id").collect()]
    assert len(ids) == len(set(ids)) and {1, 4, 7, 9} <= set(ids) and not {2, 5, 6, 8} & set(ids)
    assert simhash.simhash_dedup(empty).count() == 0


def test_simhash_dedup_of_null_and_repeated_ids(spark):
    rng = random.Random(26)
    a, b, c, d = (prose(rng, 80) for _ in range(4))
    rows = [(None, a, 1), (None, b, 1), (1, c, 1), (1, d, 1), (2, d, 1), (2, d, 1), (3, c, 1), (None, None, 2), (None, None, 2)]
    kept = simhash.simhash_dedup(spark.createDataFrame(rows, "doc_id long, text string, digest int").repartition(3)).collect()
    assert Counter(tuple(r) for r in kept) == Counter([(None, a, 1), (None, b, 1), (1, c, 1), (1, d, 1), (None, None, 2)])


def test_embedding_recall_at_the_threshold(spark):
    """Pairs at a cosine of 0.9 and just above, among vectors that are unrelated."""
    rng = np.random.default_rng(27)
    x = rng.normal(size=(1500, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(axis=1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    c = rng.uniform(0.9001, 0.91, (len(x), 1))
    y = c * x + np.sqrt(1 - c * c) * side
    rows = [(i, v.tolist()) for i, v in enumerate(np.concatenate((x, y)))]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(4))
    assert got.where("vec_id >= 1500 and component_id = vec_id - 1500").count() >= 0.99 * len(x)


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "src long, dst long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}


def vectors_brute(rows, least=0.9):
    rows = [(i, tuple(v) if v is not None else None) for i, v in rows]
    ok = lambda i, v: i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    unit = [np.array(v, dtype=float) / np.linalg.norm(v) if ok(i, v) else None for i, v in rows]
    linked = lambda i, j: unit[i] is not None and unit[j] is not None and len(unit[i]) == len(unit[j]) and float(unit[i] @ unit[j]) >= least
    comp = plain_components(rows, linked)
    small = {}
    for (i, _), c in zip(rows, comp, strict=True):
        if i is not None:
            small[c] = min(i, small.get(c, i))
    n = [sum(linked(i, j) for j in range(len(rows)) if j != i) for i in range(len(rows))]
    return Counter((i, k, small.get(c), i is not None and small[c] == i) for (i, _), k, c in zip(rows, n, comp, strict=True))


def test_embeddings_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(300):
        if i % 3 == 0:
            center = rng.normal(size=16)
        rows.append((i, [float(x) for x in (center + rng.normal(size=16) * 0.08).astype(np.float32)]))
    rows += [(900, rows[0][1]), (900, rows[0][1]), (901, rows[0][1]), (902, None), (903, []), (904, [0.0] * 16), (905, [float("nan")] * 16), (906, [float("inf")] + [1.0] * 15)]
    rows += [(30, rows[0][1]), (30, rows[3][1]), (907, [None] + [1.0] * 15), (908, [1.0, 2.0]), (909, [2.0, 4.0]), (None, rows[0][1]), (910, [x * 3 for x in rows[0][1]])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as key", "2 as rep", "3 as x")
    got = embeddings.near_duplicates(df, recall=0.9999)
    assert Counter(map(tuple, got.collect())) == vectors_brute([(i, [None if x is None else float(np.float32(x)) for x in v] if v is not None else None) for i, v in rows])
    assert embeddings.near_duplicates(df.limit(0)).count() == 0


def test_embeddings_hot_buckets(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BUCKET", 40)
    rng = np.random.default_rng(4)
    center = rng.normal(size=32)
    rows = [(i, [float(x) for x in center + rng.normal(size=32) * 0.22]) for i in range(300)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = vectors_brute(rows)
    got = {r.vec_id: r for r in embeddings.near_duplicates(df).collect()}
    found, there = sum(r.n_links for r in got.values()), sum(k for _, k, _, _ in want)
    assert there > 1000 and 0.97 * there <= found <= there
    assert all(got[i].n_links <= k for i, k, _, _ in want)


def test_embedding_recall_follows_the_plan():
    for n in (10, 10_000, 10**9):
        k, tables = embeddings.plan(n, 0.9, 0.995)
        p = embeddings.collision(np.sqrt(0.2)) ** k
        assert 1 - (1 - p) ** tables >= 0.995 and n * embeddings.collision(np.sqrt(2)) ** k <= embeddings.EXPECTED * 1.5


def substrings_brute(rows, width=13):
    first = {}
    docs = [(d, WORDS.findall(t or "")) for d, t in rows]
    for d, w in docs:
        if d is not None:
            for i in range(len(w) - width + 1):
                k = tuple(w[i : i + width])
                first[k] = min(d, first.get(k, d))
    out = Counter()
    for d, w in docs:
        gone = set()
        for i in range(len(w) - width + 1):
            if d is not None and first[tuple(w[i : i + width])] < d:
                gone.update(range(i, i + width))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out[d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_substrings_odd_rows(odd_clash, odd_rows, empty):
    got = substrings.digest(substrings.dedup_substrings(odd_clash))
    assert Counter(map(tuple, got.collect())) == substrings_brute([r[:2] for r in odd_rows])
    assert substrings.dedup_substrings(empty).count() == 0


@pytest.mark.parametrize("hot", [16384, 8])
def test_substrings_shared_passages(spark, monkeypatch, hot):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "SEGMENTS", 200)
    rng = random.Random(6)
    passages = [prose(rng, n) for n in (12, 13, 14, 30, 80)] + ["again " * 40, "a b " * 30]
    rows = []
    for i in range(150):
        parts = [prose(rng, rng.randint(0, 30)) for _ in range(3)]
        parts.insert(rng.randint(0, 3), rng.choice(passages))
        if i % 5 == 0:
            parts.append(passages[3])
        rows.append((i // 2 if i % 40 == 0 else i, " ".join(parts)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = Counter(map(tuple, substrings.digest(substrings.dedup_substrings(df)).collect()))
    assert got == substrings_brute(rows)


def test_fm_index_matching_statistics():
    """Windows of foreign queries too, against a scan."""
    rng = np.random.default_rng(8)
    sequences = [rng.integers(1, 5, rng.integers(1, 60)) for _ in range(40)]
    owners = rng.integers(0, 1000, 40)
    index = substrings.FMIndex(sequences, owners, 7, window=9)
    queries = [rng.integers(1, 7, 50) for _ in range(20)] + [np.concatenate((sequences[k][:20], rng.integers(1, 7, 5), sequences[k][5:])) for k in range(40)]
    least = {}
    for s, d in zip(sequences, owners, strict=True):
        for i in range(len(s) - 8):
            k = tuple(s[i : i + 9])
            least[k] = min(int(d), least.get(k, 1 << 60))
    for q, m in zip(queries, index.statistics(queries, 1 << 60), strict=True):
        assert m.tolist() == [least.get(tuple(q[i : i + 9]), 1 << 60) for i in range(max(0, len(q) - 8))]


def test_wavelet_ranks():
    rng = np.random.default_rng(9)
    s = rng.integers(0, 37, 1000)
    w = substrings.WaveletMatrix(s, 37)
    c, at = rng.integers(0, 37, 500), rng.integers(0, 1001, 500)
    assert w.rank(c, at).tolist() == [int((s[:i] == k).sum()) for k, i in zip(c, at, strict=True)]




def test_segments_are_cut_at_words_that_occur_once():
    rng = random.Random(1)
    base = [[rng.choice("abcdefgh") for _ in range(40)] for _ in range(5)]
    segments, owners = [], []
    for i in range(300):
        w = list(rng.choice(base))[rng.randint(0, 20) :][: rng.randint(0, 30)]
        if rng.random() < 0.5 and w:
            w[rng.randrange(len(w))] = f"once{i}"
        segments.append(" ".join(w).encode())
        owners.append(rng.randint(0, 1000))
    least = {}
    windows = [[tuple(s.split()[i : i + 13]) for i in range(max(0, len(s.split()) - 12))] for s in segments]
    for ws, d in zip(windows, owners, strict=True):
        for k in ws:
            least[k] = min(d, least.get(k, d))
    got = substrings.least_owners(segments, np.array(owners))
    assert [g.tolist() for g in got] == [[least[k] for k in ws] for ws in windows]
    assert substrings.least_owners([], np.empty(0, dtype=np.int64)) == []
