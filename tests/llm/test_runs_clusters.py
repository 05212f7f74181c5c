"""Periodic runs and clustered vectors against plain versions."""

from __future__ import annotations

import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from vitalgrid.llm import bisector, periodic, queries


# ---- periodic runs ------------------------------------------------------------------------------

def plain_runs(words):
    """All runs by trying every period at every place."""
    n, found = len(words), []
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            if j > i and length >= max(24, 3 * q) and not any(
                    all(words[k] == words[k + p] for k in range(i, i + length - p)) for p in range(1, q)):
                found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def some_words(rng):
    words = []
    for _ in range(rng.randint(0, 5)):
        root = [rng.randint(0, rng.choice([1, 2, 4, 30])) for _ in range(rng.randint(1, 12))]
        words += (root * 40)[:rng.randint(1, 80)]
    return words


def test_runs_are_those_of_all_periods():
    rng = random.Random(7)
    for _ in range(300):
        texts = [some_words(rng) for _ in range(rng.randint(0, 4))]
        flat = np.array([w for t in texts for w in t], np.int64)
        owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts]).astype(np.int64)
        starts = np.cumsum([0, *map(len, texts)])
        found = [[] for _ in texts]
        for i, (start, length, period) in zip(*periodic.runs_of(flat, owner)):
            found[i].append((start - starts[i], length, period))
        assert found == [plain_runs(t) for t in texts]


def test_splitting_recurses():
    """Removing words that occur twice leaves parts in which other words are too rare, and so on."""
    words = np.array([1, 2, 3] * 10 + [9] + [4, 5] * 2 + [1, 2, 3] * 2 + [8] + [6] * 30, np.int64)
    place = periodic.surviving(words, np.zeros(len(words), np.int64))
    assert place.tolist() == [*range(30), *range(len(words) - 30, len(words))]
    assert periodic.surviving(np.arange(100) % 40, np.zeros(100, np.int64)).tolist() == []


def test_scan_is_not_quadratic():
    words = np.random.default_rng(1).integers(0, 2, 300_000)
    words[100_000:250_000] = words[np.arange(100_000, 250_000) % 50_000 + 100_000]
    words[99_999], words[250_000] = 7, 8
    runs = periodic.lag_scan(words)
    assert [r for r in runs.tolist() if r[2] >= 1000] == [[100_000, 150_000, 50_000]]


def plain_digest(doc_id, text):
    words = (text or "").encode().split()
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=(None, None, None))
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    return (doc_id, len(runs), *best, best[1] and math.floor(1000 * best[1] / best[2]),
            hashlib.sha256(listed.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query_of_runs(spark):
    rng = random.Random(3)
    texts = ["", None, "one", " \t\n ", "a " * 24, "a " * 23, "x y z " * 30, "  " * 40, "ab cd\x0bef\n" * 9,
             *[" ".join(f"w{w}" for w in some_words(rng)) for _ in range(120)]]
    rows = [*enumerate(texts), (None, "q r s " * 20), (7, "again " * 50), (7, "again " * 50)]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, n_runs string, period int")
    found = periodic.run_digests(docs)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256",
                             "collapsed_sha256"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted((plain_digest(i, t) for i, t in rows), key=str)
    assert periodic.run_digests(docs.limit(0)).count() == 0


def test_a_very_long_text(spark):
    text = " ".join(str(i % 70_000) for i in range(280_000))
    row = periodic.periodic_runs(spark.createDataFrame([(1, text)], "doc_id int, text string")).first()
    assert row["runs"] == [(0, 280_000, 70_000)] and row["n_words"] == 280_000
    assert row["collapsed"] == " ".join(map(str, range(70_000)))


# ---- clustered vectors --------------------------------------------------------------------------

def plain_clusters(rows, k=16, rounds=3, dimensions=64, scale=64):
    """Every vector against every centroid, in whole numbers of any size."""
    kept = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    centroids = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((a - b) ** 2 for a, b in zip(v, c))
    nearest = lambda v: min(range(len(centroids)), key=lambda c: (far(v, centroids[c]), c))
    for _ in range(rounds):
        members = [[] for _ in centroids]
        for _, v in kept:
            members[nearest(v)].append(v)
        centroids = [[sum(x) // len(m) for x in zip(*m)] if m else c for m, c in zip(members, centroids)]
    placed = [(i, nearest(v), v) for i, v in kept]
    inertia = [sum(far(v, centroids[c]) for _, c, v in placed if c == n) for n in range(len(centroids))]
    return [(i, c, far(v, centroids[c]), inertia[c], sum(inertia),
             hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for i, c, v in placed]


def clusters(spark, rows):
    frame = spark.createDataFrame([(i, v, 1, "x") for i, v in rows],
                                  "vec_id long, embedding array<float>, cluster int, n string")
    return sorted((tuple(r) for r in bisector.clustered(frame).collect()), key=str)


@pytest.mark.parametrize("seed", [1, 2])
def test_clusters_are_those_of_all_distances(spark, seed):
    """Small whole components: many ties, equal vectors, repeated and null ids; vectors that are left out."""
    rng = np.random.default_rng(seed)
    rows = [(i % 190, (rng.integers(-2, 3, 64) / (64 if i % 3 else 16)).tolist()) for i in range(260)]
    rows += [(None, rows[0][1]), (5, rows[0][1]), (400, None), (401, []), (402, [0.5] * 63), (403, [0.5] * 65),
             (404, [None, *[0.5] * 63]), (405, [float("nan"), *[0.5] * 63]), (406, [float("-inf"), *[0.5] * 63])]
    assert clusters(spark, rows) == sorted(plain_clusters(rows), key=str)


def test_few_and_no_vectors(spark):
    rows = [(i, [i / 7] * 64) for i in range(5)]
    assert clusters(spark, rows) == sorted(plain_clusters(rows), key=str)
    same = [(i, [0.25] * 64) for i in range(40)]
    assert clusters(spark, same) == sorted(plain_clusters(same), key=str)
    assert clusters(spark, []) == [] and clusters(spark, [(1, None)]) == []


def test_tournament_takes_the_smaller_number_at_zero():
    centroids = np.array([[0, 0], [4, 0], [0, 4], [4, 0]], np.int64)
    rows = np.array([[2, 0], [2, 2], [4, 0], [3, 1], [0, 3], [1, 3]], np.int64)
    assert bisector.Bisectors.of(centroids).winners(rows).tolist() == [0, 0, 1, 1, 2, 2]


def test_components_too_large_are_refused(spark):
    frame = spark.createDataFrame([(1, [1e30] * 64)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="do not fit 64 bits"):
        bisector.clustered(frame).collect()


def test_queries_cover_their_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    found = queries.op12_periodic_runs(spark, sf).collect()
    assert sorted(map(tuple, found), key=str) == sorted((plain_digest(*r) for r in docs if r), key=str)
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()
    found = queries.op13_bisector_clusters(spark, sf).collect()
    assert sorted(map(tuple, found), key=str) == sorted(plain_clusters(vectors), key=str)
