"""Exact and near dedup against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest

from registrar.llm import exact_dedup, graph, minhash
from registrar.llm.shingles import shingle_set, word_hashes

from .conftest import prose


def brute_exact(rows):
    groups = {}
    for d, t, *_ in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(d)
    out = []
    for norm, ids in groups.items():
        keep = min((d for d in ids if d is not None), default=None)
        for d in ids:
            out.append((d, keep, len(ids), hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str), len(groups)


@pytest.mark.parametrize("least", [64, 5])  # with and without salted groups of the many copies
def test_exact_duplicates(docs, rows, monkeypatch, least):
    monkeypatch.setattr(exact_dedup, "HOT_LEAST", least)
    found = exact_dedup.exact_duplicates(docs).collect()
    want, groups = brute_exact(rows)
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == want
    kept = [r for r in found if r.kept]
    assert len(kept) == groups and all(r.doc_id == r.keep_id for r in kept)


def test_exact_keep_first(docs, rows):
    kept = exact_dedup.keep_first(docs)
    assert kept.columns == docs.columns
    _, groups = brute_exact(rows)
    assert kept.count() == groups
    assert exact_dedup.keep_first(docs.limit(0)).count() == 0
    assert exact_dedup.exact_duplicates(docs.limit(0)).count() == 0


def shingles(text):
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute_near(rows, percent):
    nodes = [(d, shingles(t)) for d, t, *_ in rows]
    root = {d: d for d, _ in nodes if d is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, (a, x) in enumerate(nodes):
        for b, y in nodes[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = find(a), find(b)
                root[max(p, q)] = min(p, q)
    return sorted(((d, len(s), None if d is None else find(d)) for d, s in nodes), key=str)


@pytest.mark.parametrize("percent", [85, 80])
def test_near_duplicates(docs, rows, percent):
    found = minhash.near_duplicates(docs, percent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found), key=str) == brute_near(rows, percent)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in found)


def test_near_links_between_components(spark):
    """Copies at random distances from one base, so links do not all go through one hub."""
    rnd = random.Random(5)
    base = prose(7, 150)
    rows = []
    for k in range(150):
        words = list(base)
        for _ in range(rnd.randrange(8)):
            words[rnd.randrange(len(words))] = rnd.choice(["p", "q"])
        rows.append((k, " ".join(words)))
    rnd.shuffle(rows)
    found = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string"), 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute_near(rows, 85))


def test_near_on_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = minhash.near_duplicates(docs, 85).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == sorted(brute_near(rows, 85))


def test_near_keep_one(docs, rows):
    kept = minhash.keep_one(docs, 80)
    assert kept.columns == docs.columns
    want = sorted(str(d) for d, _, c in brute_near(rows, 80) if d is None or d == c)
    assert sorted(str(r.doc_id) for r in kept.select("doc_id").collect()) == want
    assert minhash.near_duplicates(docs.limit(0)).count() == 0 and minhash.keep_one(docs.limit(0)).count() == 0


def test_bands_find_pairs_at_the_threshold():
    """Share of pairs at similarity 0.85 with a common bucket; and far pairs stay apart mostly."""
    rng = np.random.default_rng(3)
    plan = minhash.banding(85)
    found = far = 0
    for _ in range(300):
        x = rng.integers(0, 1 << 63, 185, dtype=np.uint64)
        a, b = x, np.concatenate([x[:170], rng.integers(0, 1 << 63, 15, dtype=np.uint64)])  # 170 / 200
        c = np.concatenate([x[:40], rng.integers(0, 1 << 63, 145, dtype=np.uint64)])  # 40 / 330
        keys = [minhash.band_keys(np.sort(s), plan) for s in (a, b, c)]
        found += bool((keys[0] == keys[1]).any())
        far += bool((keys[0] == keys[2]).any())
    assert found == 300 and far <= 5


def test_min_max_estimates_are_unbiased():
    rng = np.random.default_rng(4)
    plan = minhash.Banding(85, 1, 400)
    same = []
    for _ in range(40):
        x = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
        y = np.concatenate([x[:100], rng.integers(0, 1 << 63, 50, dtype=np.uint64)])
        same.append((minhash.band_keys(np.sort(x), plan) == minhash.band_keys(np.sort(y), plan)).mean())
    assert abs(np.mean(same) - 0.5) < 0.02


def test_shingle_sets_equal_brute_force(rows, monkeypatch):
    from registrar.llm import shingles as module
    for _, t, *_ in rows:
        assert len(shingle_set(t)) == len(shingles(t))
    text = rows[12][1]
    want = word_hashes(text).tolist()
    monkeypatch.setattr(module, "BLOCK", 100)
    assert word_hashes(text).tolist() == want


def test_components_of_a_chain_and_a_star(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(300, 299), (5, 5)]
    found = {r.node: r.root for r in graph.components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {k: 0 for k in range(41)} | {100 + k: 100 for k in range(30)} | {299: 299, 300: 299}
    assert found == want


def test_prefix_pairs_of_a_large_cluster(spark):
    """Near copies of one root are not paired with each other; foreign sets are found."""
    import time
    took = {}
    for n in (4000, 16000):
        base = list(range(60))
        rows = [(k, 60, 1, base[:59] + [1000 + k]) for k in range(n)]
        rows += [(n + 1, 60, 2, base[:58] + [7, 10**6, 10**6 + 1]), (n + 2, 60, 3, [10**7 + i for i in range(50)] + base[:10])]
        frame = spark.createDataFrame([(a, len(set(s)), r, sorted(set(s))) for a, _, r, s in rows], "node long, n int, root long, shingles array<long>")
        start = time.perf_counter()
        found = minhash._prefix_pairs(frame.repartition(8), 80).collect()
        took[n] = time.perf_counter() - start
        near = [(r.a, r.b) for r in found if r.b == n + 1]
        assert len(near) == n and all(r.b > n - 1 for r in found)
    assert took[16000] < 8 * max(took[4000], 2)


def test_prefix_pairs_hold_every_pair(spark):
    """Against all pairs of different roots that reach the threshold."""
    rnd = random.Random(6)
    pool = [[rnd.randrange(300) for _ in range(rnd.randrange(5, 40))] for _ in range(12)]
    sets = [sorted({x if rnd.random() > 0.06 else rnd.randrange(300) for x in rnd.choice(pool)}) for _ in range(150)]
    rows = [(k, len(s), rnd.randrange(9), s) for k, s in enumerate(sets)]
    found = {(r.a, r.b) for r in minhash._prefix_pairs(spark.createDataFrame(rows, "node long, n int, root long, shingles array<long>"), 80).collect()}
    want = {(a, b) for a, _, ra, s in rows for b, _, rb, t in rows
            if a < b and ra != rb and 100 * len(set(s) & set(t)) >= 80 * len(set(s) | set(t))}
    assert want <= found and all(rows[a][2] != rows[b][2] and a < b for a, b in found) and len(want) > 100
