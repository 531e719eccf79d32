"""Periodic runs against brute force."""

import hashlib
import random
import re
import zlib

import numpy as np

from registrar.llm import runs
from registrar.llm.queries import QUERIES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_runs(words):
    """Every period in turn: stretches that repeat it, kept if it is their smallest."""
    n, found = len(words), []
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if words[i] != words[i - q]:
                i += 1
                continue
            j = i
            while j < n and words[j] == words[j - q]:
                j += 1
            part = words[i - q:j]
            if len(part) >= max(12, 2 * q) and not any(part[p:] == part[:-p] for p in range(1, q)):
                found.append((i - q, len(part), q))
            i = j
    return sorted(found, key=lambda r: (r[0], r[2]))


def brute_collapse(words, found):
    return [w for i, w in enumerate(words) if not any(s + q <= i < s + n for s, n, q in found)]


def brute_damage(doc, words):
    h, n = zlib.crc32(str(doc).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def test_runs_of_random_words():
    rnd = random.Random(11)
    for _ in range(3000):
        n, letters = rnd.randrange(100), "abcdefgh"[:rnd.choice([1, 2, 2, 3, 4, 6, 8])]
        words = [rnd.choice(letters) for _ in range(n)]
        if rnd.random() < 0.6 and n > 10:
            a = rnd.randrange(n)
            p = 1 + (n - a) // rnd.randrange(2, 9)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = runs.find(words)
        assert found == brute_runs(words), words
        assert runs.collapse(words, found) == brute_collapse(words, found)


def test_squares_have_smallest_periods_and_right_words():
    rnd = random.Random(12)
    for _ in range(300):
        seq = [rnd.randrange(2) for _ in range(60)]
        for end, q in runs.squares(seq):
            part = seq[end - 2 * q + 1:end + 1]
            assert part[:q] == part[q:] and not any(part[p:] == part[:-p] for p in range(1, q))


def test_structured_words():
    a, b = "a", "ab"
    while len(b) < 400:
        a, b = b, b + a
    for words in (["x"] * 500, list(b), list("abc" * 100 + "abd" * 100), list("aab" * 4 + "aab"[:2]), list("ab" * 5), list("ab" * 6),
                  [str(i % 97) for i in range(600)], [str(i) for i in range(300)]):
        assert runs.find(words) == brute_runs(words)


def test_automaton_has_all_substrings_once():
    rnd = random.Random(13)
    for _ in range(50):
        seq = [rnd.randrange(3) for _ in range(30)]
        a = runs.Automaton(seq)
        distinct = {tuple(seq[i:j]) for i in range(30) for j in range(i + 1, 31)}
        assert sum(a.length[s] - a.length[a.link[s]] for s in range(1, a.states)) == len(distinct)


def test_long_texts_take_time_in_proportion():
    words = ["x"] * 300_000 + [str(i % 1237) for i in range(300_000)] + [str(-i) for i in range(300_000)]
    found = runs.find(words)
    assert found == [(0, 300_000, 1), (300_000, 300_000, 1237)]
    assert len(runs.collapse(words, found)) == 1 + 1237 + 300_000


def test_equal_hashes_only_cost_time(monkeypatch):
    words = list("abcabd" * 30)
    monkeypatch.setattr(runs, "covered", lambda ids: [(0, len(ids))])
    assert runs.find(words) == brute_runs(words)


def test_covered_parts_hold_all_runs():
    rnd = random.Random(14)
    for _ in range(500):
        words = [rnd.choice("abc") if rnd.random() < 0.8 else str(rnd.random()) for _ in range(80)]
        ids = np.unique(words, return_inverse=True)[1].astype(np.int32)
        parts = runs.covered(ids)
        assert all(any(s <= a and a + n <= e for s, e in parts) for a, n, _ in brute_runs(words))


def test_odd_rows(docs, rows, no_docs):
    found = runs.detect(docs).collect()
    want = []
    for d, t, *_ in rows:
        words = WORD.findall(t or "")
        r = brute_runs(words) if len(words) < 5000 else []
        want.append((str(d), r, " ".join(brute_collapse(words, r))))
    got = [(str(r.doc_id), [(x.start, x.length, x.period) for x in r.runs], r.collapsed) for r in found]
    assert sorted(got) == sorted(want)
    assert runs.detect(no_docs).count() == 0 and runs.damaged(no_docs).count() == 0


def test_damage_of_odd_rows(docs, rows):
    got = sorted((str(r.doc_id), WORD.findall(r.text or "")) for r in runs.damaged(docs).collect())
    assert got == sorted((str(d), brute_damage(d, WORD.findall(t or "")) if d is not None else WORD.findall(t or "")) for d, t, *_ in rows)


def test_query_of_a_table(spark):
    sf = "/root/testdata/sf0.001"
    found = {r.doc_id: r for r in QUERIES["op12_periodic_runs"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(found) == len(docs)
    some = 0
    for d in docs:
        words = brute_damage(d.doc_id, WORD.findall(d.text or ""))
        if len(words) > 3000:
            continue
        want, r = brute_runs(words), found[d.doc_id]
        listed = "".join(f"{s},{n},{q}\n" for s, n, q in want)
        best = min(want, key=lambda x: (-x[1], x[0], x[2]), default=None)
        assert r.n_runs == len(want)
        assert (r.start, r.length, r.period) == (best or (None,) * 3) and r.exponent_milli == (best and 1000 * best[1] // best[2])
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(brute_collapse(words, want)).encode()).hexdigest()
        some += bool(want)
    assert some > 10
