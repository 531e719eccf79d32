"""Periodic runs of words: suffix automaton with link-cut access.

A run is a longest stretch of words of one smallest period that holds the
period twice or more. Per document:

1. Words get numbers. A word that lies in no repeated stretch of PROBE words
   is in no run that counts (a run of LEAST words or more, at least twice its
   period, is covered by stretches of PROBE words that occur twice), so only
   the covered parts go on; most texts have none.
2. The suffix automaton of a part is built; its suffix links form a tree in
   which the path from a prefix's state to the root holds all suffixes of that
   prefix. The tree is kept as link-cut paths (splay trees), and one path has
   one colour: the end at which all its suffixes occurred last.
3. Each end is accessed in turn. Access meets the path segments of the old
   colours; a segment whose longest suffix is at least as long as the distance
   between its old end and the new one is a square. The distance is then the
   smallest period there, as a shorter one would have left a later end. All
   segments met take the new colour; each access changes a number of segments
   logarithmic on average.
4. A square is extended to both sides, once per run: later ends inside a run
   find that period already known.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import batches, mapped

#: Words that a run has at least, besides twice its period.
LEAST = 12
#: Length of the stretches whose repetition is probed; a run of LEAST words or
#: more repeats at least LEAST / 2 words in a row at the distance of its period.
PROBE = LEAST // 2

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


class Automaton:
    """Suffix automaton of a sequence of numbers, online. A state's first
    transition is held in two arrays and only further ones in a dictionary, as
    most states have one."""

    def __init__(self, seq: list[int]):
        size = 2 * len(seq) + 2
        self.length = length = array("i", bytes(4 * size))
        self.link = link = array("i", b"\xff" * 4 * size)
        self.word = word = array("i", b"\xff" * 4 * size)
        self.next = following = array("i", b"\xff" * 4 * size)
        self.more: dict[int, dict[int, int]] = {}
        more = self.more
        #: state of the prefix that ends at each place
        self.prefix = prefix = array("i", bytes(4 * len(seq)))
        last, states = 0, 1
        for i, c in enumerate(seq):
            new, states = states, states + 1
            length[new] = i + 1
            prefix[i] = new
            p = last
            while p >= 0:  # states without a transition by c get one to the new state
                if word[p] == -1:
                    word[p], following[p] = c, new
                elif word[p] == c:
                    q = following[p]
                    break
                else:
                    others = more.get(p)
                    if others is None:
                        more[p] = {c: new}
                    elif c in others:
                        q = others[c]
                        break
                    else:
                        others[c] = new
                p = link[p]
            if p < 0:
                link[new] = 0
            elif length[q] == length[p] + 1:
                link[new] = q
            else:
                copy, states = states, states + 1
                length[copy] = length[p] + 1
                link[copy], word[copy], following[copy] = link[q], word[q], following[q]
                if q in more:
                    more[copy] = dict(more[q])
                link[q] = link[new] = copy
                while p >= 0:
                    if word[p] == c:
                        if following[p] != q:
                            break
                        following[p] = copy
                    else:
                        others = more.get(p)
                        if others is None or others.get(c) != q:
                            break
                        others[c] = copy
                    p = link[p]
            last = new
        self.states = states


def squares(seq: list[int]) -> Iterator[tuple[int, int]]:
    """(end, period) of squares of ``seq``, every run's first one included, in the order of their ends."""
    automaton = Automaton(seq)
    length, n = automaton.length, automaton.states
    # Splay trees over the paths. Node 0, the root state, stands for no suffix and for "none".
    up = array("i", automaton.link[:n])  # parent in the splay tree, or of the whole path
    up[0] = 0
    left, right = array("i", bytes(4 * n)), array("i", bytes(4 * n))
    colour = array("i", b"\xff" * 4 * n)  # last end of a path's suffixes, held by the splay tree's root

    def rotate(x: int) -> None:
        y = up[x]
        z = up[y]
        if left[y] == x:
            b = left[y] = right[x]
            right[x] = y
        else:
            b = right[y] = left[x]
            left[x] = y
        if b:
            up[b] = y
        up[y], up[x] = x, z
        if z:
            if left[z] == y:
                left[z] = x
            elif right[z] == y:
                right[z] = x
            else:  # y was the root of its splay tree
                colour[x] = colour[y]
        else:
            colour[x] = colour[y]

    def splay(x: int) -> None:
        while True:
            y = up[x]
            if not y or (left[y] != x and right[y] != x):
                return
            z = up[y]
            if z and (left[z] == y or right[z] == y):
                rotate(y if (left[z] == y) == (left[y] == x) else x)
            rotate(x)

    for end, state in enumerate(automaton.prefix):
        below, x = 0, state
        while x:
            splay(x)
            before = colour[x]
            if before >= 0 and end - before <= length[x]:
                yield end, end - before
            cut = right[x]  # deeper states of the old path keep its colour
            if cut:
                colour[cut] = before
            right[x] = below
            below, x = x, up[x]
        if state != below:
            splay(state)
        colour[state] = end


def runs_of(ids: np.ndarray, offset: int = 0) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs of LEAST words or more in ``ids``."""
    seq, n, known, found = ids.tolist(), len(ids), {}, []
    for end, period in squares(seq):
        if known.get(period, -1) >= end:
            continue  # of a run that is known
        start = _same(ids, end - 2 * period, period, -1) + 1
        last = _same(ids, end + 1, period, 1) - 1
        known[period] = last
        if last - start + 1 >= LEAST:
            found.append((start + offset, last - start + 1, period))
    return found


def _same(ids: np.ndarray, at: int, period: int, step: int) -> int:
    """The first place from ``at`` on, in steps of +1 or -1, that breaks the period."""
    size = 32
    while True:
        if step > 0:
            stop = min(at + size, len(ids))
            differ = np.flatnonzero(ids[at:stop] != ids[at - period:stop - period])
            if len(differ):
                return at + int(differ[0])
            at = stop
            if stop == len(ids):
                return stop
        else:
            start = max(at - size + 1, 0)
            differ = np.flatnonzero(ids[start:at + 1] != ids[start + period:at + 1 + period])
            if len(differ):
                return start + int(differ[-1])
            at = start - 1
            if at < 0:
                return -1
        size *= 2


def covered(ids: np.ndarray) -> list[tuple[int, int]]:
    """(start, end) of the stretches whose every word lies in PROBE words that occur twice."""
    n = len(ids) - PROBE + 1
    if n < 2:
        return []
    h = np.zeros(n, dtype=np.uint64)
    for k in range(PROBE):  # equal stretches have equal hashes; others of equal hash only cost time
        h = (h ^ ids[k:k + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return []
    twice = np.zeros(n, dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    at = np.flatnonzero(twice)
    cuts = np.flatnonzero(np.diff(at) > PROBE)  # stretches that touch are one
    starts, ends = at[np.concatenate(([0], cuts + 1))], at[np.concatenate((cuts, [len(at) - 1]))] + PROBE
    return [(int(s), int(e)) for s, e in zip(starts, ends) if e - s >= LEAST]


def find(words: list[str]) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a list of words, by start, then period."""
    numbers: dict[str, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), dtype=np.int32, count=len(words))
    return sorted((run for s, e in covered(ids) for run in runs_of(ids[s:e], s)), key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words without those that any run contains after its first period."""
    if not runs:
        return words
    change = np.zeros(len(words) + 1, dtype=np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(change)[:-1] == 0).tolist()]


def detect(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, runs (array of
    start, length, period, by start, then period) and collapsed, the words
    joined by one space without those that a run repeats.

    Words are what stands between ASCII white space. A null, empty or blank
    text has no word, no run and an empty collapsed text. Whole texts are
    read, one at a time, without a shuffle; a worker holds one text's words
    and the automaton of one of its repetitive parts. Null ids and repeated
    rows stay, other columns are ignored, an empty table gives an empty one.
    """
    run_type = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("runs", run_type), ("collapsed", pa.string())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in stream:
                for doc, text in zip(b.column("doc_id"), b.column("text")):
                    words = _WORD.findall(text.as_py() or "")
                    runs = find(words)
                    kept = " ".join(collapse(words, runs))
                    yield (doc.as_py(), [{"start": s, "length": n, "period": p} for s, n, p in runs], kept), 3 * len(kept) + 64 * len(runs)
        return batches(rows(), schema)

    return docs.select("doc_id", "text").transform(
        mapped, run, "doc_id bigint, runs array<struct<start: bigint, length: bigint, period: bigint>>, collapsed string")


def damaged(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every tenth document's end made periodic: with h
    the CRC of the id, g = h // 10 and h % 10 = 0, each of the n words from
    place a = g % n on becomes word a + (i - a) % p, p = 1 + (n - a) // (3 + g % 8).
    Rows without an id stay as they are."""
    h = F.crc32(F.col("doc_id").cast("string"))
    words = F.filter(F.split(F.coalesce("text", F.lit("")), r"[\x20\x09-\x0D]+", -1), lambda w: w != "")
    chosen = (docs.select("doc_id", "text", F.coalesce(h % 10 == 0, F.lit(False)).alias("hit"), F.floor(h / 10).alias("g"))
              .withColumn("words", F.when(F.col("hit"), words)).withColumn("n", F.size("words"))
              .withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
              .withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int")))
    turned = F.concat(F.slice("words", F.lit(1), F.col("a")),
                      F.transform(F.sequence(F.lit(0), F.col("n") - F.col("a") - 1),
                                  lambda i: F.get("words", F.col("a") + i % F.col("p"))))
    return chosen.select("doc_id", F.when(F.col("hit") & (F.col("n") > 0), F.concat_ws(" ", turned)).otherwise(F.col("text")).alias("text"))
