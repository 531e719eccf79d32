"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are partitioned by their number of shingles; of an item in the
partition up to size u the floor((1 - t) * u) + 1 smallest hashes are its
MinHash sketch. A document that holds a share t or more of an item's shingles
misses at most (1 - t) * u of them, so it holds one of the sketch at least:
the search for sketch hashes in a document's shingles finds every such pair,
however long the document is. Each candidate pair is then verified by exact
containment of the item's shingles in the document's.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import batches, mapped, saved, texts
from registrar.llm.shingles import distinct, mix, windows, word_hashes

WORDS = 5
#: Least containment, in hundredths.
PERCENT = 80
#: Shingles of the items in one block; a block's result is written before the next is broadcast, so one is held at a time.
BLOCK_SHINGLES = 2_000_000

_FILTER_BITS = 20


def item_shingles(items: DataFrame) -> DataFrame:
    """(item_id, words, shingles) of every item with a word; an item of fewer
    than WORDS words has its whole sequence as its one shingle."""
    schema = pa.schema([("item_id", pa.int64()), ("words", pa.int32()), ("shingles", pa.binary())])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for item, text in texts(stream, "item_id"):
                h = word_hashes(text)
                if len(h):
                    size = min(WORDS, len(h))
                    s = distinct(windows(h, size)).tobytes()
                    yield (item, size, s), len(s)
        return batches(rows(), schema)

    return items.select("item_id", "text").transform(mapped, run, "item_id bigint, words int, shingles binary")


class Sketches:
    """Sketch index and full shingle sets of one block of items."""

    def __init__(self, items: list[tuple[int | None, int, np.ndarray]]):
        self.items = items
        self.by_length = {}
        for length in sorted({n for _, n, _ in items}):
            hashes, owners = [], []
            for i, (_, n, shingles) in enumerate(items):
                if n == length:
                    upper = 1 << (len(shingles) - 1).bit_length()  # the size partition's upper bound
                    k = (100 - PERCENT) * upper // 100 + 1
                    hashes.append(shingles[np.argsort(mix(shingles), kind="stable")[:k]])
                    owners.append(np.full(len(hashes[-1]), i))
            h, o = np.concatenate(hashes), np.concatenate(owners)
            order = np.argsort(h, kind="stable")
            bits = np.zeros(1 << _FILTER_BITS, dtype=bool)
            bits[(h >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True
            self.by_length[length] = h[order], o[order], bits

    def search(self, text: str | None) -> list[tuple[int | None, int, int]]:
        """(item_id, shingles of the item, shingles found) of every item that
        the text contains to PERCENT or more."""
        found = []
        words = word_hashes(text)
        for length, (sketch, owner, bits) in self.by_length.items():
            shingles = windows(words, length)
            maybe = shingles[bits[(shingles >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)]]
            if not len(maybe):
                continue
            maybe = distinct(maybe)
            left, right = np.searchsorted(sketch, maybe, "left"), np.searchsorted(sketch, maybe, "right")
            hit = np.flatnonzero(right > left)
            if not len(hit):
                continue
            candidates = distinct(np.concatenate([owner[left[k]:right[k]] for k in hit]))
            whole = distinct(shingles)
            for i in candidates.tolist():
                item, _, own = self.items[i]
                at = np.searchsorted(whole, own)
                at[at == len(whole)] = 0
                n = int(np.count_nonzero(whole[at] == own))
                if 100 * n >= PERCENT * len(own):
                    found.append((item, len(own), n))
        return found


def blocks(items: DataFrame) -> Iterator[tuple[Broadcast, bool]]:
    """Broadcast search blocks of a table of items (item_id, text, ...), and
    whether it is the last one. The others are destroyed when the next is asked
    for: what they gave must be written by then."""
    shingles = saved(item_shingles(items), "benchmark-shingles")
    total = shingles.agg(F.sum(F.octet_length("shingles") / 8)).first()[0] or 0
    n = int(-(-total // BLOCK_SHINGLES))
    for k in range(n):
        part = shingles.where(F.pmod(F.xxhash64("item_id", "shingles"), F.lit(n)) == k)
        rows = [(r.item_id, r.words, np.frombuffer(bytes(r.shingles), dtype=np.uint64))
                for r in part.orderBy("item_id", "shingles").toLocalIterator()]
        if rows:
            block = items.sparkSession.sparkContext.broadcast(Sketches(rows))
            del rows
            yield block, k == n - 1
            if k < n - 1:
                block.destroy()


def contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row per document and item it contains: doc_id, item_id, n_shingles
    (of the item), n_found, containment.

    Null, empty and word-less texts contain nothing and are contained in
    nothing; null ids are carried; repeated rows are judged each; an empty
    table on either side gives an empty one. Other columns are ignored. Whole
    texts are searched, without a shuffle.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("n_shingles", pa.int64()),
                        ("n_found", pa.int64()), ("containment", pa.float64())])
    ddl = "doc_id bigint, item_id bigint, n_shingles bigint, n_found bigint, containment double"

    def searched(block: Broadcast) -> DataFrame:
        def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = block.value
            return batches((((doc, item, n, found, found / n), 40)
                            for doc, text in texts(stream) for item, n, found in index.search(text)), schema)
        return docs.select("doc_id", "text").transform(mapped, run, ddl)

    parts = [searched(b) if last else saved(searched(b), "contaminated") for b, last in blocks(items)]
    return reduce(DataFrame.unionAll, parts) if parts else docs.sparkSession.createDataFrame([], ddl)


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs`` that contain no item, all columns. What a block
    leaves is written for the next one; the last one's is not."""
    for block, last in blocks(items):
        def run(stream: Iterable[pa.RecordBatch], block=block) -> Iterator[pa.RecordBatch]:
            index = block.value
            for b in stream:
                yield b.filter(pa.array([not index.search(t.as_py()) for t in b.column("text")], type=pa.bool_()))
        docs = docs.transform(mapped, run, docs.schema)
        if not last:
            docs = saved(docs, "clean")
    return docs
