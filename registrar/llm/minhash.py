"""Near-dedup by min-max hashing.

Each permutation gives two signature values, the minimum and the maximum of
the permuted shingles, so a signature needs half the hash evaluations. Bands
of ``rows`` values each (all minima or all maxima, of different permutations)
are hashed to buckets; documents that share a bucket are candidates. The
number of bands follows from MISS, the chance that a pair exactly at the
threshold shares none.

Candidates are confirmed on their full shingle sets, and without listing a
bucket's pairs:

* documents of one shingle set are one node;
* a shingle that no other candidate has cannot be shared, which bounds a
  pair's similarity from above and removes most false candidates exactly;
* each bucket's members are compared with its hub (the member with the
  smallest share of such shingles), and linked ones become one component;
* what is left are members of one bucket in different components: an exact
  set join with prefix and position filters finds their links, so no link
  between components is lost and no bucket's pairs are listed.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from registrar.llm.common import batches, mapped, saved
from registrar.llm.graph import components
from registrar.llm.shingles import mix, shingle_set

#: Chance that a pair at the threshold shares no bucket.
MISS = 1e-6
#: Node keys that a broadcast may hold; beyond it the same join is shuffled.
BROADCAST_KEYS = 1_000_000

_BLOCK = 1024


class Banding(NamedTuple):
    percent: int
    rows: int
    bands: int


def banding(percent: int) -> Banding:
    """Rows per band and an even number of bands for a threshold in hundredths."""
    rows = max(1, min(8, round(-1 / math.log2(percent / 100) * 1.4)))
    bands = math.ceil(math.log(MISS) / math.log1p(-((percent / 100) ** rows)))
    return Banding(percent, rows, bands + bands % 2)


@lru_cache(maxsize=4)
def _permutations(n: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(n)
    a, b = rng.integers(0, 1 << 63, size=(2, n, 1), dtype=np.uint64)
    return a * np.uint64(2) + np.uint64(1), b


def band_keys(shingles: np.ndarray, plan: Banding) -> np.ndarray:
    """One 64-bit bucket key per band of a non-empty set."""
    a, b = _permutations(plan.rows * plan.bands // 2)
    low, high = None, None
    for at in range(0, len(shingles), _BLOCK):
        h = mix(shingles[at:at + _BLOCK])[None, :] * a + b
        lo, hi = h.min(axis=1), h.max(axis=1)
        low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
    values = np.concatenate([low, high]).reshape(plan.bands, plan.rows)
    key = np.arange(1, plan.bands + 1, dtype=np.uint64)
    for k in range(plan.rows):
        key = mix(key * np.uint64(0xD6E8FEB86659FD93) + values[:, k])
    return key.view(np.int64)


def signatures(docs: DataFrame, plan: Banding) -> DataFrame:
    """(doc_id, text_key, n, set_id, bands) of every row; a text without words
    has n = 0 and no bands."""
    schema = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("n", pa.int64()),
                        ("set_id", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in stream:
                for doc, key, text in zip(b.column("doc_id"), b.column("text_key"), b.column("text")):
                    s = shingle_set(text.as_py())
                    bands = band_keys(s, plan).tolist() if len(s) else []
                    yield (doc.as_py(), key.as_py(), len(s), xxhash.xxh3_128_digest(s.tobytes()), bands), 400
        return batches(rows(), schema)

    return (docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
            .transform(mapped, run, "doc_id bigint, text_key bigint, n bigint, set_id binary, bands array<bigint>"))


def _sets(docs: DataFrame) -> DataFrame:
    schema = pa.schema([("set_id", pa.binary()), ("shingles", pa.list_(pa.int64()))])

    def run(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in stream:
            for text in b.column("text"):
                s = shingle_set(text.as_py())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([xxhash.xxh3_128_digest(s.tobytes())], type=pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(s)], type=pa.int32()), pa.array(s.view(np.int64)))], schema=schema)

    return docs.select("text").transform(mapped, run, "set_id binary, shingles array<bigint>")


def _known(keys: DataFrame) -> DataFrame:
    """A broadcast hint only behind a check of the size."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _possible(n1: Column, u1: Column, n2: Column, u2: Column, percent: int) -> Column:
    """Whether two sets of sizes n, of which u shingles occur elsewhere, can reach the threshold."""
    most = F.least(u1, u2)
    return F.lit(100) * most >= F.lit(percent) * (n1 + n2 - most)


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    x = sets.select(F.col("node").alias("a"), F.col("shingles").alias("xs"))
    y = sets.select(F.col("node").alias("b"), F.col("shingles").alias("ys"))
    both = F.size(F.array_intersect("xs", "ys"))
    return (pairs.join(x, "a").join(y, "b")
            .select("a", "b", both.alias("i"), (F.size("xs") + F.size("ys")).alias("n"))
            .where(F.lit(100) * F.col("i") >= F.lit(percent) * (F.col("n") - F.col("i"))).select("a", "b"))


def _links(docs: DataFrame, nodes: DataFrame, plan: Banding) -> DataFrame:
    """Links (a, b) between nodes that give their components."""
    spark = docs.sparkSession
    buckets = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = buckets.groupBy("bucket").count().where("count > 1").select("bucket")
    members = saved(buckets.join(shared, "bucket"), "bucket-members")
    found = saved(members.select("node").distinct().join(nodes.select("node", "doc_id", "set_id", "n"), "node"), "candidates")
    spark_sets = _sets(docs.join(_known(found.select("doc_id").distinct()), "doc_id", "left_semi"))
    sets = saved(spark_sets.join(found.select("set_id", "node"), "set_id").dropDuplicates(["set_id"])
                 .select("node", "shingles"), "candidate-sets")

    lone = (sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle")
            .agg(F.count("*").alias("c"), F.min("node").alias("node")).where("c = 1").groupBy("node").agg(F.count("*").alias("lone")))
    sized = (found.select("node", "n").join(lone, "node", "left")
             .select("node", "n", (F.col("n") - F.coalesce("lone", F.lit(0))).alias("u"))
             .where(F.lit(100) * F.col("u") >= F.lit(plan.percent) * F.col("n")))
    members = saved(members.join(sized, "node"), "possible-members")

    rank = F.struct((F.col("u") / F.col("n")).alias("share"), (-F.col("node")).alias("order"), "node", "n", "u")
    hubs = (members.groupBy("bucket").agg(F.max(rank).alias("hub"), F.count("*").alias("c")).where("c > 1")
            .select("bucket", "hub.node", "hub.n", "hub.u").toDF("bucket", "hub", "hub_n", "hub_u"))
    tried = saved(members.join(hubs, "bucket").where("node <> hub")
                  .where(_possible(F.col("n"), F.col("u"), F.col("hub_n"), F.col("hub_u"), plan.percent))
                  .select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")).distinct(), "hub-pairs")
    links = saved(_confirmed(tried, sets, plan.percent), "hub-links")

    placed = members.join(components(links), "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = placed.groupBy("bucket").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("bucket")
    rest = placed.join(mixed, "bucket").select("node", "n", "root").distinct()
    pairs = saved(_prefix_pairs(sets.join(rest, "node"), plan.percent), "rest-pairs")
    return links.union(_confirmed(pairs, sets, plan.percent))


def _prefix_pairs(sets: DataFrame, percent: int) -> DataFrame:
    """Candidate pairs (a, b) of different roots among ``sets`` (node, n,
    root, shingles); every pair that reaches the threshold is one.

    With shingles in one order for all sets, rarest first, such a pair shares
    a shingle among the first n - ceil(t * n) + 1 of each; and where its
    first common shingle stands, what follows must still hold the overlap
    that the threshold asks for (prefix and position filters). A shingle that
    many sets have comes late in the order, so few are compared through it.
    """
    single = sets.select("node", "n", "root", F.explode("shingles").alias("shingle"))
    often = single.groupBy("shingle").agg(F.count("*").alias("df"))
    ordered = (single.join(often, "shingle").groupBy("node", "n", "root")
               .agg(F.array_sort(F.collect_list(F.struct("df", "shingle"))).alias("order")))  # one document's set
    length = F.col("n") - F.floor((F.lit(percent) * F.col("n") + F.lit(99)) / F.lit(100)) + F.lit(1)
    prefix = (ordered.select("node", "n", "root", F.posexplode(F.slice("order", F.lit(1), length.cast("int"))).alias("place", "entry"))
              .where("entry.df > 1").select("node", "n", "root", F.col("entry.shingle").alias("shingle"), (F.col("n") - F.col("place")).alias("left")))
    prefix = saved(prefix, "prefixes")
    roots = (prefix.groupBy("shingle", "root").agg(F.count("*").alias("c")).groupBy("shingle")
             .agg(F.max(F.struct("c", "root")).alias("most"), F.count("*").alias("roots")).where("roots > 1").select("shingle", "most.root"))
    mixed = prefix.join(roots.withColumnRenamed("root", "most"), "shingle")
    x = mixed.where("root <> most").select("shingle", *(F.col(c).alias(f"x_{c}") for c in ("node", "n", "root", "left")))
    y = mixed.select("shingle", "most", *(F.col(c).alias(f"y_{c}") for c in ("node", "n", "root", "left")))
    enough = F.lit(100 + percent) * F.least("x_left", "y_left") >= F.lit(percent) * (F.col("x_n") + F.col("y_n"))
    once = (F.col("y_root") == F.col("most")) | (F.col("x_node") < F.col("y_node"))  # both outside the most frequent root: one way round
    return (x.join(y, "shingle").where("x_root <> y_root").where(once & enough)
            .select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct())


def near_duplicates(docs: DataFrame, percent: int = 80) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, n_shingles,
    component_id, kept, text_key (xxhash64 of the text).

    Rows are linked where 100 * |A & B| >= percent * |A | B| for their sets
    of five-word shingles; component_id is the smallest doc_id reachable and
    kept means that it is the row's own. A null, empty or word-less text has
    an empty set and no link. A row without doc_id has no link, a null
    component and is kept. Rows of one doc_id are judged each by its own
    text. Other columns are ignored; an empty table gives an empty one.
    """
    plan = banding(percent)
    rows = saved(signatures(docs, plan), "signatures")
    first = F.min(F.struct("doc_id", "n", "bands"))
    nodes = saved(rows.where("n > 0 and doc_id is not null").groupBy("set_id").agg(first.alias("first"))
                  .select("set_id", F.monotonically_increasing_id().alias("node"), "first.doc_id", "first.n", "first.bands"), "nodes")
    links = saved(_links(docs.select("doc_id", "text"), nodes, plan), "links")
    roots = saved(components(links), "roots")
    smallest = (roots.join(nodes.select("node", "doc_id"), "node").groupBy("root").agg(F.min("doc_id").alias("component_id")))
    linked = roots.join(smallest, "root").select("node", "component_id")
    by_set = (nodes.select("node", "set_id", "doc_id").join(linked, "node", "left")
              .select("set_id", F.coalesce("component_id", "doc_id").alias("component_id")))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id"))
    return (rows.select("doc_id", "text_key", "n", "set_id").join(by_set, "set_id", "left")
            .withColumn("component_id", component)
            .select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                    F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"), "text_key"))


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` that ``near_duplicates`` keeps, all columns."""
    gone = saved(near_duplicates(docs, percent).where("not kept").select("doc_id", "text_key").distinct(), "near-copies")
    gone = _known(gone.toDF("gone_id", "gone_key"))
    same = (docs["doc_id"] == gone["gone_id"]) & (F.xxhash64(docs["text"]) == gone["gone_key"])
    return docs.join(gone, same, "left_anti")
