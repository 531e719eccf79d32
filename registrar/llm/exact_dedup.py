"""Exact dedup by content sort, with DataFrame functions only.

Normalised texts are range-partitioned by sampled splitters
(``repartitionByRange``) and sorted externally, so equal texts are
neighbours; the window then compares whole neighbouring texts and keeps the
smallest identifier. The splitters are made of a text's first characters, its
hash and a salt, so what the driver samples has a fixed size; the comparison
is on whole texts.

Hot texts: a text with many copies is dealt over salts, each salt's group is
reduced to one row where it is, and only those rows meet. A text counts as
hot beyond ``max(HOT_LEAST, rows / HOT_GROUPS)`` rows, so there are at most
HOT_GROUPS of them, which bounds both broadcasts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from registrar.llm.common import saved

HOT_LEAST = 64
HOT_GROUPS = 100_000
SPLITTER_CHARS = 64


def normalised(text: Column) -> Column:
    """The text with every run of white space as one space; null is empty."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _sorted_groups(docs: DataFrame) -> DataFrame:
    """Every row with the first row and the size of its (salted) group of
    equal texts: row, rid, doc_id, hot, sha, norm, first, n, place."""
    norm = normalised(F.col("text"))
    rows = saved(docs.select(F.struct("*").alias("row"), F.col("doc_id"), F.monotonically_increasing_id().alias("rid"),
                             norm.alias("norm"))
                 .select("row", "doc_id", "rid", F.sha2("norm", 256).alias("sha"), F.xxhash64("norm").alias("hash"),
                         F.substring("norm", 1, SPLITTER_CHARS).alias("head")), "exact-rows")
    most = max(HOT_LEAST, rows.count() // HOT_GROUPS)
    hot = (rows.groupBy("hash").count().where(F.col("count") > most)
           .select("hash", F.ceil(F.col("count") / most).alias("salts")))
    salt = F.coalesce(F.pmod(F.xxhash64("rid"), F.col("salts")), F.lit(0))
    dealt = (rows.join(F.broadcast(hot), "hash", "left")  # at most HOT_GROUPS rows of two numbers
             .withColumn("salt", salt).withColumn("hot", F.col("salts").isNotNull()).drop("salts")
             .repartitionByRange("head", "hash", "salt")
             .withColumn("norm", normalised(F.col("row.text"))))
    group = Window.partitionBy("head", "hash", "salt", "norm")
    in_order = group.orderBy(F.col("doc_id").asc_nulls_last(), "rid")
    return dealt.select("row", "rid", "doc_id", "hot", "sha", "norm",
                        F.first(F.struct("doc_id", "rid")).over(in_order).alias("first"),
                        F.row_number().over(in_order).alias("place"), F.count("*").over(group).alias("n"))


def _hot_groups(groups: DataFrame) -> DataFrame:
    """The salted groups of each hot text put together by its whole text: sha, keep, size."""
    order = F.struct(F.col("first.doc_id").isNull().alias("none"), F.col("first.doc_id").alias("doc_id"),
                     F.col("first.rid").alias("rid"))
    return (groups.where("hot and place = 1").groupBy("norm")
            .agg(F.first("sha").alias("sha"), F.min(order).alias("keep"), F.sum("n").alias("size"))
            .select("sha", "keep.doc_id", "keep.rid", "size").toDF("sha", "keep_doc", "keep_rid", "size"))


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, ...): doc_id, keep_id,
    group_size, kept, text_sha256.

    A null text equals the empty one. Of equal texts the smallest doc_id
    stays (nulls last); among repeated rows of that doc_id one stays. If no
    row of a group has a doc_id, keep_id is null and one row stays. Other
    columns are ignored; an empty table gives an empty one.
    """
    groups = _sorted_groups(docs.select("doc_id", "text")).withColumn("norm", F.when(F.expr("hot and place = 1"), F.col("norm")))
    groups = saved(groups.drop("row"), "exact-groups")
    hot = F.broadcast(_hot_groups(groups).withColumn("hot", F.lit(True)))  # at most HOT_GROUPS rows
    rid = F.when(F.col("hot"), F.col("keep_rid")).otherwise(F.col("first.rid"))
    return groups.drop("norm").join(hot, ["hot", "sha"], "left").select(
        "doc_id", F.when(F.col("hot"), F.col("keep_doc")).otherwise(F.col("first.doc_id")).alias("keep_id"),
        F.coalesce("size", "n").alias("group_size"), (F.col("rid") == rid).alias("kept"), F.col("sha").alias("text_sha256"))


def keep_first(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that ``exact_duplicates`` keeps, all columns."""
    firsts = saved(_sorted_groups(docs).where("place = 1")
                   .withColumn("norm", F.when(F.col("hot"), F.col("norm"))), "exact-firsts")
    hot = F.broadcast(_hot_groups(firsts).select("sha", "keep_rid").withColumn("hot", F.lit(True)))
    return (firsts.join(hot, ["hot", "sha"], "left").where("not hot or rid = keep_rid")
            .select("row.*"))
