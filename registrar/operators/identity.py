"""Stable identity.

Ids are deterministic: ``hash_uuid(kind, natural key)`` formats an MD5 of
the key as a UUID-shaped text, so re-running a job gives the same ids and a
lost task recomputes the same values. An id map ``(type, source_id,
target_id, updated)`` carries ids between runs; existing entries win.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions._util import col_of

SEP = "\u001f"


def hash_uuid(kind: str, *cols) -> Column:
    """Deterministic UUID text from an entity kind and natural-key columns."""
    parts = [F.lit(kind)] + [F.coalesce(col_of(c).cast("string"), F.lit("")) for c in cols]
    h = F.md5(F.concat_ws(SEP, *parts))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def reuse_ids(df: DataFrame, id_map: DataFrame, kind: str, source_col: str, out: str = "id") -> DataFrame:
    """Take the mapped id for ``(kind, source)`` else mint a deterministic one."""
    m = (id_map.filter(F.col("type") == kind)
         .select(F.col("source_id").alias("_src"), F.col("target_id").alias("_mapped")))
    j = df.join(m, df[source_col] == m["_src"], "left")
    return j.withColumn(out, F.coalesce(F.col("_mapped"), hash_uuid(kind, F.col(source_col)))).drop("_src", "_mapped")


def upsert_id_map(id_map: DataFrame, current: DataFrame, kind: str, source_col: str,
                  id_col: str, now: Column | None = None) -> DataFrame:
    """K5: insert new ``(kind, source)`` pairs; update the id (and ``updated``)
    only when it changed; keep everything else. Adds ``action``."""
    now = now if now is not None else F.current_timestamp()
    cur = (current.select(F.lit(kind).alias("_t"), F.col(source_col).alias("_s"), F.col(id_col).alias("_id"))
           .filter(F.col("_s").isNotNull())
           .groupBy("_t", "_s").agg(F.min("_id").alias("_id")))
    j = id_map.join(cur, (id_map["type"] == cur["_t"]) & (id_map["source_id"] == cur["_s"]), "full_outer")
    action = (F.when(F.col("type").isNull(), F.lit("insert"))
              .when(F.col("_t").isNull(), F.lit("keep"))
              .when(F.col("target_id") != F.col("_id"), F.lit("update"))
              .otherwise(F.lit("keep")))
    return j.select(
        F.coalesce("type", "_t").alias("type"),
        F.coalesce("source_id", "_s").alias("source_id"),
        F.when(action == "keep", F.col("target_id")).otherwise(F.col("_id")).alias("target_id"),
        F.when(action == "keep", F.col("updated")).otherwise(now).alias("updated"),
        action.alias("action"))


def prefer_existing(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Existing rows win over incoming rows with the same non-NULL key;
    incoming rows with a NULL key always pass."""
    ex = existing.select(key).filter(F.col(key).isNotNull()).distinct()
    return incoming.join(ex, on=[key], how="left_anti")


def constant_id(kind: str, name: str) -> Column:
    """A fixed id for a batch-level entity (e.g. the audit user)."""
    return hash_uuid(kind, F.lit(name))
