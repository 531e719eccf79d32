"""Publishing to tables (K1-K8; K9 and K10 are in ``catalog``).

Published tables are versions: every write makes a new folder
``<table>/version=<run>``, and a manifest names the folders that make up each
table. All tables of a run change together, by one file that appears under the
next number (``Manifest.commit``): a run that fails before leaves the target
as it was, and of two runs at once only one can commit. Rebuilds write to a
fresh run folder and return its path. All set logic is DataFrame logic; the
functions that compute rows (``insert_ignore_rows``, ``upsert_changed``,
``update_from``, ``delete_by_keys``) are lazy and side-effect free.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.dedupe import keep_first


class PublishConflict(RuntimeError):
    """Another run has published since this one began."""


class Manifest:
    """The folders of every published table under ``root``."""

    FOLDER = "_manifests"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self.run = spark, root.rstrip("/"), uuid.uuid4().hex[:12]
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._store = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        numbers = [0]
        if self._store.exists(self._path(f"{self.root}/{self.FOLDER}")):
            names = [f.getPath().getName() for f in self._store.listStatus(self._path(f"{self.root}/{self.FOLDER}"))]
            numbers += [int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit()]
        self.number = max(numbers)
        self.tables: dict[str, list[str]] = json.loads(self._text(self.number)) if self.number else {}

    def _file(self, number: int) -> str:
        return f"{self.root}/{self.FOLDER}/{number:09d}.json"

    def _text(self, number: int) -> str:
        return self.spark.read.text(self._file(number), wholetext=True).first().value

    def read(self, table: str) -> DataFrame | None:
        """The table as this manifest has it; None if it was never published."""
        folders = self.tables.get(table)
        if not folders:
            return None
        parts = [self.spark.read.parquet(f"{self.root}/{f}") for f in folders]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p, allowMissingColumns=True)
        return out

    def add(self, df: DataFrame, table: str, label: str, replace: bool = False) -> int:
        """Write rows as a new version folder of the table; returns their number.
        Nobody sees them before ``commit``."""
        folder, seen = f"{table}/version={self.run}-{label}", Observation(f"publish {table}")
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("errorifexists").parquet(f"{self.root}/{folder}")
        self.tables[table] = [folder] if replace else [*self.tables.get(table, []), folder]
        return int(seen.get["n"])

    def replace_buckets(self, df: DataFrame, table: str, key: Sequence[str], buckets: int) -> list[int]:
        """Publish a whole new state of a keyed table, writing only the buckets
        in which a row is new, changed or gone; returns those."""
        bucket = F.pmod(F.xxhash64(*key), F.lit(buckets)).cast("int").alias("bucket")
        new = df.withColumn("bucket", bucket)
        old = self.read(table)
        if old is None:
            touched = [r.bucket for r in new.select("bucket").distinct().collect()]  # at most ``buckets`` rows
        else:
            old = old.select(*df.columns).withColumn("bucket", bucket)
            changed = new.exceptAll(old.select(*new.columns)).select("bucket").union(old.select(*new.columns).exceptAll(new).select("bucket"))
            touched = [r.bucket for r in changed.distinct().collect()]
        kept = [f for f in self.tables.get(table, []) if int(f.rsplit("=", 1)[1]) not in touched]
        folder = f"{table}/version={self.run}"
        if touched:
            new.where(F.col("bucket").isin(touched)).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        have = {r.bucket for r in new.where(F.col("bucket").isin(touched)).select("bucket").distinct().collect()} if touched else set()
        self.tables[table] = sorted(kept + [f"{folder}/bucket={b}" for b in have])
        return sorted(touched)

    def commit(self) -> int:
        """Make all added versions the target's tables, at once."""
        into = self._path(self._file(self.number + 1))
        draft = self._path(f"{self.root}/{self.FOLDER}/_draft-{self.run}")
        out = self._store.create(draft, False)
        out.write(bytearray(json.dumps(self.tables, indent=1, sort_keys=True).encode()))
        out.close()
        if self._store.exists(into) or not self._store.rename(draft, into):
            self._store.delete(draft, False)
            raise PublishConflict(f"{self.root}: another run has published manifest {self.number + 1}")
        self.number += 1
        return self.number


def published(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A published table as of the latest manifest."""
    found = Manifest(spark, root).read(table)
    if found is None:
        raise KeyError(f"'{table}' is not published in {root}")
    return found


def append(df: DataFrame, path: str) -> None:
    """K1/K3: append rows."""
    df.write.mode("append").parquet(path)


def count_as(df: DataFrame, table: str) -> DataFrame:
    """K1/K8: the one-row ``<table>_count`` result."""
    return df.agg(F.count(F.lit(1)).alias(f"{table}_count"))


def rebuild(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> str:
    """K2: write a complete new version into a fresh run folder; returns its path."""
    target = f"{path.rstrip('/')}/run={uuid.uuid4().hex[:12]}"
    w = df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return target


def insert_ignore_rows(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
                       order: Sequence[str]) -> DataFrame:
    """K4 ``ON CONFLICT (keys) DO NOTHING``: rows of ``incoming`` that would be
    inserted. Inside the batch the first row (by ``order``) per key wins; keys
    already present are skipped; rows with a NULL key never conflict."""
    keys = list(keys)
    has_null = F.lit(False)
    for k in keys:
        has_null = has_null | F.col(k).isNull()
    nulls = incoming.filter(has_null)
    keyed = keep_first(incoming.filter(~has_null), keys, order)
    ex = existing.select(*keys).distinct()
    return keyed.join(ex, on=keys, how="left_anti").unionByName(nulls)


def upsert_changed(old: DataFrame, new: DataFrame, keys: Sequence[str], value_cols: Sequence[str],
                   updated_col: str | None = None, now: Column | None = None) -> DataFrame:
    """K5 ``ON CONFLICT DO UPDATE ... WHERE changed``: the full resulting table
    plus an ``action`` column (insert / update / keep)."""
    keys = list(keys)
    n = new.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in value_cols]).withColumn("_in_new", F.lit(True))
    o = old.withColumn("_in_old", F.lit(True))
    j = o.join(n, on=keys, how="full_outer")
    changed = F.lit(False)
    for c in value_cols:
        changed = changed | ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))
    action = (F.when(F.col("_in_old").isNull(), F.lit("insert"))
              .when(F.col("_in_new").isNull(), F.lit("keep"))
              .when(changed, F.lit("update")).otherwise(F.lit("keep")))
    j = j.withColumn("action", action)
    for c in value_cols:
        j = j.withColumn(c, F.when(F.col("action") == "keep", F.col(c)).otherwise(F.col(f"_new_{c}")))
    if updated_col:
        now = now if now is not None else F.current_timestamp()
        j = j.withColumn(updated_col, F.when(F.col("action") == "keep", F.col(updated_col)).otherwise(now))
    return j.drop("_in_old", "_in_new", *[f"_new_{c}" for c in value_cols])


def update_from(df: DataFrame, src: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
                set_cols: Mapping[str, str]) -> DataFrame:
    """K6 ``UPDATE t SET c = s.v FROM s WHERE keys match``: matched rows take the
    source values (even NULL), unmatched rows keep theirs. The source must be
    unique by its key (one row per target row)."""
    rk = [f"_uk{i}" for i in range(len(right_on))]
    s = src.select(*[F.col(c).alias(a) for c, a in zip(right_on, rk)],
                   *[F.col(v).alias(f"_set_{t}") for t, v in set_cols.items()]).withColumn("_hit", F.lit(True))
    cond = None
    for l, r in zip(left_on, rk):
        e = df[l] == s[r]
        cond = e if cond is None else cond & e
    j = df.join(s, cond, "left")
    for t in set_cols:
        j = j.withColumn(t, F.when(F.col("_hit"), F.col(f"_set_{t}")).otherwise(F.col(t)))
    return j.drop("_hit", *rk, *[f"_set_{t}" for t in set_cols])


def delete_by_keys(df: DataFrame, key_rows: DataFrame, keys: Sequence[str],
                   key_cols: Sequence[str] | None = None) -> DataFrame:
    """K7 ``DELETE WHERE (keys) IN (SELECT ...)``: NULL keys never match."""
    key_cols = list(key_cols or keys)
    k = key_rows.select(*[F.col(c).alias(t) for c, t in zip(key_cols, keys)]).distinct()
    return df.join(k, on=list(keys), how="left_anti")


def read_back(df: DataFrame, order_by: Sequence[str] | None = None, return_all: bool = True,
              table: str = "result") -> DataFrame:
    """K8 / O1: the published rows ordered by the entity keys, or the one-row count."""
    if not return_all:
        return count_as(df, table)
    return df.orderBy(*order_by) if order_by else df
