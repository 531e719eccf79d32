"""Dimension lookups.

Joins are declared and left to Catalyst/AQE: a side is broadcast when its
measured size (plan statistics, or the shuffle output at runtime under AQE)
is under the broadcast threshold, otherwise a sort-merge join runs. Only
dimensions built from fixed literal dictionaries, whose size is known in
advance, are broadcast explicitly (``literal_dimension``).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Rows up to which a literal dimension is marked for broadcast; a larger one
# is an ordinary join side.
MAX_BROADCAST_ROWS = 10_000


def literal_dimension(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A fixed dimension from Python literals, marked for broadcast while small."""
    dim = spark.createDataFrame(list(rows), schema)
    return F.broadcast(dim) if len(rows) <= MAX_BROADCAST_ROWS else dim


def lookup(df: DataFrame, dim: DataFrame, left_on: Sequence[str], right_on: Sequence[str],
           take: Mapping[str, str], how: str = "left", extra=None) -> DataFrame:
    """Left lookup (J2) or composite-key lookup.

    ``take`` maps dimension column -> output name. Key columns of the
    dimension are renamed so they never clash with the probe side.
    """
    rk = [f"_lk{i}_{c}" for i, c in enumerate(right_on)]
    d = dim.select(*[F.col(c).alias(a) for c, a in zip(right_on, rk)],
                   *[F.col(c).alias(o) for c, o in take.items()])
    cond = None
    for l, r in zip(left_on, rk):
        c = df[l] == d[r]
        cond = c if cond is None else cond & c
    if extra is not None:
        cond = cond & extra
    return df.join(d, cond, how).drop(*rk)


def two_path(df: DataFrame, first: tuple, second: tuple, out: str) -> DataFrame:
    """``coalesce(path1, path2)`` where each path is (dim, left_on, right_on, value_col)."""
    d1, l1, r1, v1 = first
    d2, l2, r2, v2 = second
    a = lookup(df, d1, [l1], [r1], {v1: "_p1"})
    b = lookup(a, d2, [l2], [r2], {v2: "_p2"})
    return b.withColumn(out, F.coalesce("_p1", "_p2")).drop("_p1", "_p2")


def first_value_per_key(side: DataFrame, key: str, value: str, out: str) -> DataFrame:
    """One deterministic value per key (the smallest), as a pre-aggregated
    side for a left join. Partial aggregation keeps hot keys cheap."""
    return side.groupBy(key).agg(F.min(value).alias(out))
