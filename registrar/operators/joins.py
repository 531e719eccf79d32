"""Joins with extra branches (J8), and left joins whose rows without a key are spread."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, ArrayType, VariantType


#: Tasks over which rows without a key are spread.
NULL_SALTS = 1024


def hit() -> Column:
    """0 in every group: an aggregate and no literal, so that it stays a key of ``spread_left_join``."""
    return F.min(F.lit(0))


def _hashable(t) -> bool:
    if isinstance(t, StructType):
        return all(_hashable(f.dataType) for f in t.fields)
    return _hashable(t.elementType) if isinstance(t, ArrayType) else not isinstance(t, (MapType, VariantType))


def spread_left_join(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], hit_col: str) -> DataFrame:
    """``left`` LEFT JOIN ``right`` on pairs of columns of different names.
    Rows of the left with a NULL in a key match nothing; instead of meeting in
    one task they are spread by a hash of their values. ``hit_col`` of the
    right is made by ``hit`` and dropped, as are the right's key columns."""
    given = F.lit(True)
    for a, _ in on:
        given = given & F.col(f"`{a}`").isNotNull()
    values = [F.col(f"`{f.name}`") for f in left.schema if _hashable(f.dataType)]
    salted = left.withColumn("_salt", F.when(given, 0).otherwise(1 + F.pmod(F.xxhash64(*values), F.lit(NULL_SALTS)).cast("int")))
    cond = F.col("_salt") == F.col(hit_col)
    for a, b in on:
        cond = cond & (F.col(f"`{a}`") == F.col(f"`{b}`"))
    return salted.join(right, cond, "left").drop("_salt", hit_col, *(b for _, b in on))


def repair_branch_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                       left_interval: tuple[str, str], right_interval: tuple[str, str],
                       per: str | None = None, latest: str | None = None) -> DataFrame:
    """Pairs where either
      (repair) the right row is broken (start after end), the left row is open
               and both start on the same day; or
      (normal) the right row is open or longer than one day and the two
               intervals intersect.
    The branches are disjoint, so each is planned on its own (an equi join on
    ``(key, start)`` and a binned overlap join) and the results are unioned.
    Output: all columns of both sides (right key columns dropped).

    With ``per`` and ``latest`` only the ``latest`` of the right row that starts
    last (ties: the greatest ``latest``) is wanted per different left row and
    value of ``per``; it is found without making the pairs, whose number grows
    with the product of a key's rows. Output: the left columns and these two.
    """
    from . import intervals as iv  # which takes its left join from here
    on = list(on)
    if per is not None:
        return iv.latest_intersecting(left, right, on, left_interval, right_interval, per, latest)
    ls, le = left_interval
    rs, re_ = right_interval
    rcols = [c for c in right.columns if c not in on]
    broken = right.filter(F.col(rs) > F.col(re_))
    open_left = left.filter(F.col(le).isNull())
    b1 = open_left.join(broken.withColumnRenamed(rs, "_rs"),
                        [*[open_left[k] == broken[k] for k in on], open_left[ls] == F.col("_rs")], "inner")
    b1 = b1.select(*[open_left[c] for c in left.columns], *[F.col("_rs").alias(rs) if c == rs else broken[c] for c in rcols])
    normal = right.filter(F.col(re_).isNull() | (F.col(re_) > F.col(rs)))
    b2 = iv.overlap_join(left, normal, on, left_interval, right_interval).drop("overlap_start", "overlap_end")
    return b2.select(*left.columns, *rcols).unionByName(b1.select(*left.columns, *rcols))
