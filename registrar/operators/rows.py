"""Row generators (T2-T5): unpivot, zipped unpivot, explode of derived arrays."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unpivot(df: DataFrame, ids: Sequence[str], cols: Sequence[str], name_col: str, value_col: str,
            names: Sequence[str] | None = None) -> DataFrame:
    """One row per (id, column); ``names`` relabels the columns."""
    if names is None:
        return df.unpivot(list(ids), list(cols), name_col, value_col)
    stacked = F.explode(F.array(*[F.struct(F.lit(n).alias(name_col), F.col(c).alias(value_col))
                                  for n, c in zip(names, cols)])).alias("_u")
    return df.select(*ids, stacked).select(*ids, f"_u.{name_col}", f"_u.{value_col}")


def zip_unpivot(df: DataFrame, ids: Sequence[str], groups: Mapping[str, Sequence[str]],
                index_col: str = "slot") -> DataFrame:
    """Parallel column groups (e.g. start1..3 / end1..3) to one row per slot."""
    names = list(groups)
    arrays = [F.array(*[F.col(c) for c in groups[n]]).alias(n) for n in names]
    z = df.select(*ids, F.posexplode(F.arrays_zip(*arrays)).alias("_pos", "_z"))
    return z.select(*ids, (F.col("_pos") + 1).alias(index_col), *[F.col(f"_z.{n}").alias(n) for n in names])


def explode_case(df: DataFrame, col: str, mapping: Mapping[str, Sequence[str]], out: str,
                 default: Sequence[str] | None = None) -> DataFrame:
    """T4: unnest an array chosen per value of ``col`` (CASE ... THEN ARRAY[...])."""
    expr = None
    for k, arr in mapping.items():
        val = F.array(*[F.lit(x) for x in arr]).cast("array<string>")
        expr = F.when(F.col(col) == k, val) if expr is None else expr.when(F.col(col) == k, val)
    dflt = F.array(*[F.lit(x) for x in (default or [])]).cast("array<string>")
    expr = expr.otherwise(dflt)
    return df.withColumn(out, F.explode(expr))
