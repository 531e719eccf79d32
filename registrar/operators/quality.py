"""Quarantine routing (Q1); the constraints (Q2) are in ``constraints``.

Q1: all rules are evaluated on the complete table in one pass; an entity may
collect several reasons. ``clean`` keeps rows without a reason, ``todo`` has
one row per (row, reason).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASONS = "_reasons"


def flag(df: DataFrame, rules: Sequence[tuple[str, Column]]) -> DataFrame:
    """Attach the array of failed rule reasons (NULL rule results count as passed)."""
    arr = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(reason)) for reason, cond in rules])
    return df.withColumn(REASONS, F.filter(arr, lambda x: x.isNotNull()))


def clean(flagged: DataFrame) -> DataFrame:
    return flagged.filter(F.size(REASONS) == 0).drop(REASONS)


def todo(flagged: DataFrame, reason_col: str = "reason") -> DataFrame:
    return flagged.withColumn(reason_col, F.explode(REASONS)).drop(REASONS)


def quarantine(df: DataFrame, rules: Sequence[tuple[str, Column]], reason_col: str = "reason"):
    f = flag(df, rules)
    return clean(f), todo(f, reason_col)


def remove_keys(df: DataFrame, todo_rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Delete every row whose key appears among the quarantined ones (K7)."""
    return df.join(todo_rows.select(*keys).distinct(), on=list(keys), how="left_anti")
