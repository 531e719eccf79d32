"""Exclusion lists (S7): key tuples that remove rows from a staged table.

``x.k = t.k`` semantics: a NULL in any key never matches, so such rows are
kept. Implemented as a left-anti join; the list is de-duplicated first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def apply_exclusion(df: DataFrame, exclusion: DataFrame, keys: Sequence[str]) -> DataFrame:
    keys = list(keys)
    ex = exclusion.select(*[F.col(k).alias(f"_x_{k}") for k in keys]).distinct()
    cond = None
    for k in keys:
        e = df[k] == ex[f"_x_{k}"]
        cond = e if cond is None else cond & e
    return df.join(ex, cond, "left_anti")
