"""De-duplication.

Keep-first is a grouped ``min_by`` rather than a ``row_number`` window: the
aggregate is computed partially on the map side, so a group holding a third
of all rows is reduced to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key tuple: the row with the smallest ``order`` tuple.

    NULL keys group together (NULL-safe, as ``IS NOT DISTINCT FROM``).
    Columns must be orderable (no maps).
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    # ties on ``order`` are broken by the remaining columns, so the kept row
    # is the same on every run (and on every recomputation of a lost task)
    ordk = F.struct(*[F.col(c) for c in order], *[F.col(c) for c in rest if c not in order])
    g = df.groupBy(*keys).agg(F.min_by(F.struct(*[F.col(c) for c in rest]), ordk).alias("_row"))
    return g.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def distinct_on(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """SELECT DISTINCT over the given columns."""
    return df.select(*cols).distinct()
