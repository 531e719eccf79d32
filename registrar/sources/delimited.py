"""Delimited scan (S2): pipe-separated files with a header row, values
trimmed, a leading byte-order mark tolerated."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import errors as E
from .specs import TableSpec

# Fixed value: the delimiter of the mapping files.
DELIMITER = "|"


def read_delimited(spark: SparkSession, files: Sequence[str], spec: TableSpec) -> DataFrame:
    """Rows of all ``files``; every file is read by its own header, files of
    the same header together."""
    options = {"header": "true", "sep": DELIMITER, "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true",
               "encoding": "UTF-8", "inferSchema": "false"}
    groups: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        groups.setdefault(tuple(spark.read.options(**options).csv(f).columns), []).append(f)
    parts = [_bound(spark.read.options(**options).csv(same), spec) for same in groups.values()]
    return reduce(DataFrame.unionByName, parts)


def _bound(raw: DataFrame, spec: TableSpec) -> DataFrame:
    cols = {}
    for c in raw.columns:
        key = c.replace("\ufeff", "").strip().lower()
        if spec.column(key) is None:
            raise E.IngestError(E.NON_MAPPED_COLUMN,
                                f"Type definition for column '{key}' in table '{spec.name}' not found")
        cols[key] = c
    return raw.select(*[c.expr(F.col(f"`{cols[c.name]}`") if c.name in cols else F.lit(None).cast("string"))
                        .alias(c.name) for c in spec.columns])
