"""Aggregations.

Object aggregates are built in two steps: first one value per (entity, code)
with a partial ``max_by`` (a hot entity is reduced map-side), then the map is
assembled per entity. The second step only ever holds one entry per distinct
code, a set bounded by the code dictionary, never by the data volume.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.codes import map_literal


def last_per_code(df: DataFrame, group: Sequence[str], code: str, value: Column, order: Column) -> DataFrame:
    """A1 first step: duplicate codes collapse to the value of the latest row."""
    return df.groupBy(*group, code).agg(F.max_by(value, order).alias("_v"))


def object_aggregate(df: DataFrame, group: Sequence[str], code: str, value: Column, order: Column,
                     out: str = "data") -> DataFrame:
    """A1: per group, ``map<code, value>`` with duplicate codes collapsing to the last."""
    per_code = last_per_code(df, group, code, value, order)
    return per_code.groupBy(*group).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col(code), F.col("_v")))).alias(out))


#: Rows of a key that may meet in one task before they are summed.
HOT_ROWS = 1 << 18


def dealt_max(df: DataFrame, by: Sequence[str], keys: Sequence[str], value: Sequence[str], out: str,
              hot_rows: int = HOT_ROWS) -> DataFrame:
    """The largest struct of ``value`` per ``keys``, dealt by ``by`` (some of the
    keys, none NULL), so that the next step by these shuffles no more: a
    grouping by ``keys`` alone would write all rows to disk twice. Rows of a
    ``by`` that has more than ``hot_rows`` are summed where they are read first;
    there are few such, and where there is none nothing is done for them."""
    df = df.select(*keys, *value)
    many = F.broadcast(df.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > hot_rows).select(*by))
    largest = F.max(F.struct(*value)).alias(out)
    hot = df.join(many, list(by), "left_semi").groupBy(*keys).agg(largest).select(*keys, f"{out}.*")
    others = df.join(many, list(by), "left_anti").select(*df.columns)
    return others.unionByName(hot).repartition(*by).groupBy(*keys).agg(largest)


def weighted_total(map_col, signs: Mapping[str, int], coefficients: Mapping[str, float],
                   amount_field: str = "amount", coefficient_field: str = "coefficient") -> Column:
    """Sum over entries of sign(code) * amount * coefficient(period),
    rounded to an integer; unknown coefficients count as 0, unknown codes as +1."""
    m = F.col(map_col) if isinstance(map_col, str) else map_col
    sign_map = map_literal({k: int(v) for k, v in signs.items()}, "int")
    coef_map = map_literal({k: str(v) for k, v in coefficients.items()}, "decimal(10,4)")

    def step(acc, e):
        amt = F.coalesce(e["value"][amount_field].cast("decimal(20,4)"), F.lit(0).cast("decimal(20,4)"))
        sgn = F.coalesce(F.try_element_at(sign_map, e["key"]), F.lit(1))
        cf = F.coalesce(F.try_element_at(coef_map, e["value"][coefficient_field]), F.lit(0).cast("decimal(10,4)"))
        return (acc + (sgn * amt * cf)).cast("decimal(30,4)")

    total = F.aggregate(F.map_entries(m), F.lit(0).cast("decimal(30,4)"), step)
    return F.round(total, 0).cast("long")


def sorted_distinct(c: Column) -> Column:
    """A3: ordered distinct array (NULLs dropped, as ``collect_set`` does)."""
    return F.array_sort(F.collect_set(c))


def first_by_order(value: Column, order: Column) -> Column:
    """A4/A5: element 1 of an ordered aggregate, without materialising the array."""
    return F.min_by(value, order)
