"""Nested JSON documents built from reconciled rows (``struct`` + ``to_json``).

Explicit nulls are kept (``ignoreNullFields=false`` in the session defaults),
matching ``jsonb_build_object``. Arrays inside documents only ever hold
dictionary-bounded sets (flags, types) or per-entity bounded lists.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def json_of(*fields: Column) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def order_document(orders: DataFrame, customer: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Order + customer + line totals as one document per order."""
    lines = lineitem.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.sum("l_quantity").alias("quantity"),
        F.array_sort(F.collect_set("l_returnflag")).alias("flags"))
    j = (orders.join(customer, orders["o_custkey"] == customer["c_custkey"], "left")
         .join(lines, orders["o_orderkey"] == lines["l_orderkey"], "left"))
    doc = json_of(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("status"),
        F.struct(F.col("c_custkey").alias("key"), F.col("c_name").alias("name")).alias("customer"),
        F.struct(F.coalesce("n_lines", F.lit(0)).alias("n_lines"), F.col("quantity").alias("quantity")).alias("totals"),
        F.col("flags").alias("flags"))
    return j.select("o_orderkey", doc.alias("doc"))
