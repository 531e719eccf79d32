"""Literal code dictionaries.

Dictionaries are small, fixed Python mappings; they become ``map`` literals
inside the expression (no join, no shuffle, folded by the optimizer).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of


def map_literal(mapping: Mapping, value_type: str = "string", key_type: str = "string") -> Column:
    parts = []
    for k, v in mapping.items():
        parts.append(F.lit(k).cast(key_type))
        parts.append(F.lit(v).cast(value_type))
    if not parts:
        return F.create_map().cast(f"map<{key_type},{value_type}>")
    return F.create_map(*parts)


def map_code(c, mapping: Mapping, value_type: str = "string", key_type: str = "string") -> Column:
    """Dictionary lookup; unknown keys and NULL give NULL."""
    key = col_of(c).cast(key_type)
    return F.when(key.isNull(), F.lit(None).cast(value_type)).otherwise(
        F.try_element_at(map_literal(mapping, value_type, key_type), key))


def tristate_keep(c, mapping: Mapping, key_type: str = "string") -> Column:
    """keep a code that maps to a value or is unknown to the dictionary;
    drop codes explicitly mapped to NULL."""
    key = col_of(c).cast(key_type)
    known = list(mapping.keys())
    return F.coalesce(map_code(c, mapping, key_type=key_type).isNotNull() | ~key.isin(*known), F.lit(False))


def only_mapped(c, mapping: Mapping, key_type: str = "string") -> Column:
    """the code must be a dictionary key."""
    return F.coalesce(col_of(c).cast(key_type).isin(*list(mapping.keys())), F.lit(False))


def in_list(c, values) -> Column:
    """code list membership (NULL is not a member)."""
    return F.coalesce(col_of(c).isin(*list(values)), F.lit(False))
