"""Value parsers for staged text fields.

Every source field is read as text first; these expressions turn text into
typed values with the tolerant semantics of the legacy dumps. They are pure
``Column`` expressions, safe under ANSI mode (``try_*`` everywhere).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# The legacy dumps mark an open end date with these two texts.
OPEN_DATE_SENTINELS = ("99999999", "99991231")
# Fixed value: an XML-escaped single blank, treated as empty.
ESCAPED_BLANK = "&#x20;"


def null_forcing_text(c) -> Column:
    """NULL for missing, empty, a single blank or an escaped blank."""
    c = col_of(c)
    t = F.trim(c)
    return F.when((t == "") | (c == ESCAPED_BLANK), F.lit(None).cast("string")).otherwise(c.cast("string"))


def nullable_text(c) -> Column:
    """Text kept as is, NULL stays NULL."""
    return col_of(c).cast("string")


def non_null_text(c) -> Column:
    """NULL becomes the empty text."""
    return F.coalesce(col_of(c).cast("string"), F.lit(""))


def activity_flag(c) -> Column:
    """Upper-case ``A`` means active; anything else (incl. NULL) is false."""
    return F.coalesce(F.upper(F.trim(col_of(c))) == "A", F.lit(False))


def numeric_boolean(c) -> Column:
    """Exactly ``1`` is true; ``0``, ``false``, empty and NULL are false."""
    return F.coalesce(F.trim(col_of(c)) == "1", F.lit(False))


def nullable_date(c) -> Column:
    """P5: ``yyyyMMdd``, ``yyyy-MM-dd`` or the date of an ISO date-time to DATE;
    empty, sentinels and junk to NULL."""
    t = F.trim(col_of(c).cast("string"))
    t = F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}"), F.substring(t, 1, 10)).otherwise(t)
    parsed = F.coalesce(F.try_to_date(t, "yyyyMMdd"), F.try_to_date(t, "yyyy-MM-dd"))
    return F.when(t.isNull() | (t == "") | t.isin(*OPEN_DATE_SENTINELS), F.lit(None).cast("date")).otherwise(parsed)


def strict_boolean(c) -> Column:
    """Only a real ``true`` is true."""
    return F.coalesce(col_of(c).cast("string") == "true", F.lit(False))


def code_number(c) -> Column:
    """Integer code where ``0`` means missing."""
    n = try_int(c)
    return F.when(n == 0, F.lit(None).cast("int")).otherwise(n)


def text_to_number(c, dtype: str = "int") -> Column:
    """NULL, empty and a single blank become NULL, anything else a number (junk to NULL)."""
    t = F.trim(col_of(c).cast("string"))
    return F.when(t.isNull() | (t == ""), F.lit(None).cast(dtype)).otherwise(try_cast(t, dtype))


def array_literal(c) -> Column:
    """``{a,b}`` to ``array('a','b')``; empty or NULL to an empty array."""
    t = F.trim(F.regexp_replace(col_of(c).cast("string"), r"[{}]", ""))
    return F.when(t.isNull() | (t == ""), F.array().cast("array<string>")).otherwise(
        F.transform(F.split(t, ","), lambda x: F.trim(x)))


def tf_boolean(c) -> Column:
    """P10: case-insensitive ``t`` is true, anything else false."""
    return F.coalesce(F.lower(F.trim(col_of(c))) == "t", F.lit(False))


def range_literal(c) -> Column:
    """``[2021-04-20,)`` to struct<lower DATE, upper DATE> (half-open, NULL = unbounded)."""
    t = F.trim(col_of(c).cast("string"))
    lo = F.regexp_extract(t, r"^[\[(]\s*([0-9-]*)\s*,", 1)
    hi = F.regexp_extract(t, r",\s*([0-9-]*)\s*[\])]$", 1)
    return F.when(t.isNull() | (t == ""), F.lit(None)).otherwise(
        F.struct(F.try_to_date(F.nullif(lo, F.lit("")), "yyyy-MM-dd").alias("lower"),
                 F.try_to_date(F.nullif(hi, F.lit("")), "yyyy-MM-dd").alias("upper")))


def point_literal(c) -> Column:
    """``(21.5,61.5)`` to struct<x DOUBLE, y DOUBLE>."""
    t = F.trim(col_of(c).cast("string"))
    x = F.regexp_extract(t, r"^\(\s*([-0-9.eE+]+)\s*,", 1)
    y = F.regexp_extract(t, r",\s*([-0-9.eE+]+)\s*\)$", 1)
    return F.when(t.isNull() | (t == ""), F.lit(None)).otherwise(
        F.struct(try_cast(x, "double").alias("x"), try_cast(y, "double").alias("y")))


def try_cast(c, dtype: str) -> Column:
    return col_of(c).try_cast(dtype)


def try_int(c) -> Column:
    return F.trim(col_of(c).cast("string")).try_cast("int")


# Parser names as used by table specs (sources/specs.py).
PARSERS = {
    "null_forcing_text": null_forcing_text,
    "nullable_text": nullable_text,
    "non_null_text": non_null_text,
    "activity_flag": activity_flag,
    "numeric_boolean": numeric_boolean,
    "nullable_date": nullable_date,
    "strict_boolean": strict_boolean,
    "code_number": code_number,
    "text_to_number": text_to_number,
    "array_literal": array_literal,
    "tf_boolean": tf_boolean,
    "range_literal": range_literal,
    "point_literal": point_literal,
}
