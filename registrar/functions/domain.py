"""Domain projections (P13-P23) and the legacy SQL functions (N1-N3) as
column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# Century by the sign character of a personal identity code.
CENTURY_BY_SIGN = {"+": 1800, "-": 1900, "A": 2000}
# Supported preschool start range (school years 2018/19-2022/23).
PRESCHOOL_FIRST_START = "2018-08-01"
PRESCHOOL_LAST_START = "2023-07-31"
# Temporary identity codes contain this marker.
TEMPORARY_ID_MARKER = "%TP%"
# Fixed value: the income amount that marks "maximum fee accepted".
MAX_INCOME_MARKER = 999999


def _valid_phone(c: Column) -> Column:
    return (F.length(c) > 0) & (F.length(c) <= 20)


def contact_choice(mobile, work, home) -> tuple[Column, Column]:
    """(phone, backup). Phone = first of mobile, work, home whose length is
    1-20, else ''. Backup = the next valid number after the chosen one, else ''."""
    cands = F.array(col_of(mobile).cast("string"), col_of(work).cast("string"), col_of(home).cast("string"))
    valid = F.filter(cands, lambda x: x.isNotNull() & _valid_phone(x))
    return (F.coalesce(F.get(valid, 0), F.lit("")), F.coalesce(F.get(valid, 1), F.lit("")))


def masked(value, secret) -> Column:
    """A secret address yields ''; NULL yields ''."""
    return F.when(F.coalesce(col_of(secret), F.lit(False)), F.lit("")).otherwise(
        F.coalesce(col_of(value).cast("string"), F.lit("")))


def name_part(full_name, n: int) -> Column:
    """Part n of ``Last, First`` (1 = last, 2 = first), trimmed, NULL -> ''."""
    return F.coalesce(F.trim(F.split_part(col_of(full_name), F.lit(","), F.lit(n))), F.lit(""))


def official_id(code) -> Column:
    """Temporary codes have no official identity number."""
    c = col_of(code)
    return F.when(c.ilike(TEMPORARY_ID_MARKER), F.lit(None).cast("string")).otherwise(c)


def status_group(code, mapping: Mapping[str, str]) -> Column:
    """Status code -> status group via a literal dictionary (else NULL)."""
    from .codes import map_code
    return map_code(code, mapping)


def income_effect(max_income, income_missing) -> Column:
    """P18."""
    return (F.when(F.coalesce(col_of(max_income), F.lit(False)), F.lit("MAX_FEE_ACCEPTED"))
            .when(F.coalesce(col_of(income_missing), F.lit(False)), F.lit("INCOMPLETE"))
            .otherwise(F.lit("INCOME")))


def to_cents(amount) -> Column:
    """Money to integer cents, rounding half away from zero."""
    return F.round(col_of(amount) * F.lit(100), 0).cast("long")


def income_snapshot(amount, coefficient: str = "MONTHLY_NO_HOLIDAY_BONUS") -> Column:
    """NULL -> NULL; the max marker -> max-fee object; else cents object."""
    a = col_of(amount)
    return (F.when(a.isNull(), F.lit(None))
            .when(a == MAX_INCOME_MARKER, F.struct(F.lit(None).cast("long").alias("amount"),
                                                   F.lit(None).cast("string").alias("coefficient"),
                                                   F.lit(True).alias("max_fee")))
            .otherwise(F.struct(to_cents(a).alias("amount"), F.lit(coefficient).alias("coefficient"),
                                F.lit(False).alias("max_fee"))))


def deviation_amount(total, percent) -> tuple[Column, Column]:
    """P20: (amount, is_absolute): the sum when non-zero, else the percent."""
    s, p = col_of(total), col_of(percent)
    absolute = F.coalesce(s != 0, F.lit(False))
    return F.when(absolute, s).otherwise(p), absolute


def size_threshold(size, columns_by_size: Mapping[int, str], increase_col: str, top: int = 6) -> Column:
    """Threshold for a family size: per-size column for 2..top, otherwise
    (above top, and also size <= 1, as in the legacy CASE) the top column plus
    (size - top) x increase."""
    s = col_of(size)
    expr = None
    for n, c in sorted(columns_by_size.items()):
        expr = F.when(s == n, F.col(c)) if expr is None else expr.when(s == n, F.col(c))
    return expr.otherwise(F.col(columns_by_size[top]) + (s - top) * F.col(increase_col))


def repaired_deadline(sent, preferred_start, deadline) -> Column:
    """Keep a present deadline, else max(sent + 120 days, preferred start)."""
    return F.coalesce(col_of(deadline), F.greatest(F.date_add(col_of(sent), 120), col_of(preferred_start)))


def birth_date_from_code(code) -> Column:
    """``ddmmyy`` + century sign (+ 1800, - 1900, A 2000). A code whose
    length is not 11 gives NULL; an unknown sign gives NULL too (callers
    quarantine it with ``birth_code_sign_valid``)."""
    c = col_of(code)
    sign = F.substring(c, 7, 1)
    century = (F.when(sign == "+", F.lit(1800)).when(sign == "-", F.lit(1900))
               .when(sign == "A", F.lit(2000)))
    yy = F.substring(c, 5, 2).try_cast("int")
    ymd = F.concat(F.lpad((century + yy).cast("string"), 4, "0"), F.substring(c, 3, 2), F.substring(c, 1, 2))
    return F.when(F.length(c) != 11, F.lit(None).cast("date")).otherwise(F.try_to_date(ymd, "yyyyMMdd"))


def birth_code_sign_valid(code) -> Column:
    c = col_of(code)
    return (F.length(c) != 11) | F.substring(c, 7, 1).isin(*CENTURY_BY_SIGN)


def daycare_end_date(code, start) -> Column:
    """31 July of (birth year + 6); if that is before ``start``, 31 July of
    the year after ``start``."""
    birth = birth_date_from_code(code)
    cand = F.make_date(F.year(F.add_months(birth, 72)), F.lit(7), F.lit(31))
    s = col_of(start)
    return F.when(cand < s, F.make_date(F.year(F.add_months(s, 12)), F.lit(7), F.lit(31))).otherwise(cand)


def preschool_end_date(start) -> Column:
    """End of the school year (31 July) of ``start`` inside the supported
    range, NULL outside (callers quarantine it with ``preschool_supported``)."""
    s = col_of(start)
    end = F.make_date(F.year(s) + F.when(F.month(s) >= 8, 1).otherwise(0), F.lit(7), F.lit(31))
    return F.when(preschool_supported(s), end).otherwise(F.lit(None).cast("date"))


def preschool_supported(start) -> Column:
    s = col_of(start)
    return (s >= F.lit(PRESCHOOL_FIRST_START).cast("date")) & (s <= F.lit(PRESCHOOL_LAST_START).cast("date"))


def family_size_from_text(text, prefix: str) -> Column:
    """regex: ``<prefix> (n)`` at the start of a free text -> n, else NULL."""
    raw = F.regexp_extract(col_of(text), "^" + prefix + r" (\d+)", 1)
    return F.nullif(raw, F.lit("")).try_cast("int")


def first_non_empty(cols: Sequence) -> Column:
    return F.coalesce(*[F.nullif(col_of(c), F.lit("")) for c in cols])
