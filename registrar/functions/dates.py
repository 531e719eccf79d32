"""Date and time helpers (§2.10)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col_of

# Fixed value: the zone of the legacy system's local wall-clock times.
LEGACY_ZONE = "Europe/Helsinki"


def local_to_utc(ts, zone: str = LEGACY_ZONE) -> Column:
    """Wall-clock time in ``zone`` -> the UTC instant (session zone is UTC)."""
    return F.to_utc_timestamp(col_of(ts), zone)


def at_time(day, hhmm) -> Column:
    """A ``yyyy-MM-dd`` date plus an ``HHmm`` text -> timestamp (NULL if either is missing/bad)."""
    t = F.lpad(F.trim(col_of(hhmm).cast("string")), 4, "0")
    return F.try_to_timestamp(F.concat(F.date_format(col_of(day), "yyyy-MM-dd"), F.lit(" "), t),
                              F.lit("yyyy-MM-dd HHmm"))


def period_day(period, day) -> Column:
    """``yyyyMM`` period text plus a day number -> DATE (NULL if invalid)."""
    return F.try_to_date(F.concat(col_of(period).cast("string"), F.lpad(col_of(day).cast("string"), 2, "0")),
                         "yyyyMMdd")


def plus_years(d, n: int) -> Column:
    return F.add_months(col_of(d), 12 * n)
