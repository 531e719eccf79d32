"""Date-interval algebra on column pairs.

An interval is two DATE columns ``(start, end)``, both ends included; a NULL
end means open-ended. Only J7 uses a half-open interval (end excluded).

Scale design
------------
Every operator here is written so that no single key (a person, a customer,
a user) ever has to be processed whole by one task:

* Windows never run over raw rows of a key. Rows are first collapsed to the
  bounded domain ``(key, date)`` with a partial (map-side) aggregation; a
  window then sees at most one row per calendar day of a key, a bound that
  comes from the calendar and not from the data volume. Results are joined
  back on ``(key, date)``; that join has a unique right side, so AQE's
  skew-join handling can split a hot left partition.
* Overlap and point-in-interval joins never pair all rows of a key. Dates
  fall into bins of ``bin_days`` days, eight bins into one of the next level,
  and so on. An interval belongs to the finest level at which it touches one or
  two bins, and is held by these alone; an open end belongs to the coarsest
  level, which is one bin. A date, or a shorter interval, probes the coarser
  levels too, but only those on which the other side has an interval: a
  one-row aggregate of the narrow date columns tells (a bit per level), so
  three to five copies of a row are usual whatever the dates are.
* Two intervals meet on the coarser of their levels, in the bin that holds the
  later of their starts, once; there is no dedup step.
* Where only the latest of the intersecting rows counts, no pairs are made:
  ``latest_intersecting`` sorts both sides of a key and carries the latest row
  along, so its work grows with the rows of a key and not with their product.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import col_of

# Fixed value: the stand-in for an open end inside comparisons (never output).
OPEN_END = "9999-12-31"
DEFAULT_BIN_DAYS = 30
# Fixed value: unix days of 0001-01-01, where a missing start begins.
FIRST_DAY = -719162
#: Bits of a level: eight bins make one of the next.
LEVEL_BITS = 3
#: Days from 0001-01-01 to 9999-12-31.
CALENDAR_DAYS = 3_652_059


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def end_or_open(end) -> Column:
    return F.coalesce(col_of(end), open_end())


def overlaps(a_start, a_end, b_start, b_end) -> Column:
    """Closed intervals share at least one day (NULL end = open)."""
    return (col_of(a_start) <= end_or_open(b_end)) & (col_of(b_start) <= end_or_open(a_end))


def intersection_nonempty(a_start, a_end, b_start, b_end) -> Column:
    """GREATEST(starts) <= LEAST(ends): false for inverted intervals."""
    start = F.greatest(col_of(a_start), col_of(b_start))  # skips NULLs: a NULL start is unbounded
    return start.isNull() | (start <= F.least(end_or_open(a_end), end_or_open(b_end)))


def intersection(a_start, a_end, b_start, b_end) -> tuple[Column, Column]:
    """Intersection bounds. ``least`` skips NULLs, so an open side yields the other end."""
    return (F.greatest(col_of(a_start), col_of(b_start)),
            F.least(col_of(a_end), col_of(b_end)))


def contains(start, end, point, half_open: bool = False) -> Column:
    """Point inside ``[start, end]`` (or ``[start, end)`` when half_open)."""
    s, e, p = col_of(start), col_of(end), col_of(point)
    if half_open:
        return (s <= p) & (e.isNull() | (p < e))
    return (s <= p) & (p <= end_or_open(e))


def valid_interval(start, end, allow_open: bool = True) -> Column:
    s, e = col_of(start), col_of(end)
    ok = s.isNotNull() & (e.isNull() | (s <= e))
    return ok if allow_open else (ok & e.isNotNull())


def _levels(bin_days: int) -> int:
    """Levels until one bin holds the whole calendar."""
    n = 1
    while bin_days << (LEVEL_BITS * (n - 1)) < CALENDAR_DAYS:
        n += 1
    return n


def _bin(d: Column, bin_days: int) -> Column:
    """Bin of the finest level; earlier and later dates than the calendar's
    bounds count as those."""
    day = F.greatest(F.unix_date(F.least(d, open_end())) - FIRST_DAY, F.lit(0))
    return F.when(d.isNotNull(), F.floor(day / bin_days).cast("long"))


def _coarser(fine: Column, level: int) -> Column:
    return F.shiftright(fine, LEVEL_BITS * level)


def _level(first: Column, last: Column, bin_days: int) -> Column:
    """The finest level on which the bins ``first`` .. ``last`` of the finest are
    one or two; NULL where ``last`` comes before ``first``."""
    out = F.when(first > last, F.lit(None).cast("int"))
    top = _levels(bin_days) - 1
    for k in range(top):
        out = out.when(_coarser(last, k) - _coarser(first, k) <= 1, k)
    return out.when(first.isNotNull() & last.isNotNull(), top)


def _shifted(fine: Column, level: Column) -> Column:
    return F.call_function("shiftright", fine, (level * LEVEL_BITS).cast("int"))


def _entries(df: DataFrame, out: str, n: int, keep) -> DataFrame:
    """One row per code (level * 2 + tag) for which ``keep(level, tag)`` holds and
    bin of that level that holds ``_first`` .. ``_last``: the bin * 32 + the code."""
    level, code = F.shiftright(F.col("_code"), 1), F.array(*(F.lit(c) for c in range(2 * n)))
    kept = df.withColumn("_code", F.explode(code)).where(keep(level, F.col("_code").bitwiseAND(F.lit(1)) == 1))
    both = F.array(_shifted(F.col("_first"), level), _shifted(F.col("_last"), level))
    return (kept.withColumn("_one", F.explode(F.array_distinct(both))).withColumn(out, F.col("_one") * 32 + F.col("_code"))
            .drop("_code", "_one", "_last", "_level"))


def _occupied(df: DataFrame, first: Column, last: Column, bin_days: int) -> Column:
    """One bit per level that an interval of ``df`` belongs to, as a scalar subquery."""
    bit = F.call_function("shiftleft", F.lit(1), _level(first, last, bin_days))
    return F.coalesce(df.agg(F.bit_or(bit).alias("levels")).scalar(), F.lit(0))


def _has(levels: Column, level: Column) -> Column:
    """Whether the bit of the level is set."""
    return F.call_function("shiftright", levels, level).bitwiseAND(F.lit(1)) == 1


def _has_finer(levels: Column, level: Column) -> Column:
    """Whether a bit below the level's is set."""
    return levels.bitwiseAND(F.call_function("shiftleft", F.lit(1), level) - 1) != 0


def _low(c: str | Column) -> Column:
    return F.coalesce(col_of(c), F.date_from_unix_date(F.lit(FIRST_DAY)))


def _placed_sides(left: DataFrame, right: DataFrame, left_interval: tuple[str, str], right_interval: tuple[str, str],
                  bin_days: int) -> tuple[DataFrame, DataFrame]:
    """Both sides with one row per bin in which they may meet the other
    (``_bin``, ``_rbin``) and their starts' finest bins (``_lat``, ``_rat``)."""
    ls, le = left_interval
    rs, re_ = right_interval
    n = _levels(bin_days)

    def ends(start: str, end: str) -> tuple[Column, Column]:
        return _bin(_low(start), bin_days), _bin(end_or_open(end), bin_days)

    def placed(df: DataFrame, start: str, end: str, out: str, at: str, keep) -> DataFrame:
        first, last = ends(start, end)
        df = df.withColumn("_first", first).withColumn("_last", last).withColumn("_level", _level(F.col("_first"), F.col("_last"), bin_days))
        return _entries(df, out, n, keep).withColumnRenamed("_first", at)

    on_left, on_right = _occupied(left, *ends(ls, le), bin_days), _occupied(right, *ends(rs, re_), bin_days)
    own = F.col("_level")  # NULL, for an interval that ends before it starts, keeps nothing

    # Tag 0 on a level: the left interval belongs to it, the right one to it or a finer one. Tag 1: the right
    # one belongs to it, the left one to a finer one.
    def keep_left(level: Column, second: Column) -> Column:
        here = (own == level) & (_has(on_right, level) | _has_finer(on_right, level))
        return F.when(second, (own < level) & _has(on_right, level)).otherwise(here)

    def keep_right(level: Column, second: Column) -> Column:
        return F.when(second, (own == level) & _has_finer(on_left, level)).otherwise((own <= level) & _has(on_left, level))

    return placed(left, ls, le, "_bin", "_lat", keep_left), placed(right, rs, re_, "_rbin", "_rat", keep_right)


def overlap_join(left: DataFrame, right: DataFrame, on: Sequence[str],
                 left_interval: tuple[str, str], right_interval: tuple[str, str],
                 bin_days: int = DEFAULT_BIN_DAYS) -> DataFrame:
    """Pairs with equal keys whose closed intervals intersect. A NULL
    start is unbounded below, a NULL end unbounded above.

    ``bin_days`` is the finest bin: long validity periods (years) want wide
    bins, short ones narrow bins; the result is the same for any width.

    Output: every column of both sides (right key columns dropped) plus
    ``overlap_start`` / ``overlap_end`` (the intersection; NULL end = open).
    Column names of the two sides must not clash except for ``on``.
    """
    ls, le = left_interval
    rs, re_ = right_interval
    rkeys = [f"_rk_{k}" for k in on]
    renamed = right.select(*[F.col(k).alias(rk) for k, rk in zip(on, rkeys)],
                           *[F.col(c) for c in right.columns if c not in on])
    lb, rb = _placed_sides(left, renamed, left_interval, right_interval, bin_days)
    later = _shifted(F.greatest("_lat", "_rat"), F.shiftright(F.col("_bin"), 1).bitwiseAND(F.lit(15)))
    cond = [F.col(k) == F.col(rk) for k, rk in zip(on, rkeys)]
    cond.append(F.col("_bin") == F.col("_rbin"))
    cond.append(intersection_nonempty(F.col(ls), F.col(le), F.col(rs), F.col(re_)))
    cond.append(F.shiftright(F.col("_bin"), 5) == later)
    joined = lb.join(rb, on=_and_all(cond), how="inner")
    os_, oe = intersection(F.col(ls), F.col(le), F.col(rs), F.col(re_))
    return (joined.drop("_bin", "_rbin", "_lat", "_rat", *rkeys)
            .withColumn("overlap_start", os_)
            .withColumn("overlap_end", oe))


#: Added to a day so that none is negative; a missing start is day 0.
_DAY_ZERO = 1 << 31
#: Bits of a day.
_DAY_BITS = 32


def latest_intersecting(left: DataFrame, right: DataFrame, on: Sequence[str], left_interval: tuple[str, str],
                        right_interval: tuple[str, str], per: str, latest: str) -> DataFrame:
    """Per different left row and value of ``per``, the ``latest`` of the right
    row that starts last (ties: the greatest ``latest``) among those that J8
    pairs with the left row. Output: the left columns, ``per`` and ``latest``.

    Both sides are dealt by ``on`` (a side that is dealt so already is not moved)
    and sorted in their tasks:

    * Sorted by date, the last start up to a left row's end settles it if that
      row starts in the left interval or covers its start. An open right row
      covers every later day, so the last open one is carried along too.
    * Else only rows that cover the left start can match. Such a row lies under
      the highest bit in which its first and last day differ, once for the days
      with this bit off and once for those with it on: it covers all of the
      former from its start on, all of the latter up to its end. A left start
      looks there, for every bit that occurs, with a running maximum by start
      or by descending end.
    * Broken right rows lie under their start, where open left rows look.
    """
    on, (ls, le), (rs, re_) = list(on), left_interval, right_interval
    is_right, endless, first_day, last_day = F.col("_right"), F.col("_e").isNull(), F.col("_a"), F.col("_b")
    open_day = (F.unix_date(open_end()) + F.lit(_DAY_ZERO)).cast("long")

    def given(df: DataFrame, start: str, end: str, right_side: bool) -> DataFrame:
        for k in on:
            df = df.filter(F.col(k).isNotNull())  # a NULL key equals nothing
        return df.repartition(*on).withColumnsRenamed({start: "_s", end: "_e"}).withColumn("_right", F.lit(right_side))

    def with_days(df: DataFrame) -> DataFrame:
        def day(c: str, missing: Column) -> Column:
            return F.coalesce(F.unix_date(c).cast("long") + F.lit(_DAY_ZERO), missing.cast("long"))
        return df.withColumn("_a", day("_s", F.lit(0))).withColumn("_b", day("_e", open_day))

    rows = given(right.select(*on, rs, re_, per, latest), rs, re_, True)
    both = rows.unionByName(given(left, ls, le, False), allowMissingColumns=True)

    # a left row meets every value of ``per`` that its key has
    kinds = F.collect_set(F.when(is_right, F.struct(F.col(per).alias("v")))).over(Window.partitionBy(*on))
    own = F.array(F.struct(F.col(per).alias("v")))
    both = (both.withColumn("_kinds", kinds).withColumn("_kind", F.explode(F.when(is_right, own).otherwise(F.col("_kinds"))))
            .withColumn(per, F.col("_kind.v")).drop("_kind", "_kinds"))

    # days are made again where they are wanted: sorted rows stay narrow
    normal = is_right & (endless | F.coalesce(F.col("_e") > F.col("_s"), F.lit(False))) & (first_day <= last_day)
    bit = F.when(normal & ~endless, F.length(F.bin(first_day.bitwiseXOR(last_day))) - 1)
    both = with_days(both).withColumn("_v", F.when(is_right, F.struct(first_day.alias("a"), F.col(latest).alias("v"), last_day.alias("b"))))
    never = F.lit(1 << 40)  # after all days: no left row sees these right rows
    both = (both.withColumn("_x", F.when(normal, first_day).when(is_right, never).otherwise(last_day))
            .withColumn("_endless", F.when(normal & endless, F.col("_v")))
            .withColumn("_bits", F.call_function("shiftleft", F.lit(1).cast("long"), bit)).drop("_a", "_b", latest))
    by_date = Window.partitionBy(*on, per).orderBy("_x")
    seen = (both.withColumn("_top", F.max("_v").over(by_date)).withColumn("_open", F.max("_endless").over(by_date))
            .withColumn("_bits", F.bit_or("_bits").over(by_date)))
    seen = with_days(seen)
    settled = F.coalesce((F.col("_top.a") > first_day) | (F.col("_top.b") >= first_day), F.lit(False))
    found = F.when(is_right, F.col("_v")).when(first_day > last_day, None).when(settled, F.col("_top")).when(first_day <= open_day, F.col("_open"))
    asked = F.when((first_day <= last_day) & ~settled & F.col("_bits").isNotNull(),
                   F.filter(F.sequence(F.lit(0), F.lit(_DAY_BITS - 1)),
                            lambda k: F.call_function("shiftright", F.col("_bits"), k).bitwiseAND(F.lit(1)) == 1))

    # codes: -1 a left row as it is, 0 broken rows, from 2 on two for a bit (the first day's, the last day's)
    none = F.array().cast("array<int>")
    of_right = (F.when(bit.isNotNull(), F.array((bit + 1) * 2, (bit + 1) * 2 + 1))
                .when(F.coalesce(F.col("_s") > F.col("_e"), F.lit(False)), F.array(F.lit(0))).otherwise(none))
    of_left = F.concat(F.array(F.lit(-1)), F.transform(F.coalesce(asked, none), lambda k: (k + 1) * 2),
                       F.when(endless & F.col("_s").isNotNull(), F.array(F.lit(0))).otherwise(none))
    seen = (seen.withColumn("_v", F.struct(found["a"].alias("a"), found["v"].alias("v")))
            .withColumn("_code", F.explode(F.when(is_right, of_right).otherwise(of_left))).drop("_top", "_open", "_endless", "_bits", "_x"))
    code = F.col("_code")
    pos = F.when(code.bitwiseAND(F.lit(1)) == 1, last_day).otherwise(first_day)
    half = F.call_function("shiftright", pos, F.shiftright(code, 1) - 1)
    at = F.when(code < 0, F.lit(-1)).when(code == 0, first_day * 64).otherwise(half * 64 + F.shiftright(code, 1))
    order = F.when(code <= 0, F.lit(0)).when(half.bitwiseAND(F.lit(1)) == 0, pos).otherwise(-pos)
    seen = seen.withColumn("_at", at).withColumn("_x", order).withColumn("_v", F.when(F.col("_v.a").isNotNull(), F.col("_v"))).drop("_a", "_b", "_code")
    # a left row brings what it has found to code -1, where no right row is, and nothing to the others
    seen = seen.withColumn("_v", F.when(is_right | (F.col("_at") < 0), F.col("_v")))
    there = F.max("_v").over(Window.partitionBy(*on, per, "_at").orderBy("_x"))
    return (seen.withColumn("_last", there).withColumn("_last", F.when(F.col("_at") < 0, F.col("_v")).otherwise(F.col("_last")))
            .where(~is_right & F.col("_last").isNotNull())
            .withColumnsRenamed({"_s": ls, "_e": le}).groupBy(*left.columns, per).agg(F.max("_last").alias("_last"))
            .select(*left.columns, per, F.col("_last.v").alias(latest)))


def point_in_interval_join(points: DataFrame, intervals: DataFrame, on: Sequence[str],
                           point_col: str, interval: tuple[str, str],
                           half_open: bool = False, how: str = "inner",
                           bin_days: int = DEFAULT_BIN_DAYS, probe: DataFrame | None = None) -> DataFrame:
    """Attach every interval (same key) that contains the point.

    ``how='left'`` keeps points without a covering interval (interval columns
    NULL). Closed ``[start, end]`` by default, ``[start, end)`` when half_open.

    With ``how='left'`` or ``on=[]`` (the keyless validity lookup, e.g.
    thresholds by date) the distinct (key, date) pairs are looked up and
    joined back, so ``points`` is read twice; ``probe`` is a cheaper frame
    that holds the same pairs or more. ``how='left'`` reads the points that
    have no key or date apart.
    """
    s, e = interval
    last_day = F.date_sub(F.col(e), 1) if half_open else F.col(e)
    ikeys = [f"_ik_{k}" for k in on]
    ib = intervals.select(*[F.col(k).alias(ik) for k, ik in zip(on, ikeys)],
                          *[F.col(c) for c in intervals.columns if c not in on])
    n = _levels(bin_days)
    first, last = _bin(F.col(s), bin_days), _bin(F.coalesce(last_day, open_end()), bin_days)
    occupied = _occupied(intervals, first, last, bin_days)
    ib = ib.withColumn("_first", first).withColumn("_last", last).withColumn("_level", _level(F.col("_first"), F.col("_last"), bin_days))
    ib = _entries(ib, "_ibin", n, lambda level, second: ~second & (F.col("_level") == level)).drop("_first")
    inside = [F.col("_pbin") == F.col("_ibin"), contains(F.col(s), F.col(e), F.col("_point"), half_open)]
    same = [F.col(k) == F.col(ik) for k, ik in zip(on, ikeys)]

    def probing(df: DataFrame) -> DataFrame:
        day = _bin(F.col("_point"), bin_days)
        placed = df.withColumn("_first", day).withColumn("_last", day).withColumn("_level", F.lit(0))
        return _entries(placed, "_pbin", n, lambda level, second: ~second & _has(occupied, level)).drop("_first")

    if how == "inner" and on:
        pb = probing(points.withColumn("_point", F.col(point_col)))
        return pb.join(ib, on=_and_all(same + inside)).drop("_pbin", "_point", "_ibin", *ikeys)
    pkeys = [f"_pk_{k}" for k in on]
    pairs = (points if probe is None else probe).select(
        *[F.col(k).alias(pk) for k, pk in zip(on, pkeys)], F.col(point_col).alias("_point")).dropna().distinct()
    found = (probing(pairs)
             .join(ib, on=_and_all([F.col(pk) == F.col(ik) for pk, ik in zip(pkeys, ikeys)] + inside))
             .drop("_pbin", "_ibin", *ikeys))
    back = [F.col(k) == F.col(pk) for k, pk in zip(on, pkeys)] + [F.col(point_col) == F.col("_point")]
    given = _and_all([F.col(c).isNotNull() for c in (*on, point_col)])
    joined = points.filter(given).join(found, on=_and_all(back), how=how).drop("_point", *pkeys)
    if how != "left":
        return joined
    # points without a key or date have nothing to find: they pass by, as in the join all would meet in one task
    return joined.unionByName(points.filter(~given), allowMissingColumns=True)


def _summary(rows: DataFrame, keys: Sequence[str], start: str, end: str | None, identity: str, dates: DataFrame) -> DataFrame:
    """What a row of another identity needs to know about ``rows``, one row per
    key and date of ``dates``:

    ``_here``, ``_many``  the identity of the largest end that starts here, whether another identity starts here too
    ``_e1 _i1 _e2``       of the rows that start earlier: the largest end, its identity, the largest end of any other identity
    ``_na _ni _nb``       the next later start, its identity (NULL: several), the next later start of any other than that

    Rows are first summed to their two largest ends of distinct identities per
    date, so no window sees more rows of a key than the calendar has days. The
    running pair is merged date by date: whenever the largest end's identity
    changes, the largest end so far belongs to another one and becomes the second.
    """
    keys = list(keys)
    end = end or start
    per = rows.groupBy(*keys, start, identity).agg(F.max(end).alias("_e"))
    best = Window.partitionBy(*keys, start).orderBy(F.desc("_e"), identity)
    two = per.withColumn("_r", F.row_number().over(best)).where("_r <= 2")
    rank = F.col("_r")
    one = two.groupBy(*keys, start).agg(F.max(F.when(rank == 1, F.col("_e"))).alias("_e1h"), F.max(F.when(rank == 1, F.col(identity))).alias("_here"),
                                        F.max(F.when(rank == 2, F.col("_e"))).alias("_e2h"))
    every = (dates.select(*keys, start).unionByName(one, allowMissingColumns=True).groupBy(*keys, start)
             .agg(*(F.max(c).alias(c) for c in ("_e1h", "_here", "_e2h"))))
    up = Window.partitionBy(*keys).orderBy(start)
    upto, before = up.rowsBetween(Window.unboundedPreceding, 0), up.rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*keys).orderBy(F.desc(start))
    there, later = down.rowsBetween(Window.unboundedPreceding, 0), down.rowsBetween(Window.unboundedPreceding, -1)
    present = F.col("_e1h").isNotNull()

    x = every.withColumn("_top", F.max(F.when(present, F.struct(F.col("_e1h").alias("e"), F.col("_here").alias("i")))).over(upto))
    x = x.withColumn("_prev", F.lag("_top").over(up))
    x = x.withColumn("_change", F.when(F.col("_prev.i").eqNullSafe(F.col("_top.i")), 0).otherwise(1))
    x = x.withColumn("_epoch", F.sum("_change").over(upto))
    in_epoch = Window.partitionBy(*keys, "_epoch").orderBy(start).rowsBetween(Window.unboundedPreceding, 0)
    other = F.when(F.col("_here") == F.col("_top.i"), F.col("_e2h")).otherwise(F.col("_e1h"))
    x = x.withColumn("_second", F.greatest(F.first("_prev.e").over(in_epoch), F.max(other).over(in_epoch)))
    x = (x.withColumn("_e1", F.col("_prev.e")).withColumn("_i1", F.col("_prev.i")).withColumn("_e2", F.lag("_second").over(up)))

    sole = F.when(F.col("_e2h").isNull(), F.col("_here"))
    x = x.withColumn("_next", F.last(F.when(present, F.struct(F.col(start).alias("d"), sole.alias("i"))), True).over(later))
    parts = F.when(present & F.col("_next").isNotNull() & ~F.coalesce(sole == F.col("_next.i"), F.lit(False)), F.col("_next.d"))
    x = x.withColumn("_parts", F.last(parts, True).over(there))
    x = x.withColumn("_then", F.last(F.when(present, F.struct(F.col("_parts").alias("d"))), True).over(later))
    return x.select(*keys, start, "_here", F.col("_e2h").isNotNull().alias("_many"), "_e1", "_i1", "_e2",
                    F.col("_next.d").alias("_na"), F.col("_next.i").alias("_ni"), F.col("_then.d").alias("_nb"))


def _next_other(identity: str) -> Column:
    """The next later start of another identity, of a row joined to its ``_summary``."""
    return F.when(F.coalesce(F.col("_ni") == F.col(identity), F.lit(False)), F.col("_nb")).otherwise(F.col("_na"))


def conflicts(df: DataFrame, keys: Sequence[str], start: str, end: str,
              valid: Column | None = None, role: str | None = None,
              roles: Sequence | None = None, out: str = "overlapping", identity: str | None = None) -> DataFrame:
    """Flag rows whose interval intersects another row of the same key.

    ``valid`` restricts which rows take part (default: start present and not
    after a present end); invalid rows are never flagged and never cause a
    flag. A valid row without a start is unbounded below. With
    ``role``/``roles`` a row only conflicts with rows of a *different* role
    (the partnership rule: index 1 against index 2), with ``identity`` only
    with rows of another identity (a decision number may have several rows);
    a row with a NULL identity conflicts with none. Without it every row is
    its own identity.

    Exact equivalent of ``EXISTS (same key, other identity, both valid,
    overlap)``: sorted by start, a row overlaps an earlier one iff the running
    maximum of earlier ends reaches its start, and a later one iff the next
    later start is not after its end; rows sharing a start always overlap.
    """
    keys = list(keys)
    if valid is None:
        valid = valid_interval(start, end)
    base = df.withColumn("_valid", F.coalesce(valid, F.lit(False)))
    for k in (*keys, *([identity] if identity else [])):
        base = base.withColumn("_valid", F.col("_valid") & F.col(k).isNotNull())
    base = base.withColumn("_s", _low(start)).withColumn("_end", end_or_open(end))
    v = base.filter(F.col("_valid"))
    if role is not None and not roles:
        raise ValueError("roles must list the role values")
    if identity is not None:
        hit = F.lit(False)
        flagged = base
        for k, r in enumerate(roles if role is not None else [None]):
            against = v if role is None else v.filter(F.col(role) == F.lit(r))
            seen = _summary(against.select(*keys, "_s", "_end", identity), keys, "_s", "_end", identity, v.select(*keys, "_s").distinct())
            flagged = flagged.join(seen.select(*keys, "_s", *(F.col(c).alias(f"{c}_{k}") for c in seen.columns if c not in (*keys, "_s"))), [*keys, "_s"], "left")
            mine = F.col(identity)
            earlier = F.when(F.col(f"_i1_{k}") == mine, F.col(f"_e2_{k}")).otherwise(F.col(f"_e1_{k}"))
            following = F.when(F.coalesce(F.col(f"_ni_{k}") == mine, F.lit(False)), F.col(f"_nb_{k}")).otherwise(F.col(f"_na_{k}"))
            found = (F.coalesce((F.col(f"_here_{k}") != mine) | F.col(f"_many_{k}"), F.lit(False)) | F.coalesce(earlier >= F.col("_s"), F.lit(False))
                     | F.coalesce(following <= F.col("_end"), F.lit(False)))
            hit = hit | (found if role is None else ((F.col(role) != F.lit(r)) & found))
        return flagged.withColumn(out, F.col("_valid") & F.coalesce(hit, F.lit(False))).select(*(c for c in df.columns if c != out), out)
    w = Window.partitionBy(*keys).orderBy(F.col("_s"))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy(*keys).orderBy(F.desc("_s")).rowsBetween(Window.unboundedPreceding, -1)

    if role is None:
        summ = (v.groupBy(*keys, "_s")
                .agg(F.count(F.lit(1)).alias("_n"), F.max("_end").alias("_mx")))
        summ = (summ.withColumn("_prev_mx", F.max("_mx").over(before))
                .withColumn("_next_s", F.lead(F.col("_s")).over(w))
                .select(*keys, "_s", "_n", "_prev_mx", "_next_s"))
        flagged = base.join(summ, on=[*keys, "_s"], how="left")
        hit = ((F.col("_n") >= 2) | (F.col("_prev_mx") >= F.col("_s"))
               | (F.col("_next_s") <= F.col("_end")))
    else:
        aggs = []
        for i, r in enumerate(roles):
            is_r = F.col(role) == F.lit(r)
            aggs += [F.count(F.when(is_r, 1)).alias(f"_n{i}"),
                     F.max(F.when(is_r, F.col("_end"))).alias(f"_mx{i}")]
        summ = v.groupBy(*keys, "_s").agg(*aggs)
        sel = [*keys, "_s"]
        for i, _ in enumerate(roles):
            summ = (summ.withColumn(f"_prev_mx{i}", F.max(f"_mx{i}").over(before))
                    .withColumn(f"_next_s{i}", F.min(F.when(F.col(f"_n{i}") > 0, F.col("_s"))).over(later)))
            sel += [f"_n{i}", f"_prev_mx{i}", f"_next_s{i}"]
        flagged = base.join(summ.select(*sel), on=[*keys, "_s"], how="left")
        hit = F.lit(False)
        for i, r in enumerate(roles):
            other = F.col(role) != F.lit(r)
            hit = hit | (other & ((F.col(f"_n{i}") > 0) | (F.col(f"_prev_mx{i}") >= F.col("_s"))
                                  | (F.col(f"_next_s{i}") <= F.col("_end"))))
    return flagged.withColumn(out, F.col("_valid") & F.coalesce(hit, F.lit(False))).select(*(c for c in df.columns if c != out), out)


def _with_keys(df: DataFrame, keys: Sequence[str], *more: str) -> DataFrame:
    """Rows without a NULL in the keys: a NULL key equals nothing."""
    for k in (*keys, *more):
        df = df.filter(F.col(k).isNotNull())
    return df


def next_start(df: DataFrame, keys: Sequence[str], start: str, out: str = "next_start", identity: str | None = None) -> DataFrame:
    """The smallest strictly later start of the same key (NULL if none),
    with ``identity`` of a row of another identity."""
    keys = list(keys)
    if identity is None:
        d = _with_keys(df.select(*keys, start), keys, start).distinct()
        w = Window.partitionBy(*keys).orderBy(F.col(start))
        return df.join(d.withColumn(out, F.lead(F.col(start)).over(w)), on=[*keys, start], how="left")
    own = _with_keys(df.select(*keys, start, identity), keys, start, identity)
    seen = _summary(own, keys, start, None, identity, own.select(*keys, start).distinct()).select(*keys, start, "_na", "_ni", "_nb")
    found = F.when(F.col(identity).isNotNull(), _next_other(identity))
    return df.join(seen, on=[*keys, start], how="left").select(*df.columns, found.alias(out))


def close_open_ends(df: DataFrame, keys: Sequence[str], start: str, end: str,
                    out: str | None = None, identity: str | None = None) -> DataFrame:
    """An open end becomes (next strictly later start of the same key) - 1 day.

    Rows without a later start keep their NULL end. With ``identity`` (a
    decision number) only starts of other identities close, and all rows of an
    identity with an open end get one end, the day before the next start of
    another after the earliest open row; rows without an identity stay.
    ``out`` writes the result to a new column instead of replacing ``end``.
    """
    target = out or end
    if identity is None:
        n = next_start(df, keys, start, out="_ns")
        return (n.withColumn(target, F.when(F.col(end).isNull(), F.date_sub(F.col("_ns"), 1)).otherwise(F.col(end)))
                .drop("_ns"))
    keys = list(keys)
    own = _with_keys(df.select(*keys, start, end, identity), keys, start, identity)
    first = own.filter(F.col(end).isNull()).groupBy(*keys, identity).agg(F.min(start).alias(start))
    seen = _summary(own.select(*keys, start, identity), keys, start, None, identity, own.select(*keys, start).distinct())
    closed = (first.join(seen.select(*keys, start, "_na", "_ni", "_nb"), [*keys, start])
              .select(*keys, identity, F.date_sub(_next_other(identity), 1).alias("_closed")).where("_closed is not null"))
    return (df.join(closed, [*keys, identity], "left").withColumn("_closed", F.coalesce("_closed", end))
            .select(*(c for c in df.columns if c != target), F.col("_closed").alias(target)))


def expand_days(df: DataFrame, start: str, end: str, out: str = "day") -> DataFrame:
    """One row per day of ``[start, end]``; inverted or open intervals give no rows
    (callers resolve open ends first)."""
    return (df.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end)))
            .withColumn(out, F.explode(F.sequence(F.col(start), F.col(end)))))


def islands(df: DataFrame, keys: Sequence[str], day: str,
            start_out: str = "start_date", end_out: str = "end_date",
            count_out: str | None = None) -> DataFrame:
    """W1 gaps-and-islands: runs of consecutive days per key collapse to [min, max].

    Days are de-duplicated per key first (partial aggregation), so the window
    sees at most one row per calendar day of a key.
    """
    keys = list(keys)
    d = df.select(*keys, day).filter(F.col(day).isNotNull()).distinct()
    w = Window.partitionBy(*keys).orderBy(F.col(day))
    d = d.withColumn("_grp", F.date_sub(F.col(day), F.row_number().over(w)))
    aggs = [F.min(day).alias(start_out), F.max(day).alias(end_out)]
    if count_out:
        aggs.append(F.count(F.lit(1)).alias(count_out))
    return d.groupBy(*keys, "_grp").agg(*aggs).drop("_grp")


def _and_all(conds: Sequence[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def value_set_periods(df: DataFrame, keys: Sequence[str], start: str, end: str, value: str,
                      values: Sequence[str], out: str = "values",
                      start_out: str = "start_date", end_out: str = "end_date") -> DataFrame:
    """Maximal periods per key during which the set of active values is the
    same and non-empty (T1 + per-day set + W1, computed without expanding days).

    Equal to: expand every valid interval to its days, form per (key, day) the
    sorted set of values, and merge runs of consecutive days with the same
    set. Instead of one row per day, each interval contributes two boundary
    events (+1 at its start, -1 the day after its end); running counts per
    value over the boundary dates give the active set of each segment between
    boundaries, and adjacent segments with equal sets are merged. Work is
    proportional to the number of intervals, not of days; ``values`` (the
    dictionary of possible values, bounded) fixes the pivot width.
    """
    keys = list(keys)
    ok = (df.filter(F.col(start).isNotNull() & F.col(end).isNotNull() & (F.col(start) <= F.col(end))
                    & F.col(value).isNotNull())
          .select(*keys, start, end, value))
    ev = (ok.select(*keys, F.col(start).alias("_d"), value, F.lit(1).alias("_delta"))
          .unionByName(ok.select(*keys, F.date_add(F.col(end), 1).alias("_d"), value, F.lit(-1).alias("_delta"))))
    deltas = [F.sum(F.when(F.col(value) == F.lit(v), F.col("_delta")).otherwise(0)).alias(f"_dv{i}")
              for i, v in enumerate(values)]
    b = ev.groupBy(*keys, "_d").agg(*deltas)
    w = Window.partitionBy(*keys).orderBy("_d")
    upto = w.rowsBetween(Window.unboundedPreceding, 0)
    active = F.array(*[F.when(F.sum(f"_dv{i}").over(upto) > 0, F.lit(v)) for i, v in enumerate(values)])
    seg = b.select(*keys, "_d", F.array_sort(F.filter(active, lambda x: x.isNotNull())).alias("_set"),
                   F.date_sub(F.lead("_d").over(w), 1).alias("_e"))
    seg = seg.filter((F.size("_set") > 0) & F.col("_e").isNotNull())
    prev_e = F.lag("_e").over(w)
    prev_set = F.lag("_set").over(w)
    new_run = prev_e.isNull() | (F.date_add(prev_e, 1) != F.col("_d")) | (prev_set != F.col("_set"))
    seg = seg.withColumn("_new", F.when(new_run, 1).otherwise(0))
    seg = seg.withColumn("_run", F.sum("_new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return (seg.groupBy(*keys, "_run", F.col("_set").alias(out))
            .agg(F.min("_d").alias(start_out), F.max("_e").alias(end_out)).drop("_run"))
