"""Interval operators against brute-force definitions on random data,
including one hot key holding a large share of the rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from registrar.operators import intervals as iv

BASE = dt.date(2020, 1, 1)
OPEN = dt.date(9999, 12, 31)


def _rows(seed, n=400, keys=12, hot_share=0.4):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        k = 0 if rnd.random() < hot_share else rnd.randint(1, keys)
        if rnd.random() < 0.03:
            k = None
        s = BASE + dt.timedelta(days=rnd.randint(0, 400))
        r = rnd.random()
        if r < 0.12:
            e = None
        elif r < 0.2:
            e = s - dt.timedelta(days=rnd.randint(1, 5))
        else:
            e = s + dt.timedelta(days=rnd.randint(0, 30))
        role = rnd.choice([1, 2])
        out.append((i, k, s, e, role))
    return out


SCHEMA = "id long, k long, s date, e date, role int"


def _overlap(a, b):
    return a[2] <= (b[3] or OPEN) and b[2] <= (a[3] or OPEN)


def _valid(r, allow_open=True):
    return r[2] is not None and (r[3] is None and allow_open or (r[3] is not None and r[2] <= r[3]))


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_conflicts_match_self_join(spark, seed):
    data = _rows(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id for r in iv.conflicts(df, ["k"], "s", "e").filter("overlapping").collect()}
    want = {a[0] for a in data for b in data
            if a[1] is not None and a[1] == b[1] and a[0] != b[0] and _valid(a) and _valid(b) and _overlap(a, b)}
    assert got == want


@pytest.mark.parametrize("seed", [4, 5])
def test_conflicts_closed_only(spark, seed):
    data = _rows(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id for r in iv.conflicts(df, ["k"], "s", "e", valid=iv.valid_interval("s", "e", allow_open=False))
           .filter("overlapping").collect()}
    want = {a[0] for a in data for b in data
            if a[1] is not None and a[1] == b[1] and a[0] != b[0]
            and _valid(a, False) and _valid(b, False) and _overlap(a, b)}
    assert got == want


@pytest.mark.parametrize("seed", [6, 7])
def test_conflicts_other_role(spark, seed):
    data = _rows(seed)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id for r in iv.conflicts(df, ["k"], "s", "e", role="role", roles=[1, 2]).filter("overlapping").collect()}
    want = {a[0] for a in data for b in data
            if a[1] is not None and a[1] == b[1] and a[4] != b[4] and _valid(a) and _valid(b) and _overlap(a, b)}
    assert got == want


def test_close_open_ends(spark):
    data = _rows(8)
    df = spark.createDataFrame(data, SCHEMA)
    got = {r.id: r.e2 for r in iv.close_open_ends(df, ["k"], "s", "e", out="e2").collect()}
    for a in data:
        if a[3] is not None:
            assert got[a[0]] == a[3]
            continue
        later = [b[2] for b in data if a[1] is not None and b[1] == a[1] and b[2] > a[2]]
        want = (min(later) - dt.timedelta(days=1)) if later else None
        assert got[a[0]] == want, a


@pytest.mark.parametrize("bin_days", [1, 7, 30])
def test_overlap_join_matches_nested_loop(spark, bin_days):
    data = _rows(9, n=300)
    left = spark.createDataFrame([r for r in data if r[4] == 1], SCHEMA).select(
        F.col("id").alias("lid"), "k", F.col("s").alias("ls"), F.col("e").alias("le"))
    right = spark.createDataFrame([r for r in data if r[4] == 2], SCHEMA).select(
        F.col("id").alias("rid"), "k", F.col("s").alias("rs"), F.col("e").alias("re"))
    got = sorted((r.lid, r.rid, r.overlap_start, r.overlap_end) for r in
                 iv.overlap_join(left, right, ["k"], ("ls", "le"), ("rs", "re"), bin_days=bin_days).collect())
    want = []
    for a in data:
        for b in data:
            if a[4] == 1 and b[4] == 2 and a[1] is not None and a[1] == b[1]:
                lo = max(a[2], b[2])
                hi = min(a[3] or OPEN, b[3] or OPEN)
                if lo <= hi:
                    ends = [x for x in (a[3], b[3]) if x is not None]
                    want.append((a[0], b[0], lo, min(ends) if ends else None))
    assert got == sorted(want)


@pytest.mark.parametrize("half_open", [False, True])
def test_point_in_interval(spark, half_open):
    rnd = random.Random(11)
    points = [(i, rnd.choice([0, 0, 0, 1, 2]), BASE + dt.timedelta(days=rnd.randint(0, 60))) for i in range(300)]
    ivs = _rows(12, n=80)
    pdf = spark.createDataFrame(points, "pid long, k long, d date")
    idf = spark.createDataFrame(ivs, SCHEMA)
    got = sorted((r.pid, r.id) for r in iv.point_in_interval_join(
        pdf, idf, ["k"], "d", ("s", "e"), half_open=half_open, bin_days=5).collect())
    want = []
    for p in points:
        for r in ivs:
            if r[1] is not None and r[1] == p[1] and r[2] <= p[2]:
                inside = (p[2] < r[3]) if (half_open and r[3] is not None) else (r[3] is None or p[2] <= r[3])
                if inside:
                    want.append((p[0], r[0]))
    assert got == sorted(want)


def test_islands_and_expand(spark):
    rows = [(1, BASE + dt.timedelta(days=d)) for d in (0, 1, 2, 4, 4, 5, 9)] + [(2, BASE)]
    df = spark.createDataFrame(rows, "k long, d date")
    got = sorted((r.k, r.start_date, r.end_date, r.n) for r in iv.islands(df, ["k"], "d", count_out="n").collect())
    assert got == [(1, BASE, BASE + dt.timedelta(days=2), 3), (1, BASE + dt.timedelta(days=4), BASE + dt.timedelta(days=5), 2),
                   (1, BASE + dt.timedelta(days=9), BASE + dt.timedelta(days=9), 1), (2, BASE, BASE, 1)]
    ex = spark.createDataFrame([(1, BASE, BASE + dt.timedelta(days=2)), (2, BASE, BASE - dt.timedelta(days=1)),
                                (3, BASE, None)], "k long, s date, e date")
    assert iv.expand_days(ex, "s", "e").count() == 3


@pytest.mark.parametrize("seed", [21, 22, 23])
def test_value_set_periods_match_day_expansion(spark, seed):
    rnd = random.Random(seed)
    vals = ["A", "B", "C"]
    rows = []
    for i in range(250):
        k = 0 if rnd.random() < 0.4 else rnd.randint(1, 6)
        s = BASE + dt.timedelta(days=rnd.randint(0, 120))
        e = None if rnd.random() < 0.05 else s + dt.timedelta(days=rnd.randint(-2, 25))
        v = None if rnd.random() < 0.05 else rnd.choice(vals)
        rows.append((k, s, e, v))
    df = spark.createDataFrame(rows, "k long, s date, e date, v string")
    got = sorted((r.k, r.start_date, r.end_date, tuple(r.vals)) for r in
                 iv.value_set_periods(df, ["k"], "s", "e", "v", vals, out="vals").collect())
    per_day = {}
    for k, s, e, v in rows:
        if e is None or v is None or s > e:
            continue
        d = s
        while d <= e:
            per_day.setdefault((k, d), set()).add(v)
            d += dt.timedelta(days=1)
    want = []
    for k in sorted({k for k, _ in per_day}):
        days = sorted(d for kk, d in per_day if kk == k)
        cur = None
        for d in days:
            st = tuple(sorted(per_day[(k, d)]))
            if cur and cur[2] + dt.timedelta(days=1) == d and cur[3] == st:
                cur[2] = d
            else:
                if cur:
                    want.append(tuple(cur))
                cur = [k, d, d, st]
        if cur:
            want.append(tuple(cur))
    assert got == sorted(want)


@pytest.mark.parametrize("seed", [41, 42])
def test_repair_branch_join_matches_definition(spark, seed):
    from registrar.operators.joins import repair_branch_join
    rnd = random.Random(seed)
    left = []
    right = []
    for i in range(120):
        k = rnd.choice([0, 0, 1, 2])
        s = BASE + dt.timedelta(days=rnd.randint(0, 60))
        e = None if rnd.random() < 0.3 else s + dt.timedelta(days=rnd.randint(-3, 20))
        left.append((i, k, s, e))
    for j in range(150):
        k = rnd.choice([0, 1, 2, 3])
        s = BASE + dt.timedelta(days=rnd.randint(0, 60))
        r = rnd.random()
        e = None if r < 0.2 else (s - dt.timedelta(days=rnd.randint(1, 4)) if r < 0.4 else s + dt.timedelta(days=rnd.randint(0, 20)))
        right.append((j, k, s, e))
    L = spark.createDataFrame(left, "lid long, k long, ls date, le date")
    R = spark.createDataFrame(right, "rid long, k long, rs date, re date")
    got = sorted((r.lid, r.rid) for r in repair_branch_join(L, R, ["k"], ("ls", "le"), ("rs", "re")).collect())
    want = []
    for a in left:
        for b in right:
            if a[1] != b[1]:
                continue
            broken = b[3] is not None and b[2] > b[3] and a[2] == b[2] and a[3] is None
            normal = ((b[3] is None or b[3] > b[2])
                      and max(a[2], b[2]) <= min(a[3] or OPEN, b[3] or OPEN))
            if broken or normal:
                want.append((a[0], b[0]))
    assert got == sorted(want)


def test_joins_exact_for_any_bin_width_and_far_dates(spark):
    data = _rows(51, n=200)
    data += [(900, 0, dt.date(2999, 1, 1), None, 1), (901, 0, None, dt.date(2020, 3, 1), 2), (902, 0, None, None, 1),
             (903, 0, dt.date(1, 1, 1), dt.date(9999, 12, 31), 2)]
    lrows, rrows = [r for r in data if r[4] == 1], [r for r in data if r[4] == 2]
    left = spark.createDataFrame(lrows, SCHEMA).select(F.col("id").alias("lid"), "k", F.col("s").alias("ls"), F.col("e").alias("le"))
    right = spark.createDataFrame(rrows, SCHEMA).select(F.col("id").alias("rid"), "k", F.col("s").alias("rs"), F.col("e").alias("re"))
    low = dt.date(1, 1, 1)
    want = sorted((a[0], b[0]) for a in lrows for b in rrows if a[1] is not None and a[1] == b[1]
                  and max(a[2] or low, b[2] or low) <= min(a[3] or OPEN, b[3] or OPEN))
    for width in (1, 7, 365):
        got = iv.overlap_join(left, right, ["k"], ("ls", "le"), ("rs", "re"), bin_days=width).collect()
        assert sorted((r.lid, r.rid) for r in got) == want, width
    points = [(i, i % 3 if i % 7 else None, BASE + dt.timedelta(days=i) if i % 11 else None) for i in range(120)]
    points += [(500, 0, dt.date(2999, 1, 1)), (501, 0, OPEN), (502, 0, low), (500, 0, dt.date(2999, 1, 1))]
    pts = spark.createDataFrame(points, "pid long, k long, d date")
    ivs = spark.createDataFrame(data, SCHEMA).withColumnRenamed("k", "ik")
    for keyed in (True, False):
        pairs = [(p[0], r[0]) for p in points for r in data if p[2] and r[2] and r[2] <= p[2] <= (r[3] or OPEN)
                 and (not keyed or p[1] is not None and p[1] == r[1])]
        hit = {p for p, _ in pairs}
        want = sorted(pairs + [(p[0], -1) for p in points if p[0] not in hit])
        for width in (5, 90):
            side = ivs.withColumnRenamed("ik", "k") if keyed else ivs
            got = iv.point_in_interval_join(pts, side, ["k"] if keyed else [], "d", ("s", "e"), how="left", bin_days=width).collect()
            assert sorted((r.pid, -1 if r.id is None else r.id) for r in got) == want, (keyed, width)


def test_copies_do_not_grow_with_the_dates(spark):
    for far in (BASE, dt.date(2999, 1, 1)):
        rows = [(i, 0, BASE + dt.timedelta(days=i), None, 1) for i in range(1000)] + [(1000, 0, far, far, 1)]
        df = spark.createDataFrame(rows, SCHEMA)
        left, right = iv._placed_sides(df, df, ("s", "e"), ("s", "e"), 30)
        assert left.count() <= 1000 + 3 and right.count() <= 2 * 1000 + 5  # open ends: one bin each, twice on the right


@pytest.mark.parametrize("bin_days", [7, 30, 365])
def test_few_copies_on_the_test_tables(spark, bin_days):
    from registrar.plans.star import order_intervals
    o = order_intervals(spark, "/root/testdata/sf0.01").select("o_custkey", "start_date", "end_date")
    left, right = iv._placed_sides(o, o, ("start_date", "end_date"), ("start_date", "end_date"), bin_days)
    assert left.count() <= 5 * o.count() and right.count() <= 6 * o.count()


def test_occupied_levels(spark):
    df = spark.createDataFrame([(0, 0, BASE, BASE, 1), (1, 0, BASE, None, 1), (2, 0, BASE, BASE - dt.timedelta(days=3), 1)], SCHEMA)
    first, last = iv._bin(F.col("s"), 30), iv._bin(iv.end_or_open("e"), 30)
    mask = df.select(iv._occupied(df, first, last, 30).alias("m")).first().m
    assert mask == 1 | 1 << (iv._levels(30) - 1)  # the inverted interval belongs to the first level or none


ID_SCHEMA = "id long, k long, s date, e date, role int, nbr long"


def identified(seed: int, n: int = 260):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        s = None if rnd.random() < 0.06 else BASE + dt.timedelta(days=rnd.randrange(60))
        e = None if rnd.random() < 0.15 else (s or BASE) + dt.timedelta(days=rnd.choice([-2, 0, 1, 3, 8, 30]))
        out.append((i, rnd.randrange(14), s, e, rnd.choice([1, 2]), None if rnd.random() < 0.05 else rnd.randrange(4)))
    return out


def lies(a, b):
    """Overlap of two valid intervals with open sides."""
    low, high = dt.date(1, 1, 1), dt.date(9999, 12, 31)
    return (a[2] or low) <= (b[3] or high) and (b[2] or low) <= (a[3] or high)


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("role", [None, "role"])
def test_conflicts_of_other_identities(spark, seed, role):
    rows = identified(seed)
    df = spark.createDataFrame(rows, ID_SCHEMA).repartition(4)

    def valid(r):  # like the legacy rule: an end that is open, or not before a known start
        return r[3] is None or (r[2] is not None and r[3] >= r[2])

    got = {r.id: r.overlapping for r in iv.conflicts(
        df, ["k"], "s", "e", valid=(F.col("e") >= F.col("s")) | F.col("e").isNull(), identity="nbr",
        **({"role": "role", "roles": [1, 2]} if role else {})).collect()}
    want = {a[0]: any(a[1] == b[1] and None not in (a[5], b[5]) and a[5] != b[5] and valid(a) and valid(b) and lies(a, b)
                      and (role is None or a[4] != b[4]) for b in rows) for a in rows}
    assert got == want and 20 < sum(want.values()) < 250


@pytest.mark.parametrize("seed", range(4))
def test_conflicts_without_starts(spark, seed):
    rows = identified(seed)
    df = spark.createDataFrame(rows, ID_SCHEMA)
    got = {r.id: r.overlapping for r in iv.conflicts(df, ["k"], "s", "e", valid=F.col("e").isNull() | (F.col("s") <= F.col("e"))).collect()}

    def valid(r):
        return r[3] is None or (r[2] is not None and r[2] <= r[3])
    assert got == {a[0]: any(a[0] != b[0] and a[1] == b[1] and valid(a) and valid(b) and lies(a, b) for b in rows) for a in rows}


@pytest.mark.parametrize("seed", range(4))
def test_next_start_and_closing_by_identity(spark, seed):
    rows = identified(seed)
    df = spark.createDataFrame(rows, ID_SCHEMA).repartition(3)

    def nxt(a, s):
        return min((b[2] for b in rows if b[1] == a[1] and None not in (a[5], b[5], s, b[2]) and b[5] != a[5] and b[2] > s), default=None)

    got = {r.id: r.next_start for r in iv.next_start(df, ["k"], "s", identity="nbr").collect()}
    assert got == {a[0]: nxt(a, a[2]) for a in rows}
    closed = {r.id: r.e for r in iv.close_open_ends(df, ["k"], "s", "e", identity="nbr").collect()}
    want = {}
    for a in rows:
        ends = [n - dt.timedelta(days=1) for b in rows if b[1] == a[1] and a[5] is not None and b[5] == a[5] and b[3] is None and (n := nxt(b, b[2]))]
        want[a[0]] = min(ends) if ends else a[3]
    assert closed == want
