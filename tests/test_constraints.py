"""Q2: constraints in one pass, against brute force and in strict mode."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from registrar.operators import constraints as con

SCHEMA = "id int, a int, b string, s date, e date, _n int"


def day(n):
    return None if n is None else dt.date(2021, 1, 1) + dt.timedelta(days=n)


def brute(rows, known):
    """The same constraints row by row; {(constraint, key): rows}."""
    out = {}

    def add(name, key, n=1):
        out[name, key] = out.get((name, key), 0) + n

    def text(*v):
        return "|".join("" if x is None else str(x) for x in v)

    for i, a, b, s, e, _ in rows:
        if b is None:
            add("not_null:b", text(i))
        if b is not None and b not in ("x", "y"):
            add("values:b", text(i))
        if s is not None and e is not None and s > e:
            add("check:start_before_end", text(i))
        if a is not None and b is not None and (a, b) not in known:
            add("foreign_key:a,b", text(i))
    groups = {}
    for r in rows:
        groups.setdefault(r[1], []).append(r)
    for a, members in groups.items():
        if a is None:
            continue
        pairs = {}
        for r in members:
            pairs.setdefault(r[2], []).append(r)
        for b, same in pairs.items():
            if b is not None and len(same) > 1:
                add("unique:a,b", text(a, b), len(same))
        if len({r[2] for r in members}) > 1:
            add("consistent:b", text(a), len(members))
        valid = [r for r in members if r[3] is not None and (r[4] is None or r[3] <= r[4])]
        for k, r in enumerate(valid):
            if any(j != k and o[3] <= r[3] and (o[4] is None or o[4] >= r[3]) for j, o in enumerate(valid)):
                add("no_overlap:busy", text(a, r[3]))
    return out


def declared(ref):
    return [*con.not_null("b"), con.values("b", ["x", "y"]), con.check("start_before_end", F.col("s") <= F.col("e")),
            con.ForeignKey(("a", "b"), ref, ("ra", "b")), con.Unique(("a", "b")), con.Agree("b", ("a",), ("b",)),
            con.NoOverlap("busy", ("a",), "s", "e")]


def as_dict(df):
    return {(r.constraint_name, r.key_text): r.n_rows for r in df.collect()}


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(400):
        hot = rnd.random() < 0.3
        s = rnd.choice([None, *range(0, 4000, 3)])
        e = rnd.choice([None, None, *[(s or 0) + d for d in (-4, 0, 2, 5, 9, 14, 20, 6, 3)]])
        rows.append((i % 390, 0 if hot else rnd.choice([None, *range(1, 60)]), rnd.choice(["x", "y", "y", "z", None]),
                     day(s), day(e), 7))
    known = {(a, b) for a in range(40) for b in ("x", "z")}
    ref = spark.createDataFrame([*known, *known, (None, "y"), (50, None)], "ra int, b string")
    got = as_dict(con.violations(spark.createDataFrame(rows, SCHEMA), ["id"], declared(ref)))
    assert got == brute(rows, known)
    assert {n.split(":")[0] for n, _ in got} == {"not_null", "values", "check", "foreign_key", "unique", "consistent", "no_overlap"}


def test_empty_tables_and_no_constraints(spark):
    df, ref = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "ra int, b string")
    assert con.violations(df, ["id"], declared(ref)).collect() == []
    one = spark.createDataFrame([(1, 2, "x", None, None, 0)], SCHEMA)
    assert as_dict(con.violations(one, ["id"], declared(ref))) == {("foreign_key:a,b", "1"): 1}
    assert con.violations(one, ["id"], []).count() == 0


def test_keys_do_not_run_together(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c")], "x string, y string")
    assert con.violations(df, ["x"], [con.Unique(("x", "y"))]).count() == 0


def test_the_table_is_read_once(spark, tmp_path):
    spark.range(50).select(F.col("id").cast("int").alias("id"), F.lit(1).alias("a"), F.lit("x").alias("b"),
                           F.lit(None).cast("date").alias("s"), F.lit(None).cast("date").alias("e")).write.parquet(str(tmp_path / "t"))
    ref = spark.createDataFrame([(1, "x")], "ra int, b string")
    plan = con.violations(spark.read.parquet(str(tmp_path / "t")), ["id"], declared(ref))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1


def test_rows_without_reference_are_spread(spark):
    """NULL keys carry a salt into the join, so they do not meet in one task."""
    df = spark.range(1000).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") < 0, 1).alias("a"))
    ref = spark.range(5).select(F.col("id").cast("int").alias("k"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = con.violations(df, ["id"], [con.ForeignKey(("a",), ref, ("k",))])
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert out.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = next(line for line in plan.splitlines() if "SortMergeJoin" in line or "ShuffledHashJoin" in line)
    assert "_q2s0" in join


def test_strict_chain_stops_and_names_the_constraint(spark, tmp_path):
    from registrar.plans.runner import run_chain
    from registrar.plans.transfer import publish_all
    from registrar.sinks.publish import Manifest
    units = spark.createDataFrame([("u1", ["CENTRE"], "MUNICIPAL", "fi"), ("u2", ["NOTHING"], "MUNICIPAL", "sv")],
                                  "id string, type array<string>, provider_type string, language string")

    def job(t):
        return {"unit": units, "unit_violations": con.violations(units, ["id"], [con.values("language", ["fi"])])}

    state = run_chain({"units": units}, [("units", job)], out_dir=str(tmp_path / "loose"))
    assert state["unit_violations"].count() == 1
    with pytest.raises(con.ConstraintError) as e:
        run_chain({"units": units}, [("units", job)], out_dir=str(tmp_path / "strict"), strict=True)
    assert e.value.counts == {"values:language": 1} and con.VIOLATED in str(e.value)

    target = str(tmp_path / "target")
    publish = [("units", job)]
    with pytest.raises(con.ConstraintError):
        publish_all({"units": units}, target, jobs=publish, strict=True)
    assert Manifest(spark, target).tables == {}
    for _ in range(2):  # found again by a second run, held once
        assert publish_all({"units": units}, target, jobs=publish)["units"]["unit_violations"] == 1
    assert Manifest(spark, target).read("_checks/unit_violations").count() == 1
