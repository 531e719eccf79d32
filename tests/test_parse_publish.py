"""Value parsers (P1-P12, N1-N3) and publishing semantics (K4-K7)."""

import datetime as dt

from pyspark.sql import functions as F

from registrar.functions import domain as dom
from registrar.functions import parse as P
from registrar.operators import identity as ident
from registrar.sinks import publish as pub


def test_text_and_flag_parsers(spark):
    df = spark.createDataFrame([("",), (" ",), ("&#x20;",), ("a",), (None,), ("1",), ("0",)], "v string")
    got = df.select(P.null_forcing_text("v").alias("t"), P.numeric_boolean("v").alias("b"),
                    P.activity_flag("v").alias("a"), P.non_null_text("v").alias("n")).collect()
    assert [r.t for r in got] == [None, None, None, "a", None, "1", "0"]
    assert [r.b for r in got] == [False, False, False, False, False, True, False]
    assert [r.a for r in got] == [False, False, False, True, False, False, False]
    assert got[4].n == ""


def test_dates_codes_arrays(spark):
    df = spark.createDataFrame([("20200301", "0", "{1,2}", "[2021-04-20,)", "(21.5,61.5)"),
                                ("99999999", "5", "", "", ""), ("2020-03-01", "x", None, None, None),
                                ("junk", None, "{}", "[2020-01-01,2020-02-01)", None)],
                               "d string, c string, a string, r string, p string")
    got = df.select(P.nullable_date("d").alias("d"), P.code_number("c").alias("c"),
                    P.array_literal("a").alias("a"), P.range_literal("r").alias("r"),
                    P.point_literal("p").alias("p")).collect()
    assert [r.d for r in got] == [dt.date(2020, 3, 1), None, dt.date(2020, 3, 1), None]
    assert [r.c for r in got] == [None, 5, None, None]
    assert [r.a for r in got] == [["1", "2"], [], [], []]
    assert got[0].r.lower == dt.date(2021, 4, 20) and got[0].r.upper is None
    assert got[0].p.x == 21.5 and got[0].p.y == 61.5


def test_identity_code_functions(spark):
    df = spark.createDataFrame([("010619A9501", "2020-01-01"), ("150385-1234", "2000-01-01"),
                                ("150385X1234", "2000-01-01"), ("short", "2000-01-01")], "c string, s string")
    df = df.withColumn("s", F.to_date("s"))
    got = df.select(dom.birth_date_from_code("c").alias("b"), dom.birth_code_sign_valid("c").alias("ok"),
                    dom.daycare_end_date("c", "s").alias("e")).collect()
    assert got[0].b == dt.date(2019, 6, 1) and got[0].e == dt.date(2025, 7, 31)
    assert got[1].b == dt.date(1985, 3, 15) and got[1].e == dt.date(2001, 7, 31)
    assert got[2].b is None and got[2].ok is False
    assert got[3].b is None and got[3].ok is True


def test_preschool_end(spark):
    df = spark.createDataFrame([("2018-08-01",), ("2019-07-31",), ("2023-07-31",), ("2023-08-01",), ("2018-07-31",)], "s string")
    got = [r.e for r in df.select(dom.preschool_end_date(F.to_date("s")).alias("e")).collect()]
    assert got == [dt.date(2019, 7, 31), dt.date(2019, 7, 31), dt.date(2023, 7, 31), None, None]


def test_insert_ignore(spark):
    existing = spark.createDataFrame([("a",)], "k string")
    incoming = spark.createDataFrame([("a", 1), ("b", 3), ("b", 2), (None, 4), (None, 5)], "k string, n int")
    got = sorted((r.k or "", r.n) for r in pub.insert_ignore_rows(existing, incoming, ["k"], ["n"]).collect())
    assert got == [("", 4), ("", 5), ("b", 2)]


def test_upsert_changed_and_update_from(spark):
    old = spark.createDataFrame([("x", "1", None), ("y", "2", None)], "k string, v string, updated timestamp")
    new = spark.createDataFrame([("x", "1"), ("y", "9"), ("z", "3")], "k string, v string")
    got = {r.k: (r.v, r.action) for r in pub.upsert_changed(old, new, ["k"], ["v"], "updated").collect()}
    assert got == {"x": ("1", "keep"), "y": ("9", "update"), "z": ("3", "insert")}
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(1, None)], "k int, w string")
    got = sorted((r.k, r.v) for r in pub.update_from(t, s, ["k"], ["k"], {"v": "w"}).collect())
    assert got == [(1, None), (2, "b")]


def test_delete_by_keys_and_ids(spark):
    t = spark.createDataFrame([(1, "a"), (None, "b"), (2, "c")], "k int, v string")
    d = spark.createDataFrame([(1,), (None,)], "k int")
    assert sorted(r.v for r in pub.delete_by_keys(t, d, ["k"]).collect()) == ["b", "c"]
    ids = spark.range(3).select(ident.hash_uuid("PERSON", F.col("id")).alias("u")).collect()
    assert len({r.u for r in ids}) == 3 and all(len(r.u) == 36 for r in ids)


def test_read_back_and_rebuild(spark, tmp_path):
    df = spark.createDataFrame([(2, "b"), (1, "a")], "k int, v string")
    assert [r.k for r in pub.read_back(df, ["k"]).collect()] == [1, 2]
    assert pub.read_back(df, return_all=False, table="t").collect()[0].t_count == 2
    target = pub.rebuild(df, str(tmp_path / "rebuilt"))
    assert spark.read.parquet(target).count() == 2 and "/run=" in target


def test_consistency_check(spark):
    from registrar.operators import constraints as con
    df = spark.createDataFrame([("p1", 1, "a"), ("p1", 2, "a"), ("p2", 1, "a"), ("p2", 2, "b"), ("p3", 1, None),
                                ("p3", 2, None)], "k string, i int, d string")
    assert [r.key_text for r in con.violations(df, ["k", "i"], [con.Agree("d", ("k",), ("d",))]).collect()] == ["p2"]
