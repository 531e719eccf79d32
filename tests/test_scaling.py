"""What a job shuffles, pairs and writes must follow its rows, not the repeats in them."""

import datetime as dt
import random
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from registrar.operators import aggregate as agg
from registrar.operators import constraints as con
from registrar.operators import intervals as iv
from registrar.operators import joins
from registrar.plans import transfer
from registrar.plans.transform import _common, finance
from registrar.sources import inputs

DAY = dt.date(2020, 1, 1)


@pytest.fixture
def shuffled(spark):
    """Joins by shuffle into eight fixed partitions."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_task(df):
    return df.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]


def test_points_without_a_key_do_not_meet_in_one_task(spark, shuffled):
    points = spark.range(4000, numPartitions=8).select(F.col("id").alias("n"), F.when(F.col("id") % 100 == 0, "a").alias("k"),
                                                       F.when(F.col("id") % 50 == 0, F.lit(DAY)).alias("d"))
    spans = spark.createDataFrame([("a", DAY, None, "hit")], "k string, s date, e date, v string")
    found = iv.point_in_interval_join(points, spans, ["k"], "d", ("s", "e"), how="left")
    assert found.count() == 4000 and found.where("v = 'hit'").count() == 40
    assert found.where("v is null and k is not null").count() == 0
    assert largest_task(found) < 1500


def test_lookups_without_a_code_do_not_meet_in_one_task(spark, shuffled):
    rows = spark.range(4000, numPartitions=8).select(F.col("id").alias("n"), F.when(F.col("id") % 100 == 0, "c").alias("ssn"),
                                                     F.create_map(F.lit("x"), F.col("id")).alias("m"))
    person = spark.createDataFrame([("p2", "c"), ("p1", "c"), ("p3", None)], "id string, legacy_ssn string")
    found = _common.person_lookup(rows, person, "ssn", {"id": "person_id"})
    assert found.columns == ["n", "ssn", "m", "person_id"]
    assert found.count() == 4000 and found.where("person_id = 'p1'").count() == 40 and found.where("person_id is null").count() == 3960
    assert largest_task(found) < 1500


def test_incomes_are_paired_by_interval_and_type(spark, monkeypatch):
    sides = []
    joined = finance.repair_branch_join

    def seen(left, right, *more):
        sides.extend((left.count(), right.count()))
        return joined(left, right, *more)
    monkeypatch.setattr(finance, "repair_branch_join", seen)
    end = DAY + dt.timedelta(days=30)
    inc = spark.createDataFrame([("c", DAY, end, False, False, Decimal(n), None) for n in range(40)],
                                "personid string, startdate date, enddate date, maxincome boolean, incomemissing boolean, summa decimal(18,4), guid string")
    rows = spark.createDataFrame([("c", DAY, end, 83, 85, Decimal(n), f"g{n:02d}") for n in range(50)],
                                 "personid string, startdate date, enddate date, incomeperiod int, incometype int, summa decimal(18,4), guid string")
    person = spark.createDataFrame([("p", "c")], "id string, legacy_ssn string")
    out = finance.income({"income": inc, "incomerows": rows, "mig_person": person})
    assert sides == [1, 1]
    todo = out["mig_income_todo"].collect()  # all forty overlap
    assert len(todo) == 40 and {r.income_total for r in todo} == {n * 100 for n in range(40)}
    amounts = {next(iter(r.data.values())).amount for r in todo}
    assert amounts == {n * 100 for n in range(40)}  # no declared total is the 4,900 of the latest row


def test_incomes_with_different_dates_are_not_paired_with_every_row(spark, monkeypatch):
    made, plans, joined = [], [], finance.repair_branch_join

    def seen(*given):
        found = joined(*given)
        made.append(found.count())
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found
    monkeypatch.setattr(finance, "repair_branch_join", seen)
    days = [DAY + dt.timedelta(days=n) for n in range(60)]
    inc = spark.createDataFrame([("c", d, None, False, False, Decimal(n), None) for n, d in enumerate(days[:40])],
                                "personid string, startdate date, enddate date, maxincome boolean, incomemissing boolean, summa decimal(18,4), guid string")
    rows = spark.createDataFrame([("c", d, None, 83, 85 + n % 2, Decimal(n), f"g{n:02d}") for n, d in enumerate(days)],
                                 "personid string, startdate date, enddate date, incomeperiod int, incometype int, summa decimal(18,4), guid string")
    person = spark.createDataFrame([("p", "c")], "id string, legacy_ssn string")
    out = finance.income({"income": inc, "incomerows": rows, "mig_person": person})
    assert out["mig_income_todo"].count() == 40  # all are open
    assert made == [80]  # forty incomes with two types, not 2,400 pairs
    assert "Exchange" not in plans[0][:plans[0].index("Union")]  # rows are dealt by person once and grouped and sorted there


def test_rows_of_a_hot_key_are_summed_before_they_are_dealt(spark, shuffled):
    rows = spark.range(4000, numPartitions=8).select(F.when(F.col("id") < 3600, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 90)).alias("k"),
                                                     (F.col("id") % 7).alias("d"), F.col("id").alias("v"), F.when(F.col("id") % 3 > 0, "g").alias("g"))
    want = sorted(map(repr, rows.groupBy("k", "d").agg(F.max(F.struct("g", "v")).alias("x")).collect()))
    for hot_rows in (100, 10000):  # with hot keys, and without
        found = agg.dealt_max(rows, ["k"], ["k", "d"], ["g", "v"], "x", hot_rows)
        assert found.columns == ["k", "d", "x"] and sorted(map(repr, found.collect())) == want
        assert found.select("k", F.spark_partition_id().alias("p")).distinct().count() == 91
        dealt = found._jdf.queryExecution().executedPlan().toString()
        assert "LeftAnti" in dealt and "LeftSemi" in dealt


@pytest.mark.parametrize("seed", [1, 2, 3, 4])
def test_latest_row_per_type_is_the_one_of_all_pairs(spark, seed):
    rnd = random.Random(seed)
    near = [None, dt.date(1, 1, 1), dt.date(1970, 1, 1), dt.date(9999, 12, 31)]

    def day(missing):
        return rnd.choice(near) if rnd.random() < missing else DAY + dt.timedelta(days=rnd.choice([rnd.randrange(40), rnd.randrange(2000)]))

    def end(start):
        if start is None or rnd.random() < 0.3:
            return day(0.6)
        return min(max(start.toordinal() + rnd.choice([0, 1, -2, 3, 9, 70, 900, 40000]), 1), dt.date.max.toordinal())

    def span():
        s = day(0.1)
        e = end(s)
        return s, dt.date.fromordinal(e) if isinstance(e, int) else e
    keys = ["a", "b", "c", None]
    left = spark.createDataFrame(list({(rnd.choice(keys), *span()) for _ in range(250)}), "k string, ls date, le date")
    rows = [(rnd.choice(keys[1:]), *span(), rnd.choice(["x", "y", "z", None]), rnd.choice([None, "g1", "g2", "g3"]), n % 7) for n in range(250)]
    rows += [("b", s, e, t, g, v) for k, s, e, t, g, v in rows if v == 3]
    right = (spark.createDataFrame(rows, "k string, rs date, re date, t string, g string, v int")
             .groupBy("k", "rs", "re", "t").agg(F.max(F.struct("rs", "g", "v")).alias("last")))
    sides = (left, right, ["k"], ("ls", "le"), ("rs", "re"))
    pairs = joins.repair_branch_join(*sides)
    want = pairs.groupBy("k", "ls", "le", "t").agg(F.max("last").alias("last"))
    found = joins.repair_branch_join(*sides, "t", "last")
    assert found.columns == ["k", "ls", "le", "t", "last"] and found.count() == want.count() > 200
    assert sorted(map(repr, found.collect())) == sorted(map(repr, want.collect()))


def test_a_unique_key_shares_the_entries_of_its_agreement(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 1, "b"), (2, 1, "a"), (2, 1, "a"), (3, 1, "a"), (None, 1, "a"), (None, 1, "b")], "x int, y int, v string")
    rules = [con.Unique(("x", "y")), con.Agree("v", ("x", "y"), ("v",)), con.Unique(("x",)), con.Agree("late", ("x",), ("y",)),
             con.check("low", F.col("x") < 3)]
    found = con.violations(df, ["x", "y"], rules)
    assert sorted((r.constraint_name, r.key_text, r.n_rows) for r in found.collect()) == [
        ("check:low", "3|1", 1), ("consistent:v", "1|1", 2), ("unique:x", "1", 2), ("unique:x", "2", 2), ("unique:x,y", "1|1", 2), ("unique:x,y", "2|1", 2)]
    assert "lambda" not in found._jdf.queryExecution().optimizedPlan().toString()


def test_persons_join_once_per_child_and_guardian(spark, shuffled):
    persons = spark.createDataFrame([("c", "Cee"), ("g", "Gee")], "id string, first_name string").select(
        "*", *(F.lit(None).cast("string").alias(x) for x in ("last_name", "social_security_number", "street_address", "postal_code", "post_office", "language", "phone", "email")),
        F.lit(None).cast("date").alias("date_of_birth"), F.lit(None).cast("array<string>").alias("nationalities"))
    apps = spark.createDataFrame([(f"a{n}", DAY, DAY, "g", "c", False, "S", "CLUB") for n in range(50)],
                                 "id string, sentdate date, duedate date, guardian_id string, child_id string, transferapplication boolean, status string, type string")
    form = apps.select(F.col("id").alias("application_id"), F.lit(1).alias("legacy_priority"), F.lit("u").alias("unit_id"),
                       F.lit(None).cast("string").alias("service_need_option_id"), F.lit(DAY).alias("preferred_start_date"))
    forms = transfer.applications({"mig_application": apps, "mig_application_form": form, "mig_person": persons,
                                   **inputs.empty(spark, "service_need_option")})["application_form"]
    assert forms.count() == 50 and forms.where("document like '%Cee%' and document like '%Gee%'").count() == 50
    plan = forms._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[(_c|child_id)#\d+, (_g|guardian_id)#", plan)  # the pairs, before any person joins
