"""A5: the journals of an absence come in lists of bounded length."""

from pyspark.sql import functions as F

from registrar.plans.transform import daily_journals
from registrar.plans.transform.journals import JOURNAL_CHUNK
from registrar.sources import inputs


def test_lists_do_not_grow_with_unknown_children(spark):
    days = [F.lit(169 if d == 1 else 0).alias(f"reportcode{d:02d}") for d in range(1, 32)]
    rows = spark.range(3000).select(F.col("id").cast("int").alias("dailyjournalid"),
                                    F.when(F.col("id") % 100 == 7, "known").otherwise(F.concat(F.lit("nobody"), F.col("id"))).alias("personid"),
                                    *days)
    rows = rows.unionByName(rows.where(F.col("dailyjournalid") < 50))  # repeated rows
    journals = spark.range(3000).select(F.col("id").cast("int").alias("dailyjournalid"), F.lit(1).alias("unit"),
                                        F.lit(None).cast("int").alias("department"), F.lit(None).cast("string").alias("childminder"),
                                        F.lit("202103").alias("period"))
    person = spark.createDataFrame([("c1", "known")], "id string, legacy_ssn string")
    placement = spark.createDataFrame([("c1", "DAYCARE")], "child_id string, type string").select(
        "*", F.lit("2021-01-01").cast("date").alias("start_date"), F.lit(None).cast("date").alias("end_date"))
    out = daily_journals({"dailyjournals": journals, "dailyjournalrows": rows, "mig_person": person, "mig_placement": placement,
                          **inputs.empty(spark, "unitmap", "childmindermap", "mig_daycare_group")})
    clean, todo = out["mig_absence"].collect(), out["mig_absence_todo"].collect()
    assert [(r.child_id, r.legacy_dailyjournalids) for r in clean] == [("c1", list(range(7, 3000, 100)))]
    missing = [r for r in todo if r.reason == "CHILD MISSING"]
    assert len(missing) == 1 and missing[0].legacy_dailyjournalids is None and missing[0].absence_type == "SICKLEAVE"
    lists = out["mig_absence_journal"].orderBy("absence_id", "chunk").collect()
    assert max(len(r.journal_ids) for r in lists) <= JOURNAL_CHUNK
    of = {}
    for r in lists:
        assert all(i // JOURNAL_CHUNK == r.chunk for i in r.journal_ids)
        of.setdefault(r.absence_id, []).extend(r.journal_ids)
    assert of[clean[0].id] == clean[0].legacy_dailyjournalids
    assert of[missing[0].id] == [i for i in range(3000) if i % 100 != 7]
