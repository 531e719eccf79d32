"""D13 daily journals (absences, backup care) and D14 attendance times."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import codes
from ...functions import dictionaries as dic
from ...functions.dates import at_time, local_to_utc, period_day
from ...operators import identity as ident
from ...operators import intervals as iv
from ...operators import quality as q
from ...operators import rows as R
from ._common import Tables, get, materialize, person_lookup, spark_of, split, together, unique_dim, unit_lookup

# Care types per placement type (absences are recorded per care type).
CARE_TYPES = {
    "CLUB": ["CLUB"], "SCHOOL_SHIFT_CARE": ["SCHOOL_SHIFT_CARE"], "PRESCHOOL": ["PRESCHOOL"],
    "PREPARATORY": ["PRESCHOOL"], "PRESCHOOL_DAYCARE": ["PRESCHOOL_DAYCARE"],
    "PREPARATORY_DAYCARE": ["PRESCHOOL_DAYCARE"], "DAYCARE": ["DAYCARE"], "DAYCARE_PART_TIME": ["DAYCARE"],
    "DAYCARE_FIVE_YEAR_OLDS": ["DAYCARE"], "DAYCARE_PART_TIME_FIVE_YEAR_OLDS": ["DAYCARE"],
    "TEMPORARY_DAYCARE": ["DAYCARE"], "TEMPORARY_DAYCARE_PART_DAY": ["DAYCARE"],
}
UNKNOWN_CARE_TYPE = "UNKNOWN"
#: A list of journal ids holds the ids of one range of this many numbers, so
#: no list grows with the rows that name no known child.
JOURNAL_CHUNK = 1024


def journal_days(t: Tables) -> DataFrame:
    """One row per (journal row, day of month) with a non-zero report code."""
    rows = get(t, "dailyjournalrows")
    day_cols = [f"reportcode{d:02d}" for d in range(1, 32)]
    u = R.unpivot(rows, ["dailyjournalid", "personid"], day_cols, "day_of_month", "reportcode",
                  names=[f"{d:02d}" for d in range(1, 32)])
    j = get(t, "dailyjournals").select("dailyjournalid", "unit", "department", "childminder", "period")
    v = u.filter(F.col("reportcode") != 0).join(j, "dailyjournalid")
    return v.select("dailyjournalid", "unit", "department", "childminder", "personid",
                    period_day("period", "day_of_month").alias("date"), "reportcode")


def daily_journals(t: Tables) -> dict[str, DataFrame]:
    """Absences and backup care from the journal rows. The journals of an
    absence (A5) are rows of ``mig_absence_journal``: (absence_id, chunk, ids),
    ascending; chunk ``n`` has the ids from ``n * JOURNAL_CHUNK``. Absences of
    known children carry the whole list too, which the journals of one child
    and day bound; those of unknown children have NULL there."""
    days = journal_days(t)
    person = get(t, "mig_person")
    return together(spark_of(t), lambda: _absences(t, days, person), lambda: _backup_care(t, days, person))


def _absences(t: Tables, days: DataFrame, person: DataFrame) -> dict[str, DataFrame]:
    a = days.filter(codes.tristate_keep("reportcode", dic.REPORT_CODE_ABSENCE, key_type="int"))
    a = person_lookup(a, person, "personid", {"id": "child_id"})
    pl = get(t, "mig_placement").select(F.col("child_id").alias("_pc"), F.col("type").alias("_ptype"),
                                          F.col("start_date").alias("_ps"), F.col("end_date").alias("_pe"))
    a = materialize(a.withColumn("_pc", F.col("child_id")))
    a = iv.point_in_interval_join(a.filter(F.col("date").isNotNull()), pl, ["_pc"], "date", ("_ps", "_pe"),
                                  how="left", bin_days=90).unionByName(
        a.filter(F.col("date").isNull()).withColumn("_ptype", F.lit(None).cast("string"))
         .withColumn("_ps", F.lit(None).cast("date")).withColumn("_pe", F.lit(None).cast("date")))
    a = R.explode_case(a, "_ptype", CARE_TYPES, "care_type", default=[UNKNOWN_CARE_TYPE])
    a = a.withColumn("absence_type", codes.map_code("reportcode", dic.REPORT_CODE_ABSENCE, key_type="int"))
    chunk = F.floor(F.col("dailyjournalid") / JOURNAL_CHUNK).alias("chunk")
    lists = materialize(a.groupBy("child_id", "date", "care_type", chunk).agg(
        F.array_sort(F.collect_set("dailyjournalid")).alias("journal_ids"),
        F.min(F.struct("dailyjournalid", "reportcode", "absence_type")).alias("_first")))
    absence_id = ident.hash_uuid("ABSENCE", "child_id", "date", "care_type")
    links = lists.where(F.col("chunk").isNotNull()).select(absence_id.alias("absence_id"), "chunk", "journal_ids")
    known = F.when(F.col("child_id").isNotNull(), F.struct("chunk", "journal_ids"))
    ab = lists.groupBy("child_id", "date", "care_type").agg(
        F.collect_list(known).alias("_lists"), F.min("_first").alias("_first")).select(
        absence_id.alias("id"),
        F.when(F.col("child_id").isNotNull(), F.flatten(F.transform(F.array_sort("_lists"), lambda x: x["journal_ids"])))
        .alias("legacy_dailyjournalids"), "child_id", "date", "care_type", F.col("_first.absence_type").alias("absence_type"))
    aflag = q.flag(ab, [("CHILD MISSING", F.col("child_id").isNull()),
                        ("PLACEMENT MISSING", F.col("care_type") == UNKNOWN_CARE_TYPE),
                        ("TYPE MISSING", F.col("absence_type").isNull()),
                        ("INVALID DATE", F.col("date").isNull())])
    ab_clean, ab_todo = split(aflag, ["id"], unique=False)
    return {"mig_absence": ab_clean, "mig_absence_todo": ab_todo, "mig_absence_journal": links}


def _backup_care(t: Tables, days: DataFrame, person: DataFrame) -> dict[str, DataFrame]:
    # consecutive days per (child, unit, group) collapse to one period
    b = days.filter(codes.in_list("reportcode", dic.BACKUP_CARE_CODES) & F.col("date").isNotNull())
    b = person_lookup(b, person, "personid", {"id": "child_id"})
    b = unit_lookup(b, t, "unit", "childminder", "unit_id")
    groups = unique_dim(get(t, "mig_daycare_group", "id string, legacy_id int"), "legacy_id", "id",
                        "group_id").withColumnRenamed("legacy_id", "_gk")
    b = b.join(groups, b["department"] == groups["_gk"], "left")
    isl = iv.islands(b, ["child_id", "unit_id", "group_id"], "date")
    bc = isl.select(ident.hash_uuid("BACKUP_CARE", "child_id", "unit_id", "group_id", "start_date").alias("id"),
                    "child_id", "unit_id", "group_id", "start_date", "end_date")
    bc = iv.conflicts(materialize(bc), ["child_id"], "start_date", "end_date", valid=F.lit(True))
    bflag = q.flag(bc, [("CHILD MISSING", F.col("child_id").isNull()),
                        ("UNIT MISSING", F.col("unit_id").isNull()),
                        ("OVERLAPPING BACKUP CARE", F.col("overlapping"))]).drop("overlapping")
    bc_clean, bc_todo = split(bflag, ["id"], unique=False)
    return {"mig_backup_care": bc_clean, "mig_backup_care_todo": bc_todo}


def timestamps(t: Tables) -> dict[str, DataFrame]:
    """Three in/out slots per day -> attendances (local time -> UTC)."""
    d = get(t, "timestampdetails")
    z = R.zip_unpivot(d, ["rownumber", "day"], {"starttime": ["starttime1", "starttime2", "starttime3"],
                                                 "endtime": ["endtime1", "endtime2", "endtime3"]})
    z = z.filter(F.col("starttime").isNotNull() | F.col("endtime").isNotNull())
    h = get(t, "timestampheaders").filter(F.col("rowtype") == "R").select(
        F.col("rownumber").alias("_hr"), "unit", "childminder", "personid", "period")
    v = z.join(h, z["rownumber"] == h["_hr"])
    v = v.withColumn("date", period_day("period", "day"))
    v = person_lookup(v, get(t, "mig_person"), "personid", {"id": "child_id"})
    v = unit_lookup(v, t, "unit", "childminder", "unit_id")
    att = v.select(ident.hash_uuid("ATTENDANCE", "rownumber", "day", "slot").alias("id"),
                   F.col("rownumber").alias("legacy_rownumber"), "child_id",
                   local_to_utc(at_time("date", "starttime")).alias("arrived"),
                   local_to_utc(at_time("date", "endtime")).alias("departed"), "unit_id")
    flagged = q.flag(att, [("PERSON MISSING", F.col("child_id").isNull()),
                           ("TIME MISSING", F.col("arrived").isNull() | F.col("departed").isNull()),
                           ("UNIT MISSING", F.col("unit_id").isNull())])
    clean, todo = split(flagged, ["id"])
    return {"mig_child_attendance": clean, "mig_child_attendance_todo": todo}
