"""D6 daycare groups, D7 placements, D8 service needs, D10 applications,
D15 cleanup of unused groups."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ...functions import codes
from ...functions import dictionaries as dic
from ...functions import domain as dom
from ...operators import dedupe
from ...operators import constraints as con
from ...operators import identity as ident
from ...operators import intervals as iv
from ...operators import quality as q
from ...sinks.publish import delete_by_keys
from ._common import (Tables, extent_option, filtered, get, id_map, id_map_update, materialize, person_lookup, split,
                      unique_dim, unit_lookup)

SERVICE_NEED_OPTION_SCHEMA = "id string, name_fi string, valid_placement_type string, fee_coefficient decimal(10,4)"


def departments(t: Tables) -> dict[str, DataFrame]:
    """Departments of mapped units -> daycare groups (start <= end checked)."""
    d = get(t, "departments")
    um = unique_dim(get(t, "unitmap"), "effica_id", "evaka_id", "daycare_id").withColumnRenamed("effica_id", "_uk")
    j = d.join(um, d["unitcode"] == um["_uk"], "inner")
    g = j.select(ident.hash_uuid("DAYCARE_GROUP", "unitcode", "departmentcode", "startdate").alias("id"),
                 "daycare_id", F.col("departmentcode").alias("legacy_id"), F.col("departmentname").alias("name"),
                 F.col("startdate").alias("start_date"), F.col("enddate").alias("end_date"))
    flagged = q.flag(g, [("START AFTER END", F.col("start_date") > F.col("end_date")),
                         ("NAME MISSING", F.col("name").isNull())])
    clean, todo = split(flagged, ["id"])
    violations = con.violations(clean, ["id"], [
        *con.not_null("daycare_id", "legacy_id", "name", "start_date"),
        con.check("start_before_end", F.col("start_date") <= F.col("end_date"))])
    return {"mig_daycare_group": clean, "mig_daycare_group_todo": todo, "mig_daycare_group_violations": violations}


def placements(t: Tables) -> dict[str, DataFrame]:
    """Placements with type from their extents (default DAYCARE), child,
    unit (unit map or child-minder map) and group; open ends closed by the
    next placement of the child, then by the type's default end; quarantine."""
    p = filtered(t, "placements")
    ext = get(t, "placementextents").select("placementnbr", "extentcode", "days")
    ext = extent_option(ext, t, "extentcode", "days", "_opt")
    sno = get(t, "service_need_option", SERVICE_NEED_OPTION_SCHEMA).select(F.col("id").alias("_opt"),
                                                                          "valid_placement_type")
    types = (ext.join(sno, "_opt").groupBy(F.col("placementnbr").alias("_tp"))
             .agg(F.min("valid_placement_type").alias("_type")))
    p = p.join(types, p["placementnbr"] == types["_tp"], "left")
    p = person_lookup(p, get(t, "mig_person"), "personid", {"id": "child_id"})
    p = unit_lookup(p, t, "placementunitcode", "placementchildminder", "unit_id")
    groups = unique_dim(get(t, "mig_daycare_group", "id string, legacy_id int"), "legacy_id", "id",
                        "daycare_group_id").withColumnRenamed("legacy_id", "_gk")
    p = p.join(groups, p["placementdepartmentcode"] == groups["_gk"], "left")
    rows = p.select(ident.hash_uuid("PLACEMENT", "placementnbr").alias("id"),
                    F.col("placementnbr").alias("legacy_placement_nbr"), F.col("personid").alias("legacy_ssn"),
                    F.coalesce("_type", F.lit("DAYCARE")).alias("type"), "child_id", "unit_id",
                    F.col("startdate").alias("start_date"), F.col("enddate").alias("end_date"), "daycare_group_id")
    rows = iv.close_open_ends(rows, ["legacy_ssn"], "start_date", "end_date")
    preschool = F.col("type") == "PRESCHOOL_DAYCARE"
    default_end = F.when(preschool, dom.preschool_end_date("start_date")).otherwise(
        dom.daycare_end_date("legacy_ssn", "start_date"))
    rows = rows.withColumn("_was_open", F.col("end_date").isNull())
    rows = rows.withColumn("end_date", F.coalesce("end_date", default_end))
    rows = iv.conflicts(materialize(rows), ["legacy_ssn"], "start_date", "end_date",
                        valid=iv.valid_interval("start_date", "end_date", allow_open=False))
    flagged = q.flag(rows, [
        ("PERSON MISSING", F.col("child_id").isNull()),
        ("UNIT MISSING", F.col("unit_id").isNull()),
        ("OVERLAPPING PLACEMENT", F.col("overlapping")),
        ("UNSUPPORTED PRESCHOOL START", F.col("_was_open") & preschool & ~dom.preschool_supported("start_date")),
        ("INVALID IDENTITY CODE", F.col("_was_open") & ~preschool & ~dom.birth_code_sign_valid("legacy_ssn")),
    ]).drop("overlapping", "_was_open")
    clean, todo = split(flagged, ["id"])
    violations = con.violations(clean, ["id"], [
        con.Unique(("legacy_placement_nbr",)), *con.not_null("legacy_placement_nbr", "legacy_ssn", "type", "start_date"),
        con.ForeignKey(("child_id",), get(t, "mig_person"), ("id",))])
    return {"mig_placement": clean, "mig_placement_todo": todo, "mig_placement_violations": violations}


def service_needs(t: Tables) -> dict[str, DataFrame]:
    """Extents of migrated placements -> service needs; duplicates (same
    placement, start, end, code) keep the smallest extent number."""
    pe = get(t, "placementextents")
    pl = get(t, "mig_placement").select(F.col("legacy_placement_nbr").alias("_pn"), F.col("id").alias("placement_id"),
                                          F.col("end_date").alias("_pend"))
    j = pe.join(pl, pe["placementnbr"] == pl["_pn"], "inner")
    j = extent_option(j, t, "extentcode", "days", "option_id")
    rows = j.select(F.col("placementnbr").alias("legacy_placement_nbr"), F.col("extentnbr").alias("legacy_extent_nbr"),
                    F.col("extentcode").cast("string").alias("legacy_extent_code"), "option_id", "placement_id",
                    F.col("startdate").alias("start_date"), F.coalesce("enddate", "_pend").alias("end_date"))
    rows = dedupe.keep_first(rows, ["legacy_placement_nbr", "start_date", "end_date", "legacy_extent_code"],
                             ["legacy_extent_nbr"])
    rows = rows.withColumn("id", ident.hash_uuid("SERVICE_NEED", "legacy_placement_nbr", "legacy_extent_nbr"))
    rows = iv.conflicts(materialize(rows), ["legacy_placement_nbr"], "start_date", "end_date",
                        valid=iv.valid_interval("start_date", "end_date", allow_open=False))
    flagged = q.flag(rows, [("OPTION MISSING", F.col("option_id").isNull()),
                            ("START AFTER END", F.col("start_date") > F.col("end_date")),
                            ("OVERLAPPING SERVICE NEED", F.col("overlapping"))]).drop("overlapping")
    clean, todo = split(flagged, ["id"])
    return {"mig_service_need": clean, "mig_service_need_todo": todo}


def applications(t: Tables) -> dict[str, DataFrame]:
    """Applications (+ guardian from the child's family on the sent date)
    and their preferred units; due date repaired from the first preference."""
    a = get(t, "applications").filter(
        codes.tristate_keep("applicationtype", dic.APPLICATION_TYPE, key_type="int")
        & codes.only_mapped("status", dic.APPLICATION_STATUS, key_type="int"))
    handling = unique_dim(get(t, "codes").withColumn("_days", F.col("extrainfo1").try_cast("int")), "code", "_days")
    a = a.join(handling.withColumnRenamed("code", "_hc"), a["specialhandlingtime"].cast("int") == F.col("_hc"), "left")
    a = person_lookup(a, get(t, "mig_person"), "personid", {"id": "child_id"})
    links = get(t, "mig_fridge_child").select(F.col("child_id").alias("_cid"), "head_of_family",
                                                F.col("start_date").alias("_fs"), F.col("end_date").alias("_fe"))
    a = a.withColumn("_cid", F.col("child_id"))
    a = iv.point_in_interval_join(materialize(a), links, ["_cid"], "applicationdate", ("_fs", "_fe"), how="left", bin_days=365)
    a = a.withColumnRenamed("head_of_family", "guardian_id")
    # an application has one id per guardian; an entry of the bare guid stands for the smallest guardian
    first = F.min("guardian_id").over(Window.partitionBy("guid", "careid"))
    a = a.withColumn("_source", F.when(F.col("guid").isNotNull(), F.concat_ws("/", "guid", "guardian_id")))
    a = a.withColumn("_bare", F.when(F.col("guardian_id").eqNullSafe(first), F.col("guid")))
    prev = id_map(t).filter(F.col("type") == "APPLICATION").select("source_id", "target_id")
    mapped = (a.join(prev.toDF("_source", "_mapped_id"), "_source", "left")
              .join(prev.toDF("_bare", "_mapped_bare"), "_bare", "left"))
    app = mapped.select(
        "_source", F.coalesce("_mapped_id", "_mapped_bare", ident.hash_uuid("APPLICATION", "guid", "guardian_id")).alias("id"),
        F.col("guid").alias("legacy_guid"), F.col("careid").alias("legacy_id"),
        codes.map_code("applicationtype", dic.APPLICATION_TYPE, key_type="int").alias("type"),
        F.col("applicationdate").alias("sentdate"),
        F.when(F.col("_days").isNotNull(), F.date_add("applicationdate", F.col("_days"))).alias("duedate"),
        "guardian_id", "child_id", "transferapplication",
        codes.map_code("status", dic.APPLICATION_STATUS, key_type="int").alias("status"))
    idmap = id_map_update(t, "APPLICATION", app, "_source", "id")
    flagged = q.flag(app.drop("_source"), [("GUARDIAN MISSING", F.col("guardian_id").isNull()),
                           ("CHILD MISSING", F.col("child_id").isNull()),
                           ("TYPE MISSING", F.col("type").isNull())])
    app_clean, app_todo = split(flagged, ["id"], unique=False)

    r = get(t, "applicationrows")
    r = r.join(app_clean.select(F.col("legacy_id").alias("_eid"), F.col("id").alias("application_id")),
               r["careid"] == F.col("_eid"), "inner")
    r = unit_lookup(r, t, "unitcode", "childminder", "unit_id")
    r = extent_option(r, t, "extent", "days", "service_need_option_id")
    form = r.select(F.col("careid").alias("legacy_application_id"), F.col("priority").alias("legacy_priority"),
                    "application_id", "unit_id", "service_need_option_id",
                    F.col("startdate").alias("preferred_start_date"))
    fflag = q.flag(form, [("UNIT MISSING", F.col("unit_id").isNull())])
    form_clean, form_todo = split(fflag, ["legacy_application_id", "legacy_priority"], unique=False)

    first = (form_clean.filter(F.col("legacy_priority") == 1)
             .groupBy(F.col("application_id").alias("_aid")).agg(F.min("preferred_start_date").alias("_pref")))
    app_clean = app_clean.join(first, app_clean["id"] == first["_aid"], "left")
    app_clean = app_clean.withColumn(
        "duedate", F.when(F.col("duedate").isNull() & F.col("_pref").isNotNull(),
                          F.greatest(F.date_add("sentdate", 120), F.col("_pref"))).otherwise(F.col("duedate"))
    ).drop("_aid", "_pref")
    # Q2: allowed application types of the target
    violations = con.violations(app_clean, ["id"], [con.values("type", ["CLUB", "DAYCARE", "PRESCHOOL"])])
    return {"mig_application": app_clean, "mig_application_todo": app_todo, "mig_application_violations": violations,
            "mig_application_form": form_clean, "mig_application_form_todo": form_todo, "idmap": idmap}


def cleanup(t: Tables) -> dict[str, DataFrame]:
    """Drop daycare groups used by no placement and no backup care."""
    groups = get(t, "mig_daycare_group")
    used = (get(t, "mig_placement", "daycare_group_id string").select(F.col("daycare_group_id").alias("id"))
            .union(get(t, "mig_backup_care", "group_id string").select(F.col("group_id").alias("id")))
            .filter(F.col("id").isNotNull()).distinct())
    unused = groups.select("id").join(used, "id", "left_anti")
    return {"mig_daycare_group": delete_by_keys(groups, unused, ["id"]),
            "mig_daycare_group_removed": groups.join(unused, "id", "left_semi")}
