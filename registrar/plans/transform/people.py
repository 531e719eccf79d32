"""D1 persons and D2 families."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import domain as dom
from ...operators import constraints as con
from ...operators import identity as ident
from ...operators import intervals as iv
from ...operators import quality as q
from ...sinks.publish import insert_ignore_rows
from ._common import Tables, filtered, get, id_map_update, materialize, person_lookup, spark_of, split, together, with_ids

# Fixed values of the target schema: the source-system marker of a person
# row (a CHECK constraint of the target) and the guid prefix given to
# persons that already exist in the target.
SOURCE_LEGACY = "effica"
SOURCE_TARGET = "evaka"
TARGET_GUID_PREFIX = "evaka-"

# Family validity periods run for months to years (a child link to the 18th
# birthday): year-wide bins keep the copies per period few.
LONG_PERIOD_BIN_DAYS = 365

PERSON_SCHEMA = ("id string, legacy_guid string, social_security_number string, last_name string, "
                 "first_name string, email string, language string, street_address string, postal_code string, "
                 "post_office string, nationalities array<string>, restricted_details_enabled boolean, "
                 "phone string, backup_phone string, legacy_ssn string, date_of_birth date, source_system string")

EXISTING_PERSON_SCHEMA = ("id string, social_security_number string, last_name string, first_name string, "
                          "email string, language string, street_address string, postal_code string, "
                          "post_office string, nationalities array<string>, restricted_details_enabled boolean, "
                          "phone string, backup_phone string, date_of_birth date")


def persons(t: Tables) -> dict[str, DataFrame]:
    """Staged persons -> ``mig_person`` (+ existing target persons, which
    win on the identity number), ``mig_person_todo``, updated ``idmap``."""
    p = get(t, "persons")
    codes = get(t, "codes")
    lang = (codes.filter(F.col("codetype") == "SPRAK").filter(F.col("code").isNotNull())
            .groupBy("code").agg(F.min("extrainfo1").alias("language")))
    src = with_ids(p, t, "PERSON", "guid", "id")
    src = src.join(lang, src["mothertongue"] == lang["code"], "left")
    phone, backup = dom.contact_choice("personmobilephone", "phonework", "phonehome")
    secret = F.col("secretaddress")
    rows = src.select(
        "id", F.col("guid").alias("legacy_guid"),
        dom.official_id("personid").alias("social_security_number"),
        dom.name_part("personname", 1).alias("last_name"),
        dom.name_part("personname", 2).alias("first_name"),
        F.col("personhomeemail").alias("email"), "language",
        dom.masked("personstreetaddress", secret).alias("street_address"),
        dom.masked("personzipcode", secret).alias("postal_code"),
        dom.masked("personcity", secret).alias("post_office"),
        F.array().cast("array<string>").alias("nationalities"),
        secret.alias("restricted_details_enabled"),
        phone.alias("phone"), backup.alias("backup_phone"),
        F.col("personid").alias("legacy_ssn"),
        dom.birth_date_from_code("personid").alias("date_of_birth"),
        F.lit(SOURCE_LEGACY).alias("source_system"))
    flagged = q.flag(rows, [("INVALID BIRTH DATE", F.col("date_of_birth").isNull())])
    ok, todo = split(flagged, ["id"])

    existing = get(t, "person", EXISTING_PERSON_SCHEMA)
    from_target = existing.select(
        "id", F.concat(F.lit(TARGET_GUID_PREFIX), F.col("id")).alias("legacy_guid"), "social_security_number",
        "last_name", "first_name", "email", "language", "street_address", "postal_code", "post_office",
        "nationalities", "restricted_details_enabled", "phone", "backup_phone",
        F.col("social_security_number").alias("legacy_ssn"), "date_of_birth", F.lit(SOURCE_TARGET).alias("source_system"))
    inserted = insert_ignore_rows(from_target, ok, ["social_security_number"], ["legacy_guid"])
    person = from_target.unionByName(inserted.select(*from_target.columns))
    mapped = p.select("guid").join(person.select(F.col("legacy_guid").alias("guid"), "id"), "guid")
    # Q2: constraints of the target table as explicit checks
    violations = con.violations(person, ["id"], [
        con.Unique(("id",)), con.Unique(("social_security_number",)), *con.not_null("id"),
        con.values("source_system", [SOURCE_LEGACY, SOURCE_TARGET])])
    return {"mig_person": person, "mig_person_todo": todo, "mig_person_violations": violations,
            "idmap": id_map_update(t, "PERSON", mapped, "guid", "id")}


def families(t: Tables) -> dict[str, DataFrame]:
    """Family rows -> child links and partnerships, with quarantine.

    Child links: heads ('R') x children ('B') of the same family whose
    intervals intersect; a child's open end is the day before the 18th
    birthday. Partnerships: heads x partners ('S'), one row per member with
    index 1 (head) and 2 (partner). Conflicts: a child in two overlapping
    links; a person in overlapping partnerships with different indices."""
    f = filtered(t, "families")
    person = get(t, "mig_person")
    return together(spark_of(t), lambda: _child_links(f, person), lambda: _partnerships(f, person))


def _child_links(f: DataFrame, person: DataFrame) -> dict[str, DataFrame]:
    pcols = {"id": "person_id", "date_of_birth": "dob"}
    hofs = person_lookup(f.filter(F.col("roleinfamily") == "R"), person, "personid", pcols)
    hofs = hofs.filter(F.col("person_id").isNotNull()).select(
        F.col("personid").alias("hof_ssn"), F.col("person_id").alias("head_of_family"),
        F.col("familynbr").alias("family_number"), F.col("startdate").alias("h_start"),
        F.col("enddate").alias("h_end"))
    kids = person_lookup(f.filter(F.col("roleinfamily") == "B"), person, "personid", pcols)
    kids = kids.filter(F.col("person_id").isNotNull()).select(
        F.col("personid").alias("child_ssn"), F.col("person_id").alias("child_id"),
        F.col("familynbr").alias("family_number"), F.col("startdate").alias("c_start"),
        F.coalesce(F.col("enddate"), F.date_sub(F.add_months(F.col("dob"), 216), 1)).alias("c_end"))
    links = iv.overlap_join(hofs, kids, ["family_number"], ("h_start", "h_end"), ("c_start", "c_end"), bin_days=LONG_PERIOD_BIN_DAYS)
    child = links.select(
        ident.hash_uuid("FRIDGE_CHILD", "family_number", "hof_ssn", "child_ssn", "overlap_start",
                        "overlap_end").alias("id"),
        "child_id", "child_ssn", "head_of_family", "hof_ssn", "family_number",
        F.col("overlap_start").alias("start_date"), F.col("overlap_end").alias("end_date"))
    child = iv.conflicts(materialize(child), ["child_id"], "start_date", "end_date",
                         valid=iv.valid_interval("start_date", "end_date", allow_open=False))
    child_flag = q.flag(child, [("OVERLAPPING", F.col("overlapping")),
                                ("START AFTER END", F.col("start_date") > F.col("end_date"))]).drop("overlapping")
    child_clean, child_todo = split(child_flag, ["id"])
    return {"mig_fridge_child": child_clean, "mig_fridge_child_todo": child_todo}


def _partnerships(f: DataFrame, person: DataFrame) -> dict[str, DataFrame]:
    heads = f.filter(F.col("roleinfamily") == "R").select(
        F.col("personid").alias("hof_ssn"), F.col("familynbr").alias("family_number"),
        F.col("startdate").alias("h_start"), F.col("enddate").alias("h_end"))
    partners = f.filter(F.col("roleinfamily") == "S").select(
        F.col("personid").alias("partner_ssn"), F.col("familynbr").alias("family_number"),
        F.col("startdate").alias("p_start"), F.col("enddate").alias("p_end"))
    ps = iv.overlap_join(heads, partners, ["family_number"], ("h_start", "h_end"), ("p_start", "p_end"), bin_days=LONG_PERIOD_BIN_DAYS)
    ps = ps.withColumn("partnership_id", ident.hash_uuid("PARTNERSHIP", "family_number", "hof_ssn", "partner_ssn",
                                                         "overlap_start", "overlap_end"))
    members = (ps.select("partnership_id", "family_number", "overlap_start", "overlap_end",
                         F.col("hof_ssn").alias("legacy_ssn"), F.lit(1).alias("indx"))
               .unionByName(ps.select("partnership_id", "family_number", "overlap_start", "overlap_end",
                                      F.col("partner_ssn").alias("legacy_ssn"), F.lit(2).alias("indx"))))
    members = person_lookup(members, person, "legacy_ssn", {"id": "person_id"}).filter(F.col("person_id").isNotNull())
    partner = members.select("partnership_id", "person_id", "legacy_ssn", "indx", "family_number",
                             F.col("overlap_start").alias("start_date"),
                             F.col("overlap_end").alias("end_date")).distinct()
    partner = iv.conflicts(materialize(partner), ["person_id"], "start_date", "end_date", role="indx", roles=[1, 2],
                           identity="partnership_id", valid=(F.col("end_date") >= F.col("start_date")) | F.col("end_date").isNull())
    partner_flag = q.flag(partner, [("OVERLAPPING", F.col("overlapping")),
                                    ("START AFTER END", F.col("start_date") > F.col("end_date"))]).drop("overlapping")
    partner_clean, partner_todo = split(partner_flag, ["partnership_id", "indx"])
    # Q2: both members of a partnership share its dates, and are two persons
    violations = con.violations(partner_clean, ["partnership_id", "indx"], [
        con.Unique(("partnership_id", "indx")), con.Unique(("partnership_id", "person_id")),
        *con.not_null("person_id", "legacy_ssn", "start_date"),
        con.Agree("partnership_dates", ("partnership_id",), ("start_date", "end_date"))])
    return {"mig_fridge_partner": partner_clean, "mig_fridge_partner_todo": partner_todo,
            "mig_fridge_partner_violations": violations}
