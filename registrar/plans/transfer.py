"""Transfer jobs (X1-X17): reconciled tables -> rows for the target tables.

Each job returns the rows to publish per target table as lazy DataFrames;
``publish_all`` publishes them (K3) in chain order, all or nothing. Conflict rules of the
target (``ON CONFLICT DO NOTHING``) are applied here as insert-ignore
against the target's current rows (K4), so publishing twice adds nothing.
Enum casts of the target become allowed-value checks (``*_violations``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.documents import json_of
from ..operators import constraints as con
from ..operators import identity as ident
from ..operators import intervals as iv
from ..sources import inputs
from ..sinks.publish import Manifest, insert_ignore_rows, update_from
from .transform._common import Tables, get, spark_of

# Fixed values of the target system.
REGISTRY_UPDATED_AT = "2021-05-01 00:00:00"      # identity registry refresh marker
AUDIT_USER_NAME = "Effica"                         # batch audit user (I3)
USER_TABLE = "evaka_user"                          # target table of users
UNIT_MANAGER_FILE = "evaka_unit_manager"           # mapping file of unit managers
DAYCARE_FILE = "evaka_daycare"                     # mapping file of units
CARETAKERS_PER_GROUP = 3
SYNTHESISED_GROUP_NAME = "Ryhmä"
APPLICATION_ORIGIN = "ELECTRONIC"
DEFAULT_NATIONALITY = "FI"
DEFAULT_LANGUAGE = "fi"
VARDA_BACKDATE_YEARS = 20

CARE_TYPES = ["CLUB", "FAMILY", "CENTRE", "PRESCHOOL", "PREPARATORY_EDUCATION", "GROUP_FAMILY"]
PROVIDER_TYPES = ["MUNICIPAL", "PURCHASED", "PRIVATE", "MUNICIPAL_SCHOOL", "PRIVATE_SERVICE_VOUCHER"]
UNIT_LANGUAGES = ["fi", "sv"]

FEE_THRESHOLDS_SCHEMA = (
    "id string, valid_during struct<lower:date,upper:date>, "
    + ", ".join(f"min_income_threshold_{n} long, max_income_threshold_{n} long, income_multiplier_{n} decimal(5,4)"
                for n in range(2, 7))
    + ", income_threshold_increase_6_plus long, min_fee int, max_fee int")
VOUCHER_VALUE_SCHEMA = "id string, validity struct<lower:date,upper:date>, base_value int, age_under_three_coefficient decimal(3,2)"
SERVICE_NEED_OPTION_SCHEMA = (
    "id string, name_fi string, name_sv string, name_en string, valid_placement_type string, "
    "fee_coefficient decimal(4,2), fee_description_fi string, fee_description_sv string, "
    "voucher_value_coefficient decimal(4,2), voucher_value_description_fi string, voucher_value_description_sv string")
OPTION_SCHEMA = "id string, value string"


AUDIT_USER_TYPE = "UNKNOWN"
USER_SCHEMA = "id string, type string, name string"


def audit_user_id(t: Tables | None = None) -> Column:
    """The batch audit user: the existing user of that name and type if the
    target has one (scalar subquery), else the deterministic id."""
    fixed = ident.constant_id("EMPLOYEE", AUDIT_USER_NAME)
    if t is None or USER_TABLE not in t:
        return fixed
    existing = (t[USER_TABLE].filter((F.col("type") == AUDIT_USER_TYPE) & (F.col("name") == AUDIT_USER_NAME))
                .agg(F.min("id")))
    return F.coalesce(existing.scalar(), fixed)


def audit_user(t: Tables) -> dict[str, DataFrame]:
    """Create the audit user once (nothing when it already exists)."""
    spark = spark_of(t)
    existing = get(t, USER_TABLE, USER_SCHEMA)
    row = spark.range(1).select(audit_user_id().alias("id"), F.lit(AUDIT_USER_TYPE).alias("type"),
                                F.lit(AUDIT_USER_NAME).alias("name"))
    have = existing.filter((F.col("type") == AUDIT_USER_TYPE) & (F.col("name") == AUDIT_USER_NAME)).select("type", "name")
    return {USER_TABLE: row.join(have, ["type", "name"], "left_anti").select("id", "type", "name")}


def _batch_time(t: Tables) -> Column:
    """One timestamp for the whole batch (``current_timestamp`` is fixed per query)."""
    return F.current_timestamp()


def _child_register(t: Tables, ids: DataFrame) -> DataFrame:
    existing = get(t, "child", "id string")
    rows = ids.select(F.col("child_id").alias("id")).filter(F.col("id").isNotNull()).distinct()
    return rows.join(existing.select("id"), "id", "left_anti")


# ------------------------------------------------------------ X1 - X8

def persons(t: Tables, mock_registry: bool = False) -> dict[str, DataFrame]:
    """Insert-ignore on the identity number (and on the id)."""
    p = get(t, "mig_person")
    existing = get(t, "person", "id string, social_security_number string")
    stamp = F.lit(REGISTRY_UPDATED_AT).cast("timestamp")
    rows = p.select("id", "social_security_number", "last_name", "first_name", "email", "language", "street_address",
                    "postal_code", "post_office", "restricted_details_enabled", "phone", "backup_phone",
                    "date_of_birth", stamp.alias("updated_from_vtj"),
                    (stamp if mock_registry else F.lit(None).cast("timestamp")).alias("vtj_guardians_queried"),
                    (stamp if mock_registry else F.lit(None).cast("timestamp")).alias("vtj_dependants_queried"))
    new = insert_ignore_rows(existing.select("social_security_number"), rows, ["social_security_number"], ["id"])
    new = new.join(existing.select("id"), "id", "left_anti")
    return {"person": new}


def families(t: Tables) -> dict[str, DataFrame]:
    """Child links and partnerships, never in conflict."""
    c = get(t, "mig_fridge_child").select("child_id", F.col("head_of_family").alias("head_of_child"),
                                            "start_date", "end_date", F.lit(False).alias("conflict"))
    p = get(t, "mig_fridge_partner").select("partnership_id", "indx", "person_id", "start_date", "end_date",
                                              F.lit(False).alias("conflict"))
    return {"fridge_child": c, "fridge_partner": p}


def _assistance(t: Tables, source: str, values_col: str, target: str, option_table: str, ref_table: str,
                ref_key: str) -> dict[str, DataFrame]:
    src = get(t, source)
    rows = src.select("id", audit_user_id(t).alias("updated_by"), "child_id", "start_date", "end_date")
    opts = get(t, option_table, OPTION_SCHEMA).select(F.col("id").alias("option_id"), F.col("value").alias("_v"))
    refs = (src.select(F.col("id").alias(ref_key), F.explode(values_col).alias("_v"))
            .join(opts, "_v").select(ref_key, "option_id"))
    return {"child": _child_register(t, src), target: rows, ref_table: refs}


def assistance_needs(t: Tables) -> dict[str, DataFrame]:
    """Child register, needs, one basis reference per listed basis (T5)."""
    return _assistance(t, "mig_assistance_need", "bases", "assistance_need", "assistance_basis_option",
                       "assistance_basis_option_ref", "need_id")


def assistance_actions(t: Tables) -> dict[str, DataFrame]:
    """Child register, actions, one option reference per listed action (T5)."""
    return _assistance(t, "mig_assistance_action", "actions", "assistance_action", "assistance_action_option",
                       "assistance_action_option_ref", "action_id")


def income(t: Tables) -> dict[str, DataFrame]:
    """Incomes with batch time and audit user."""
    i = get(t, "mig_income")
    return {"income": i.select("id", "person_id", F.to_json("data").alias("data"), "effect", "valid_from", "valid_to",
                               _batch_time(t).alias("updated_at"), audit_user_id(t).alias("updated_by"),
                               F.lit("").alias("notes"), F.lit(False).alias("is_entrepreneur"),
                               F.lit(None).cast("string").alias("application_id"))}


def unit_managers(t: Tables) -> dict[str, DataFrame]:
    """X6."""
    return {"unit_manager": get(t, UNIT_MANAGER_FILE).select("id", "name", "email", "phone")}


def daycares(t: Tables) -> dict[str, DataFrame]:
    """Units with fixed defaults; enum columns checked against allowed values."""
    d = get(t, DAYCARE_FILE)
    none_s = F.lit(None).cast("string")
    rows = d.select(
        "id", "name", "type", "care_area_id", "phone", "url", "backup_location",
        none_s.alias("language_emphasis_id"), "opening_date", "closing_date", "email", "schedule", "additional_info",
        "unit_manager_id", "cost_center", "upload_to_varda", F.lit(0).alias("capacity"),
        "decision_daycare_name", "decision_preschool_name", F.lit("").alias("decision_handler"),
        F.lit("").alias("decision_handler_address"), "street_address", "postal_code", "post_office",
        "mailing_po_box", "location", "mailing_street_address", "mailing_postal_code", "mailing_post_office",
        "invoiced_by_municipality", "provider_type", "language", "upload_to_koski",
        none_s.alias("oph_unit_oid"), none_s.alias("oph_organizer_oid"), "operation_days", "ghost_unit",
        "daycare_apply_period", "preschool_apply_period",
        F.lit(None).cast("struct<lower:date,upper:date>").alias("club_apply_period"),
        none_s.alias("finance_decision_handler"), "round_the_clock",
        F.array().cast("array<string>").alias("enabled_pilot_features"),
        F.lit(False).alias("upload_children_to_varda"))
    bad_type = F.exists(F.coalesce("type", F.array().cast("array<string>")), lambda x: ~x.isin(*CARE_TYPES))
    viol = con.violations(rows, ["id"], [con.check("type", ~bad_type), con.values("provider_type", PROVIDER_TYPES),
                                         con.values("language", UNIT_LANGUAGES)])
    return {"daycare": rows, "daycare_violations": viol}


def departments(t: Tables) -> dict[str, DataFrame]:
    """Groups and their caretaker rows (fixed amount per group)."""
    g = get(t, "mig_daycare_group").select("id", "daycare_id", "name", "start_date", "end_date")
    care = g.select(F.col("id").alias("group_id"), F.lit(CARETAKERS_PER_GROUP).alias("amount"), "start_date", "end_date")
    return {"daycare_group": g, "daycare_caretaker": care}


# ------------------------------------------------------------ X9 - X17

def placements(t: Tables) -> dict[str, DataFrame]:
    """Child register, placements, service needs; a group is synthesised
    per distinct (unit, start, end) of placements without one, and every
    placement gets a group placement."""
    ep = get(t, "mig_placement")
    pl = ep.select("id", "type", "child_id", "unit_id", "start_date", "end_date")
    sn = get(t, "mig_service_need", "id string, option_id string, placement_id string, start_date date, end_date date"
             ).select("id", "option_id", "placement_id", "start_date", "end_date",
                                             F.lit(False).alias("shift_care"))
    synth = (ep.filter(F.col("daycare_group_id").isNull())
             .select(F.col("unit_id").alias("daycare_id"), "start_date", "end_date").distinct()
             .withColumn("id", ident.hash_uuid("DAYCARE_GROUP", "daycare_id", "start_date", "end_date"))
             .select("id", "daycare_id", F.lit(SYNTHESISED_GROUP_NAME).alias("name"), "start_date", "end_date"))
    pick = synth.groupBy(F.col("daycare_id").alias("_u"), F.col("start_date").alias("_s"),
                         F.col("end_date").alias("_e")).agg(F.min("id").alias("_gid"))
    gp = ep.join(pick, (ep["unit_id"] == pick["_u"]) & (ep["start_date"] == pick["_s"]) & (ep["end_date"] == pick["_e"]),
                 "left")
    gp = gp.select(F.col("id").alias("daycare_placement_id"),
                   F.coalesce("daycare_group_id", "_gid").alias("daycare_group_id"), "start_date", "end_date")
    return {"child": _child_register(t, ep), "placement": pl, "service_need": sn, "daycare_group": synth,
            "daycare_group_placement": gp}


def fee_alterations(t: Tables) -> dict[str, DataFrame]:
    """X10."""
    fa = get(t, "mig_fee_alteration")
    return {"fee_alteration": fa.select("id", "person_id", "type", "amount", "is_absolute", "valid_from", "valid_to",
                                        "notes", _batch_time(t).alias("updated_at"),
                                        audit_user_id(t).alias("updated_by"))}


def threshold_document(size: Column) -> Column:
    """Thresholds for a family size as a JSON object (NULL fields when no
    threshold period covers the date)."""
    def pick(prefix: str) -> Column:
        e = None
        for n in range(2, 7):
            e = F.when(size == n, F.col(f"{prefix}_{n}")) if e is None else e.when(size == n, F.col(f"{prefix}_{n}"))
        return e
    over = (size - 6) * F.col("income_threshold_increase_6_plus")
    known = size.between(2, 6)
    return json_of(
        F.when(known, pick("min_income_threshold")).otherwise(F.col("min_income_threshold_6") + over).alias("minIncomeThreshold"),
        F.when(known, pick("max_income_threshold")).otherwise(F.col("max_income_threshold_6") + over).alias("maxIncomeThreshold"),
        F.when(known, pick("income_multiplier")).otherwise(F.col("income_multiplier_6")).alias("incomeMultiplier"),
        F.col("max_fee").alias("maxFee"), F.col("min_fee").alias("minFee"))


def _thresholds_at(df: DataFrame, t: Tables, date_col: str) -> DataFrame:
    """Keyless validity lookup of the fee thresholds (``valid_during @> date``,
    half-open), by the distinct dates: no all-pairs product with the dimension."""
    ft = get(t, "fee_thresholds", FEE_THRESHOLDS_SCHEMA)
    ft = ft.withColumn("_ft_from", F.col("valid_during.lower")).withColumn("_ft_to", F.col("valid_during.upper"))
    ft = ft.withColumnRenamed("id", "_ft_id").drop("valid_during")
    return iv.point_in_interval_join(df, ft, [], date_col, ("_ft_from", "_ft_to"), half_open=True, how="left")


def voucher_value_decisions(t: Tables) -> dict[str, DataFrame]:
    """X11: thresholds by family size on the decision date, service need
    option and voucher value lookups; one row per decision (A9)."""
    v = get(t, "mig_voucher_value_decision")
    v = _thresholds_at(v, t, "legacy_decision_date")
    sno = get(t, "service_need_option", SERVICE_NEED_OPTION_SCHEMA).select(
        F.col("id").alias("_sno_id"), "valid_placement_type", "fee_coefficient", "voucher_value_coefficient",
        "fee_description_fi", "fee_description_sv", "voucher_value_description_fi", "voucher_value_description_sv")
    v = v.join(sno, v["service_need_option_id"] == sno["_sno_id"], "left")
    vv = get(t, "voucher_value", VOUCHER_VALUE_SCHEMA).select(
        F.col("id").alias("_vv_id"), F.col("validity.lower").alias("_vv_from"), F.col("validity.upper").alias("_vv_to"),
        "base_value", "age_under_three_coefficient")
    v = iv.point_in_interval_join(v, vv, [], "legacy_decision_date", ("_vv_from", "_vv_to"),
                                  half_open=True, how="left", probe=t["mig_voucher_value_decision"])
    v = v.dropDuplicates(["id", "_ft_id", "_sno_id", "_vv_id"])
    rows = v.select(
        "id", "status", "valid_from", "valid_to", "decision_number", "head_of_family_id", "partner_id", "family_size",
        threshold_document(F.col("family_size")).alias("fee_thresholds"),
        F.lit(None).cast("timestamp").alias("approved_at"), "child_id", "child_date_of_birth", "base_co_payment",
        "sibling_discount", "placement_unit_id", F.col("valid_placement_type").alias("placement_type"), "co_payment",
        F.lit("[]").alias("fee_alterations"), "base_value", "voucher_value", "final_co_payment",
        F.col("fee_coefficient").alias("service_need_fee_coefficient"),
        F.col("voucher_value_coefficient").alias("service_need_voucher_value_coefficient"),
        F.col("fee_description_fi").alias("service_need_fee_description_fi"),
        F.col("fee_description_sv").alias("service_need_fee_description_sv"),
        F.col("voucher_value_description_fi").alias("service_need_voucher_value_description_fi"),
        F.col("voucher_value_description_sv").alias("service_need_voucher_value_description_sv"),
        F.col("age_under_three_coefficient").alias("age_coefficient"), "capacity_factor")
    return {"voucher_value_decision": rows}


def fee_decisions(t: Tables) -> dict[str, DataFrame]:
    """Fee decisions with validity range and thresholds; child rows with
    their service need option."""
    fd = _thresholds_at(get(t, "mig_fee_decision"), t, "start_date")
    valid = F.struct(F.col("start_date").alias("lower"), F.date_add("end_date", 1).alias("upper"))
    rows = fd.select("id", "status", valid.alias("valid_during"),
                     F.concat(F.lit("["), F.date_format("start_date", "yyyy-MM-dd"), F.lit(","),
                              F.coalesce(F.date_format(F.date_add("end_date", 1), "yyyy-MM-dd"), F.lit("")),
                              F.lit(")")).alias("valid_during_text"),
                     "decision_type", "head_of_family_id", "head_of_family_income", "partner_id", "partner_income",
                     "family_size", threshold_document(F.col("family_size")).alias("fee_thresholds"),
                     "decision_number")
    kids = get(t, "mig_fee_decision_child")
    sno = get(t, "service_need_option", SERVICE_NEED_OPTION_SCHEMA).select(
        F.col("id").alias("_sno_id"), "valid_placement_type", "fee_coefficient", "fee_description_fi", "fee_description_sv")
    k = kids.join(sno, kids["service_need_option_id"] == sno["_sno_id"], "inner")
    krows = k.select("id", "fee_decision_id", "child_id", "child_date_of_birth", "sibling_discount", "placement_unit_id",
                     F.col("valid_placement_type").alias("placement_type"),
                     F.col("fee_coefficient").alias("service_need_fee_coefficient"),
                     F.col("fee_description_fi").alias("service_need_description_fi"),
                     F.col("fee_description_sv").alias("service_need_description_sv"),
                     "base_fee", "fee", F.lit("[]").alias("fee_alterations"), "final_fee")
    return {"fee_decision": rows, "fee_decision_child": krows}


def _address(prefix: str, editable: bool) -> Column:
    if editable:
        return F.struct(F.lit("").alias("street"), F.lit("").alias("postalCode"), F.lit("").alias("city"),
                        F.lit(True).alias("editable"))
    return F.struct(F.col(f"{prefix}street_address").alias("street"), F.col(f"{prefix}postal_code").alias("postalCode"),
                    F.col(f"{prefix}post_office").alias("city"), F.lit(False).alias("editable"))


def applications(t: Tables) -> dict[str, DataFrame]:
    """Applications and their form documents (daycare/preschool shape or
    club shape), with preferences ordered by priority."""
    ea = get(t, "mig_application")
    app = ea.select("id", "sentdate", "duedate", "guardian_id", "child_id", "transferapplication", "status",
                    F.lit(APPLICATION_ORIGIN).alias("origin"))
    form = get(t, "mig_application_form")
    sno = get(t, "service_need_option", SERVICE_NEED_OPTION_SCHEMA).select(
        F.col("id").alias("_sno_id"), "name_fi", "name_sv", "name_en")
    f = form.join(sno, form["service_need_option_id"] == sno["_sno_id"], "left")
    opt = F.when(F.col("_sno_id").isNotNull(), F.struct(F.col("_sno_id").alias("id"), F.col("name_fi").alias("nameFi"),
                                                         F.col("name_sv").alias("nameSv"), F.col("name_en").alias("nameEn")))
    # one entry per (application, priority): the list is bounded by the priorities of one application
    prefs = f.groupBy("application_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("legacy_priority", "unit_id"))), lambda x: x["unit_id"])
         .alias("unit_ids"),
        F.min_by(opt, F.when(opt.isNotNull(), F.col("legacy_priority"))).alias("service_need_option"),
        F.min_by("preferred_start_date", "legacy_priority").alias("preferred_start_date"))
    person = get(t, "mig_person")
    c = person.select(*[F.col(x).alias(f"c_{x}") for x in person.columns])
    g = person.select(*[F.col(x).alias(f"g_{x}") for x in person.columns])
    child = F.struct(F.col("c_first_name").alias("firstName"), F.col("c_last_name").alias("lastName"),
                     F.coalesce("c_social_security_number", F.lit("")).alias("socialSecurityNumber"),
                     F.col("c_date_of_birth").alias("dateOfBirth"), _address("c_", False).alias("address"),
                     F.coalesce(F.get(F.col("c_nationalities"), 0), F.lit(DEFAULT_NATIONALITY)).alias("nationality"),
                     F.coalesce("c_language", F.lit(DEFAULT_LANGUAGE)).alias("language"),
                     F.lit(None).cast("boolean").alias("hasCorrectingAddress"),
                     _address("", True).alias("correctingAddress"), F.lit(None).cast("date").alias("childMovingDate"),
                     F.lit(False).alias("restricted"))
    guardian = F.struct(F.col("g_first_name").alias("firstName"), F.col("g_last_name").alias("lastName"),
                        F.coalesce("g_social_security_number", F.lit("")).alias("socialSecurityNumber"),
                        _address("g_", False).alias("address"), F.col("g_phone").alias("phoneNumber"),
                        F.col("g_email").alias("email"), F.lit(None).cast("boolean").alias("hasCorrectingAddress"),
                        _address("", True).alias("correctingAddress"),
                        F.lit(None).cast("date").alias("guardianMovingDate"), F.lit(False).alias("restricted"))
    # persons are joined once per pair of child and guardian, and the lists of units, which are
    # already dealt by application, come last: so neither is shuffled for the other's joins
    family = (ea.select(F.col("child_id").alias("_c"), F.col("guardian_id").alias("_g")).distinct()
              .join(c, F.col("_c") == F.col("c_id")).join(g, F.col("_g") == F.col("g_id"))
              .select("_c", "_g", child.alias("child"), guardian.alias("guardian")))
    j = (ea.select("id", "child_id", "guardian_id", "type")
         .join(family, (F.col("child_id") == F.col("_c")) & (F.col("guardian_id") == F.col("_g")))
         .join(prefs, F.col("id") == F.col("application_id")))
    child, guardian = F.col("child"), F.col("guardian")
    apply = F.struct(F.col("unit_ids").alias("preferredUnits"), F.lit(False).alias("siblingBasis"),
                     F.lit("").alias("siblingName"), F.lit("").alias("siblingSsn"))
    empty = F.array().cast("array<string>")
    daycare_doc = json_of(
        child.alias("child"), guardian.alias("guardian"), F.lit(None).cast("string").alias("otherGuardianAgreementStatus"),
        apply.alias("apply"), F.lit(False).alias("urgent"), F.lit(False).alias("partTime"),
        F.col("service_need_option").alias("serviceNeedOption"), F.lit(None).cast("string").alias("connectedDaycare"),
        F.col("preferred_start_date").alias("preferredStartDate"), F.lit(None).cast("string").alias("serviceStart"),
        F.lit(None).cast("string").alias("serviceEnd"), F.lit(False).alias("extendedCare"),
        F.struct(F.lit(None).cast("boolean").alias("preparatory"), F.lit(False).alias("assistanceNeeded"),
                 F.lit("").alias("assistanceDescription")).alias("careDetails"),
        F.lit(None).cast("string").alias("guardian2"), F.lit(False).alias("hasOtherAdults"), empty.alias("otherAdults"),
        F.lit(False).alias("hasOtherChildren"), empty.alias("otherChildren"), F.lit(0).alias("docVersion"),
        F.struct(F.lit("").alias("allergyType"), F.lit("").alias("dietType"), F.lit("").alias("otherInfo"))
         .alias("additionalDetails"),
        F.lit(False).alias("maxFeeAccepted"), F.col("type").alias("type"))
    club_doc = json_of(
        child.alias("child"), guardian.alias("guardian"), apply.alias("apply"),
        F.col("preferred_start_date").alias("preferredStartDate"), F.lit(False).alias("wasOnDaycare"),
        F.lit(False).alias("wasOnClubCare"),
        F.struct(F.lit(False).alias("assistanceNeeded"), F.lit("").alias("assistanceDescription"),
                 F.lit("").alias("assistanceAdditionalDetails")).alias("clubCare"),
        F.lit(0).alias("docVersion"), F.struct(F.lit("").alias("otherInfo")).alias("additionalDetails"))
    doc = F.when(F.col("type").isin("DAYCARE", "PRESCHOOL"), daycare_doc).when(F.col("type") == "CLUB", club_doc)
    forms = j.select(F.col("id").alias("application_id"), F.lit(1).alias("revision"), doc.alias("document"),
                     F.lit(True).alias("latest"))
    return {"application": app, "application_form": forms}


def absences(t: Tables) -> dict[str, DataFrame]:
    """X14."""
    a = get(t, "mig_absence")
    return {"child": _child_register(t, a),
            "absence": a.select("id", "child_id", "date", "care_type", "absence_type",
                                audit_user_id(t).alias("modified_by"))}


def backup_cares(t: Tables) -> dict[str, DataFrame]:
    """X15."""
    b = get(t, "mig_backup_care")
    return {"child": _child_register(t, b),
            "backup_care": b.select("id", "child_id", "unit_id", "group_id", "start_date", "end_date")}


def attendances(t: Tables) -> dict[str, DataFrame]:
    """X16."""
    a = get(t, "mig_child_attendance")
    return {"child": _child_register(t, a),
            "child_attendance": a.select("id", "child_id", "arrived", "departed", "unit_id")}


def unit_external_ids(t: Tables) -> dict[str, DataFrame]:
    """Registry ids onto existing units (K6), and registry unit rows
    backdated so that the next sync refreshes them."""
    dom_ = get(t, "daycare_oid_map")
    daycare = get(t, "daycare", "id string, oph_unit_oid string, oph_organizer_oid string")
    src = dom_.join(daycare.select(F.col("id").alias("evaka_id")), "evaka_id").groupBy("evaka_id").agg(
        F.min("unit_oid").alias("unit_oid"), F.min("organizer_oid").alias("organizer_oid"))
    updated = update_from(daycare, src, ["id"], ["evaka_id"], {"oph_unit_oid": "unit_oid",
                                                               "oph_organizer_oid": "organizer_oid"})
    varda = dom_.filter(F.col("varda_unit_id").isNotNull()).select(
        F.col("evaka_id").alias("evaka_daycare_id"), "varda_unit_id",
        (_batch_time(t) - F.expr(f"INTERVAL {VARDA_BACKDATE_YEARS} YEARS")).alias("uploaded_at"))
    return {"daycare": updated, "varda_unit": varda}


# Transfer chain order; False = switched off in the legacy chain.
CHAIN = [
    ("audit_user", audit_user, True),
    ("persons", persons, True), ("families", families, True), ("assistance_needs", assistance_needs, False),
    ("assistance_actions", assistance_actions, False), ("income", income, True),
    ("unit_managers", unit_managers, True), ("daycares", daycares, True), ("departments", departments, True),
    ("placements", placements, True), ("fee_alterations", fee_alterations, True),
    ("voucher_value_decisions", voucher_value_decisions, True), ("fee_decisions", fee_decisions, True),
    ("applications", applications, True), ("absences", absences, True), ("backup_cares", backup_cares, True),
    ("attendances", attendances, False), ("unit_external_ids", unit_external_ids, True),
]


# Columns that a second run of the same rows fills anew.
_STAMPS = {"created", "updated", "created_at", "updated_at", "modified_at", "sent_at"}


def _not_present(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Rows of ``incoming`` that the target does not have: by ``id`` where the
    table has one, else by all columns but the time stamps."""
    keys = ["id"] if "id" in incoming.columns else [c for c in incoming.columns if c not in _STAMPS]
    keys = [c for c in keys if c in existing.columns]
    if not keys:
        return incoming
    have = existing.select(*[F.col(c).alias(f"_have_{c}") for c in keys]).distinct()
    return incoming.join(have, [F.col(c).eqNullSafe(F.col(f"_have_{c}")) for c in keys], "left_anti")


#: Buckets of the published id map; a run rewrites those in which an id is new or changed.
IDMAP_BUCKETS = 64


def publish_all(t: Mapping[str, DataFrame], target_dir: str, include_off: bool = False,
                jobs: Sequence[tuple[str, Callable]] | None = None, strict: bool = False) -> dict[str, dict[str, int]]:
    """Run the transfer chain and publish every job's new rows under ``target_dir``.

    Rows that a target has already, whether given in ``t`` or published by an
    earlier run, are not inserted again, so publishing twice equals publishing
    once. Later jobs see existing and new rows together (the child register,
    the audit user, daycare groups). The id map is published too, for the next
    run. Nothing is visible (``publish.published``) until all jobs have run;
    then all tables change at once. A ``*_violations`` table holds what the run
    found; ``strict`` stops with ``ConstraintError`` if that is anything, and
    the target stays as it was. Returns per job the rows added (K8)."""
    if jobs is None:
        jobs = [(n, f) for n, f, on in CHAIN if on or include_off]
    inputs.resolve(t, [n for n, _ in jobs], inputs.PUBLISH_INPUTS, {})
    manifest = Manifest(spark_of(t), target_dir)
    state = dict(t)
    report: dict[str, dict[str, int]] = {}
    for name, job in jobs:
        counts = {}
        for table, df in job(state).items():
            checked = table.endswith("_violations")
            target = f"_checks/{table}" if checked else table
            update = checked or (name, table) == ("unit_external_ids", "daycare")
            before, given = manifest.read(target), t.get(table)
            if not update:
                for existing in (before, given):
                    if existing is not None and existing.columns:
                        df = _not_present(existing, df)
            counts[table] = manifest.add(df, target, name, replace=update)
            state[table] = manifest.read(target)
            if strict and checked:
                con.require_none(table, counts[table], state[table])
            if given is not None and not update:
                state[table] = state[table].unionByName(_not_present(state[table], given), allowMissingColumns=True)
        report[name] = counts
    if "idmap" in t:
        manifest.replace_buckets(t["idmap"].select("type", "source_id", "target_id", "updated"), "idmap", ["type", "source_id"], IDMAP_BUCKETS)
    manifest.commit()
    return report
