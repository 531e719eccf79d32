"""D5 income, D9 fee alterations, D11 voucher value decisions, D12 fee decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ...functions import codes
from ...functions import dictionaries as dic
from ...functions import domain as dom
from ...functions.documents import json_of
from ...operators import aggregate as agg
from ...operators import constraints as con
from ...operators import identity as ident
from ...operators import intervals as iv
from ...operators import quality as q
from ...operators.joins import repair_branch_join
from ...session import release_shuffles
from ._common import (Tables, extent_option, filtered, get, id_map_update, materialize, person_lookup, split,
                      unit_lookup, with_ids)



def _main_income(amount: Column) -> Column:
    return F.create_map(F.lit(dic.FEE_DECISION_INCOME_TYPE),
                        F.struct(amount.cast("long").alias("amount"),
                                 F.lit(dic.DEFAULT_INCOME_PERIOD).alias("coefficient")))


def income(t: Tables) -> dict[str, DataFrame]:
    """Incomes with their income rows as a typed ``data`` map.

    Rows attach to an income when their intervals intersect, or through the
    repair branch (a broken row starting on the same day as an open income).
    Duplicate income types collapse to the latest row. When the weighted
    total of the map differs from the declared total, the map is replaced by
    a single MAIN_INCOME entry of the declared total."""
    inc = get(t, "income")
    key = ["personid", "maxincome", "incomemissing", "startdate", "enddate", "summa"]
    span = ["personid", "startdate", "enddate"]
    spans = inc.select(*span).distinct()
    inc = inc.select(*key).distinct()
    rows = filtered(t, "incomerows").select(
        "personid", F.col("startdate").alias("r_start"), F.col("enddate").alias("r_end"),
        "incomeperiod", "incometype", F.col("summa").alias("r_summa"), F.col("guid").alias("r_guid"))
    types = sorted({*dic.INCOME_TYPE.values(), dic.UNKNOWN_INCOME_TYPE})
    numbers = {code: types.index(name) for code, name in dic.INCOME_TYPE.items()}
    number = F.coalesce(codes.map_code("incometype", numbers, "int", "int"), F.lit(types.index(dic.UNKNOWN_INCOME_TYPE)))
    period = F.coalesce(codes.map_code("incomeperiod", dic.INCOME_PERIOD, key_type="int"),
                        F.lit(dic.UNKNOWN_INCOME_PERIOD))
    value = F.struct(dom.to_cents("_latest.r_summa").alias("amount"), period.alias("coefficient"))
    # Incomes match by their interval, and of the rows with one person, interval and type only the latest
    # counts, so both sides are summed to these first: what a person has in one task depends on the different
    # dates, not on how many incomes or rows share them. Of all rows that match only the latest of a type
    # counts as well, so no pairs are made. Types are shuffled by their number.
    rows = rows.where(F.col("personid").isNotNull()).withColumn("_type", number)
    rows = agg.dealt_max(rows, ["personid"], ["personid", "r_start", "r_end", "_type"], ["r_guid", "incomeperiod", "r_summa"], "_latest")
    per_type = (repair_branch_join(spans, rows, ["personid"], ("startdate", "enddate"), ("r_start", "r_end"), "_type", "_latest")
                .withColumn("_type", F.element_at(F.array(*(F.lit(name) for name in types)), F.col("_type") + 1))
                .withColumn("incomeperiod", F.col("_latest.incomeperiod")))
    data = (per_type.groupBy(*span).agg(F.map_from_entries(F.collect_list(F.struct("_type", value.alias("_v")))).alias("_rows_map"))
            .select(*(F.col(c).alias(f"_k_{c}") for c in span), "_rows_map"))
    same = (F.col("personid") == F.col("_k_personid")) & F.col("startdate").eqNullSafe(F.col("_k_startdate")) & F.col("enddate").eqNullSafe(F.col("_k_enddate"))
    j = inc.join(data, same, "left").drop(*(f"_k_{c}" for c in span))
    empty = F.create_map().cast("map<string,struct<amount:bigint,coefficient:string>>")
    total = dom.to_cents("summa")
    shaped = (F.when(F.col("maxincome"), empty).when(F.col("incomemissing"), empty)
              .when(F.col("_rows_map").isNotNull(), F.col("_rows_map"))
              .when(F.col("summa") > 0, _main_income(total))
              .otherwise(empty))
    j = j.withColumn("_data", shaped).withColumn("income_total", total.cast("int"))
    weighted = agg.weighted_total("_data", dic.INCOME_SIGNS, dic.INCOME_COEFFICIENTS)
    j = j.withColumn("data", F.when((F.col("income_total") - weighted) == 0, F.col("_data"))
                     .otherwise(_main_income(F.col("income_total"))))
    j = person_lookup(j, get(t, "mig_person"), "personid", {"id": "person_id"}).filter(F.col("person_id").isNotNull())
    out = j.select(ident.hash_uuid("INCOME", *key).alias("id"), "person_id", F.col("personid").alias("person_ssn"), "data",
                   dom.income_effect("maxincome", "incomemissing").alias("effect"),
                   F.col("startdate").alias("valid_from"), F.col("enddate").alias("valid_to"), "income_total")
    # no two incomes of a person may overlap (the legacy exclusion constraint)
    out = materialize(out)
    release_shuffles(out.sparkSession)
    checked = iv.conflicts(out, ["person_id"], "valid_from", "valid_to")
    flagged = q.flag(checked, [("OVERLAPPING INCOME", F.col("overlapping"))]).drop("overlapping")
    clean, todo = split(flagged, ["id"])
    violations = con.violations(clean, ["id"], [
        *con.not_null("person_id", "person_ssn", "data", "valid_from", "effect"),
        con.ForeignKey(("person_id",), get(t, "mig_person"), ("id",)),
        con.NoOverlap("income", ("person_id",), "valid_from", "valid_to")])
    return {"mig_income": clean, "mig_income_todo": todo, "mig_income_violations": violations}


def fee_deviations(t: Tables) -> dict[str, DataFrame]:
    """Fee deviations of migrated placements -> fee alterations."""
    fd = get(t, "feedeviations")
    pl = get(t, "mig_placement").select(F.col("legacy_placement_nbr").alias("_pnbr"), "child_id")
    j = fd.join(pl, fd["placementnbr"] == pl["_pnbr"], "inner")
    j = j.filter(F.col("deviationtype").isNotNull() & ((F.col("sum") != 0) | (F.col("procent") != 0)))
    types = {k: v[0] for k, v in dic.DEVIATION_TYPE.items()}
    notes = {k: v[1] for k, v in dic.DEVIATION_TYPE.items()}
    amount = F.when(F.col("sum") == 0, F.col("procent")).otherwise(F.col("sum"))
    out = j.select(
        ident.hash_uuid("FEE_ALTERATION", "guid", "placementnbr", "rownbr").alias("id"),
        F.col("child_id").alias("person_id"),
        codes.map_code("deviationtype", types, key_type="int").alias("type"),
        F.round(amount, 0).cast("int").alias("amount"),
        (F.col("sum") != 0).alias("is_absolute"),
        F.col("startdate").alias("valid_from"), F.col("enddate").alias("valid_to"),
        codes.map_code("deviationtype", notes, key_type="int").alias("notes"))
    flagged = q.flag(out, [("TYPE MISSING", F.col("type").isNull()),
                           ("PERSON MISSING", F.col("person_id").isNull())])
    clean, todo = split(flagged, ["id"])
    violations = con.violations(clean, ["id"], con.not_null("person_id", "type", "amount", "is_absolute", "valid_from", "notes"))
    return {"mig_fee_alteration": clean, "mig_fee_alteration_todo": todo, "mig_fee_alteration_violations": violations}


def _status_group(status: Column, sent_group: str) -> Column:
    return (F.when(status == "DRAFT", "DRAFT")
            .when(status.isin("SENT", "WAITING_FOR_SENDING", "WAITING_FOR_MANUAL_SENDING"), sent_group))


def _family_at(points: DataFrame, t: Tables, ssn_col: str, date_col: str, key: str) -> DataFrame:
    """Head of family of a child on a date (child link containing the date),
    and the head's partner on that date. One deterministic pick per ``key``."""
    links = get(t, "mig_fridge_child").select(
        F.col("child_ssn").alias("_ssn"), "head_of_family",
        F.col("start_date").alias("_fs"), F.col("end_date").alias("_fe"))
    p = points.select(key, F.col(ssn_col).alias("_ssn"), F.col(date_col).alias("_d")).filter(F.col("_d").isNotNull())
    heads = iv.point_in_interval_join(p, links, ["_ssn"], "_d", ("_fs", "_fe"), bin_days=365)
    heads = heads.groupBy(key, "_d").agg(F.min("head_of_family").alias("head_of_family_id"))
    part = get(t, "mig_fridge_partner")
    p1 = part.select(F.col("person_id").alias("head_of_family_id"), F.col("partnership_id").alias("_pid"),
                     F.col("indx").alias("_ix"), F.col("start_date").alias("_ps"), F.col("end_date").alias("_pe"))
    hp = iv.point_in_interval_join(heads, p1, ["head_of_family_id"], "_d", ("_ps", "_pe"), bin_days=365)
    p2 = part.select(F.col("partnership_id").alias("_pid2"), F.col("indx").alias("_ix2"),
                     F.col("person_id").alias("_partner"))
    hp = hp.join(p2, (hp["_pid"] == p2["_pid2"]) & (hp["_ix"] != p2["_ix2"]))
    partners = hp.groupBy(key).agg(F.min("_partner").alias("partner_id"))
    return heads.select(key, "head_of_family_id").join(partners, key, "left")


def voucher_value_decisions(t: Tables) -> dict[str, DataFrame]:
    """Voucher value decisions with family, unit and option lookups,
    open ends closed per (child, status group), quarantine rules."""
    d = get(t, "decisions").filter(codes.in_list("decisiontype", dic.VOUCHER_DECISION_TYPES))
    d = with_ids(d, t, "DECISION", "guid", "id")
    status = codes.map_code("decisionstatus", dic.DECISION_STATUS, key_type="int")
    d = d.withColumn("status", status).withColumn("status_group", _status_group(F.col("status"), "APPROVED"))
    fam = _family_at(d, t, "personid", "decisiondate", "guid")
    d = d.join(fam, "guid", "left")
    d = person_lookup(d, get(t, "mig_person"), "personid", {"id": "child_id", "date_of_birth": "child_date_of_birth"})
    d = unit_lookup(d, t, "decisionunitcode", "decisionchildminder", "placement_unit_id")
    d = extent_option(d, t, "extent", "days", "service_need_option_id")
    rows = d.select(
        "id", F.col("guid").alias("legacy_guid"), F.col("personid").alias("legacy_ssn"),
        F.col("decisiondate").alias("legacy_decision_date"), "status", "status_group",
        F.col("startdate").alias("valid_from"), F.col("enddate").alias("valid_to"),
        F.col("decisionnbr").cast("long").alias("decision_number"), "head_of_family_id", "partner_id",
        F.col("familysize").alias("family_size"), "child_id", "child_date_of_birth",
        F.lit(0).alias("base_co_payment"), F.lit(0).alias("sibling_discount"), "placement_unit_id",
        "service_need_option_id", F.lit(0).alias("co_payment"),
        dom.to_cents("totalsum").cast("int").alias("voucher_value"),
        dom.to_cents("paydecision").cast("int").alias("final_co_payment"),
        F.col("factor").cast("decimal(4,2)").alias("capacity_factor"))
    idmap = id_map_update(t, "DECISION", rows.select(F.col("legacy_guid").alias("guid"), "id"), "guid", "id")
    has_group = rows.filter(F.col("status_group").isNotNull())
    closed = iv.close_open_ends(has_group, ["legacy_ssn", "status_group"], "valid_from", "valid_to", identity="decision_number")
    rows = closed.unionByName(rows.filter(F.col("status_group").isNull()))
    valid = (F.col("valid_from") <= F.col("valid_to")) | F.col("valid_from").isNull() | F.col("valid_to").isNull()
    rows = iv.conflicts(materialize(rows), ["legacy_ssn", "status_group"], "valid_from", "valid_to", valid=valid, identity="decision_number")
    flagged = q.flag(rows, [
        ("STATUS MISSING", F.col("status").isNull()),
        ("HEAD OF FAMILY MISSING", F.col("head_of_family_id").isNull()),
        ("CHILD MISSING", F.col("child_id").isNull()),
        ("UNIT MISSING", F.col("placement_unit_id").isNull()),
        ("SERVICE NEED OPTION MISSING", F.col("service_need_option_id").isNull()),
        ("START AFTER END", F.col("valid_from") > F.col("valid_to")),
        ("INVALID FAMILY SIZE", F.col("family_size") <= 1),
        ("OVERLAPPING DECISION", F.col("overlapping"))]).drop("overlapping")
    clean, todo = split(flagged, ["id"])
    violations = con.violations(clean, ["id"], [con.check("head_is_not_partner", F.col("head_of_family_id") != F.col("partner_id"))])
    return {"mig_voucher_value_decision": clean, "mig_voucher_value_decision_todo": todo,
            "mig_voucher_value_decision_violations": violations, "idmap": idmap}


def _income_document(income: Column) -> Column:
    """P19 as the fee-decision income document (JSON text)."""
    cents = dom.to_cents(income)
    maxed = income == dom.MAX_INCOME_MARKER
    data = F.when(maxed, F.create_map().cast("map<string,bigint>")).otherwise(
        F.create_map(F.lit(dic.FEE_DECISION_INCOME_TYPE), cents))
    tot = F.when(maxed, F.lit(0).cast("long")).otherwise(cents)
    doc = json_of(F.when(maxed, "MAX_FEE_ACCEPTED").otherwise("INCOME").alias("effect"), data.alias("data"),
                  tot.alias("totalIncome"), F.lit(0).alias("totalExpenses"), tot.alias("total"),
                  F.lit(False).alias("worksAtECHA"), F.lit(None).cast("date").alias("validFrom"),
                  F.lit(None).cast("date").alias("validTo"))
    return F.when(income.isNull(), F.lit(None).cast("string")).otherwise(doc)


def pay_decisions(t: Tables) -> dict[str, DataFrame]:
    """Fee decisions (head/partner income documents, family size from
    the free text of a row) and their child rows."""
    pd = get(t, "paydecisions").filter(codes.tristate_keep("status", dic.PAY_DECISION_STATUS, key_type="int"))
    pd = with_ids(pd, t, "PAY_DECISION", "guid", "id")
    status = codes.map_code("status", dic.PAY_DECISION_STATUS, key_type="int")
    rows = get(t, "paydecisionrows")
    # Head income, partner row and family size in one pass over the rows of
    # each decision; where the legacy joins could fan out, the row with the
    # smallest (row number, row guid, value) is taken. ``min_by`` skips rows
    # whose ordering is NULL, so each ordering also selects the row kind.
    r = rows.filter(F.col("rowtype").isin(1, 2, 3)).select(F.col("internalid").alias("_iid"), F.col("person").alias("_person"), "income", "rownumber",
                    F.col("guid").alias("_rguid"), "rowtype",
                    dom.family_size_from_text("specification", "Perhekoko").alias("_fs"))
    adult = F.col("rowtype").isin(1, 2)
    is_head = adult & (F.col("_person") == F.col("headoffamily"))
    is_partner = adult & (F.col("_person") != F.col("headoffamily"))
    per_pd = pd.select("guid", "internaldecisionnumber", "headoffamily").join(
        r, pd["internaldecisionnumber"] == r["_iid"]).groupBy("guid").agg(
        F.min_by("income", F.when(is_head, F.struct("rownumber", "_rguid", "income"))).alias("_head_income"),
        F.min_by(F.struct("_person", "income"),
                 F.when(is_partner, F.struct("rownumber", "_rguid", "_person", "income"))).alias("_pr"),
        F.min_by("_fs", F.when(F.col("rowtype") == 3, F.struct("rownumber", "_rguid", "_fs"))).alias("family_size"))
    j = pd.join(per_pd, "guid", "left")
    person = get(t, "mig_person")
    j = person_lookup(j, person, "headoffamily", {"id": "head_of_family_id"})
    j = j.withColumn("_partner_ssn", F.col("_pr._person"))
    j = person_lookup(j, person, "_partner_ssn", {"id": "partner_id"})
    fee = j.select(
        "id", F.col("guid").alias("legacy_guid"), F.col("headoffamily").alias("legacy_ssn"),
        status.alias("status"), _status_group(status, "SENT").alias("status_group"),
        F.col("startdate").alias("start_date"), F.col("enddate").alias("end_date"),
        F.lit("NORMAL").alias("decision_type"), "head_of_family_id",
        F.col("_head_income").alias("head_of_family_income"), "partner_id",
        F.col("_pr.income").alias("partner_income"), "family_size",
        F.col("decisionnumber").cast("long").alias("decision_number"))
    idmap = id_map_update(t, "PAY_DECISION", fee.select(F.col("legacy_guid").alias("guid"), "id"), "guid", "id")
    fee = iv.conflicts(materialize(fee), ["legacy_ssn", "status_group"], "start_date", "end_date",
                       valid=(F.col("end_date") >= F.col("start_date")) | F.col("end_date").isNull())
    for c in ("head_of_family_income", "partner_income"):  # the documents come after the shuffles
        fee = fee.withColumn(c, _income_document(F.col(c)))
    flagged = q.flag(fee, [("STATUS MISSING", F.col("status").isNull()),
                           ("START AFTER END", F.col("start_date") > F.col("end_date")),
                           ("OVERLAPPING FEE DECISION", F.col("overlapping")),
                           ("PERSON MISSING", F.col("head_of_family_id").isNull()),
                           ("FAMILY SIZE MISSING", F.col("family_size").isNull())]).drop("overlapping")
    fee_clean, fee_todo = split(flagged, ["id"])
    fee_viol = con.violations(fee_clean, ["id"], [
        con.Unique(("legacy_guid",)), *con.not_null("legacy_ssn", "decision_type", "decision_number", "start_date"),
        con.check("head_is_not_partner", F.col("head_of_family_id") != F.col("partner_id")),
        con.ForeignKey(("head_of_family_id",), person, ("id",)), con.ForeignKey(("partner_id",), person, ("id",))])

    kids = rows.filter(F.col("rowtype") == 5).select(
        F.col("guid").alias("legacy_guid"), F.col("internalid").alias("_kid_iid"), "person", "fee")
    # decisions are fewer than their rows, so they are put together before the rows join them
    decisions = get(t, "paydecisions").select(F.col("internaldecisionnumber").alias("_kid_iid"), F.col("guid").alias("_pd_guid")).join(
        fee_clean.select(F.col("legacy_guid").alias("_pd_guid"), F.col("id").alias("fee_decision_id"),
                         F.col("start_date").alias("_fd_start")), "_pd_guid", "left")
    kids = kids.join(decisions, "_kid_iid")
    kids = person_lookup(kids, person, "person", {"id": "child_id", "date_of_birth": "child_date_of_birth"})
    pl = get(t, "mig_placement").select("child_id", F.col("id").alias("_placement_id"),
                                          F.col("unit_id").alias("placement_unit_id"),
                                          F.col("start_date").alias("_ps"), F.col("end_date").alias("_pe"))
    kids = kids.select("legacy_guid", "fee", "fee_decision_id", "_fd_start", "child_id", "child_date_of_birth")  # only what follows is written
    kids = iv.point_in_interval_join(materialize(kids), pl, ["child_id"], "_fd_start", ("_ps", "_pe"), half_open=True, how="left",
                                     bin_days=90).drop("_ps", "_pe")
    sn = get(t, "mig_service_need").select(F.col("placement_id").alias("_placement_id"),
                                             F.col("option_id").alias("service_need_option_id"),
                                             F.col("start_date").alias("_ss"), F.col("end_date").alias("_se"))
    kids = iv.point_in_interval_join(materialize(kids), sn, ["_placement_id"], "_fd_start", ("_ss", "_se"),
                                     half_open=True, how="left", bin_days=90)
    cents = dom.to_cents("fee").cast("int")
    child = kids.select(
        ident.hash_uuid("FEE_DECISION_CHILD", "legacy_guid", "_placement_id", "service_need_option_id").alias("id"),
        "legacy_guid", "fee_decision_id", "child_id", "child_date_of_birth", F.lit(0).alias("sibling_discount"),
        "placement_unit_id", "service_need_option_id", cents.alias("base_fee"), cents.alias("fee"),
        cents.alias("final_fee"))
    cflag = q.flag(child, [("PERSON MISSING", F.col("child_id").isNull()),
                           ("PLACEMENT MISSING", F.col("placement_unit_id").isNull()),
                           ("SERVICE NEED OPTION MISSING", F.col("service_need_option_id").isNull())])
    child_clean, child_todo = split(cflag, ["id"])
    return {"mig_fee_decision": fee_clean, "mig_fee_decision_todo": fee_todo, "mig_fee_decision_violations": fee_viol,
            "mig_fee_decision_child": child_clean, "mig_fee_decision_child_todo": child_todo, "idmap": idmap}
