"""The reconciliation chain end to end on small legacy-shaped inputs.

Inputs are re-typed from the legacy test fixtures (same shapes and values),
written as record files / pipe files, ingested, then run through the jobs.
Golden facts come from the legacy snapshots."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from registrar.plans.runner import run_chain
from registrar.sinks.publish import published
from registrar.sources import inputs
from registrar.sources import records

D = dt.date
U1 = "19fec146-e2f1-11eb-8473-db55258254c5"
U2 = "19fec1fa-e2f1-11eb-8473-eb1f7ce94b07"
OPT_FULL = "86ef70a0-bf85-11eb-91e6-1fb57a101161"
OPT_PART = "86ef7370-bf85-11eb-91e7-6fcd728c518d"

PERSONS = [
    dict(personid="020967-9992", personname="Authentic, Aimo", secretaddress="false", personstreetaddress="Fakestreet 123",
         personcity="Ypäjä", personzipcode="00001", personmobilephone="000-0000000", phonework="", phonehome="",
         mothertongue="1", guid="{g1}"),
    dict(personid="020288-TP01", personname="Temporary, Teppo", secretaddress="0", personstreetaddress="StreetStreet 321",
         personmobilephone="", phonework="111-1111111", phonehome="", mothertongue="1", guid="{g2}"),
    dict(personid="180476-998M", personname="Hidden, Hilda", secretaddress="1", personstreetaddress="HideStreet 2",
         personcity="Ypäjä", personzipcode="00001", personmobilephone="", phonework=" ", phonehome="0222222222",
         mothertongue="1", guid="{g3}"),
    dict(personid="010619A9501", personname="Child, Christian", secretaddress="0", personmobilephone="222-2222222",
         phonework="222-2222223", phonehome="222-2222224", mothertongue="1", guid="{g4}"),
    dict(personid="251118A9509", personname="Child, Camilla", secretaddress="0", personmobilephone=" ",
         phonework=" 222-2222222", phonehome="222-2222223 ", mothertongue="1", guid="{g5}"),
    dict(personid="181101A9092", personname="", secretaddress="", mothertongue="1", guid="{g6}"),
]
CODES = [dict(code="1", active="A", codetype="SPRAK", text="Suomi", extrainfo1="fi", guid="{c1}")]
FAMILIES = [
    dict(familynbr="1", personid="020967-9992", startdate="20191125", enddate="20201130", roleinfamily="R"),
    dict(familynbr="1", personid="180476-998M", startdate="20191125", enddate="20201130", roleinfamily="S"),
    dict(familynbr="1", personid="251118A9509", startdate="20191125", enddate="20201130", roleinfamily="B"),
    dict(familynbr="2", personid="020967-9992", startdate="20201201", enddate="99999999", roleinfamily="R"),
    dict(familynbr="2", personid="180476-998M", startdate="20201201", enddate="99999999", roleinfamily="S"),
    dict(familynbr="2", personid="251118A9509", startdate="20201201", enddate="", roleinfamily="B"),
    dict(familynbr="2", personid="010619A9501", startdate="20201201", enddate="", roleinfamily="B"),
    dict(familynbr="2", personid="010619A9501", startdate="20201201", enddate="20201201", roleinfamily="B"),
]
INCOME = [
    dict(personid="180476-998M", startdate="20200301", enddate="20210301", maxincome="0", incomemissing="0", summa="50000.00"),
    dict(personid="020967-9992", startdate="20200301", enddate="99991231", maxincome="0", incomemissing="0", summa="5060.60"),
]
INCOMEROWS = [
    dict(personid="020967-9992", startdate="20210101", enddate="99991231", incomeperiod="83", incometype="85", summa="4500.60"),
    dict(personid="020967-9992", startdate="20210101", enddate="20210201", incomeperiod="83", incometype="108", summa="560.00"),
    dict(personid="020967-9992", startdate="20210101", enddate="99991231", incomeperiod="83", incometype="88", summa="215.00"),
    dict(personid="020967-9992", startdate="20210101", enddate="99991231", incomeperiod="111", incometype="109", summa="10.00"),
]
DEPARTMENTS = [dict(unitcode="123", departmentcode="1231", departmentname="Tenhon terhot", startdate="20200301", enddate=""),
               dict(unitcode="125", departmentcode="1251", departmentname="Tujun tupajumit", startdate="20200301",
                    enddate="99999999")]
PLACEMENTS = [
    dict(placementnbr="11", personid="010619A9501", placementunitcode="123", placementdepartmentcode="1231",
         placementchildminder="", startdate="20200301", enddate=""),
    dict(placementnbr="12", personid="010619A9501", placementunitcode="123", placementdepartmentcode="1231",
         placementchildminder="", startdate="20210301", enddate=""),
] + [dict(placementnbr=str(n), personid="251118A9509", placementunitcode="0", placementdepartmentcode="0",
          placementchildminder="010101-TP99", startdate=s, enddate=e)
     for n, s, e in [(13, "20200301", ""), (14, "20210101", "20211231"), (15, "20210801", ""), (16, "20210801", "")]]
EXTENTS = [dict(placementnbr="11", extentnbr="1", startdate="20200301", enddate="", hours="0", days="0", extentcode="100"),
           dict(placementnbr="13", extentnbr="2", startdate="20200301", enddate="", hours="0", days="15", extentcode="101"),
           dict(placementnbr="13", extentnbr="3", startdate="20200301", enddate="", hours="0", days="15", extentcode="101")]
JOURNALS = [dict(dailyjournalid="123456", unit="123", department="1231", childminder="", period="202003"),
            dict(dailyjournalid="123457", unit="125", department="1251", childminder="", period="202003")]
JOURNAL_ROWS = [
    dict(dailyjournalid="123456", personid="251118A9509", extrachild="&#x20;", reportcode03="173", reportcode09="169",
         reportcode15="176", reportcode16="176", reportcode17="176", reportcode19="176", reportcode24="999",
         reportcode01="0"),
    dict(dailyjournalid="123457", personid="251118A9509", reportcode15="174", reportcode16="174", reportcode17="174",
         reportcode19="174"),
]
APPLICATIONS = [dict(personid="010619A9501", applicationdate="20210801", placeneed="1.00", specialhandlingtime="0",
                     transferapplication="0", status="999962042", careid="12345", applicationtype="999940001",
                     guid="APP-1")]
APPLICATION_ROWS = [dict(personid="010619A9501", priority="1", unitcode="123", childminder="&#x20;", startdate="20210901",
                         days="0", extent="100", careid="12345")]
DECISIONS = [dict(personid="010619A9501", decisiontype="426", decisionstatus="999420001", decisionunitcode="123",
                  decisionchildminder="", startdate="20200401", enddate="", decisiondate="20201201", decisionnbr="1",
                  extent="100", days="0", paydecision="1", factor="0.00", familysize="5", totalsum="10", guid="10")]
PAY_DECISIONS = [dict(headoffamily="020967-9992", internaldecisionnumber="3843781", startdate="20200301",
                      enddate="99991231", fee="492.00", decisionnumber="123456790", decisiondate="20200101",
                      status="999420001", guid="paydecision3843781")]
PAY_ROWS = [dict(internalid="3843781", rownumber="1", person="020967-9992", income="100.2", rowtype="1", guid="r1"),
            dict(internalid="3843781", rownumber="2", person="", income="", specification="Perhekoko 2 (maksu 10.70%)",
                 rowtype="3", guid="r2"),
            dict(internalid="3843781", rownumber="3", person="010619A9501", income="", fee="492.00", rowtype="5",
                 guid="r3"),
            dict(internalid="3843781", rownumber="4", person="180476-998M", income="999999", rowtype="2", guid="r4")]
DEVIATIONS = [dict(placementnbr="11", rownbr="1", deviationtype="5", startdate="20200301", enddate="", sum="0", procent="0"),
              dict(placementnbr="12", rownbr="2", deviationtype="39", startdate="20200301", enddate="", sum="10",
                   procent="0")]
NEEDS = [dict(personid="010619A9501", specialneedcode="207", startdate="20190808", enddate="20200531")]
MEANS = [dict(personid="010619A9501", specialneedcode="207", mean="438", startdate="20190808", enddate="20200531")]
TS_HEADERS = [dict(rownumber="1122", childminder="010101-TP99", period="202101", rowtype="R", unit="0", department="0",
                   personid="251118A9509", placementnumber="13")]
TS_DETAILS = [dict(rownumber="1122", day="1", starttime1="0726", endtime1="1617", starttime2=" ", endtime2=" ")]
CSV = {
    "unitmap": f"﻿effica_id|evaka_id\r\n123| {U1}\r\n125|{U2}\r\n",
    "childmindermap": f"﻿effica_id|evaka_id\r\n010101-TP99| {U2}\r\n",
    "extentmap": f"﻿effica_id|days|evaka_id\r\n100|0| {OPT_FULL}\r\n101|15|{OPT_PART}",
    "placements_exclusion": "placementnbr\n16\n",
    "families_exclusion": "personid|familynbr|roleinfamily|startdate|enddate\n010619A9501|2|B|20201201|20201201\n",
}


def _xml(element, rows):
    out = ["<!-- fixture -->"]
    for r in rows:
        out.append(f"<{element}>" + "".join(f"<{k}>{v}</{k}>" for k, v in r.items()) + f"</{element}>")
    return "\n".join(out) + "\n"


@pytest.fixture(scope="module")
def result(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("legacy"))
    for table, element, rows in [("persons", "person", PERSONS), ("codes", "item", CODES),
                                 ("families", "personinfamily", FAMILIES), ("income", "income", INCOME),
                                 ("incomerows", "incomerow", INCOMEROWS), ("departments", "department", DEPARTMENTS),
                                 ("placements", "placement", PLACEMENTS), ("placementextents", "placementextent", EXTENTS),
                                 ("dailyjournals", "DailyJournals", JOURNALS),
                                 ("dailyjournalrows", "DailyJournalRows", JOURNAL_ROWS),
                                 ("applications", "Application", APPLICATIONS),
                                 ("applicationrows", "ApplicationRows", APPLICATION_ROWS),
                                 ("decisions", "decision", DECISIONS), ("paydecisions", "PayDecision", PAY_DECISIONS),
                                 ("paydecisionrows", "PayDecisionRows", PAY_ROWS),
                                 ("feedeviations", "feedeviation", DEVIATIONS), ("specialneeds", "SpecialNeeds", NEEDS),
                                 ("specialmeans", "SpecialMeans", MEANS),
                                 ("timestampheaders", "TimeStampHeaders", TS_HEADERS),
                                 ("timestampdetails", "TimeStampDetails", TS_DETAILS)]:
        with open(os.path.join(base, f"{table}.xml"), "w", encoding="utf-8") as f:
            f.write(_xml(element, rows))
    for table, text in CSV.items():
        with open(os.path.join(base, f"{table}.csv"), "w", encoding="utf-8") as f:
            f.write(text)
    staged = records.ingest_dir(spark, base)
    staged["service_need_option"] = spark.createDataFrame(
        [(OPT_FULL, "full", "DAYCARE", 1.0), (OPT_PART, "part", "DAYCARE_PART_TIME", 0.6)],
        "id string, name_fi string, valid_placement_type string, fee_coefficient double")
    return run_chain(staged, include_off=True)


def test_persons(result):
    rows = {r.legacy_ssn: r for r in result["mig_person"].collect()}
    assert len(rows) == 6
    assert rows["020288-TP01"].social_security_number is None
    hidden = rows["180476-998M"]
    assert (hidden.street_address, hidden.postal_code, hidden.post_office) == ("", "", "")
    assert hidden.phone == "0222222222" and hidden.backup_phone == ""
    assert rows["010619A9501"].phone == "222-2222222" and rows["010619A9501"].backup_phone == "222-2222223"
    assert rows["010619A9501"].date_of_birth == D(2019, 6, 1) and rows["020967-9992"].language == "fi"
    assert rows["020967-9992"].last_name == "Authentic" and rows["020967-9992"].first_name == "Aimo"
    assert rows["181101A9092"].last_name == "" and rows["181101A9092"].phone == ""


def test_child_links(result):
    kids = sorted((r.child_ssn, r.start_date, r.end_date) for r in result["mig_fridge_child"].collect())
    assert kids == [("010619A9501", D(2020, 12, 1), D(2037, 5, 31)),
                    ("251118A9509", D(2019, 11, 25), D(2020, 11, 30)),
                    ("251118A9509", D(2020, 12, 1), D(2036, 11, 24))]
    assert result["mig_fridge_child_todo"].count() == 0


def test_partnerships(result):
    p = sorted((r.legacy_ssn, r.indx, r.start_date, r.end_date) for r in result["mig_fridge_partner"].collect())
    assert p == [("020967-9992", 1, D(2019, 11, 25), D(2020, 11, 30)), ("020967-9992", 1, D(2020, 12, 1), None),
                 ("180476-998M", 2, D(2019, 11, 25), D(2020, 11, 30)), ("180476-998M", 2, D(2020, 12, 1), None)]


def test_income(result):
    inc = {r.person_ssn: r for r in result["mig_income"].collect()}
    aimo = inc["020967-9992"]
    assert aimo.income_total == 506060 and aimo.effect == "INCOME"
    data = {k: (v.amount, v.coefficient) for k, v in aimo.data.items()}
    assert data == {"MAIN_INCOME": (450060, "MONTHLY_NO_HOLIDAY_BONUS"),
                    "OTHER_INCOME": (56000, "MONTHLY_NO_HOLIDAY_BONUS"),
                    "PAID_ALIMONY": (21500, "MONTHLY_NO_HOLIDAY_BONUS"),
                    "DAILY_ALLOWANCE": (1000, "DAILY_ALLOWANCE_21_5")}
    hilda = inc["180476-998M"]
    assert {k: v.amount for k, v in hilda.data.items()} == {"MAIN_INCOME": 5000000}


def test_placements_and_service_needs(result):
    pl = {r.legacy_placement_nbr: r for r in result["mig_placement"].collect()}
    assert sorted(pl) == [11, 12, 13]
    assert pl[11].end_date == D(2021, 2, 28) and pl[12].end_date == D(2025, 7, 31) and pl[13].end_date == D(2020, 12, 31)
    assert pl[13].type == "DAYCARE_PART_TIME" and pl[11].type == "DAYCARE"
    assert pl[11].unit_id == U1 and pl[13].unit_id == U2
    assert pl[11].daycare_group_id is not None and pl[13].daycare_group_id is None
    todo = sorted((r.legacy_placement_nbr, r.reason, r.end_date) for r in result["mig_placement_todo"].collect())
    assert todo == [(14, "OVERLAPPING PLACEMENT", D(2021, 12, 31)), (15, "OVERLAPPING PLACEMENT", D(2024, 7, 31))]
    sn = sorted((r.legacy_placement_nbr, r.legacy_extent_nbr, r.option_id, r.end_date)
                for r in result["mig_service_need"].collect())
    assert sn == [(11, 1, OPT_FULL, D(2021, 2, 28)), (13, 2, OPT_PART, D(2020, 12, 31))]


def test_cleanup_drops_unused_group(result):
    removed = [r.legacy_id for r in result["mig_daycare_group_removed"].collect()]
    assert removed == [1251]
    assert [r.legacy_id for r in result["mig_daycare_group"].collect()] == [1231]


def test_daily_journals(result):
    ab = [(r.date, r.care_type, r.absence_type, r.legacy_dailyjournalids) for r in result["mig_absence"].collect()]
    assert ab == [(D(2020, 3, 9), "DAYCARE", "SICKLEAVE", [123456])]
    todo = [(r.date, r.reason) for r in result["mig_absence_todo"].collect()]
    assert todo == [(D(2020, 3, 24), "TYPE MISSING")]
    bc = sorted((r.start_date, r.end_date, r.unit_id) for r in result["mig_backup_care"].collect())
    assert bc == [(D(2020, 3, 15), D(2020, 3, 17), U1), (D(2020, 3, 19), D(2020, 3, 19), U1)]


def test_applications(result):
    app = result["mig_application"].collect()
    assert [(r.type, r.status, r.sentdate, r.duedate, r.transferapplication) for r in app] == [
        ("DAYCARE", "SENT", D(2021, 8, 1), D(2021, 11, 29), False)]
    assert app[0].guardian_id is not None
    form = result["mig_application_form"].collect()
    assert [(r.legacy_priority, r.unit_id, r.service_need_option_id, r.preferred_start_date) for r in form] == [
        (1, U1, OPT_FULL, D(2021, 9, 1))]


def test_fee_deviations(result):
    fa = [(r.type, r.notes, r.amount, r.is_absolute, r.valid_from) for r in result["mig_fee_alteration"].collect()]
    assert fa == [("DISCOUNT", "ALENNUS AP/IP", 10, True, D(2020, 3, 1))]


def test_voucher_decisions(result):
    d = result["mig_voucher_value_decision"].collect()
    assert len(d) == 1 and result["mig_voucher_value_decision_todo"].count() == 0
    r = d[0]
    assert (r.status, r.status_group, r.voucher_value, r.final_co_payment, r.family_size) == ("SENT", "APPROVED", 1000, 100, 5)
    assert r.placement_unit_id == U1 and r.service_need_option_id == OPT_FULL and r.valid_to is None
    assert r.head_of_family_id is not None and r.partner_id is not None


def test_pay_decisions(result):
    import json
    fd = result["mig_fee_decision"].collect()
    assert len(fd) == 1 and result["mig_fee_decision_todo"].count() == 0
    r = fd[0]
    assert (r.status, r.status_group, r.family_size, r.decision_number, r.end_date) == ("SENT", "SENT", 2, 123456790, None)
    head = json.loads(r.head_of_family_income)
    assert head["effect"] == "INCOME" and head["data"] == {"MAIN_INCOME": 10020} and head["total"] == 10020
    assert head["validFrom"] is None and head["worksAtECHA"] is False
    partner = json.loads(r.partner_income)
    assert partner["effect"] == "MAX_FEE_ACCEPTED" and partner["data"] == {} and partner["total"] == 0
    kids = result["mig_fee_decision_child"].collect()
    assert [(k.fee, k.placement_unit_id, k.service_need_option_id, k.child_date_of_birth) for k in kids] == [
        (49200, U1, OPT_FULL, D(2019, 6, 1))]


def test_assistance(result):
    need = [(r.legacy_ssn, r.start_date, r.end_date, r.bases) for r in result["mig_assistance_need"].collect()]
    assert need == [("010619A9501", D(2019, 8, 8), D(2020, 5, 31), ["DEVELOPMENTAL_DISABILITY"])]
    act = [(r.start_date, r.end_date, r.actions) for r in result["mig_assistance_action"].collect()]
    assert act == [(D(2019, 8, 8), D(2020, 5, 31), ["10"])]


def test_timestamps(result):
    att = result["mig_child_attendance"].collect()
    assert [(r.arrived, r.departed, r.unit_id) for r in att] == [
        (dt.datetime(2021, 1, 1, 5, 26), dt.datetime(2021, 1, 1, 14, 17), U2)]


@pytest.fixture(scope="module")
def target(spark, result):
    dims = dict(result)
    dims["service_need_option"] = spark.createDataFrame(
        [(OPT_FULL, "Kokopäiväinen", "Heldag", "Full", "DAYCARE", 1.0, "Kokopäiväinen", "Kokopäiväinen", 1.0,
          "Kokopäiväinen", "Kokopäiväinen"),
         (OPT_PART, "Osapäiväinen", "Deldag", "Part", "DAYCARE_PART_TIME", 0.6, "Osa", "Del", 0.6, "Osa", "Del")],
        "id string, name_fi string, name_sv string, name_en string, valid_placement_type string, "
        "fee_coefficient double, fee_description_fi string, fee_description_sv string, "
        "voucher_value_coefficient double, voucher_value_description_fi string, voucher_value_description_sv string")
    dims["voucher_value"] = spark.createDataFrame(
        [("vv1", (D(2020, 3, 1), None), 82600, 1.55)],
        "id string, validity struct<lower:date,upper:date>, base_value int, age_under_three_coefficient double")
    dims.update(inputs.empty(spark, "fee_thresholds", "evaka_unit_manager", "evaka_daycare", "daycare_oid_map"))
    return dims


def test_transfer_voucher_and_fee_decisions(target):
    import json
    from registrar.plans import transfer as X
    v = X.voucher_value_decisions(target)["voucher_value_decision"].collect()
    assert len(v) == 1
    r = v[0]
    assert json.loads(r.fee_thresholds) == {"minIncomeThreshold": None, "maxIncomeThreshold": None,
                                            "incomeMultiplier": None, "maxFee": None, "minFee": None}
    assert (r.base_value, float(r.age_coefficient), r.placement_type) == (82600, 1.55, "DAYCARE")
    assert r.service_need_voucher_value_description_fi == "Kokopäiväinen" and r.voucher_value == 1000
    fd = X.fee_decisions(target)
    row = fd["fee_decision"].collect()[0]
    assert row.valid_during_text == "[2020-03-01,)" and row.valid_during.upper is None
    kid = fd["fee_decision_child"].collect()[0]
    assert kid.placement_type == "DAYCARE" and kid.fee == 49200


def test_transfer_application_document(target):
    import json
    from registrar.plans import transfer as X
    out = X.applications(target)
    assert out["application"].collect()[0].origin == "ELECTRONIC"
    doc = json.loads(out["application_form"].collect()[0].document)
    assert doc["type"] == "DAYCARE" and doc["apply"]["preferredUnits"] == [U1]
    assert doc["serviceNeedOption"]["id"] == OPT_FULL and doc["preferredStartDate"] == "2021-09-01"
    assert doc["child"]["socialSecurityNumber"] == "010619A9501" and doc["child"]["nationality"] == "FI"
    assert doc["guardian"]["lastName"] == "Authentic" and doc["guardian2"] is None


def test_transfer_placements_groups(target):
    from registrar.plans import transfer as X
    out = X.placements(target)
    synth = out["daycare_group"].collect()
    assert [(g.daycare_id, g.name, g.start_date, g.end_date) for g in synth] == [(U2, "Ryhmä", D(2020, 3, 1), D(2020, 12, 31))]
    gp = out["daycare_group_placement"].collect()
    assert len(gp) == 3 and all(g.daycare_group_id is not None for g in gp)
    assert out["child"].count() == 2


def test_publish_all_is_idempotent_for_conflicting_tables(spark, target, tmp_path):
    from registrar.plans import transfer as X
    first = X.publish_all(target, str(tmp_path / "target"))
    assert first["persons"]["person"] == 6 and first["placements"]["placement"] == 3
    assert first["departments"]["daycare_caretaker"] == 1
    again = X.persons({**target, "person": published(spark, str(tmp_path / "target"), "person")})
    assert again["person"].count() == 0


def test_audit_user_created_once_and_reused(spark, target):
    from registrar.plans import transfer as X
    made = X.audit_user(target)[X.USER_TABLE].collect()
    assert len(made) == 1 and made[0].name == "Effica"
    existing = spark.createDataFrame([("u-1", "UNKNOWN", "Effica")], X.USER_SCHEMA)
    t2 = {**target, X.USER_TABLE: existing}
    assert X.audit_user(t2)[X.USER_TABLE].count() == 0
    rows = X.income(t2)["income"].select("updated_by").distinct().collect()
    assert [r.updated_by for r in rows] == ["u-1"]


def test_transfer_assistance_registers_and_external_ids(spark, target):
    from registrar.plans import transfer as X
    opts = spark.createDataFrame([("b1", "DEVELOPMENTAL_DISABILITY"), ("b2", "OTHER")], X.OPTION_SCHEMA)
    acts = spark.createDataFrame([("a1", "10")], X.OPTION_SCHEMA)
    t = {**target, "assistance_basis_option": opts, "assistance_action_option": acts,
         "child": spark.createDataFrame([], "id string")}
    need = X.assistance_needs(t)
    assert need["assistance_need"].count() == 1 and need["child"].count() == 1
    assert [r.option_id for r in need["assistance_basis_option_ref"].collect()] == ["b1"]
    act = X.assistance_actions(t)
    assert [r.option_id for r in act["assistance_action_option_ref"].collect()] == ["a1"]
    ab = X.absences(t)
    assert ab["absence"].count() == 1 and ab["child"].count() == 1
    existing_child = ab["child"]
    again = X.absences({**t, "child": existing_child})
    assert again["child"].count() == 0
    assert X.backup_cares(t)["backup_care"].count() == 2
    assert X.attendances(t)["child_attendance"].count() == 1
    daycare = spark.createDataFrame([(U1, None, None), (U2, None, None)],
                                    "id string, oph_unit_oid string, oph_organizer_oid string")
    oid = spark.createDataFrame([(U1, "1.2.3", "9.9", 77, None), (U2, "4.5.6", "9.9", None, None)],
                                "evaka_id string, unit_oid string, organizer_oid string, varda_unit_id int, name string")
    ext = X.unit_external_ids({**t, "daycare": daycare, "daycare_oid_map": oid})
    assert sorted((r.id, r.oph_unit_oid) for r in ext["daycare"].collect()) == [(U1, "1.2.3"), (U2, "4.5.6")]
    v = ext["varda_unit"].collect()
    assert [(r.evaka_daycare_id, r.varda_unit_id) for r in v] == [(U1, 77)]
    import datetime as _dt
    assert v[0].uploaded_at.year <= _dt.datetime.now().year - 19


def test_cli_end_to_end(spark, tmp_path):
    import os
    from registrar import cli
    base = tmp_path / "in"
    base.mkdir()
    with open(base / "persons.xml", "w", encoding="utf-8") as f:
        f.write(_xml("person", PERSONS))
    with open(base / "codes.xml", "w", encoding="utf-8") as f:
        f.write(_xml("item", CODES))
    rc = cli.main(["--input", str(base), "--target", str(tmp_path / "target"), "--work", str(tmp_path / "work"), "--jobs", "persons"])
    assert rc == 0
    assert published(spark, str(tmp_path / "target"), "person").count() == 6
    assert cli.main(["--input", str(base), "--target", str(tmp_path / "t3"), "--jobs", "persons,families"]) == 2  # no family rows
    assert cli.main(["--input", str(base), "--target", str(tmp_path / "t3"), "--jobs", "person"]) == 2  # no such job
    assert not (tmp_path / "t3").exists()
    bad = tmp_path / "bad"
    bad.mkdir()
    with open(bad / "notatable.xml", "w", encoding="utf-8") as f:
        f.write("<x><a>1</a></x>\n")
    assert cli.main(["--input", str(bad), "--target", str(tmp_path / "t2")]) == 2


def test_constraint_checks_are_empty_on_clean_fixtures(result):
    for name in ["mig_person_violations", "mig_placement_violations", "mig_application_violations",
                 "mig_voucher_value_decision_violations", "mig_fee_decision_violations",
                 "mig_fridge_partner_violations"]:
        assert result[name].count() == 0, name


def test_cli_loads_dimensions(spark, tmp_path):
    from registrar import cli
    base = tmp_path / "in"
    base.mkdir()
    for table, element, rows in [("persons", "person", PERSONS), ("placements", "placement", PLACEMENTS), ("codes", "item", CODES),
                                 ("departments", "department", DEPARTMENTS), ("placementextents", "placementextent", EXTENTS)]:
        with open(base / f"{table}.xml", "w", encoding="utf-8") as f:
            f.write(_xml(element, rows))
    for table in ("unitmap", "childmindermap", "extentmap"):
        with open(base / f"{table}.csv", "w", encoding="utf-8") as f:
            f.write(CSV[table])
    dims = tmp_path / "dims"
    spark.createDataFrame([(OPT_FULL, "full", "DAYCARE", 1.0), (OPT_PART, "part", "DAYCARE_PART_TIME", 0.6)],
                          "id string, name_fi string, valid_placement_type string, fee_coefficient double"
                          ).write.parquet(str(dims / "service_need_option"))
    args = ["--input", str(base), "--jobs", "persons,departments,placements,service_needs", "--target", str(tmp_path / "target"),
            "--work", str(tmp_path / "work")]
    assert cli.main(args) == 2  # placement types need the options
    assert cli.main([*args, "--dims", str(dims)]) == 0
    types = {r.type for r in published(spark, str(tmp_path / "target"), "placement").collect()}
    assert "DAYCARE_PART_TIME" in types
