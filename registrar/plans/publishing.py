"""Queries over the publishing jobs X1-X17, every column of every output.

The reconciled tables that a job reads are derived from the star-schema test
tables, whole, with repeated keys, missing parts and rows that the target has
already. A query stacks its job's outputs: the target's name, the names of its
columns, and the row's values as text (``~`` for NULL, ``set`` for the batch
time, which differs between runs).
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..operators import identity as ident
from ..operators import lookup
from . import transfer
from .registry import query, read_table
from .star import (ORDER_IV, _fee_threshold_dim, _pick_sql, _threshold_values_sql, _uuid_keys_sql, order_intervals)

BATCH_TIMES = {"updated_at", "uploaded_at"}


def u(kind: str, *keys: str) -> str:
    return _uuid_keys_sql(kind, *keys)


def _text(f) -> Column:
    c = F.col(f"`{f.name}`")
    if f.name in BATCH_TIMES:
        return F.when(c.isNotNull(), "set")
    if isinstance(f.dataType, ArrayType):
        return F.when(c.isNotNull(), F.array_join(c.cast("array<string>"), ","))
    if isinstance(f.dataType, StructType):
        return F.when(c.isNotNull(), F.concat_ws("..", *[F.coalesce(c[x.name].cast("string"), F.lit("")) for x in f.dataType]))
    return c.cast("string")


def stacked(outputs: Mapping[str, DataFrame]) -> DataFrame:
    out = None
    for name, df in outputs.items():
        part = df.select(F.lit(name).alias("target"), F.lit(",".join(df.columns)).alias("columns"),
                         F.concat_ws("|", *[F.coalesce(_text(f), F.lit("~")) for f in df.schema]).alias("row_text"))
        out = part if out is None else out.unionByName(part)
    return out


def rows_sql(target: str, columns: Mapping[str, str], source: str) -> str:
    values = ", ".join(f"COALESCE(CAST({e} AS VARCHAR), '~')" for e in columns.values())
    return f"SELECT '{target}' AS target, '{','.join(columns)}' AS columns, concat_ws('|', {values}) AS row_text {source}"


def key(kind: str, *cols) -> Column:
    return ident.hash_uuid(kind, *cols)


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_intervals(spark, sf_dir)


def _children(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target's child register: every sixth customer."""
    return (read_table(spark, sf_dir, "customer").where(F.col("c_custkey") % 6 == 0).select(key("PERSON", "c_custkey").alias("id")))


def _users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users of the target, some of them batch users."""
    return read_table(spark, sf_dir, "supplier").select(
        key("USER", "s_suppkey").alias("id"), F.when(F.col("s_suppkey") % 3 == 0, "EMPLOYEE").otherwise("UNKNOWN").alias("type"),
        F.when(F.col("s_suppkey") % 4 == 0, transfer.AUDIT_USER_NAME).otherwise(F.col("s_name")).alias("name"))


BATCH_USER = f"(SELECT MIN({u('USER', 's_suppkey')}) FROM supplier WHERE s_suppkey % 3 <> 0 AND s_suppkey % 4 = 0)"
CHILD = u("PERSON", "o_custkey")


def register_sql(source: str, child: str = CHILD) -> str:
    """New rows of the child register from the ids ``child`` of ``source``."""
    return rows_sql("child", {"id": "id"}, f"FROM (SELECT DISTINCT {child} AS id FROM {source}) WHERE id IS NOT NULL "
                    f"AND id NOT IN (SELECT {u('PERSON', 'c_custkey')} FROM customer WHERE c_custkey % 6 = 0)")


# ------------------------------------------------------------------ X1, X2

PERSON_COLUMNS = {
    "id": "id", "social_security_number": "ssn", "last_name": "c_name", "first_name": "c_mktsegment", "email": "email",
    "language": "'fi'", "street_address": "'Street 1'", "postal_code": "'00100'", "post_office": "'Town'",
    "restricted_details_enabled": "c_acctbal < 0", "phone": "'040'", "backup_phone": "''", "date_of_birth": "dob",
    "updated_from_vtj": f"'{transfer.REGISTRY_UPDATED_AT}'", "vtj_guardians_queried": "NULL", "vtj_dependants_queried": "NULL"}
PERSON_SQL = f"""
p AS (SELECT c.*, {u('PERSON', 'c_custkey')} AS id, CASE WHEN c_custkey % 9 <> 0 THEN 'S' || CAST(c_custkey // 2 AS VARCHAR) END AS ssn,
             CASE WHEN c_custkey % 4 <> 0 THEN lower(c_name) END AS email, DATE '1990-01-01' + CAST(c_custkey % 9000 AS INTEGER) AS dob
      FROM customer c)"""


def _persons(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return read_table(spark, sf_dir, "customer").select(
        key("PERSON", "c_custkey").alias("id"),
        F.when(k % 9 != 0, F.concat(F.lit("S"), F.floor(k / 2).cast("string"))).alias("social_security_number"),
        F.col("c_name").alias("last_name"), F.col("c_mktsegment").alias("first_name"),
        F.when(k % 4 != 0, F.lower("c_name")).alias("email"), F.lit("fi").alias("language"), F.lit("Street 1").alias("street_address"),
        F.lit("00100").alias("postal_code"), F.lit("Town").alias("post_office"),
        F.when(k % 5 != 0, F.array(F.lit("SE"))).otherwise(F.array().cast("array<string>")).alias("nationalities"),
        (F.col("c_acctbal") < 0).alias("restricted_details_enabled"), F.lit("040").alias("phone"), F.lit("").alias("backup_phone"),
        F.date_add(F.lit("1990-01-01").cast("date"), (k % 9000).cast("int")).alias("date_of_birth"))


@query("publish_persons_job", sql=f"""
WITH {PERSON_SQL},
ex AS (SELECT {u('EXISTING', 'c_custkey')} AS id, 'S' || CAST(c_custkey // 2 AS VARCHAR) AS ssn FROM customer WHERE c_custkey % 10 = 1
       UNION ALL SELECT {u('PERSON', 'c_custkey')}, NULL FROM customer WHERE c_custkey % 14 = 0),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY ssn ORDER BY id) AS k FROM p
      WHERE ssn NOT IN (SELECT ssn FROM ex WHERE ssn IS NOT NULL))
{rows_sql('person', PERSON_COLUMNS, '''FROM (SELECT * EXCLUDE (k) FROM n WHERE k = 1 UNION ALL SELECT * FROM p WHERE ssn IS NULL)
WHERE id NOT IN (SELECT id FROM ex)''')}""")
def publish_persons_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    c, k = read_table(spark, sf_dir, "customer"), F.col("c_custkey")
    existing = (c.where(k % 10 == 1).select(key("EXISTING", "c_custkey").alias("id"),
                                            F.concat(F.lit("S"), F.floor(k / 2).cast("string")).alias("social_security_number"))
                .unionByName(c.where(k % 14 == 0).select(key("PERSON", "c_custkey").alias("id"),
                                                         F.lit(None).cast("string").alias("social_security_number"))))
    return stacked(transfer.persons({"mig_person": _persons(spark, sf_dir), "person": existing}))


@query("publish_families_job", sql=f"""
WITH {ORDER_IV}
{rows_sql('fridge_child', {'child_id': CHILD, 'head_of_child': u('PERSON', 'o_orderkey % 1000'), 'start_date': 'start_date',
                           'end_date': 'end_date', 'conflict': 'false'}, 'FROM iv')}
UNION ALL
{rows_sql('fridge_partner', {'partnership_id': u('PARTNERSHIP', 'o_orderkey'), 'indx': '1 + o_orderkey % 2', 'person_id': CHILD,
                             'start_date': 'start_date', 'end_date': 'end_date', 'conflict': 'false'}, 'FROM iv')}""")
def publish_families_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    o, person = _orders(spark, sf_dir), key("PERSON", "o_custkey")
    return stacked(transfer.families({
        "mig_fridge_child": o.select(person.alias("child_id"), key("PERSON", F.col("o_orderkey") % 1000).alias("head_of_family"),
                                     "start_date", "end_date"),
        "mig_fridge_partner": o.select(key("PARTNERSHIP", "o_orderkey").alias("partnership_id"), (1 + F.col("o_orderkey") % 2).alias("indx"),
                                       person.alias("person_id"), "start_date", "end_date")}))


# ------------------------------------------------------------------ X3, X4

SOME_CHILD = f"CASE WHEN o_custkey % 20 <> 0 THEN {CHILD} END"
# Fixed values for the queries: listed values by order key % 4 (B9 has no option).
LISTS = (("B0",), ("B1", "B2"), (), ("B3", "B9"))
LISTS_SQL = "CASE o_orderkey % 4 " + " ".join(f"WHEN {i} THEN [{', '.join(repr(v) for v in vs)}]::VARCHAR[]" for i, vs in enumerate(LISTS)) + " END"


def _assistance_sql(kind: str, target: str, ref: str, ref_key: str) -> str:
    return f"""
WITH {ORDER_IV}, op AS (SELECT {u('OPTION', 'r_regionkey')} AS option_id, 'B' || CAST(r_regionkey AS VARCHAR) AS v FROM region),
l AS (SELECT {u(kind, 'o_orderkey')} AS rid, unnest({LISTS_SQL}) AS v FROM iv)
{register_sql('iv', SOME_CHILD)}
UNION ALL
{rows_sql(target, {'id': u(kind, 'o_orderkey'), 'updated_by': BATCH_USER, 'child_id': SOME_CHILD, 'start_date': 'start_date',
                   'end_date': 'end_date'}, 'FROM iv')}
UNION ALL
{rows_sql(ref, {ref_key: 'rid', 'option_id': 'option_id'}, 'FROM l JOIN op ON op.v = l.v')}"""


def _assistance(spark: SparkSession, sf_dir: str, kind: str, values: str, source: str, options: str) -> dict[str, DataFrame]:
    lists = F.lit(None).cast("array<string>")
    for i, vs in enumerate(LISTS):
        lists = F.when(F.col("o_orderkey") % 4 == i, F.array(*[F.lit(v) for v in vs]).cast("array<string>")).otherwise(lists)
    src = _orders(spark, sf_dir).select(key(kind, "o_orderkey").alias("id"), "start_date", "end_date", lists.alias(values),
                                        F.when(F.col("o_custkey") % 20 != 0, key("PERSON", "o_custkey")).alias("child_id"))
    opts = read_table(spark, sf_dir, "region").select(key("OPTION", "r_regionkey").alias("id"),
                                                      F.concat(F.lit("B"), F.col("r_regionkey").cast("string")).alias("value"))
    return {source: src, options: opts, "child": _children(spark, sf_dir), "evaka_user": _users(spark, sf_dir)}


@query("publish_assistance_needs_job", sql=_assistance_sql("NEED", "assistance_need", "assistance_basis_option_ref", "need_id"))
def publish_assistance_needs_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stacked(transfer.assistance_needs(_assistance(spark, sf_dir, "NEED", "bases", "mig_assistance_need", "assistance_basis_option")))


@query("publish_assistance_actions_job", sql=_assistance_sql("ACTION", "assistance_action", "assistance_action_option_ref", "action_id"))
def publish_assistance_actions_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stacked(transfer.assistance_actions(_assistance(spark, sf_dir, "ACTION", "actions", "mig_assistance_action", "assistance_action_option")))


# ------------------------------------------------------------------ X5, X10

@query("publish_income_job", sql=f"""
WITH {ORDER_IV}
{rows_sql('income', {'id': u('INCOME', 'o_orderkey'), 'person_id': CHILD,
                     'data': """'{"MAIN_INCOME":{"amount":' || CAST(o_orderkey AS VARCHAR) || ',"coefficient":"' || o_orderstatus || '"}}'""",
                     'effect': 'o_orderpriority', 'valid_from': 'start_date', 'valid_to': 'end_date', 'updated_at': "'set'",
                     'updated_by': BATCH_USER, 'notes': "''", 'is_entrepreneur': 'false', 'application_id': 'NULL'}, 'FROM iv')}""")
def publish_income_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    entry = F.struct(F.col("o_orderkey").alias("amount"), F.col("o_orderstatus").alias("coefficient"))
    inc = _orders(spark, sf_dir).select(
        key("INCOME", "o_orderkey").alias("id"), key("PERSON", "o_custkey").alias("person_id"),
        F.create_map(F.lit("MAIN_INCOME"), entry).alias("data"), F.col("o_orderpriority").alias("effect"),
        F.col("start_date").alias("valid_from"), F.col("end_date").alias("valid_to"))
    return stacked(transfer.income({"mig_income": inc, "evaka_user": _users(spark, sf_dir)}))


@query("publish_fee_alterations_job", sql="WITH x AS (SELECT * FROM lineitem)\n" + rows_sql("fee_alteration", {
    "id": u("FEE_ALTERATION", "l_orderkey", "l_linenumber"), "person_id": u("PERSON", "l_suppkey"),
    "type": "CASE WHEN l_returnflag = 'R' THEN 'RELIEF' ELSE 'DISCOUNT' END", "amount": "CAST(l_quantity AS INTEGER)",
    "is_absolute": "l_linestatus = 'F'", "valid_from": "CAST(l_shipdate AS DATE)", "valid_to": "NULL", "notes": "l_returnflag",
    "updated_at": "'set'", "updated_by": u("EMPLOYEE", f"'{transfer.AUDIT_USER_NAME}'")}, "FROM x"))
def publish_fee_alterations_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    fa = read_table(spark, sf_dir, "lineitem").select(
        key("FEE_ALTERATION", "l_orderkey", "l_linenumber").alias("id"), key("PERSON", "l_suppkey").alias("person_id"),
        F.when(F.col("l_returnflag") == "R", "RELIEF").otherwise("DISCOUNT").alias("type"),
        F.col("l_quantity").cast("int").alias("amount"), (F.col("l_linestatus") == "F").alias("is_absolute"),
        F.to_date("l_shipdate").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.col("l_returnflag").alias("notes"))
    return stacked(transfer.fee_alterations({"mig_fee_alteration": fa}))  # no user yet: the batch user's own id


# ------------------------------------------------------------ X6, X7, X8, X17

UNIT = u("UNIT", "s_suppkey")
# columns of a unit: its value in SQL, in the order of the target
UNIT_COLUMNS = {
    "id": UNIT, "name": "s_name", "type": "CASE WHEN s_suppkey % 6 = 0 THEN 'CENTRE,CASTLE' WHEN s_suppkey % 6 <> 1 THEN 'CENTRE,PRESCHOOL' END",
    "care_area_id": u("AREA", "s_nationkey"), "phone": "'040'", "url": "NULL", "backup_location": "''", "language_emphasis_id": "NULL",
    "opening_date": "DATE '2001-01-01' + CAST(s_suppkey AS INTEGER)", "closing_date": "NULL", "email": "lower(s_name)", "schedule": "NULL",
    "additional_info": "NULL", "unit_manager_id": u("MANAGER", "s_nationkey"), "cost_center": "CAST(s_nationkey AS VARCHAR)",
    "upload_to_varda": "s_suppkey % 2 = 0", "capacity": "0", "decision_daycare_name": "s_name", "decision_preschool_name": "''",
    "decision_handler": "''", "decision_handler_address": "''", "street_address": "'Street 1'", "postal_code": "'00100'",
    "post_office": "'Town'", "mailing_po_box": "NULL", "location": "'(1,2)'", "mailing_street_address": "NULL",
    "mailing_postal_code": "NULL", "mailing_post_office": "NULL", "invoiced_by_municipality": "s_suppkey % 3 = 0",
    "provider_type": "CASE WHEN s_suppkey % 10 = 0 THEN 'CHURCH' WHEN s_suppkey % 10 <> 1 THEN 'MUNICIPAL' END",
    "language": "CASE WHEN s_suppkey % 15 = 0 THEN 'en' ELSE 'sv' END", "upload_to_koski": "true", "oph_unit_oid": "NULL",
    "oph_organizer_oid": "NULL", "operation_days": "'1,2,3'", "ghost_unit": "false", "daycare_apply_period": "'[2020-01-01,)'",
    "preschool_apply_period": "NULL", "club_apply_period": "NULL", "finance_decision_handler": "NULL",
    "round_the_clock": "s_suppkey % 4 = 0", "enabled_pilot_features": "''", "upload_children_to_varda": "false"}
VIOLATION = {"constraint_name": "name", "key_text": UNIT, "n_rows": "1"}


def _broken(name: str, cond: str) -> str:
    return rows_sql("daycare_violations", {**VIOLATION, "constraint_name": f"'{name}'"}, f"FROM supplier WHERE {cond}")


@query("publish_units_job", sql="\nUNION ALL\n".join([
    rows_sql("unit_manager", {"id": u("MANAGER", "n_nationkey"), "name": "n_name", "email": "NULL", "phone": "'050'"}, "FROM nation"),
    rows_sql("daycare", UNIT_COLUMNS, "FROM supplier"),
    _broken("check:type", "s_suppkey % 6 = 0"), _broken("values:provider_type", "s_suppkey % 10 = 0"),
    _broken("values:language", "s_suppkey % 15 = 0"),
    rows_sql("daycare_group", {"id": u("GROUP", "s_suppkey"), "daycare_id": UNIT, "name": "s_name", "start_date": "DATE '2001-01-01'",
                               "end_date": "CASE WHEN s_suppkey % 2 = 0 THEN DATE '2021-12-31' END"}, "FROM supplier"),
    rows_sql("daycare_caretaker", {"group_id": u("GROUP", "s_suppkey"), "amount": "3", "start_date": "DATE '2001-01-01'",
                                   "end_date": "CASE WHEN s_suppkey % 2 = 0 THEN DATE '2021-12-31' END"}, "FROM supplier"),
    rows_sql("evaka_user", {"id": u("EMPLOYEE", f"'{transfer.AUDIT_USER_NAME}'"), "type": "'UNKNOWN'", "name": f"'{transfer.AUDIT_USER_NAME}'"}, "")]))
def publish_units_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X6-X8 and the batch user (I3), which no user of the target is yet."""
    s, k, none = read_table(spark, sf_dir, "supplier"), F.col("s_suppkey"), F.lit(None).cast("string")
    kinds = F.when(k % 6 == 0, F.array(F.lit("CENTRE"), F.lit("CASTLE"))).when(k % 6 != 1, F.array(F.lit("CENTRE"), F.lit("PRESCHOOL")))
    units = s.select(
        key("UNIT", "s_suppkey").alias("id"), F.col("s_name").alias("name"), kinds.alias("type"), key("AREA", "s_nationkey").alias("care_area_id"),
        F.lit("040").alias("phone"), F.lit("").alias("backup_location"),
        F.date_add(F.lit("2001-01-01").cast("date"), k.cast("int")).alias("opening_date"), F.lit(None).cast("date").alias("closing_date"),
        F.lower("s_name").alias("email"), key("MANAGER", "s_nationkey").alias("unit_manager_id"),
        F.col("s_nationkey").cast("string").alias("cost_center"), (k % 2 == 0).alias("upload_to_varda"),
        F.col("s_name").alias("decision_daycare_name"), F.lit("").alias("decision_preschool_name"), F.lit("Street 1").alias("street_address"),
        F.lit("00100").alias("postal_code"), F.lit("Town").alias("post_office"), F.lit("(1,2)").alias("location"),
        *[none.alias(c) for c in ("url", "schedule", "additional_info", "mailing_po_box", "mailing_street_address", "mailing_postal_code",
                                  "mailing_post_office", "preschool_apply_period")],
        (k % 3 == 0).alias("invoiced_by_municipality"), F.when(k % 10 == 0, "CHURCH").when(k % 10 != 1, "MUNICIPAL").alias("provider_type"),
        F.when(k % 15 == 0, "en").otherwise("sv").alias("language"), F.lit(True).alias("upload_to_koski"),
        F.array(F.lit(1), F.lit(2), F.lit(3)).alias("operation_days"), F.lit(False).alias("ghost_unit"),
        F.lit("[2020-01-01,)").alias("daycare_apply_period"), (k % 4 == 0).alias("round_the_clock"))
    groups = s.select(key("GROUP", "s_suppkey").alias("id"), key("UNIT", "s_suppkey").alias("daycare_id"), F.col("s_name").alias("name"),
                      F.lit("2001-01-01").cast("date").alias("start_date"),
                      F.when(k % 2 == 0, F.lit("2021-12-31").cast("date")).alias("end_date"))
    managers = read_table(spark, sf_dir, "nation").select(key("MANAGER", "n_nationkey").alias("id"), F.col("n_name").alias("name"),
                                                          none.alias("email"), F.lit("050").alias("phone"))
    users = _users(spark, sf_dir).where(F.col("type") == "EMPLOYEE")
    return stacked({**transfer.unit_managers({"evaka_unit_manager": managers}), **transfer.daycares({"evaka_daycare": units}),
                    **transfer.departments({"mig_daycare_group": groups}), **transfer.audit_user({"evaka_user": users})})


@query("publish_unit_external_ids_job", sql=f"""
WITH m AS (SELECT s_suppkey AS k, 'u' || CAST(s_suppkey AS VARCHAR) AS oid FROM supplier WHERE s_suppkey % 3 <> 0
           UNION ALL SELECT s_suppkey, 'a' || CAST(s_suppkey AS VARCHAR) FROM supplier WHERE s_suppkey % 12 = 4),
g AS (SELECT k, MIN(oid) AS oid FROM m GROUP BY k)
{rows_sql('daycare', {'id': UNIT, 'oph_unit_oid': "CASE WHEN g.k IS NOT NULL THEN g.oid ELSE 'old' END",
                      'oph_organizer_oid': "CASE WHEN g.k IS NULL THEN 'old' END"}, 'FROM supplier LEFT JOIN g ON g.k = s_suppkey WHERE s_suppkey % 5 <> 0')}
UNION ALL
{rows_sql('varda_unit', {'evaka_daycare_id': u('UNIT', 'k'), 'varda_unit_id': 'k * 10', 'uploaded_at': "'set'"}, 'FROM m WHERE k % 2 = 0')}""")
def publish_unit_external_ids_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    s, k = read_table(spark, sf_dir, "supplier"), F.col("s_suppkey")

    def oids(letter: str, rows: Column) -> DataFrame:
        return s.where(rows).select(key("UNIT", "s_suppkey").alias("evaka_id"), F.concat(F.lit(letter), k.cast("string")).alias("unit_oid"),
                                    F.lit(None).cast("string").alias("organizer_oid"),
                                    F.when(k % 2 == 0, k * 10).alias("varda_unit_id"))
    units = s.where(k % 5 != 0).select(key("UNIT", "s_suppkey").alias("id"), F.lit("old").alias("oph_unit_oid"),
                                       F.lit("old").alias("oph_organizer_oid"))
    return stacked(transfer.unit_external_ids({"daycare_oid_map": oids("u", k % 3 != 0).unionByName(oids("a", k % 12 == 4)), "daycare": units}))


# ------------------------------------------------------- X9, X14, X15, X16

PLACED_IN = u("UNIT", "o_custkey % 7")
GROUP = f"CASE WHEN o_orderkey % 3 <> 0 THEN {u('GROUP', 'o_orderkey % 50')} END"


@query("publish_placements_all_job", sql=f"""
WITH {ORDER_IV},
p AS (SELECT iv.*, {PLACED_IN} AS unit_id, {GROUP} AS group_id FROM iv),
sg AS (SELECT DISTINCT unit_id, start_date, end_date FROM p WHERE group_id IS NULL)
{register_sql('iv')}
UNION ALL
{rows_sql('placement', {'id': u('PLACEMENT', 'o_orderkey'), 'type': 'o_orderpriority', 'child_id': CHILD, 'unit_id': 'unit_id',
                        'start_date': 'start_date', 'end_date': 'end_date'}, 'FROM p')}
UNION ALL
{rows_sql('service_need', {'id': u('NEED', 'l_orderkey', 'l_linenumber'), 'option_id': u('OPTION', 'l_linenumber'),
                           'placement_id': u('PLACEMENT', 'l_orderkey'), 'start_date': 'CAST(l_shipdate AS DATE)',
                           'end_date': 'CAST(l_shipdate AS DATE) + 30', 'shift_care': 'false'}, 'FROM lineitem')}
UNION ALL
{rows_sql('daycare_group', {'id': u('DAYCARE_GROUP', 'unit_id', 'start_date', 'end_date'), 'daycare_id': 'unit_id',
                            'name': f"'{transfer.SYNTHESISED_GROUP_NAME}'", 'start_date': 'start_date', 'end_date': 'end_date'}, 'FROM sg')}
UNION ALL
{rows_sql('daycare_group_placement', {
    'daycare_placement_id': u('PLACEMENT', 'o_orderkey'),
    'daycare_group_id': "COALESCE(group_id, CASE WHEN end_date IS NOT NULL THEN " + u('DAYCARE_GROUP', 'unit_id', 'start_date', 'end_date') + " END)",
    'start_date': 'start_date', 'end_date': 'end_date'}, 'FROM p')}""")
def publish_placements_all_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X9 with all five outputs; placements with an open end find no group, as their end equals none."""
    o, k = _orders(spark, sf_dir), F.col("o_orderkey")
    pl = o.select(key("PLACEMENT", "o_orderkey").alias("id"), F.col("o_orderpriority").alias("type"), key("PERSON", "o_custkey").alias("child_id"),
                  key("UNIT", F.col("o_custkey") % 7).alias("unit_id"), "start_date", "end_date",
                  F.when(k % 3 != 0, key("GROUP", k % 50)).alias("daycare_group_id"))
    day = F.to_date("l_shipdate")
    sn = read_table(spark, sf_dir, "lineitem").select(
        key("NEED", "l_orderkey", "l_linenumber").alias("id"), key("OPTION", "l_linenumber").alias("option_id"),
        key("PLACEMENT", "l_orderkey").alias("placement_id"), day.alias("start_date"), F.date_add(day, 30).alias("end_date"))
    return stacked(transfer.placements({"mig_placement": pl, "mig_service_need": sn, "child": _children(spark, sf_dir)}))


@query("publish_daily_records_job", sql=f"""
WITH {ORDER_IV}
{register_sql('iv')}
UNION ALL
{rows_sql('absence', {'id': u('ABSENCE', 'o_orderkey'), 'child_id': CHILD, 'date': 'start_date', 'care_type': 'o_orderstatus',
                      'absence_type': 'o_orderpriority', 'modified_by': BATCH_USER}, 'FROM iv')}
UNION ALL
{rows_sql('backup_care', {'id': u('BACKUP', 'o_orderkey'), 'child_id': CHILD, 'unit_id': PLACED_IN, 'group_id': GROUP,
                          'start_date': 'start_date', 'end_date': 'end_date'}, 'FROM iv')}
UNION ALL
{rows_sql('child_attendance', {'id': u('ATTENDANCE', 'o_orderkey'), 'child_id': CHILD,
                               'arrived': "strftime(start_date, '%Y-%m-%d') || ' 08:15:00'",
                               'departed': "CASE WHEN end_date IS NOT NULL THEN strftime(start_date, '%Y-%m-%d') || ' 16:00:00' END",
                               'unit_id': PLACED_IN}, 'FROM iv')}""")
def publish_daily_records_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X14-X16; the child register comes out of each of them alike."""
    o, k = _orders(spark, sf_dir), F.col("o_orderkey")
    child, unit, day = key("PERSON", "o_custkey").alias("child_id"), key("UNIT", F.col("o_custkey") % 7).alias("unit_id"), F.col("start_date")

    def at(clock: str) -> Column:
        return F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(clock)).cast("timestamp")
    given = {"child": _children(spark, sf_dir), "evaka_user": _users(spark, sf_dir)}
    absence = o.select(key("ABSENCE", "o_orderkey").alias("id"), child, day.alias("date"), F.col("o_orderstatus").alias("care_type"),
                       F.col("o_orderpriority").alias("absence_type"))
    backup = o.select(key("BACKUP", "o_orderkey").alias("id"), child, unit, F.when(k % 3 != 0, key("GROUP", k % 50)).alias("group_id"),
                      "start_date", "end_date")
    attended = o.select(key("ATTENDANCE", "o_orderkey").alias("id"), child, at(" 08:15:00").alias("arrived"),
                        F.when(F.col("end_date").isNotNull(), at(" 16:00:00")).alias("departed"), unit)
    return stacked({**transfer.absences({"mig_absence": absence, **given}), **transfer.backup_cares({"mig_backup_care": backup, **given}),
                    **transfer.attendances({"mig_child_attendance": attended, **given})})


# ------------------------------------------------------------ X11, X12

# Fixed values for the queries: voucher values by time.
VOUCHER_VALUES = [("vv-1", "1990-01-01", "1997-06-01", "870", "1.55"), ("vv-2", "1997-06-01", "2000-01-01", "900", "1.60")]
VOUCHER_VALUES_SQL = "vv(lo, hi, base_value, age) AS (VALUES " + ", ".join(
    f"(DATE '{lo}', DATE '{hi}', {base}, CAST('{age}' AS DECIMAL(3,2)))" for _, lo, hi, base, age in VOUCHER_VALUES) + ")"
OPTION_SQL = f"""so AS (SELECT {u('OPTION', 'r_regionkey')} AS sid, r_name AS ptype, CAST('0.8' AS DECIMAL(4,2)) AS fee_co,
              CAST('0.6' AS DECIMAL(4,2)) AS voucher_co, 'fi ' || r_name AS fi, 'sv ' || r_name AS sv, 'en ' || r_name AS en FROM region)"""


def _voucher_values(spark: SparkSession) -> DataFrame:
    v = lookup.literal_dimension(spark, VOUCHER_VALUES, "id string, lo string, hi string, base string, age string")
    return v.select("id", F.struct(F.col("lo").cast("date").alias("lower"), F.col("hi").cast("date").alias("upper")).alias("validity"),
                    F.col("base").cast("int").alias("base_value"), F.col("age").cast("decimal(3,2)").alias("age_under_three_coefficient"))


def _options(spark: SparkSession, sf_dir: str) -> DataFrame:
    def text(lang: str) -> Column:
        return F.concat(F.lit(lang + " "), F.col("r_name"))
    return read_table(spark, sf_dir, "region").select(
        key("OPTION", "r_regionkey").alias("id"), text("fi").alias("name_fi"), text("sv").alias("name_sv"), text("en").alias("name_en"),
        F.col("r_name").alias("valid_placement_type"), F.lit("0.8").cast("decimal(4,2)").alias("fee_coefficient"),
        text("fi").alias("fee_description_fi"), text("sv").alias("fee_description_sv"),
        F.lit("0.6").cast("decimal(4,2)").alias("voucher_value_coefficient"), text("fi").alias("voucher_value_description_fi"),
        text("sv").alias("voucher_value_description_sv"))


def _json_number(name: str, expr: str) -> str:
    return f"""'"{name}":' || COALESCE(CAST({expr} AS VARCHAR), 'null')"""


THRESHOLDS_SQL = "'{' || " + " || ',' || ".join([
    _json_number("minIncomeThreshold", f"CAST(CASE WHEN family_size BETWEEN 2 AND 6 THEN {_pick_sql('mn')} ELSE mn6 + (family_size - 6) * inc END AS BIGINT)"),
    _json_number("maxIncomeThreshold", f"CAST(CASE WHEN family_size BETWEEN 2 AND 6 THEN {_pick_sql('mx')} ELSE mx6 + (family_size - 6) * inc END AS BIGINT)"),
    _json_number("incomeMultiplier", f"CAST(CASE WHEN family_size BETWEEN 2 AND 6 THEN {_pick_sql('mu')} ELSE mu6 END AS DECIMAL(5,4))"),
    _json_number("maxFee", "max_fee"), _json_number("minFee", "min_fee")]) + " || '}'"
AT_START = "ft ON d.start_date >= ft.lo AND (ft.hi IS NULL OR d.start_date < ft.hi)"


@query("publish_voucher_decisions_job", sql=f"""
WITH {ORDER_IV}, {_threshold_values_sql()}, {VOUCHER_VALUES_SQL}, {OPTION_SQL},
d AS (SELECT *, CAST(2 + o_orderkey % 7 AS INTEGER) AS family_size, CAST(o_orderkey % 300 AS INTEGER) AS pay FROM iv)
{rows_sql('voucher_value_decision', {
    'id': u('VOUCHER', 'o_orderkey'), 'status': 'o_orderstatus', 'valid_from': 'start_date', 'valid_to': 'end_date',
    'decision_number': 'o_orderkey', 'head_of_family_id': CHILD, 'partner_id': 'NULL', 'family_size': 'family_size',
    'fee_thresholds': THRESHOLDS_SQL, 'approved_at': 'NULL', 'child_id': u('PERSON', 'o_custkey + 1'),
    'child_date_of_birth': "DATE '1994-01-01'", 'base_co_payment': 'pay', 'sibling_discount': '0', 'placement_unit_id': PLACED_IN,
    'placement_type': 'ptype', 'co_payment': 'pay', 'fee_alterations': "'[]'", 'base_value': 'base_value', 'voucher_value': 'pay * 3',
    'final_co_payment': 'pay', 'service_need_fee_coefficient': 'fee_co', 'service_need_voucher_value_coefficient': 'voucher_co',
    'service_need_fee_description_fi': 'fi', 'service_need_fee_description_sv': 'sv',
    'service_need_voucher_value_description_fi': 'fi', 'service_need_voucher_value_description_sv': 'sv',
    'age_coefficient': 'age', 'capacity_factor': "'1.00'"},
    f"FROM d LEFT JOIN {AT_START} LEFT JOIN vv ON d.start_date >= vv.lo AND d.start_date < vv.hi "
    f"LEFT JOIN so ON so.sid = {u('OPTION', 'o_orderkey % 6')}")}""")
def publish_voucher_decisions_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, pay = F.col("o_orderkey"), (F.col("o_orderkey") % 300).cast("int")
    v = _orders(spark, sf_dir).select(
        key("VOUCHER", "o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), F.col("start_date").alias("valid_from"),
        F.col("end_date").alias("valid_to"), k.alias("decision_number"), key("PERSON", "o_custkey").alias("head_of_family_id"),
        F.lit(None).cast("string").alias("partner_id"), (2 + k % 7).cast("int").alias("family_size"),
        F.col("start_date").alias("legacy_decision_date"), key("PERSON", F.col("o_custkey") + 1).alias("child_id"),
        F.lit("1994-01-01").cast("date").alias("child_date_of_birth"), pay.alias("base_co_payment"), F.lit(0).alias("sibling_discount"),
        key("UNIT", F.col("o_custkey") % 7).alias("placement_unit_id"), pay.alias("co_payment"), (pay * 3).alias("voucher_value"),
        pay.alias("final_co_payment"), F.lit("1.00").cast("decimal(4,2)").alias("capacity_factor"),
        key("OPTION", k % 6).alias("service_need_option_id"))
    return stacked(transfer.voucher_value_decisions({
        "mig_voucher_value_decision": v, "fee_thresholds": _fee_threshold_dim(spark), "service_need_option": _options(spark, sf_dir),
        "voucher_value": _voucher_values(spark)}))


@query("publish_fee_decisions_all_job", sql=f"""
WITH {ORDER_IV}, {_threshold_values_sql()}, {OPTION_SQL},
d AS (SELECT *, CAST(2 + o_orderkey % 7 AS INTEGER) AS family_size FROM iv)
{rows_sql('fee_decision', {
    'id': u('FEE', 'o_orderkey'), 'status': 'o_orderstatus',
    'valid_during': "strftime(start_date, '%Y-%m-%d') || '..' || COALESCE(strftime(end_date + 1, '%Y-%m-%d'), '')",
    'valid_during_text': "'[' || strftime(start_date, '%Y-%m-%d') || ',' || COALESCE(strftime(end_date + 1, '%Y-%m-%d'), '') || ')'",
    'decision_type': "'NORMAL'", 'head_of_family_id': CHILD, 'head_of_family_income': "'{}'", 'partner_id': 'NULL',
    'partner_income': 'NULL', 'family_size': 'family_size', 'fee_thresholds': THRESHOLDS_SQL, 'decision_number': 'o_orderkey'},
    f'FROM d LEFT JOIN {AT_START}')}
UNION ALL
{rows_sql('fee_decision_child', {
    'id': u('FEE_CHILD', 'l_orderkey', 'l_linenumber'), 'fee_decision_id': u('FEE', 'l_orderkey'), 'child_id': u('PERSON', 'l_suppkey'),
    'child_date_of_birth': "DATE '1994-01-01'", 'sibling_discount': '0', 'placement_unit_id': u('UNIT', 'l_partkey % 7'),
    'placement_type': 'ptype', 'service_need_fee_coefficient': 'fee_co', 'service_need_description_fi': 'fi',
    'service_need_description_sv': 'sv', 'base_fee': 'CAST(l_quantity AS INTEGER)', 'fee': 'CAST(l_quantity AS INTEGER)',
    'fee_alterations': "'[]'", 'final_fee': 'CAST(l_quantity AS INTEGER)'},
    f"FROM lineitem JOIN so ON so.sid = {u('OPTION', 'l_linenumber')}")}""")
def publish_fee_decisions_all_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X12 with both outputs; children whose option the target lacks are left out."""
    k, fee = F.col("o_orderkey"), F.col("l_quantity").cast("int")
    fd = _orders(spark, sf_dir).select(
        key("FEE", "o_orderkey").alias("id"), F.col("o_orderstatus").alias("status"), "start_date", "end_date",
        F.lit("NORMAL").alias("decision_type"), key("PERSON", "o_custkey").alias("head_of_family_id"),
        F.lit("{}").alias("head_of_family_income"), F.lit(None).cast("string").alias("partner_id"),
        F.lit(None).cast("string").alias("partner_income"), (2 + k % 7).cast("int").alias("family_size"), k.alias("decision_number"))
    kids = read_table(spark, sf_dir, "lineitem").select(
        key("FEE_CHILD", "l_orderkey", "l_linenumber").alias("id"), key("FEE", "l_orderkey").alias("fee_decision_id"),
        key("PERSON", "l_suppkey").alias("child_id"), F.lit("1994-01-01").cast("date").alias("child_date_of_birth"),
        F.lit(0).alias("sibling_discount"), key("UNIT", F.col("l_partkey") % 7).alias("placement_unit_id"),
        key("OPTION", "l_linenumber").alias("service_need_option_id"), fee.alias("base_fee"), fee.alias("fee"), fee.alias("final_fee"))
    return stacked(transfer.fee_decisions({"mig_fee_decision": fd, "mig_fee_decision_child": kids,
                                           "fee_thresholds": _fee_threshold_dim(spark), "service_need_option": _options(spark, sf_dir)}))


# ------------------------------------------------------------------ X13

def _json(value) -> str:
    """SQL for JSON text: a dict is an object and a tuple names the SQL text
    of a string (``s``) or of JSON itself (``j``); others are JSON constants."""
    if isinstance(value, dict):
        return "'{' || " + " || ',' || ".join(f"""'"{k}":' || {_json(v)}""" for k, v in value.items()) + " || '}'"
    if isinstance(value, tuple):
        return f"""COALESCE('"' || CAST({value[1]} AS VARCHAR) || '"', 'null')""" if value[0] == "s" else f"COALESCE({value[1]}, 'null')"
    return f"'{json.dumps(value)}'"


def _person_json(p: str, child: bool) -> dict:
    fixed = {"street": ("s", f"{p}.street"), "postalCode": ("s", f"{p}.postal"), "city": ("s", f"{p}.city"), "editable": False}
    blank = {"street": "", "postalCode": "", "city": "", "editable": True}
    out = {"firstName": ("s", f"{p}.first_name"), "lastName": ("s", f"{p}.last_name"),
           "socialSecurityNumber": ("s", f"COALESCE({p}.ssn, '')")}
    if child:
        return {**out, "dateOfBirth": ("s", f"{p}.dob"), "address": fixed, "nationality": ("s", f"{p}.nationality"),
                "language": ("s", f"{p}.language"), "hasCorrectingAddress": None, "correctingAddress": blank,
                "childMovingDate": None, "restricted": False}
    return {**out, "address": fixed, "phoneNumber": ("s", f"{p}.phone"), "email": ("s", f"{p}.email"), "hasCorrectingAddress": None,
            "correctingAddress": blank, "guardianMovingDate": None, "restricted": False}


APPLY_JSON = {"preferredUnits": ("j", "units"), "siblingBasis": False, "siblingName": "", "siblingSsn": ""}
NO_LIST = ("j", "'[]'")
DAYCARE_JSON = {
    "child": _person_json("c", True), "guardian": _person_json("g", False), "otherGuardianAgreementStatus": None, "apply": APPLY_JSON,
    "urgent": False, "partTime": False, "serviceNeedOption": ("j", "option"), "connectedDaycare": None,
    "preferredStartDate": ("s", "wanted"), "serviceStart": None, "serviceEnd": None, "extendedCare": False,
    "careDetails": {"preparatory": None, "assistanceNeeded": False, "assistanceDescription": ""}, "guardian2": None,
    "hasOtherAdults": False, "otherAdults": NO_LIST, "hasOtherChildren": False, "otherChildren": NO_LIST, "docVersion": 0,
    "additionalDetails": {"allergyType": "", "dietType": "", "otherInfo": ""}, "maxFeeAccepted": False, "type": ("s", "a.type")}
CLUB_JSON = {
    "child": _person_json("c", True), "guardian": _person_json("g", False), "apply": APPLY_JSON, "preferredStartDate": ("s", "wanted"),
    "wasOnDaycare": False, "wasOnClubCare": False,
    "clubCare": {"assistanceNeeded": False, "assistanceDescription": "", "assistanceAdditionalDetails": ""}, "docVersion": 0,
    "additionalDetails": {"otherInfo": ""}}
OPTION_JSON = {"id": ("s", "so.sid"), "nameFi": ("s", "so.fi"), "nameSv": ("s", "so.sv"), "nameEn": ("s", "so.en")}
APPLICATION_TYPE = "CASE o_orderkey % 4 WHEN 0 THEN 'CLUB' WHEN 1 THEN 'PRESCHOOL' WHEN 2 THEN 'DAYCARE' ELSE 'OTHER' END"


@query("publish_applications_job", sql=f"""
WITH {ORDER_IV}, {OPTION_SQL}, {PERSON_SQL},
q AS (SELECT id, c_mktsegment AS first_name, c_name AS last_name, ssn, dob, 'Street 1' AS street, '00100' AS postal, 'Town' AS city,
             CASE WHEN c_custkey % 5 <> 0 THEN 'SE' ELSE 'FI' END AS nationality, 'fi' AS language, '040' AS phone, email FROM p),
a AS (SELECT iv.*, {u('APPLICATION', 'o_orderkey')} AS aid, {CHILD} AS guardian_id, {u('PERSON', 'o_custkey + 1')} AS child_id,
             {APPLICATION_TYPE} AS type FROM iv),
f AS (SELECT l_orderkey, l_linenumber, MIN(l_suppkey) AS s FROM lineitem GROUP BY l_orderkey, l_linenumber),
pr AS (SELECT l_orderkey, '[' || string_agg('"' || {u('UNIT', 's')} || '"', ',' ORDER BY l_linenumber) || ']' AS units,
              MIN(DATE '2021-08-01' + l_linenumber) AS wanted,
              arg_min({_json(OPTION_JSON)}, l_linenumber) FILTER (WHERE so.sid IS NOT NULL) AS option
       FROM f LEFT JOIN so ON l_linenumber % 2 = 0 AND so.sid = {u('OPTION', 'l_linenumber')} GROUP BY l_orderkey)
{rows_sql('application', {'id': 'aid', 'sentdate': 'start_date', 'duedate': 'end_date', 'guardian_id': 'guardian_id',
                          'child_id': 'child_id', 'transferapplication': 'o_orderkey % 5 = 0', 'status': 'o_orderstatus',
                          'origin': f"'{transfer.APPLICATION_ORIGIN}'"}, 'FROM a')}
UNION ALL
{rows_sql('application_form', {
    'application_id': 'aid', 'revision': '1',
    'document': f"CASE WHEN a.type IN ('DAYCARE', 'PRESCHOOL') THEN {_json(DAYCARE_JSON)} WHEN a.type = 'CLUB' THEN {_json(CLUB_JSON)} END",
    'latest': 'true'}, 'FROM a JOIN pr ON pr.l_orderkey = a.o_orderkey JOIN q c ON c.id = a.child_id JOIN q g ON g.id = a.guardian_id')}""")
def publish_applications_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applications and whole form documents of both shapes."""
    k, ln = F.col("o_orderkey"), F.col("l_linenumber")
    kind = F.when(k % 4 == 0, "CLUB").when(k % 4 == 1, "PRESCHOOL").when(k % 4 == 2, "DAYCARE").otherwise("OTHER")
    app = _orders(spark, sf_dir).select(
        key("APPLICATION", "o_orderkey").alias("id"), F.col("start_date").alias("sentdate"), F.col("end_date").alias("duedate"),
        key("PERSON", "o_custkey").alias("guardian_id"), key("PERSON", F.col("o_custkey") + 1).alias("child_id"),
        (k % 5 == 0).alias("transferapplication"), F.col("o_orderstatus").alias("status"), kind.alias("type"))
    form = (read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.min("l_suppkey").alias("s"))
            .select(key("APPLICATION", "l_orderkey").alias("application_id"), ln.alias("legacy_priority"), key("UNIT", "s").alias("unit_id"),
                    F.when(ln % 2 == 0, key("OPTION", "l_linenumber")).alias("service_need_option_id"),
                    F.date_add(F.lit("2021-08-01").cast("date"), ln).alias("preferred_start_date")))
    return stacked(transfer.applications({"mig_application": app, "mig_application_form": form, "mig_person": _persons(spark, sf_dir),
                                          "service_need_option": _options(spark, sf_dir)}))
