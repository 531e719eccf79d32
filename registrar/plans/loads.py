"""Queries of the loading side over the star-schema test tables: existing
target tables (S8), staging with checks, coded errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.domain import PRESCHOOL_FIRST_START, PRESCHOOL_LAST_START
from ..operators import lookup
from ..session import scratch_path
from ..sources import errors, inputs, staging
from ..sources.specs import spec
from .registry import query, read_table
from .star import BIRTH_SQL, CUSTOMER_CODES, EXTENT_OPTIONS, ORDER_IV, _customer_spec, _staged_placements, ymd

# ------------------------------------------------- S8 existing target tables

#: Days by which the placements of ``placement_types_job`` come later (20 years), into the supported school years.
LATER = 7305


def write_dimensions(tables: dict[str, DataFrame]) -> str:
    """A folder of target tables, one sub-folder per table."""
    spark = next(iter(tables.values())).sparkSession
    root = scratch_path(spark, "dimensions")
    for name, df in tables.items():
        df.write.parquet(f"{root}/{name}")
    return root


def _target_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """A table for every declared dimension, with some of its columns, in other
    numeric types where they may differ, and with columns nobody declared."""
    customer, supplier, part = (read_table(spark, sf_dir, t) for t in ("customer", "supplier", "part"))
    nation, region = (read_table(spark, sf_dir, t) for t in ("nation", "region"))
    orders = read_table(spark, sf_dir, "orders")

    def key(c, kind):
        return F.concat(F.lit(f"{kind}-"), F.col(c).cast("string")).alias("id")

    return {
        "person": customer.select(key("c_custkey", "p"), F.col("c_name").alias("last_name"), F.lit("extra").alias("nobody_reads")),
        "idmap": orders.select(F.lit("DECISION").alias("type"), F.col("o_orderkey").cast("string").alias("source_id"),
                               key("o_orderkey", "d").alias("target_id"), F.to_timestamp("o_orderdate").alias("updated")),
        "service_need_option": part.select(key("p_partkey", "o"), F.col("p_name").alias("name_fi"),
                                           (F.col("p_partkey") % 100 / 100).alias("fee_coefficient")),
        "fee_thresholds": region.select(key("r_regionkey", "t"), (F.col("r_regionkey") * 100).cast("int").alias("min_fee"),
                                        F.struct(F.lit("2000-01-01").cast("date").alias("lower"), F.lit(None).cast("date").alias("upper")).alias("valid_during")),
        "voucher_value": nation.select(key("n_nationkey", "v"), (F.col("n_nationkey") * 10).cast("bigint").alias("base_value")),
        "daycare": supplier.select(key("s_suppkey", "u"), F.col("s_name").alias("oph_unit_oid")),
        "child": customer.where("c_custkey % 3 = 0").select(key("c_custkey", "p")),
        "evaka_user": nation.select(key("n_nationkey", "e"), F.lit("UNKNOWN").alias("type"), F.col("n_name").alias("name")),
        "assistance_basis_option": region.select(key("r_regionkey", "b"), F.col("r_name").alias("value")),
        "assistance_action_option": region.select(key("r_regionkey", "a"), F.col("r_name").alias("value")),
    }


@query("dimension_tables", sql="""
SELECT 'person' AS name, 'p-' || c_custkey AS id, c_name AS value, CAST(NULL AS BIGINT) AS number FROM customer
UNION ALL SELECT 'idmap', 'DECISION/' || o_orderkey, 'd-' || o_orderkey, CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS BIGINT) FROM orders
UNION ALL SELECT 'service_need_option', 'o-' || p_partkey, p_name, CAST(p_partkey % 100 AS BIGINT) FROM part
UNION ALL SELECT 'fee_thresholds', 't-' || r_regionkey, '2000-01-01', CAST(r_regionkey * 100 AS BIGINT) FROM region
UNION ALL SELECT 'voucher_value', 'v-' || n_nationkey, NULL, CAST(n_nationkey * 10 AS BIGINT) FROM nation
UNION ALL SELECT 'daycare', 'u-' || s_suppkey, s_name, NULL FROM supplier
UNION ALL SELECT 'child', 'p-' || c_custkey, NULL, NULL FROM customer WHERE c_custkey % 3 = 0
UNION ALL SELECT 'evaka_user', 'e-' || n_nationkey, n_name, NULL FROM nation
UNION ALL SELECT 'assistance_basis_option', 'b-' || r_regionkey, r_name, NULL FROM region
UNION ALL SELECT 'assistance_action_option', 'a-' || r_regionkey, r_name, NULL FROM region
""")
def dimension_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every declared dimension, loaded through its declaration."""
    found = inputs.load_dimensions(spark, write_dimensions(_target_tables(spark, sf_dir)))
    value = {"person": "last_name", "idmap": "target_id", "service_need_option": "name_fi",
             "fee_thresholds": F.date_format("valid_during.lower", "yyyy-MM-dd"), "daycare": "oph_unit_oid", "evaka_user": "name",
             "assistance_basis_option": "value", "assistance_action_option": "value"}
    number = {"idmap": F.unix_seconds("updated"), "service_need_option": F.col("fee_coefficient") * 100,
              "fee_thresholds": F.col("min_fee"), "voucher_value": F.col("base_value")}
    out = None
    for name, d in inputs.DIMENSIONS.items():
        v = value.get(name, F.lit(None))
        part = found[name].select(F.lit(name).alias("name"), F.concat_ws("/", *d.key).alias("id"),
                                  (F.col(v) if isinstance(v, str) else v).cast("string").alias("value"),
                                  number.get(name, F.lit(None)).cast("bigint").alias("number"))
        out = part if out is None else out.unionByName(part)
    return out


@query("placement_types_job", sql=f"""
WITH {ORDER_IV}, {CUSTOMER_CODES},
persons AS (SELECT cc.code AS legacy_ssn FROM customer c JOIN cc ON cc.c_custkey = c.c_custkey WHERE c.c_acctbal >= 0),
types AS (SELECT l_orderkey AS nbr, MIN(CASE WHEN l_suppkey % 2 = 0 AND l_partkey % 4 <> 0 THEN 'PRESCHOOL_DAYCARE'
                                             WHEN l_suppkey % 2 = 1 AND l_partkey % 4 = 0 THEN 'DAYCARE_PART_TIME' END) AS type
          FROM lineitem GROUP BY l_orderkey),
p AS (SELECT iv.o_orderkey AS nbr, cc.code AS ssn, COALESCE(t.type, 'DAYCARE') AS type, iv.start_date + {LATER} AS s, iv.end_date + {LATER} AS e,
             EXISTS (SELECT 1 FROM persons WHERE persons.legacy_ssn = cc.code) AS has_person,
             EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c.c_nationkey AND n_regionkey <> 4) AS has_unit
      FROM iv JOIN cc ON cc.c_custkey = iv.o_custkey JOIN customer c ON c.c_custkey = iv.o_custkey LEFT JOIN types t ON t.nbr = iv.o_orderkey),
p2 AS (SELECT a.*, COALESCE(a.e, (SELECT MIN(b.s) FROM p b WHERE b.ssn = a.ssn AND b.nbr <> a.nbr AND b.s > a.s) - 1) AS e2,
              {BIRTH_SQL.replace('code', 'a.ssn')} AS birth, a.type = 'PRESCHOOL_DAYCARE' AS pre,
              a.s BETWEEN DATE '{PRESCHOOL_FIRST_START}' AND DATE '{PRESCHOOL_LAST_START}' AS supported
       FROM p a),
p3 AS (SELECT *, COALESCE(e2, CASE WHEN pre AND supported THEN make_date(year(s) + CASE WHEN month(s) >= 8 THEN 1 ELSE 0 END, 7, 31)
                                   WHEN pre THEN NULL
                                   WHEN make_date(year(birth) + 6, 7, 31) < s THEN make_date(year(s) + 1, 7, 31)
                                   ELSE make_date(year(birth) + 6, 7, 31) END) AS e3 FROM p2),
flags AS (
  SELECT nbr, 'PERSON MISSING' AS reason FROM p3 WHERE NOT has_person
  UNION ALL SELECT nbr, 'UNIT MISSING' FROM p3 WHERE NOT has_unit
  UNION ALL SELECT DISTINCT a.nbr, 'OVERLAPPING PLACEMENT' FROM p3 a JOIN p3 b ON a.ssn = b.ssn AND a.nbr <> b.nbr
     AND a.s <= a.e3 AND b.s <= b.e3 AND a.s <= b.e3 AND b.s <= a.e3
  UNION ALL SELECT nbr, 'UNSUPPORTED PRESCHOOL START' FROM p3 WHERE e2 IS NULL AND pre AND NOT supported
  UNION ALL SELECT nbr, 'INVALID IDENTITY CODE' FROM p3
     WHERE e2 IS NULL AND NOT pre AND length(ssn) = 11 AND substr(ssn, 7, 1) NOT IN ('+', '-', 'A'))
SELECT nbr AS legacy_placement_nbr, type, strftime(s, '%Y-%m-%d') AS start_date, strftime(e3, '%Y-%m-%d') AS end_date,
       COALESCE(reason, 'OK') AS outcome
FROM p3 LEFT JOIN flags USING (nbr)
""")
def placement_types_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 with extents: placement types from the loaded service need options."""
    from .transform import placements
    options = spark.createDataFrame([("opt-full", "PRESCHOOL_DAYCARE"), ("opt-part", "DAYCARE_PART_TIME")], "id string, valid_placement_type string")
    li = read_table(spark, sf_dir, "lineitem")
    extents = li.select(F.col("l_orderkey").alias("placementnbr"), F.when(F.col("l_suppkey") % 2 == 0, 100).otherwise(101).alias("extentcode"),
                        F.when(F.col("l_partkey") % 4 == 0, 15).otherwise(0).alias("days"))
    staged = _staged_placements(spark, sf_dir)
    given = staged["placements"]
    for c in ("startdate", "enddate"):
        given = given.withColumn(c, F.date_add(c, LATER))
    out = placements({**staged, "placements": given, "placementextents": extents,
                      "extentmap": lookup.literal_dimension(spark, EXTENT_OPTIONS, "effica_id int, days int, evaka_id string"),
                      **inputs.load_dimensions(spark, write_dimensions({"service_need_option": options}))})
    cols = ["legacy_placement_nbr", "type", ymd("start_date").alias("start_date"), ymd("end_date").alias("end_date")]
    return (out["mig_placement"].select(*cols, F.lit("OK").alias("outcome"))
            .unionByName(out["mig_placement_todo"].select(*cols, F.col("reason").alias("outcome"))))


# ----------------------------------------- S1, S4, K1 staging; S5 coded errors

def _tag(name: str, value) -> Column:
    return F.concat(F.lit(f"<{name}>"), value, F.lit(f"</{name}>"))


def _customer_record(**other) -> Column:
    """A customer as record text; ``other`` replaces elements by name."""
    cols = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")
    return F.concat(F.lit("<customer>"), *(other.get(c, _tag(c, F.col(c).cast("string"))) for c in cols), F.lit("</customer>"))


def _dump(lines: DataFrame, name: str) -> str:
    path = scratch_path(lines.sparkSession, name)
    lines.write.text(path)
    return path


@query("staged_ingest", sql="""
SELECT 'row' AS kind, c_custkey, c_name || CASE WHEN c_custkey % 5 = 0 THEN ' </customer> <x> & y' ELSE '' END AS c_name,
       CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment
FROM customer WHERE c_custkey % 7 <> 0
UNION ALL SELECT 'count', count(*), 'customer', NULL, NULL, NULL FROM customer WHERE c_custkey % 7 <> 0
""")
def staged_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A dump staged once: records in comments are none, CDATA is text, and the
    rows counted while writing are the table's."""
    c = read_table(spark, sf_dir, "customer")
    cdata = F.concat(F.lit("<![CDATA["), "c_name", F.lit(" </customer> <x> & y]]>"))
    record = F.when(F.col("c_custkey") % 5 == 0, _customer_record(c_name=_tag("C_Name", cdata))).otherwise(_customer_record())
    line = (F.when(F.col("c_custkey") % 7 == 0, F.concat(F.lit("<!-- out: "), record, F.lit(" -->")))
            .when(F.col("c_custkey") % 11 == 0, F.concat(F.lit("<!-- next </customer> -->"), record)).otherwise(record))
    staged = staging.stage_dir(spark, _dump(c.select(line), "customer-dump"), "customer", {"customer": _customer_spec()})
    rows = staged.tables["customer"].select(F.lit("row").alias("kind"), "c_custkey", "c_name", F.col("c_nationkey").cast("long").alias("c_nationkey"),
                                            "c_acctbal", "c_mktsegment")
    return rows.unionByName(spark.createDataFrame([("count", n, t) for t, n in staged.counts.items()], "kind string, c_custkey long, c_name string"),
                            allowMissingColumns=True)


@query("ingest_errors", sql=f"""
SELECT 'customer' AS table_name, CASE c_custkey % 40 WHEN 1 THEN '{errors.NON_FLAT_DATA}' WHEN 2 THEN '{errors.NON_MAPPED_COLUMN}'
       WHEN 3 THEN '{errors.MALFORMED_RECORD}' WHEN 4 THEN '{errors.AMBIGUOUS_TABLE_DATA}' ELSE 'OK' END AS code, c_custkey,
       CASE c_custkey % 40 WHEN 1 THEN 'b' WHEN 2 THEN 'c_oops' WHEN 4 THEN 'other' END AS detail
FROM customer
UNION ALL SELECT 'empty', '{errors.NO_DATA_CONTENT}', NULL, NULL
UNION ALL SELECT 'nowhere', '{errors.NON_MAPPED_TABLE}', NULL, NULL
""")
def ingest_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every record of three dumps: a row of the staged table, or an error row with its code."""
    c = read_table(spark, sf_dir, "customer")
    k = F.col("c_custkey") % 40
    line = (F.when(k == 1, _customer_record(c_name=_tag("c_name", _tag("b", F.col("c_name")))))
            .when(k == 2, _customer_record(c_name=_tag("c_oops", F.col("c_name"))))
            .when(k == 3, _customer_record(c_name=F.concat(F.lit("<c_name>"), "c_name")))
            .when(k == 4, F.concat(F.lit("<other>1</other>"), _customer_record())).otherwise(_customer_record()))
    dump = _dump(c.select(line), "customer-errors")
    comments = _dump(c.select(F.concat(F.lit("<!-- "), "c_name", F.lit(" -->"))), "customer-comments")
    known = {"customer": _customer_spec(), "empty": spec("empty", "c_custkey bigint number", element="customer")}
    parts = [staging.stage_dir(spark, path, table, known, strict=False)
             for path, table in ((dump, "customer"), (comments, "empty"), (dump, "nowhere"))]
    out = parts[0].tables["customer"].select(F.lit("customer").alias("table_name"), F.lit("OK").alias("code"), "c_custkey",
                                             F.lit(None).cast("string").alias("detail"))
    for p in parts:
        key = F.nullif(F.regexp_extract("fragment", r"<c_custkey>(\d+)<", 1), F.lit("")).cast("bigint")
        detail = F.when(F.col("fragment").isNotNull(), F.col("detail"))
        out = out.unionByName(p.errors.select(F.col("table").alias("table_name"), "code", key.alias("c_custkey"), detail.alias("detail")))
    return out


@query("delimited_ingest", sql="""
SELECT CAST(s_suppkey AS BIGINT) AS s_suppkey, s_name, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_acctbal END AS s_acctbal FROM supplier
""")
def delimited_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pipe files with own headers, a byte-order mark and blanks around
    values; a third of the rows has another order of columns, a third fewer."""
    from ..sources.delimited import read_delimited
    s = read_table(spark, sf_dir, "supplier")
    blank = {c: F.concat(F.lit(" "), F.col(c).cast("string"), F.lit("  ")) for c in s.columns}
    headers = {0: {"S_Name": "s_name", "s_suppkey": "s_suppkey"}, 1: {"s_suppkey ": "s_suppkey", " s_name": "s_name", "s_acctbal": "s_acctbal"},
               2: {"\ufeffs_acctbal": "s_acctbal", "s_name": "s_name", "s_suppkey": "s_suppkey"}}
    root, files = scratch_path(spark, "supplier-files"), []
    for k, names in headers.items():
        part = s.where(F.col("s_suppkey") % 3 == k).select(*(blank[c].alias(n) for n, c in names.items()))
        part.write.options(header=True, sep="|", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(f"{root}/{k}")
        files += [f for f in _files(spark, f"{root}/{k}") if f.endswith(".csv")]
    return read_delimited(spark, files, spec("supplier", "s_suppkey bigint number, s_name text text, s_acctbal double number", kind="delimited"))


def _files(spark: SparkSession, path: str) -> list[str]:
    from ..sources.records import list_files
    return list_files(spark, path)


@query("incremental_ingest", sql="""
SELECT c_custkey, c_name, c_acctbal FROM customer
""")
def incremental_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dumps that arrive in two turns; the third run finds nothing new."""
    from ..streaming.incremental import incremental_ingest as load
    c, root = read_table(spark, sf_dir, "customer"), scratch_path(spark, "stream")
    known, folder, target = _customer_spec(), f"{root}/dumps", f"{root}/table"
    for turn in range(3):
        if turn < 2:
            c.where(F.col("c_custkey") % 2 == turn).select(_customer_record()).write.mode("append").text(folder)
        load(spark, folder, known, "customer", target, f"{root}/checkpoint")
    return spark.read.parquet(target).select("c_custkey", "c_name", "c_acctbal")
