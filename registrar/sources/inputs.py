"""Declared inputs of the jobs (S8): what each job reads, which existing
target tables ("dimensions") there are, and their schemas and keys.

The declaration is resolved before anything is planned: ``load_dimensions``
checks a folder of target tables against it, ``resolve`` checks that every
table a chain of jobs needs is given or made by an earlier job of the chain.
Both stop the run with a coded ``InputError``; no job stands in an empty frame
for a table that it needs. A table that a caller knows to be empty is given
as such (``empty``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .specs import REGISTRY

MISSING = "R-INPUT-1"      # a job needs a table that nobody gives
UNKNOWN = "R-INPUT-2"      # a dimension folder of no declared name
UNREADABLE = "R-INPUT-3"   # a dimension folder without a table in it
COLUMN = "R-INPUT-4"       # a dimension without a key column, or with a column of another type
KEY = "R-INPUT-5"          # a dimension key that is NULL or repeated


class InputError(ValueError):
    def __init__(self, code: str, message: str):
        super().__init__(f"{message} ({code})")
        self.code = code


@dataclass(frozen=True)
class Dimension:
    """An existing target table. ``required``: a job that reads it cannot do
    without (a lookup of codes); others are empty before the first run."""

    name: str
    schema: str
    key: tuple[str, ...]
    required: bool = False


def _thresholds() -> str:
    sizes = ", ".join(f"min_income_threshold_{n} long, max_income_threshold_{n} long, income_multiplier_{n} decimal(5,4)" for n in range(2, 7))
    return f"id string, valid_during struct<lower:date,upper:date>, {sizes}, income_threshold_increase_6_plus long, min_fee int, max_fee int"


_ADDRESS = "email string, language string, street_address string, postal_code string, post_office string"

# Names, columns and keys of the existing target tables.
DIMENSIONS = {d.name: d for d in (
    Dimension("person", "id string, social_security_number string, last_name string, first_name string, " + _ADDRESS
              + ", nationalities array<string>, restricted_details_enabled boolean, phone string, backup_phone string, "
              "date_of_birth date", ("id",)),
    Dimension("idmap", "type string, source_id string, target_id string, updated timestamp", ("type", "source_id")),
    Dimension("service_need_option", "id string, name_fi string, name_sv string, name_en string, valid_placement_type string, "
              "fee_coefficient decimal(4,2), fee_description_fi string, fee_description_sv string, "
              "voucher_value_coefficient decimal(4,2), voucher_value_description_fi string, voucher_value_description_sv string",
              ("id",), required=True),
    Dimension("fee_thresholds", _thresholds(), ("id",), required=True),
    Dimension("voucher_value", "id string, validity struct<lower:date,upper:date>, base_value int, age_under_three_coefficient decimal(3,2)",
              ("id",), required=True),
    Dimension("daycare", "id string, oph_unit_oid string, oph_organizer_oid string", ("id",)),
    Dimension("child", "id string", ("id",)),
    Dimension("evaka_user", "id string, type string, name string", ("id",)),
    Dimension("assistance_basis_option", "id string, value string", ("id",), required=True),
    Dimension("assistance_action_option", "id string, value string", ("id",), required=True),
)}

#: Tables that jobs make and that single jobs can be run without when given as ``empty``.
INTERMEDIATE = {
    "mig_daycare_group": "id string, daycare_id string, legacy_id int, name string, start_date date, end_date date",
    "mig_backup_care": "id string, child_id string, unit_id string, group_id string, start_date date, end_date date",
    "mig_service_need": "id string, option_id string, placement_id string, start_date date, end_date date",
}

_UNITS = ("unitmap", "childmindermap")

#: What each reconciliation job reads, besides exclusion lists (always optional).
JOB_INPUTS: dict[str, tuple[str, ...]] = {
    "persons": ("persons", "codes", "idmap", "person"),
    "families": ("families", "mig_person"),
    "special_needs": ("specialneeds", "mig_person"),
    "special_means": ("specialmeans", "mig_person"),
    "income": ("income", "incomerows", "mig_person"),
    "departments": ("departments", "unitmap"),
    "placements": ("placements", "placementextents", "extentmap", "service_need_option", "mig_person", *_UNITS, "mig_daycare_group"),
    "service_needs": ("placementextents", "extentmap", "mig_placement"),
    "fee_deviations": ("feedeviations", "mig_placement"),
    "applications": ("applications", "applicationrows", "codes", "extentmap", *_UNITS, "mig_person", "mig_fridge_child", "idmap"),
    "voucher_value_decisions": ("decisions", "extentmap", *_UNITS, "mig_person", "mig_fridge_child", "mig_fridge_partner", "idmap"),
    "pay_decisions": ("paydecisions", "paydecisionrows", "mig_person", "mig_placement", "mig_service_need", "idmap"),
    "daily_journals": ("dailyjournals", "dailyjournalrows", *_UNITS, "mig_person", "mig_placement", "mig_daycare_group"),
    "timestamps": ("timestampheaders", "timestampdetails", *_UNITS, "mig_person"),
    "cleanup": ("mig_daycare_group", "mig_placement", "mig_backup_care"),
}

#: Tables that the reconciliation jobs make.
JOB_OUTPUTS: dict[str, tuple[str, ...]] = {
    "persons": ("mig_person", "idmap"), "families": ("mig_fridge_child", "mig_fridge_partner"),
    "special_needs": ("mig_assistance_need",), "special_means": ("mig_assistance_action",), "income": ("mig_income",),
    "departments": ("mig_daycare_group",), "placements": ("mig_placement",), "service_needs": ("mig_service_need",),
    "fee_deviations": ("mig_fee_alteration",), "applications": ("mig_application", "mig_application_form", "idmap"),
    "voucher_value_decisions": ("mig_voucher_value_decision", "idmap"),
    "pay_decisions": ("mig_fee_decision", "mig_fee_decision_child", "idmap"),
    "daily_journals": ("mig_absence", "mig_absence_journal", "mig_backup_care"), "timestamps": ("mig_child_attendance",),
    "cleanup": ("mig_daycare_group",),
}

#: What each publishing job reads.
PUBLISH_INPUTS: dict[str, tuple[str, ...]] = {
    "audit_user": ("evaka_user",), "persons": ("mig_person", "person"), "families": ("mig_fridge_child", "mig_fridge_partner"),
    "assistance_needs": ("mig_assistance_need", "assistance_basis_option", "child"),
    "assistance_actions": ("mig_assistance_action", "assistance_action_option", "child"),
    "income": ("mig_income",), "unit_managers": ("evaka_unit_manager",), "daycares": ("evaka_daycare",),
    "departments": ("mig_daycare_group",), "placements": ("mig_placement", "mig_service_need", "child"),
    "fee_alterations": ("mig_fee_alteration",),
    "voucher_value_decisions": ("mig_voucher_value_decision", "fee_thresholds", "service_need_option", "voucher_value"),
    "fee_decisions": ("mig_fee_decision", "mig_fee_decision_child", "fee_thresholds", "service_need_option"),
    "applications": ("mig_application", "mig_application_form", "service_need_option", "mig_person"),
    "absences": ("mig_absence", "child"), "backup_cares": ("mig_backup_care", "child"),
    "attendances": ("mig_child_attendance", "child"), "unit_external_ids": ("daycare_oid_map", "daycare"),
}


def is_optional(name: str) -> bool:
    """Whether a job can do without the table (it is empty before a first run)."""
    return name in DIMENSIONS and not DIMENSIONS[name].required


def schema_of(name: str) -> str:
    if name in DIMENSIONS:
        return DIMENSIONS[name].schema
    return INTERMEDIATE[name] if name in INTERMEDIATE else REGISTRY[name].ddl()


def empty(spark: SparkSession, *names: str) -> dict[str, DataFrame]:
    """The named tables as empty frames of their declared schemas."""
    return {n: spark.createDataFrame([], schema_of(n)) for n in names}


def missing(tables: Iterable[str], jobs: Sequence[str], needs: Mapping[str, tuple[str, ...]] = JOB_INPUTS,
            makes: Mapping[str, tuple[str, ...]] = JOB_OUTPUTS) -> list[tuple[str, str]]:
    """(job, table) of every input that is neither given, nor optional, nor made by an earlier job."""
    known, out = set(tables), []
    for job in jobs:
        out += [(job, t) for t in needs.get(job, ()) if t not in known and not is_optional(t)]
        known.update(makes.get(job, ()))
    return out


def resolve(tables: Iterable[str], jobs: Sequence[str], needs: Mapping[str, tuple[str, ...]] = JOB_INPUTS,
            makes: Mapping[str, tuple[str, ...]] = JOB_OUTPUTS) -> None:
    """Stop before planning if a job lacks an input; the message names all of them."""
    if lacking := missing(tables, jobs, needs, makes):
        raise InputError(MISSING, "Missing inputs: " + ", ".join(f"'{t}' of job '{j}'" for j, t in lacking))


def _typed(df: DataFrame, d: Dimension) -> DataFrame:
    """The dimension with its declared columns: others are left out, absent ones
    NULL. A column of another type is cast if Spark can store it as the declared one."""
    declared = StructType.fromDDL(d.schema)
    lacking = [c for c in d.key if c not in df.columns]
    if lacking:
        raise InputError(COLUMN, f"Column '{lacking[0]}' of table '{d.name}' not found")
    for f in declared:
        if f.name in df.columns and (have := df.schema[f.name].dataType) != f.dataType and not _castable(have, f.dataType):
            raise InputError(COLUMN, f"Column '{f.name}' of table '{d.name}' is {have.simpleString()}, not {f.dataType.simpleString()}")
    return df.select(*((F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in declared))


def _castable(have, want) -> bool:
    numbers = {"tinyint", "smallint", "int", "bigint", "float", "double", "decimal"}

    def kind(t) -> str:
        name = t.simpleString().split("(")[0]
        return "number" if name in numbers else "time" if name.startswith("timestamp") else name
    if isinstance(have, StructType) and isinstance(want, StructType):
        return len(have) == len(want) and all(_castable(a.dataType, b.dataType) for a, b in zip(have, want))
    return kind(have) == kind(want)


def load_dimensions(spark: SparkSession, path: str, names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Every sub-folder of ``path`` as the dimension of its name, read as
    parquet. Unknown, empty or ill-typed folders and keys that are NULL or
    repeated stop the run; the keys of all folders are checked in one job."""
    jvm = spark._jvm.org.apache.hadoop.fs
    where = jvm.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    folders = sorted(s.getPath().getName() for s in store.listStatus(where)
                     if s.isDirectory() and not s.getPath().getName().startswith(("_", ".")))
    unknown = [f for f in folders if f not in DIMENSIONS]
    if unknown:
        raise InputError(UNKNOWN, f"Unknown dimension table '{unknown[0]}'")
    out = {}
    for name in folders:
        if names is not None and name not in names:
            continue
        try:
            found = spark.read.parquet(f"{path.rstrip('/')}/{name}")
        except Exception as e:
            raise InputError(UNREADABLE, f"No parquet table in the folder of dimension '{name}'") from e
        out[name] = _typed(found, DIMENSIONS[name])
    if out:
        bad = _bad_keys(out).limit(1).collect()
        if bad:
            raise InputError(KEY, f"Key ({', '.join(DIMENSIONS[bad[0].name].key)}) of table '{bad[0].name}' is NULL or repeated: {bad[0].key}")
    return out


def _bad_keys(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(name, key, n) of keys that are NULL or occur more than once."""
    every = None
    for name, df in tables.items():
        key = DIMENSIONS[name].key
        part = df.select(F.lit(name).alias("name"), F.array(*(F.col(c).cast("string") for c in key)).alias("key"))
        every = part if every is None else every.unionByName(part)
    return (every.groupBy("name", "key").agg(F.count("*").alias("n"))
            .where((F.col("n") > 1) | F.exists("key", lambda x: x.isNull())))
