"""Maintenance of published tables: reset (K9) and statistics.

A reset empties tables and everything that refers to them, from the outermost
referring table inwards, by one new manifest; the versions before stay on
storage. ``analyze`` registers the published tables in the session's catalog,
each folder of the current manifest as a partition, so that Spark's optimizer
has row counts and column statistics for joins with them. With a Hive
metastore both outlive the session.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from graphlib import TopologicalSorter

from pyspark.sql import SparkSession
from pyspark.sql.types import AtomicType

from .publish import Manifest

# The target's tables and the tables whose keys they hold.
REFERENCES: dict[str, tuple[str, ...]] = {
    "daycare": ("unit_manager",), "varda_unit": ("daycare",), "daycare_group": ("daycare",),
    "daycare_caretaker": ("daycare_group",), "child": ("person",), "fridge_child": ("person",), "fridge_partner": ("person",),
    "income": ("person",), "fee_alteration": ("person",), "assistance_need": ("child",), "assistance_action": ("child",),
    "assistance_basis_option_ref": ("assistance_need",), "assistance_action_option_ref": ("assistance_action",),
    "placement": ("child", "daycare"), "service_need": ("placement",),
    "daycare_group_placement": ("placement", "daycare_group"), "fee_decision": ("person",),
    "fee_decision_child": ("fee_decision", "person", "daycare"), "voucher_value_decision": ("person", "daycare"),
    "application": ("person",), "application_form": ("application",), "absence": ("child",),
    "backup_care": ("child", "daycare", "daycare_group"), "child_attendance": ("child", "daycare"),
}
# The tables that a reset starts from, and those whose statistics a run refreshes.
RESET_ROOTS = ("person", "daycare", "unit_manager")
AFFECTED = ("absence", "application", "backup_care", "child", "child_attendance", "daycare", "daycare_group", "fee_decision",
            "fridge_child", "fridge_partner", "income", "person", "placement", "service_need", "unit_manager",
            "voucher_value_decision")


def reset_order(roots: Iterable[str], references: Mapping[str, Sequence[str]] = REFERENCES) -> list[str]:
    """``roots`` and all tables that refer to them, directly or not; a table
    comes after every table that refers to it. A cycle raises ``CycleError``."""
    wanted, more = set(), set(roots)
    while more:
        wanted |= more
        more = {t for t, refs in references.items() if wanted & set(refs)} - wanted
    referring = {t: [] for t in sorted(wanted)}
    for t in sorted(wanted):
        for r in references.get(t, ()):
            if r in wanted:
                referring[r].append(t)
    return list(TopologicalSorter(referring).static_order())


def reset(spark: SparkSession, root: str, tables: Sequence[str] = RESET_ROOTS,
          references: Mapping[str, Sequence[str]] = REFERENCES) -> list[str]:
    """Empty the published tables and what refers to them, all at once; returns
    the tables emptied, in order. Tables never published are passed over, an
    unknown name is an error. The id map stays, so a later run gives the same ids."""
    manifest = Manifest(spark, root)
    declared = {*references, *(r for refs in references.values() for r in refs)}
    if unknown := set(tables) - declared - set(manifest.tables):
        raise KeyError(f"unknown table '{min(unknown)}'")
    done = []
    for t in reset_order(tables, references):
        df = manifest.read(t)
        if df is not None:
            manifest.add(spark.createDataFrame([], df.schema), t, "reset", replace=True)
            done.append(t)
    if done:
        manifest.commit()
    return done


def register(spark: SparkSession, root: str, table: str, database: str = "default") -> str:
    """The published table under its name in the catalog: an external table
    with one partition per folder of the current manifest. Returns the name."""
    manifest = Manifest(spark, root)
    df = manifest.read(table)
    if df is None:
        raise KeyError(f"'{table}' is not published in {root}")
    name = f"`{database}`.`{table}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    spark.sql(f"DROP TABLE IF EXISTS {name}")  # external: only the entry goes
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    spark.sql(f"CREATE TABLE {name} ({columns}, published_part INT) USING parquet PARTITIONED BY (published_part) "
              f"LOCATION '{manifest.root}/{table}'")
    parts = " ".join(f"PARTITION (published_part={i}) LOCATION '{manifest.root}/{f}'" for i, f in enumerate(manifest.tables[table]))
    spark.sql(f"ALTER TABLE {name} ADD {parts}")
    return name


def analyze(spark: SparkSession, root: str, tables: Sequence[str] = AFFECTED, database: str = "default") -> dict[str, str]:
    """Register the tables and compute their row counts and the statistics of
    every column of a plain type. Per table "ok" or the error; one table's
    error does not keep the others from being analyzed."""
    out = {}
    for t in tables:
        try:
            name = register(spark, root, t, database)
            plain = [f.name for f in spark.table(name).schema if isinstance(f.dataType, AtomicType) and f.name != "published_part"]
            spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS FOR COLUMNS " + ", ".join(f"`{c}`" for c in plain))
            out[t] = "ok"
        except Exception as e:  # reported per table
            out[t] = f"error: {type(e).__name__}: {str(e).splitlines()[0]}"
    return out
