"""Staging (S1, S5, K1): a dump is read once, checked while it is written.

Every record of a source becomes either a typed row of the staged table or a
row of its error table with one of the coded errors, its file and its text.
Both are written by the same job, as two partitions of one folder; counters
observed on that job (``DataFrame.observe``) tell what was found, so no check
reads the dump, or the table, again. In strict mode a source with errors
raises and hands out no table. Later jobs read the written tables.

Only a comment or CDATA section that crosses file splits makes a source be
read a second time (see ``scanner``).
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from . import errors as E
from . import records, scanner
from .delimited import read_delimited
from .specs import REGISTRY, TableSpec

ROW, ERROR, SPLIT = "row", "error", "split"
ERROR_DDL = "`table` string, code string, file string, detail string, fragment string"
#: In the order in which a source's errors are reported.
RECORD_CODES = (E.AMBIGUOUS_TABLE_DATA, E.NON_FLAT_DATA, E.NON_MAPPED_COLUMN, E.MALFORMED_RECORD)
MESSAGES = {E.AMBIGUOUS_TABLE_DATA: "Table data ambiguous: more than one element type in",
            E.NON_FLAT_DATA: "Nested values in", E.NON_MAPPED_COLUMN: "Type definition for a column not found in",
            E.MALFORMED_RECORD: "Malformed record in", E.NO_DATA_CONTENT: "No parseable data element detected in"}


@dataclass(frozen=True)
class Staged:
    """One source: its table, its error rows, and what was counted."""

    table: DataFrame
    errors: DataFrame
    rows: int
    by_code: Mapping[str, int]
    scans: int = 1


def coded(scanned: DataFrame, spec: TableSpec, element: str) -> DataFrame:
    """Scanned pieces -> (kind, code, file, detail, fragment, transition
    columns, typed columns): one row per record, error or split transition."""
    close = f"</{element}>"
    v = F.regexp_replace("value", r"<\?[^>]*\?>", "")
    pos = F.regexp_instr(v, F.lit(f"<{element}" + r"(\s[^>]*)?>"))
    split = F.col("from_state").isNotNull()
    has = ~split & (pos > 0)
    cut = scanned.select("file", "start", "value", "from_state", "to_state", "replaces",
                         F.when(has, F.concat(F.substring(v, pos, F.length(v)), F.lit(close))).alias("fragment"),
                         F.when(~split, F.trim(F.when(has, F.substring(v, F.lit(1), pos - 1)).otherwise(v))).alias("stray"))
    inner = F.regexp_replace(F.regexp_replace("fragment", f"^<{element}" + r"(\s[^>]*)?>", ""), f"{close}$", "")
    left = F.regexp_replace(F.regexp_replace(inner, records.FLAT_CHILD, ""), records.EMPTY_CHILD, "")
    tags = F.transform(F.regexp_extract_all(inner, F.lit("<(" + records.NAME + ")"), 1), F.lower)
    unknown = F.array_except(tags, F.array(*(F.lit(c) for c in spec.column_names)))
    schema = ", ".join(f"`{c}` string" for c in spec.column_names) + f", `{records.CORRUPT}` string"
    parsed = cut.select("*", left.contains("<").alias("nested"), F.get(unknown, 0).alias("unknown"),
                        F.from_xml("fragment", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": records.CORRUPT}).alias("r"))
    stray = F.col("stray").rlike("<" + records.NAME)
    bad = F.col("fragment").isNotNull()
    code = (F.when(stray, E.AMBIGUOUS_TABLE_DATA).when(bad & F.col(f"r.{records.CORRUPT}").isNotNull(), E.MALFORMED_RECORD)
            .when(bad & F.col("nested"), E.NON_FLAT_DATA).when(bad & F.col("unknown").isNotNull(), E.NON_MAPPED_COLUMN))
    kinds = parsed.select("*", code.alias("code")).where("from_state is not null or fragment is not null or code is not null")
    kind = F.when(F.col("from_state").isNotNull(), SPLIT).when(F.col("code").isNotNull(), ERROR).otherwise(ROW)
    kept = ~F.col("code").isNull()
    return kinds.select(
        kind.alias("kind"), "code", "file", "start", "from_state", "to_state", "replaces", F.when(split, F.col("value")).alias("carry"),
        F.when(kept, F.coalesce("unknown", F.nullif(F.regexp_extract("stray", "<(" + records.NAME + ")", 1), F.lit("")))).alias("detail"),
        F.when(kept, F.coalesce("fragment", "stray")).alias("fragment"),
        *(c.expr(F.col(f"r.`{c.name}`")).alias(f"v_{c.name}") for c in spec.columns))


def _write(rows: DataFrame, path: str) -> dict[str, int]:
    """Write the rows by kind, counting them on the way."""
    seen = Observation("staging")
    counts = {"rows": F.count_if(F.col("kind") == ROW), **{c: F.count_if(F.col("code") == c) for c in RECORD_CODES}}
    rows.observe(seen, *(e.alias(n) for n, e in counts.items())).write.partitionBy("kind").parquet(path)
    found = seen.get
    return {n: int(found.get(n) or 0) for n in counts}


def _read(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """One kind's folder; a kind without rows has none."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return spark.createDataFrame([], ddl)
    return spark.read.schema(ddl).parquet(path)


def stage_pieces(raw: DataFrame, spec: TableSpec, element: str, path: str) -> Staged:
    """Stage the pieces (file, start, value) of a dump under ``path``."""
    spark, scans, at = raw.sparkSession, 1, f"{path}/scan-1"
    counts = _write(coded(scanner.scan(raw, element), spec, element), at)
    transitions = _read(spark, f"{at}/kind={SPLIT}", "file string, start bigint, from_state string, to_state string, replaces boolean, carry string")
    scanner.starts(transitions.withColumnRenamed("carry", "value")).write.parquet(f"{path}/starts")
    inside = spark.read.parquet(f"{path}/starts")
    if inside.where("start is not null").take(1):  # a comment crosses splits: again, from the true starts
        scans, at = 2, f"{path}/scan-2"
        counts = _write(coded(scanner.scan(scanner.with_starts(raw, inside), element), spec, element), at)
    cut_off = inside.where("start is null and trim(carry) <> ''")  # a file that ends inside a comment, within a record
    lost = cut_off.count()
    errors = _read(spark, f"{at}/kind={ERROR}", "code string, file string, detail string, fragment string").unionByName(
        cut_off.select(F.lit(E.MALFORMED_RECORD).alias("code"), "file", F.lit("comment without an end").alias("detail"), F.col("carry").alias("fragment")))
    typed = _read(spark, f"{at}/kind={ROW}", ", ".join(f"v_{c.name} {t}" for c, t in zip(spec.columns, _types(spec))))
    by_code = {c: counts[c] + (lost if c == E.MALFORMED_RECORD else 0) for c in RECORD_CODES}
    if not counts["rows"] and not any(by_code.values()):
        by_code[E.NO_DATA_CONTENT] = 1
        errors = errors.unionByName(spark.createDataFrame([(E.NO_DATA_CONTENT, None, None, None)], "code string, file string, detail string, fragment string"))
    return Staged(typed.select(*(F.col(f"v_{c}").alias(c) for c in spec.column_names)),
                  errors.select(F.lit(spec.name).alias("table"), "code", "file", "detail", "fragment"),
                  counts["rows"], {c: n for c, n in by_code.items() if n}, scans)


def _types(spec: TableSpec) -> Iterable[str]:
    return (part.split(" ", 1)[1] for part in _columns(spec.ddl()))


def _columns(ddl: str) -> list[str]:
    """The columns of a DDL string; commas inside types don't part them."""
    out, depth, at = [], 0, 0
    for k, ch in enumerate(ddl):
        depth += (ch in "<(") - (ch in ">)")
        if ch == "," and not depth:
            out.append(ddl[at:k].strip())
            at = k + 1
    return [*out, ddl[at:].strip()]


def stage_files(spark: SparkSession, files: Iterable[str], spec: TableSpec, element: str, path: str | None = None) -> Staged:
    """Stage the record files of one table in a new folder."""
    return stage_pieces(scanner.pieces(spark, list(files), element), spec, element, path or scratch_path(spark, f"staged-{spec.name}"))


def raise_first(staged: Staged, table: str) -> None:
    """Strict mode: the first error of a source, with its file, as an exception."""
    for code in (E.AMBIGUOUS_TABLE_DATA, E.NO_DATA_CONTENT, E.NON_FLAT_DATA, E.NON_MAPPED_COLUMN, E.MALFORMED_RECORD):
        if staged.by_code.get(code):
            first = staged.errors.where(F.col("code") == code).orderBy("file", "fragment").first()
            where = "".join(f", {label} {x}" for label, x in (("found:", first.detail), ("file", first.file)) if x)
            raise E.IngestError(code, f"{MESSAGES[code]} '{table}' ({sum(staged.by_code.values())} in all{where})")


@dataclass(frozen=True)
class StagedDir:
    tables: dict[str, DataFrame]
    errors: DataFrame
    counts: dict[str, int]


def stage_dir(spark: SparkSession, path: str, target: str | None = None, registry: dict[str, TableSpec] | None = None,
              strict: bool = True, out_dir: str | None = None) -> StagedDir:
    """Stage every record and delimited file of a folder. Strict: the first
    error raises, and nothing is handed out. Otherwise sources without errors
    come as tables, and all errors as rows (table, code, file, detail,
    fragment); a table with errors is handed out without the records in error."""
    registry = registry or REGISTRY
    root = out_dir or scratch_path(spark, "staged")
    tables, counts, errors, alone = {}, {}, [], []
    for table, files, kind in records.grouped(spark, path, target):
        try:
            if table not in registry:
                raise E.IngestError(E.NON_MAPPED_TABLE, f"Type definitions for table '{table}' not found")
            spec = registry[table]
            if kind == "delimited":
                seen = Observation(f"staging {table}")
                read_delimited(spark, files, spec).observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(f"{root}/{table}-delimited")
                tables[table], counts[table] = spark.read.schema(spec.ddl()).parquet(f"{root}/{table}-delimited"), int(seen.get["n"])
                continue
            element = spec.element or records.discover_element(spark, files)
            if element is None:
                raise E.IngestError(E.NO_DATA_CONTENT, f"{MESSAGES[E.NO_DATA_CONTENT]} '{table}'")
            staged = stage_files(spark, files, spec, element, f"{root}/{table}")
        except E.IngestError as e:
            if strict:
                raise
            alone.append((table, e.code, files[0], str(e), None))
            continue
        if strict:
            raise_first(staged, table)
        errors.append(staged.errors)
        if staged.rows:
            tables[table], counts[table] = staged.table, staged.rows
    every = spark.createDataFrame(alone, ERROR_DDL)
    for e in errors:
        every = every.unionByName(e)
    return StagedDir(tables, every, counts)
