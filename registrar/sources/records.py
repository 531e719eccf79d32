"""Record-file scan (S1, S3-S6): root-less XML dumps, one repeated element per row.

A dump has no root element: ``<person>...</person><person>...</person>``.
Spark's XML source reads only the first row of such a file, so the files are
split by the text source with the element's closing tag as record separator
(``lineSep``). ``scanner`` makes the pieces whole records (comments, CDATA) and
``staging`` parses them with ``from_xml``, checks and writes them. The text
source splits large files across tasks at separator boundaries, so one file of
any size is read in parallel, with no buffer to size (the legacy chunked
import, S6, is not needed).

The census further down checks the fragments of a stream's micro-batch
(``streaming``): unknown column, nested value, no data, more than one element.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import errors as E
from .specs import TableSpec

NAME = r"[A-Za-z_][A-Za-z0-9_.-]*"
COMMENT = r"(?s)<!--.*?-->"
CORRUPT = "_corrupt_record"
FLAT_CHILD = r"<(" + NAME + r")(\s[^>]*)?>[^<]*</\1\s*>"
EMPTY_CHILD = r"<" + NAME + r"(\s[^>]*)?/>"


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Regular files directly in ``path`` (sub-folders are not entered), or the
    file ``path`` itself. Names that Spark's readers would skip are listed too."""
    jvm = spark._jvm.org.apache.hadoop.fs
    where = jvm.Path(path)
    fs = where.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.listStatus(where) if s.isFile())


def _stem(p: str) -> str:
    name = p.rsplit("/", 1)[-1].lower()
    return name.split(".")[0]


def _is_data_file(p: str) -> bool:
    n = p.rsplit("/", 1)[-1].lower()
    if n.endswith(".license") or n == "_success":
        return False
    if n.startswith((".", "_")):
        raise E.IngestError(E.NON_MAPPED_TABLE, f"File '{n}' has a name that Spark does not read; rename it")
    return True


def discover_element(spark: SparkSession, files: Sequence[str]) -> str | None:
    """First element name of a dump (comments and declarations skipped).

    Reads a file's beginning, split at every ``>`` so that each piece is one
    tag's worth of text even when the dump has no line breaks at all, and
    reads on while it holds nothing but comments and declarations."""
    for f in files:
        chunks = 400
        while True:
            head = spark.read.option("lineSep", ">").text(f).limit(chunks).collect()
            text = ">".join(r.value for r in head)
            text = re.sub(r"(?s)<!--.*?(-->|\Z)", "", text)
            text = re.sub(r"(?s)<\?.*?(\?>|\Z)", "", text)
            m = re.search(r"<(" + NAME + r")([\s>/]|\Z)", text)
            if m:
                return m.group(1)
            if len(head) < chunks:
                break
            chunks *= 8
    return None


def grouped(spark: SparkSession, path: str, target: str | None = None) -> list[tuple[str, list[str], str]]:
    """S3: (table, files, kind) of a folder: files by their stem, or all for one explicit target."""
    groups: dict[tuple[str, str], list[str]] = {}
    for f in list_files(spark, path):
        if _is_data_file(f):
            groups.setdefault((target or _stem(f), "delimited" if f.lower().endswith(".csv") else "record"), []).append(f)
    return [(table, files, kind) for (table, kind), files in sorted(groups.items(), key=lambda g: (g[0][1] != "record", g[0][0]))]


def fragments_of(raw: DataFrame, element: str) -> DataFrame:
    """``fragments`` of pieces (``value``) that end at the element's closing tag."""
    close = f"</{element}>"
    v = F.regexp_replace(F.col("value"), COMMENT, "")
    v = F.regexp_replace(v, r"<\?[^>]*\?>", "")
    open_re = "<" + element + r"(\s[^>]*)?>"
    pos = F.regexp_instr(v, F.lit(open_re))
    has_open = pos > 0
    before = F.when(has_open, F.substring(v, F.lit(1), pos - 1)).otherwise(v)
    body = F.when(has_open, F.concat(F.substring(v, pos, F.length(v)), F.lit(close)))
    return raw.select(body.alias("fragment"), F.trim(before).alias("stray"))


def census(frags: DataFrame, element: str) -> dict:
    """Tag names and structural counters, aggregated on the executors.

    Tags are exploded before they are collected, so what reaches the driver
    is bounded by the number of distinct tag names, not by the records."""
    inner = F.regexp_replace(F.col("fragment"), "^<" + element + r"(\s[^>]*)?>", "")
    inner = F.regexp_replace(inner, "</" + element + ">$", "")
    leftover = F.regexp_replace(F.regexp_replace(inner, FLAT_CHILD, ""), EMPTY_CHILD, "")
    per = frags.select(
        F.col("fragment").isNotNull().alias("_has"),
        (F.col("fragment").isNotNull() & leftover.contains("<")).alias("_nested"),
        F.coalesce(F.col("stray").rlike("<" + NAME), F.lit(False)).alias("_stray"),
        F.posexplode_outer(F.regexp_extract_all(inner, F.lit("<(" + NAME + ")"), 1)).alias("_pos", "_tag"))
    first = F.col("_pos").isNull() | (F.col("_pos") == 0)
    row = per.agg(
        F.sum(F.when(first & F.col("_has"), 1).otherwise(0)).alias("n"),
        F.sum(F.when(first & F.col("_nested"), 1).otherwise(0)).alias("nested"),
        F.sum(F.when(first & F.col("_stray"), 1).otherwise(0)).alias("stray"),
        F.array_sort(F.collect_set(F.lower("_tag"))).alias("tags"),
    ).first()
    return {"n": row["n"] or 0, "nested": row["nested"] or 0, "stray": row["stray"] or 0,
            "tags": list(row["tags"] or [])}


def validate(c: dict, spec: TableSpec) -> None:
    """Raise the first structural error found."""
    if c["stray"]:
        raise E.IngestError(E.AMBIGUOUS_TABLE_DATA,
                            f"Table data ambiguous: more than one element type in '{spec.name}'")
    if c["n"] == 0:
        raise E.IngestError(E.NO_DATA_CONTENT, f"No parseable data element detected in '{spec.name}'")
    if c["nested"]:
        raise E.IngestError(E.NON_FLAT_DATA, f"Nested values in '{spec.name}'")
    unknown = [t for t in c["tags"] if spec.column(t) is None]
    if unknown:
        raise E.IngestError(E.NON_MAPPED_COLUMN,
                            f"Type definition for column '{unknown[0]}' in table '{spec.name}' not found")


def parse_fragments(frags: DataFrame, spec: TableSpec) -> DataFrame:
    """``from_xml`` into text fields (tags bind case-insensitively), then the
    spec's parsers type every column; absent columns come out NULL-parsed."""
    schema = ", ".join(f"`{c}` string" for c in spec.column_names) + f", `{CORRUPT}` string"
    rec = frags.filter(F.col("fragment").isNotNull()).select(
        F.from_xml("fragment", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    broken = F.col(f"r.{CORRUPT}")  # a record that is no XML stops the load, with its text
    rec = rec.filter(F.when(broken.isNotNull(), F.raise_error(F.concat(F.lit(f"Malformed record in '{spec.name}': "), broken)).cast("boolean"))
                     .otherwise(F.lit(True)))
    return rec.select(*[c.expr(F.col(f"r.`{c.name}`")).alias(c.name) for c in spec.columns])


def read_records(spark: SparkSession, files: Sequence[str], spec: TableSpec, element: str | None = None) -> DataFrame:
    """The typed rows of record files, staged in a new folder; raises on the first coded error."""
    from . import staging
    element = element or spec.element or discover_element(spark, files)
    if element is None:
        raise E.IngestError(E.NO_DATA_CONTENT, f"No parseable data element detected in '{spec.name}'")
    staged = staging.stage_files(spark, files, spec, element)
    staging.raise_first(staged, spec.name)
    return staged.table


def ingest_dir(spark: SparkSession, path: str, target: str | None = None,
               registry: dict[str, TableSpec] | None = None, out_dir: str | None = None) -> dict[str, DataFrame]:
    """E1 import: every record and delimited file of a folder -> staged, typed
    tables, each written once. Raises ``IngestError`` with the coded errors."""
    from . import staging
    return staging.stage_dir(spark, path, target, registry, out_dir=out_dir).tables


def _xml_escape(c):
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    return F.replace(c, F.lit(">"), F.lit("&gt;"))


def write_records(df: DataFrame, path: str, element: str, tag_names: dict[str, str] | None = None) -> None:
    """Write rows as a root-less record dump (one element per row; NULL -> empty
    tag). ``tag_names`` overrides the tag spelling per column (e.g. mixed case)."""
    tag_names = tag_names or {}
    parts = [F.lit(f"<{element}>")]
    for c in df.columns:
        t = tag_names.get(c, c)
        parts += [F.lit(f"<{t}>"), F.coalesce(_xml_escape(F.col(c).cast("string")), F.lit("")), F.lit(f"</{t}>")]
    parts.append(F.lit(f"</{element}>"))
    df.select(F.concat(*parts).alias("value")).write.mode("errorifexists").text(path)
