"""Shared helpers of the reconciliation jobs."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ...operators import identity as ident
from ...operators.joins import hit, spread_left_join
from ...sources import inputs
from ...sources.exclusion import apply_exclusion
from ...sources.specs import exclusion_for

Tables = Mapping[str, DataFrame]

ID_MAP_SCHEMA = "type string, source_id string, target_id string, updated timestamp"


def spark_of(t: Tables) -> SparkSession:
    for df in t.values():
        return df.sparkSession
    raise ValueError("no input tables")


def get(t: Tables, name: str, schema: str | None = None) -> DataFrame:
    """A named input. A present input lacking some declared columns gets them
    as typed NULLs. An absent one stops the job, unless it is declared
    optional (a target table before the first run): then it is empty."""
    if name in t and t[name] is not None:
        return conform(t[name], schema) if schema else t[name]
    if not inputs.is_optional(name):
        raise inputs.InputError(inputs.MISSING, f"Missing input '{name}'")
    return spark_of(t).createDataFrame([], schema or inputs.schema_of(name))


def conform(df: DataFrame, schema: str) -> DataFrame:
    """Add the declared columns the frame lacks, as typed NULLs."""
    spark = df.sparkSession
    declared = spark.createDataFrame([], schema).schema
    have = set(df.columns)
    for f in declared.fields:
        if f.name not in have:
            df = df.withColumn(f.name, F.lit(None).cast(f.dataType))
    return df


def filtered(t: Tables, table: str) -> DataFrame:
    """The staged table minus its exclusion list (S7), when one is given."""
    df = get(t, table)
    ex_spec = exclusion_for(table)
    if ex_spec is not None and ex_spec.name in t:
        df = apply_exclusion(df, t[ex_spec.name], ex_spec.column_names)
    return df


def id_map(t: Tables) -> DataFrame:
    return get(t, "idmap", ID_MAP_SCHEMA)


def with_ids(df: DataFrame, t: Tables, kind: str, guid_col: str = "guid", out: str = "id") -> DataFrame:
    return ident.reuse_ids(df, id_map(t), kind, guid_col, out)


def id_map_update(t: Tables, kind: str, rows: DataFrame, guid_col: str, id_col: str) -> DataFrame:
    """K5 on the id map, restricted to entries of ``kind`` plus all others kept."""
    m = id_map(t)
    others = m.filter(F.col("type") != kind)
    mine = m.filter(F.col("type") == kind)
    up = ident.upsert_id_map(mine, rows, kind, guid_col, id_col).drop("action")
    return others.unionByName(up)


def unique_dim(df: DataFrame, key: str, value: str, out: str | None = None) -> DataFrame:
    """A lookup side with one value per key (the smallest), so a lookup never
    multiplies rows when a mapping file repeats a key."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(value).alias(out or value))


def unit_lookup(df: DataFrame, t: Tables, unit_col: str | None, minder_col: str | None,
                out: str = "unit_id") -> DataFrame:
    """Unit via the unit map, else via the child-minder map."""
    res = df
    cols = []
    if unit_col:
        um = unique_dim(get(t, "unitmap"), "effica_id", "evaka_id", "_um").withColumnRenamed("effica_id", "_um_k")
        res = res.join(um, res[unit_col] == um["_um_k"], "left").drop("_um_k")
        cols.append(F.col("_um"))
    if minder_col:
        cm = unique_dim(get(t, "childmindermap"), "effica_id", "evaka_id", "_cm").withColumnRenamed("effica_id", "_cm_k")
        res = res.join(cm, res[minder_col] == cm["_cm_k"], "left").drop("_cm_k")
        cols.append(F.col("_cm"))
    return res.withColumn(out, F.coalesce(*cols)).drop(*[c for c in ("_um", "_cm") if c in res.columns])


def person_lookup(df: DataFrame, person: DataFrame, ssn_col: str, take: Mapping[str, str]) -> DataFrame:
    """Target person by legacy identity code: all columns of one person,
    the one with the smallest id if several share the code."""
    p = (person.filter(F.col("legacy_ssn").isNotNull()).groupBy(F.col("legacy_ssn").alias("_p_ssn"))
         .agg(F.min_by(F.struct(*[F.col(c).alias(o) for c, o in take.items()]), "id").alias("_p"), hit().alias("_p_hit")))
    found = spread_left_join(df, p, [(ssn_col, "_p_ssn")], "_p_hit")
    return found.select(*df.columns, *[F.col(f"_p.{o}").alias(o) for o in take.values()])


def extent_option(df: DataFrame, t: Tables, code_col: str, days_col: str, out: str = "option_id") -> DataFrame:
    """Service need option by (extent code, days)."""
    em = (get(t, "extentmap").filter(F.col("effica_id").isNotNull())
          .groupBy(F.col("effica_id").alias("_em_k"), F.col("days").alias("_em_days"))
          .agg(F.min("evaka_id").alias(out)))
    j = df.join(em, (df[code_col] == em["_em_k"]) & (df[days_col] == em["_em_days"]), "left")
    return j.drop("_em_k", "_em_days")


def together(spark: SparkSession, *branches: Callable[[], dict[str, DataFrame]]) -> dict[str, DataFrame]:
    """Independent branches of a job at the same time: each writes its
    intermediates, and one's few last tasks leave room for the other's."""
    with ThreadPoolExecutor(len(branches)) as pool:
        made = [f.result() for f in [pool.submit(inheritable_thread_target(spark)(b)) for b in branches]]
    return {name: df for out in made for name, df in out.items()}


def materialize(df: DataFrame, name: str = "intermediate") -> DataFrame:
    """Write an intermediate that several consumers read as a parquet table in
    a fresh folder under the shared ``spark.checkpoint.dir`` and read it back:
    it is computed once instead of once per consumer, and a lost executor
    recomputes from the written table, not from the whole lineage."""
    from ...session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split(flagged: DataFrame, key: Sequence[str], unique: bool = True):
    """Clean rows (no reason) and one todo row per reason. When ``key`` may
    repeat, every row of a key with a reason leaves the clean table (the
    legacy ``DELETE ... WHERE id IN (todo)``). The flagged rows are
    materialized once, so the two outputs do not recompute the job."""
    from ...operators import quality as q
    flagged = materialize(flagged)
    todo = q.todo(flagged)
    clean = q.clean(flagged) if unique else q.remove_keys(flagged.drop(q.REASONS), todo, key)
    return clean, todo
