"""Constraints of a table, checked in one pass (Q2).

``violations`` reads the table once whatever is declared: a row's own checks
and its foreign keys become flags of the row, and everything that concerns
several rows (unique keys, agreement, intervals that must not overlap) goes
into the same narrow ledger of (constraint, key), which one aggregation closes.

Scale design
------------
* A row gives one ledger entry per constraint over several rows and one per
  failed check; entries are counted before the shuffle. Wide columns never move.
* A foreign key joins the distinct keys of its table, which Spark broadcasts
  or merges by their size. Rows without a reference (NULL) are spread over
  salts, as they would otherwise meet in one task.
* Intervals are collapsed to one entry per (key, start) before the window over
  a key, so that it sees at most one row per calendar day.

NULL follows SQL: a check that is NULL passes, and a key with a NULL in it
neither clashes nor lacks a reference. Empty tables give no rows. Columns of
any name may be present; only names beginning with ``_q2`` are taken.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .intervals import end_or_open, valid_interval

SCHEMA = "constraint_name string, key_text string, n_rows long"
#: Tasks over which rows without a reference are spread.
NULL_SALTS = 1024
#: The error code of a strict run.
VIOLATED = "R-CONSTRAINT-1"


@dataclass(frozen=True)
class Check:
    """A row's own condition; the row breaks it where it is false."""

    name: str
    holds: Column


@dataclass(frozen=True)
class ForeignKey:
    cols: tuple[str, ...]
    ref: DataFrame
    ref_cols: tuple[str, ...]

    @property
    def name(self) -> str:
        return "foreign_key:" + ",".join(self.cols)


@dataclass(frozen=True)
class Unique:
    cols: tuple[str, ...]

    @property
    def name(self) -> str:
        return "unique:" + ",".join(self.cols)


@dataclass(frozen=True)
class Agree:
    """Rows that share ``by`` have the same ``cols`` (NULL is a value). The
    values are compared by a 64-bit hash, which aggregates without a sort."""

    label: str
    by: tuple[str, ...]
    cols: tuple[str, ...]

    @property
    def name(self) -> str:
        return f"consistent:{self.label}"


@dataclass(frozen=True)
class NoOverlap:
    """Intervals (both ends included, a NULL end is open) of rows that share
    ``by`` have no day in common. Rows without a start or with the end before
    it have no days. Reported are the starts that fall into another interval."""

    label: str
    by: tuple[str, ...]
    start: str
    end: str

    @property
    def name(self) -> str:
        return f"no_overlap:{self.label}"


Constraint = Check | ForeignKey | Unique | Agree | NoOverlap


def not_null(*cols: str) -> list[Constraint]:
    return [Check(f"not_null:{c}", F.col(c).isNotNull()) for c in cols]


def check(name: str, holds: Column) -> Constraint:
    return Check(f"check:{name}", holds)


def values(col: str, allowed: Sequence) -> Constraint:
    return Check(f"values:{col}", F.col(col).isin(*allowed))


class ConstraintError(ValueError):
    """A strict run met violations; ``counts`` has them per constraint."""

    def __init__(self, table: str, counts: dict[str, int]):
        listed = ", ".join(f"{n} of {c}" for c, n in sorted(counts.items()))
        super().__init__(f"'{table}' breaks its constraints: {listed} ({VIOLATED})")
        self.code, self.table, self.counts = VIOLATED, table, counts


def _all_set(cols: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull()
    return out


def _text(cols: Sequence[str]) -> Column:
    return F.array(*[F.col(c).cast("string") for c in cols])


def _with_reference(df: DataFrame, fk: ForeignKey, i: int, keys: Sequence[str]) -> DataFrame:
    """Adds ``_q2miss<i>``: the row names a key that the reference lacks."""
    names = [f"_q2r{i}_{j}" for j in range(len(fk.cols))]
    salt, hit = f"_q2s{i}", f"_q2h{i}"
    given = _all_set(fk.cols)
    # an aggregate and no literal, so that the salt stays a key of the join
    ref = (fk.ref.select(*[F.col(c).alias(n) for c, n in zip(fk.ref_cols, names)]).where(_all_set(names))
           .groupBy(*names).agg(F.min(F.lit(0)).alias(hit)))
    left = df.withColumn(salt, F.when(given, 0).otherwise(1 + F.pmod(F.xxhash64(*keys), F.lit(NULL_SALTS)).cast("int")))
    cond = F.col(salt) == F.col(hit)
    for c, n in zip(fk.cols, names):
        cond = cond & (F.col(c) == F.col(n))
    return (left.join(ref, cond, "left").withColumn(f"_q2miss{i}", given & F.col(hit).isNull())
            .drop(salt, hit, *names))


def violations(df: DataFrame, keys: Sequence[str], constraints: Sequence[Constraint]) -> DataFrame:
    """One row per broken constraint and key: the row's ``keys`` for checks and
    foreign keys, the shared key for the others (with the start for
    intervals), as text joined by ``|``, NULL as empty; ``n_rows`` counts the
    rows concerned."""
    names = [c.name for c in constraints]
    if not names:
        return df.sparkSession.createDataFrame([], SCHEMA)
    intervals = any(isinstance(c, NoOverlap) for c in constraints)
    agreement = any(isinstance(c, Agree) for c in constraints)
    for i, c in enumerate(constraints):
        if isinstance(c, ForeignKey):
            df = _with_reference(df, c, i, keys)

    def entry(i: int, key: Column, start: Column | None = None, end: Column | None = None, value: Column | None = None) -> Column:
        parts = [F.lit(i).alias("c"), key.alias("k")]
        if intervals:
            parts += [(F.lit(None) if start is None else start).cast("date").alias("s"),
                      (F.lit(None) if end is None else end).cast("date").alias("e")]
        if agreement:
            parts.append((F.lit(None) if value is None else F.xxhash64(value)).cast("long").alias("v"))
        return F.struct(*parts)

    # a unique key that is also an agreement's key is counted by the agreement's entries
    by_agreement = {i: a for i, c in enumerate(constraints) if isinstance(c, Unique)
                    for a, g in enumerate(constraints) if isinstance(g, Agree) and g.by == c.cols}
    entries = []
    for i, c in enumerate(constraints):
        if isinstance(c, Check):
            entries.append(F.when(~F.coalesce(c.holds, F.lit(True)), entry(i, _text(keys))))
        elif isinstance(c, ForeignKey):
            entries.append(F.when(F.col(f"_q2miss{i}"), entry(i, _text(keys))))
        elif isinstance(c, Unique):
            if i not in by_agreement:
                entries.append(F.when(_all_set(c.cols), entry(i, _text(c.cols))))
        elif isinstance(c, Agree):
            entries.append(F.when(_all_set(c.by), entry(i, _text(c.by), value=F.to_json(_text(c.cols)))))
        else:
            days = _all_set(c.by) & valid_interval(c.start, c.end)
            entries.append(F.when(days, entry(i, _text(c.by), F.col(c.start), end_or_open(c.end))))
    # exploded first and filtered then: a lambda over the array would not be compiled
    ledger = df.select(F.explode(F.array(*entries)).alias("x")).where("x is not null").select("x.*")

    aggs = [F.count(F.lit(1)).alias("n")]
    if intervals:
        aggs.append(F.max("e").alias("e"))
    if agreement:
        aggs += [F.min("v").alias("lo"), F.max("v").alias("hi")]
    closed = ledger.groupBy("c", "k", *(["s"] if intervals else [])).agg(*aggs)

    def ids(kind) -> list[int]:
        return [i for i, c in enumerate(constraints) if isinstance(c, kind)]

    counted = sorted({by_agreement.get(i, i) for i in ids(Unique)})
    broken = F.col("c").isin(ids((Check, ForeignKey))) | (F.col("c").isin(counted) & (F.col("n") > 1))
    if agreement:
        broken = broken | (F.col("c").isin(ids(Agree)) & (F.col("lo") != F.col("hi")))
    key = F.col("k")
    if intervals:
        spans = F.col("c").isin(ids(NoOverlap))
        before = Window.partitionBy("c", "k").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
        closed = closed.where(broken | spans).withColumn("_before", F.max("e").over(before))
        broken = broken | (spans & ((F.col("n") > 1) | (F.col("_before") >= F.col("s"))))
        key = F.when(F.col("s").isNull(), key).otherwise(F.concat(key, F.array(F.col("s").cast("string"))))
    named = F.element_at(F.array(*[F.lit(n) for n in names]), F.col("c") + 1)
    found = closed.where(broken)
    if by_agreement:  # such an entry stands for the agreement, the unique key, or both
        agrees = ~F.col("c").isin(sorted(set(by_agreement.values()))) | (F.col("lo") != F.col("hi"))
        both = [F.when(agrees, named)] + [F.when((F.col("c") == a) & (F.col("n") > 1), F.lit(names[i])) for i, a in by_agreement.items()]
        found, named = found.withColumn("_name", F.explode(F.array(*both))).where("_name is not null"), F.col("_name")
    return found.select(
        named.alias("constraint_name"),
        F.array_join(key, "|", "").alias("key_text"),
        F.col("n").alias("n_rows"))


def counts(found: DataFrame) -> dict[str, int]:
    """Violations per constraint; at most one row per declared constraint comes to the driver."""
    return {r.constraint_name: r.n for r in found.groupBy("constraint_name").agg(F.count(F.lit(1)).alias("n")).collect()}


def require_none(table: str, n: int, found: DataFrame) -> None:
    """Strict mode: ``n`` is the number observed while the violations were
    written; only if there are any is the written table read."""
    if n:
        raise ConstraintError(table, counts(found))
