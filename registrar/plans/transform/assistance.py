"""D3 assistance needs and D4 assistance actions (day expansion + islands)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ...functions import codes
from ...functions import dictionaries as dic
from ...operators import identity as ident
from ...operators import intervals as iv
from ...operators import quality as q
from ._common import Tables, get, person_lookup, split


def _periods(t: Tables, table: str, code_col: str, mapping: dict, out: str, kind: str) -> DataFrame:
    """Each row's interval (open end: 31 July of the birth year + 6 years,
    else start + 6 years - 1 day) contributes its mapped value; the result is
    the maximal periods per child with the same sorted set of values on every
    day, as the legacy day expansion + islands gives, computed by a boundary
    sweep (``value_set_periods``) instead of one row per day."""
    src = get(t, table)
    src = person_lookup(src, get(t, "mig_person"), "personid", {"id": "child_id", "date_of_birth": "_dob"})
    fallback = F.coalesce(F.add_months(F.make_date(F.year("_dob"), F.lit(7), F.lit(31)), 72),
                          F.date_sub(F.add_months(F.col("startdate"), 72), 1))
    src = src.withColumn("_end", F.coalesce(F.col("enddate"), fallback))
    values = {k: str(v) for k, v in mapping.items()}
    src = src.withColumn("_value", codes.map_code(code_col, values, key_type="int"))
    src = src.withColumnRenamed("personid", "legacy_ssn")
    isl = iv.value_set_periods(src, ["legacy_ssn", "child_id"], "startdate", "_end", "_value",
                               sorted(set(values.values())), out=out)
    rows = isl.select(ident.hash_uuid(kind, "legacy_ssn", "start_date", F.array_join(out, ",")).alias("id"),
                      "legacy_ssn", "child_id", "start_date", "end_date", out)
    flagged = q.flag(rows, [("PERSON MISSING", F.col("child_id").isNull())])
    return split(flagged, ["id"])


def special_needs(t: Tables) -> dict[str, DataFrame]:
    clean, todo = _periods(t, "specialneeds", "specialneedcode", dic.SPECIAL_NEED, "bases", "ASSISTANCE_NEED")
    return {"mig_assistance_need": clean, "mig_assistance_need_todo": todo}


def special_means(t: Tables) -> dict[str, DataFrame]:
    clean, todo = _periods(t, "specialmeans", "mean", dic.SPECIAL_MEAN, "actions", "ASSISTANCE_ACTION")
    return {"mig_assistance_action": clean, "mig_assistance_action_todo": todo}
