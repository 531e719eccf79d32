"""Plan-shape checks for the scale rules: no window over raw rows of a key,
no join on the key alone for interval pairs, keep-first without a window."""

import datetime as dt

from pyspark.sql import functions as F

from registrar.operators import dedupe
from registrar.operators import intervals as iv


def _tree(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def _subtree(lines, i):
    depth = len(lines[i]) - len(lines[i].lstrip(" :+-"))
    out = []
    for line in lines[i + 1:]:
        d = len(line) - len(line.lstrip(" :+-"))
        if d <= depth:
            break
        out.append(line)
    return out


def _frame(spark):
    rows = [(i, i % 3, dt.date(2020, 1, 1) + dt.timedelta(days=i % 50), None) for i in range(200)]
    return spark.createDataFrame(rows, "id long, k long, s date, e date")


def test_windows_only_over_aggregated_rows(spark):
    df = _frame(spark)
    for out in (iv.conflicts(df, ["k"], "s", "e"), iv.close_open_ends(df, ["k"], "s", "e"),
                iv.islands(df, ["k"], "s")):
        lines = _tree(out)
        windows = [i for i, line in enumerate(lines) if "Window " in line]
        assert windows
        for i in windows:
            sub = _subtree(lines, i)
            first_agg = next(j for j, line in enumerate(sub) if "Aggregate" in line)
            first_rel = next(j for j, line in enumerate(sub) if "LocalRelation" in line or "LogicalRDD" in line)
            assert first_agg < first_rel, "\n".join(lines)


def test_overlap_join_keys_include_bin(spark):
    a = _frame(spark).select(F.col("id").alias("a"), "k", F.col("s").alias("as_"), F.col("e").alias("ae"))
    b = _frame(spark).select(F.col("id").alias("b"), "k", F.col("s").alias("bs"), F.col("e").alias("be"))
    out = iv.overlap_join(a, b, ["k"], ("as_", "ae"), ("bs", "be"))
    joins = [line for line in _tree(out) if " Join " in line or line.strip().startswith(("Join", "+- Join", ":- Join"))]
    assert joins and all("_bin" in line and "_rbin" in line for line in joins if "Inner" in line), joins


def test_keep_first_is_an_aggregate(spark):
    out = dedupe.keep_first(_frame(spark), ["k"], ["id"])
    text = "\n".join(_tree(out))
    assert "Window" not in text and "min_by" in text
