"""Recomputation gives the same rows, ids included: what a job relies on when
a lost executor's tasks are re-run."""

import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["income_job", "voucher_decision_job", "person_job", "drop_duplicate_rows"])
def test_two_runs_give_identical_rows(spark, name):
    q = entry.queries()[name]
    first = sorted(tuple(str(v) for v in r) for r in q(spark, SF).collect())
    second = sorted(tuple(str(v) for v in r) for r in q(spark, SF).collect())
    assert first == second and first
