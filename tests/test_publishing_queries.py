"""The publishing queries cover every output of every job with rows of each kind."""

import re

import pytest

import __spark_entry__  # noqa: F401  (registers the queries)
from registrar.plans.registry import ORACLE, QUERIES

SF = "/root/testdata/sf0.001"
JOBS = ["persons", "families", "assistance_needs", "assistance_actions", "income", "units", "placements_all", "fee_alterations",
        "voucher_decisions", "fee_decisions_all", "applications", "daily_records", "unit_external_ids"]


@pytest.mark.parametrize("job", JOBS)
def test_every_output_has_rows(spark, job):
    name = f"publish_{job}_job"
    rows = QUERIES[name](spark, SF).collect()
    targets = set(re.findall(r"SELECT '([a-z_]+)' AS target", ORACLE[name]))
    assert {r.target for r in rows} == targets
    for r in rows:
        assert r.row_text.count("|") >= r.columns.count(",")
    assert len({(r.target, r.row_text) for r in rows}) > 5


def test_forms_have_both_shapes(spark):
    docs = [r.row_text for r in QUERIES["publish_applications_job"](spark, SF).collect() if r.target == "application_form"]
    assert any('"clubCare":{' in d for d in docs) and any('"type":"PRESCHOOL"' in d for d in docs)
    assert any('"serviceNeedOption":{"id"' in d for d in docs) and any('"serviceNeedOption":null' in d for d in docs)
    assert any(d.endswith("|~|true") for d in docs)  # a type without a form
