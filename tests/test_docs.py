"""docs/COVERAGE.md only cites queries and test modules that exist."""

import os
import re

import __spark_entry__  # noqa: F401  (registers the queries)
from registrar.plans.registry import QUERIES

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_coverage_map_references_exist():
    text = open(os.path.join(ROOT, "docs", "COVERAGE.md"), encoding="utf-8").read()
    queries = set(re.findall(r"q:([a-z_0-9]+)", text))
    tests = set(re.findall(r"t:([a-z_0-9]+)", text))
    assert queries and tests
    assert queries <= set(QUERIES), queries - set(QUERIES)
    for t in tests:
        assert os.path.exists(os.path.join(ROOT, "tests", f"{t}.py")), t


def test_every_query_is_in_the_coverage_map():
    text = open(os.path.join(ROOT, "docs", "COVERAGE.md"), encoding="utf-8").read()
    cited = set(re.findall(r"q:([a-z_0-9]+)", text))
    missing = set(QUERIES) - cited
    assert not missing, missing
