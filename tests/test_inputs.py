"""Declared inputs of the jobs."""

from collections.abc import Mapping

import pytest

from registrar.plans import loads, transfer
from registrar.plans.runner import run_chain
from registrar.plans.transform import CHAIN
from registrar.plans.transform._common import get
from registrar.sources import inputs


def code_of(call):
    with pytest.raises(inputs.InputError) as e:
        call()
    return e.value.code, str(e.value)


def test_declared_names():
    assert set(inputs.JOB_INPUTS) == set(inputs.JOB_OUTPUTS) == {n for n, *_ in CHAIN}
    assert set(inputs.PUBLISH_INPUTS) == {n for n, *_ in transfer.CHAIN}
    for names in (*inputs.JOB_INPUTS.values(), *inputs.PUBLISH_INPUTS.values()):
        for n in names:
            assert n.startswith("mig_") or inputs.schema_of(n)
    assert inputs.DIMENSIONS["fee_thresholds"].schema == transfer.FEE_THRESHOLDS_SCHEMA


class Watched(Mapping):
    """Tables that note which of them a job asks for."""

    def __init__(self, tables):
        self.tables, self.asked = tables, set()

    def __getitem__(self, name):
        self.asked.add(name)
        return self.tables[name]

    def __contains__(self, name):
        return name in self.tables

    def __iter__(self):
        return iter(self.tables)

    def __len__(self):
        return len(self.tables)


@pytest.mark.parametrize("job", ["persons", "departments", "service_needs", "cleanup"])
def test_jobs_read_what_they_declare(spark, job):
    names = inputs.JOB_INPUTS[job]
    tables = inputs.empty(spark, *(n for n in names if n != "mig_placement" and n != "mig_person"))
    if "mig_placement" in names:
        tables["mig_placement"] = spark.createDataFrame([], "id string, legacy_placement_nbr int, end_date date, daycare_group_id string")
    tables["unused"] = spark.range(1)
    seen = Watched(tables)
    dict((n, f) for n, f, _ in CHAIN)[job](seen)
    assert set(names) <= seen.asked


def test_missing_inputs_are_all_named_before_planning(spark):
    ran = []
    jobs = [("placements", lambda t: ran.append(1)), ("service_needs", lambda t: ran.append(2))]
    code, text = code_of(lambda: run_chain(inputs.empty(spark, "placements", "unitmap"), jobs))
    assert code == inputs.MISSING and not ran
    for t in ("placementextents", "extentmap", "service_need_option", "mig_person", "childmindermap", "mig_daycare_group"):
        assert f"'{t}' of job 'placements'" in text
    assert "'mig_placement' of job" not in text  # placements makes it
    assert code_of(lambda: transfer.publish_all(inputs.empty(spark, "person"), "/nowhere"))[0] == inputs.MISSING
    assert code_of(lambda: get(inputs.empty(spark, "person"), "placements"))[0] == inputs.MISSING
    assert get(inputs.empty(spark, "person"), "idmap").columns == ["type", "source_id", "target_id", "updated"]


def test_dimension_folders(spark, tmp_path):
    def folder(name, rows, schema, at="a"):
        spark.createDataFrame(rows, schema).write.mode("overwrite").parquet(str(tmp_path / at / name))
        return str(tmp_path / at)

    path = folder("service_need_option", [("o1", 0.5, "x")], "id string, fee_coefficient double, unknown string")
    (tmp_path / "a" / "_temporary").mkdir()
    folder("child", [("c",)], "id string")
    got = inputs.load_dimensions(spark, path)
    assert set(got) == {"service_need_option", "child"}
    assert got["service_need_option"].columns == [f.split()[0] for f in inputs.DIMENSIONS["service_need_option"].schema.split(", ")]
    row = got["service_need_option"].collect()[0]
    assert (row.id, float(row.fee_coefficient), row.name_fi) == ("o1", 0.5, None)
    assert set(inputs.load_dimensions(spark, path, ["child"])) == {"child"}

    assert code_of(lambda: inputs.load_dimensions(spark, folder("chlid", [("c",)], "id string", "b")))[0] == inputs.UNKNOWN
    (tmp_path / "c" / "child").mkdir(parents=True)
    assert code_of(lambda: inputs.load_dimensions(spark, str(tmp_path / "c")))[0] == inputs.UNREADABLE
    assert code_of(lambda: inputs.load_dimensions(spark, folder("child", [("c",)], "ident string", "d")))[0] == inputs.COLUMN
    assert code_of(lambda: inputs.load_dimensions(spark, folder("child", [(7,)], "id int", "e")))[0] == inputs.COLUMN
    for k, rows in enumerate(([("c",), ("c",)], [(None,)])):
        code, text = code_of(lambda: inputs.load_dimensions(spark, folder("child", rows, "id string", f"f{k}")))
        assert code == inputs.KEY and "child" in text
    (tmp_path / "g").mkdir()
    assert inputs.load_dimensions(spark, str(tmp_path / "g")) == {}


def test_every_branch_of_the_types_query_has_rows(spark):
    rows = loads.placement_types_job(spark, "/root/testdata/sf0.01").groupBy("type", "outcome").count().collect()
    assert {r.type for r in rows} == {"DAYCARE", "DAYCARE_PART_TIME", "PRESCHOOL_DAYCARE"}
    assert {r.outcome for r in rows} == {"OK", "PERSON MISSING", "UNIT MISSING", "OVERLAPPING PLACEMENT", "UNSUPPORTED PRESCHOOL START",
                                         "INVALID IDENTITY CODE"}
