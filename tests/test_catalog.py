"""Reset along foreign keys, statistics of registered tables."""

from graphlib import CycleError

import pytest

from registrar import cli
from registrar.sinks import catalog
from registrar.sinks.publish import Manifest, published


@pytest.fixture()
def target(spark, tmp_path):
    root = str(tmp_path / "target")
    for run in (1, 2):
        m = Manifest(spark, root)
        m.add(spark.createDataFrame([(f"p{run}{i}", run) for i in range(3)], "id string, n int"), "person", "a")
        if run == 1:
            m.add(spark.createDataFrame([("c1", "p11")], "id string, person string"), "child", "a")
            m.add(spark.createDataFrame([("pl1", "c1")], "id string, child_id string"), "placement", "a")
            m.add(spark.createDataFrame([("u1", ["x"])], "id string, kinds array<string>"), "daycare", "a")
            m.add(spark.createDataFrame([("m1",)], "id string"), "unit_manager", "a")
            m.add(spark.createDataFrame([("PERSON", "s1")], "type string, source_id string"), "idmap", "a")
        m.commit()
    return root


def test_order_walks_all_references():
    order = catalog.reset_order(["person"])
    assert order[-1] == "person" and "daycare" not in order and "unit_manager" not in order
    for t in order:
        assert all(order.index(t) < order.index(r) for r in catalog.REFERENCES.get(t, ()) if r in order), t
    assert set(catalog.reset_order(catalog.RESET_ROOTS)) == {*catalog.REFERENCES, "person", "unit_manager"}
    assert catalog.reset_order(["x"], {}) == ["x"]
    with pytest.raises(CycleError):
        catalog.reset_order(["a"], {"a": ("b",), "b": ("a",)})


def test_reset_empties_what_refers_to_a_table(spark, target):
    assert published(spark, target, "person").count() == 6
    assert catalog.reset(spark, target, ["person"]) == ["placement", "child", "person"]
    for t in ("person", "child", "placement"):
        assert published(spark, target, t).count() == 0
    assert published(spark, target, "person").columns == ["id", "n"]
    assert published(spark, target, "daycare").count() == 1 and published(spark, target, "idmap").count() == 1
    with pytest.raises(KeyError):
        catalog.reset(spark, target, ["persons"])


def test_statistics_cover_all_versions(spark, target):
    out = catalog.analyze(spark, target, ["person", "daycare", "income"], "reg_stats")
    assert out["person"] == "ok" and out["daycare"] == "ok" and out["income"].startswith("error: KeyError")
    assert spark.table("reg_stats.person").count() == 6
    stats = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED reg_stats.person n").collect()}
    assert (stats["min"], stats["max"], stats["distinct_count"], stats["num_nulls"]) == ("1", "2", "2", "0")
    rows = [r.data_type for r in spark.sql("DESCRIBE EXTENDED reg_stats.person").collect() if r.col_name == "Statistics"]
    assert "6 rows" in rows[0]


def test_from_the_command_line(spark, target, capsys):
    assert cli.main(["--target", target, "--analyze", "reg_cli"]) == 0
    assert '"person": "ok"' in capsys.readouterr().out
    assert cli.main(["--target", target, "--reset"]) == 0
    assert published(spark, target, "daycare").count() == 0 and published(spark, target, "person").count() == 0
    assert cli.main(["--target", target, "--reset", "nothing"]) == 2
    with pytest.raises(SystemExit):
        cli.main(["--target", target])
