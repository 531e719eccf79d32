"""K3 all-or-nothing publishing, K5 / I1 the id map across runs."""

import pytest

from registrar.plans import transfer
from registrar.sinks import publish
from registrar.sources import inputs

PERSON = "id string, legacy_guid string, social_security_number string, last_name string, first_name string, email string, " \
         "language string, street_address string, postal_code string, post_office string, nationalities array<string>, " \
         "restricted_details_enabled boolean, phone string, backup_phone string, legacy_ssn string, date_of_birth date, source_system string"


def state(spark, ids, groups=()):
    people = [(i, f"g-{i}", f"s-{i}", *[None] * 7, [], False, None, None, f"s-{i}", None, "x") for i in ids]
    rows = [(g, "u", 1, g, None, None) for g in groups]
    return {"mig_person": spark.createDataFrame(people, PERSON),
            "mig_daycare_group": spark.createDataFrame(rows, inputs.INTERMEDIATE["mig_daycare_group"])}


JOBS = [(n, f) for n, f, _ in transfer.CHAIN if n in ("audit_user", "persons", "departments")]


def ids(spark, root, table="person"):
    return sorted(r.id for r in publish.published(spark, root, table).collect())


def test_a_run_that_fails_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "target")

    def broken(t):
        raise RuntimeError("in the last job")

    failing = [*JOBS[:2], ("departments", broken)]
    with pytest.raises(RuntimeError, match="in the last job"):
        transfer.publish_all(state(spark, ["a", "b"]), root, jobs=failing)
    with pytest.raises(KeyError):
        publish.published(spark, root, "person")
    report = transfer.publish_all(state(spark, ["a", "b"], ["g"]), root, jobs=JOBS)
    assert report["persons"] == {"person": 2} and report["departments"]["daycare_group"] == 1
    with pytest.raises(RuntimeError):
        transfer.publish_all(state(spark, ["a", "b", "c"]), root, jobs=failing)
    assert ids(spark, root) == ["a", "b"] and publish.Manifest(spark, root).number == 1
    assert transfer.publish_all(state(spark, ["a", "b", "c"], ["g"]), root, jobs=JOBS)["persons"] == {"person": 1}
    assert ids(spark, root) == ["a", "b", "c"] and ids(spark, root, "daycare_group") == ["g"]
    assert ids(spark, root, "evaka_user") and publish.published(spark, root, "evaka_user").count() == 1


def test_of_two_runs_at_once_one_commits(spark, tmp_path):
    root = str(tmp_path / "target")
    one, two = publish.Manifest(spark, root), publish.Manifest(spark, root)
    assert one.add(spark.range(3), "t", "x") == 3 and two.add(spark.range(5), "t", "x") == 5
    assert one.commit() == 1
    with pytest.raises(publish.PublishConflict):
        two.commit()
    assert publish.published(spark, root, "t").count() == 3
    three = publish.Manifest(spark, root)
    three.add(spark.range(7), "t", "x", replace=True)
    assert publish.published(spark, root, "t").count() == 3  # not committed yet
    three.commit()
    assert publish.published(spark, root, "t").count() == 7


def test_only_touched_buckets_are_written(spark, tmp_path):
    root = str(tmp_path / "target")
    rows = [("P", str(k), f"id-{k}") for k in range(200)]
    schema = "type string, source_id string, target_id string"

    def put(data):
        m = publish.Manifest(spark, root)
        touched = m.replace_buckets(spark.createDataFrame(data, schema), "idmap", ["type", "source_id"], 16)
        m.commit()
        return touched, dict.fromkeys(m.tables["idmap"])

    first, before = put(rows)
    assert first == list(range(16)) and len(before) == 16
    assert put(rows)[0] == []
    touched, after = put([*rows[:50], ("P", "50", "other"), *rows[51:], ("P", "new", "id-new")])
    assert 1 <= len(touched) <= 2 and len(set(after) & set(before)) == 16 - len(touched)
    got = {r.source_id: r.target_id for r in publish.published(spark, root, "idmap").collect()}
    assert got == {**{k: v for _, k, v in rows}, "50": "other", "new": "id-new"}
    put(rows[:100])
    assert publish.published(spark, root, "idmap").count() == 100


def test_second_cli_run_reads_the_first_ones_ids(spark, tmp_path):
    from registrar import cli
    from test_transform_chain import CODES, PERSONS, _xml
    base, root = tmp_path / "in", str(tmp_path / "target")
    base.mkdir()
    (base / "codes.xml").write_text(_xml("item", CODES), encoding="utf-8")
    (base / "persons.xml").write_text(_xml("person", PERSONS[:3]), encoding="utf-8")
    args = ["--input", str(base), "--target", root, "--jobs", "persons"]
    assert cli.main(args) == 0
    first = {r.source_id: (r.target_id, r.updated) for r in publish.published(spark, root, "idmap").collect()}
    manifest = publish.Manifest(spark, root)
    changed = spark.createDataFrame([("PERSON", s, "kept-id" if k == 0 else t, u) for k, (s, (t, u)) in enumerate(sorted(first.items()))],
                                    inputs.DIMENSIONS["idmap"].schema)
    manifest.replace_buckets(changed, "idmap", ["type", "source_id"], transfer.IDMAP_BUCKETS)
    manifest.commit()
    (base / "persons.xml").write_text(_xml("person", PERSONS), encoding="utf-8")
    assert cli.main(args) == 0
    second = {r.source_id: r.target_id for r in publish.published(spark, root, "idmap").collect()}
    assert len(first) == 3 and len(second) == len(PERSONS)
    for k, (source, (target, _)) in enumerate(sorted(first.items())):
        assert second[source] == ("kept-id" if k == 0 else target)
