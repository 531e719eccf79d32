"""Inputs at the edges: nothing may be lost, shifted or doubled silently."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from registrar.functions import parse
from registrar.operators import intervals as iv
from registrar.operators.lookup import literal_dimension
from registrar.plans import transfer
from registrar.plans.transform._common import person_lookup
from registrar.sources import delimited, records
from registrar.sources.errors import IngestError
from registrar.sources.specs import REGISTRY
from registrar.streaming.incremental import incremental_ingest


def _write(path, text):
    path.write_text(text, encoding="utf-8")


def test_long_comment_before_the_first_element(spark, tmp_path):
    _write(tmp_path / "codes.xml", "<!-- " + "a > b " * 1000 + "-->\n<item><code>7</code></item>\n")
    assert [r.code for r in records.ingest_dir(spark, str(tmp_path))["codes"].collect()] == [7]


def test_subfolders_are_not_entered_and_hidden_names_are_reported(spark, tmp_path):
    _write(tmp_path / "codes.xml", "<item><code>1</code></item>\n")
    (tmp_path / "more").mkdir()
    _write(tmp_path / "more" / "codes.xml", "<item><code>2</code></item>\n")
    assert records.ingest_dir(spark, str(tmp_path))["codes"].count() == 1
    _write(tmp_path / "_codes.xml", "<item><code>3</code></item>\n")
    with pytest.raises(IngestError):
        records.ingest_dir(spark, str(tmp_path))


def test_malformed_record_stops_the_load(spark, tmp_path):
    _write(tmp_path / "codes.xml", "<item><code>1</code><text>a & b</text></item>\n")
    with pytest.raises(Exception, match="Malformed record"):
        records.ingest_dir(spark, str(tmp_path))["codes"].collect()


def test_delimited_files_with_their_own_column_order(spark, tmp_path):
    uuid = "00000000-0000-0000-0000-00000000000{}"
    _write(tmp_path / "a.csv", f"effica_id|evaka_id\n1|{uuid.format(1)}\n")
    _write(tmp_path / "b.csv", f"evaka_id|effica_id\n{uuid.format(2)}|2\n")
    found = delimited.read_delimited(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], REGISTRY["unitmap"])
    assert sorted((r.effica_id, r.evaka_id) for r in found.collect()) == [(1, uuid.format(1)), (2, uuid.format(2))]


def test_streams_with_checkpoints_of_their_own_add_up(spark, tmp_path):
    target = str(tmp_path / "codes")
    for name, codes in (("one", range(1, 6)), ("two", range(6, 9))):
        (tmp_path / name).mkdir()
        _write(tmp_path / name / "codes.xml", "".join(f"<item><code>{c}</code></item>\n" for c in codes))
        incremental_ingest(spark, str(tmp_path / name), REGISTRY["codes"], "item", target, str(tmp_path / f"ckpt-{name}"))
    assert sorted(r.code for r in spark.read.parquet(target).collect()) == list(range(1, 9))


def test_null_start_is_unbounded(spark):
    day = dt.date
    left = spark.createDataFrame([(1, None, day(2020, 12, 31)), (1, day(2021, 1, 1), None), (2, None, None)], "k int, s date, e date")
    right = spark.createDataFrame([(1, day(2020, 2, 1), day(2020, 3, 1)), (2, None, None), (1, None, day(2020, 1, 5))],
                                  "k int, rs date, re date")
    found = iv.overlap_join(left, right, ["k"], ("s", "e"), ("rs", "re"))
    assert sorted((r.k, str(r.s), str(r.rs)) for r in found.collect()) == [
        (1, "None", "2020-02-01"), (1, "None", "None"), (2, "None", "None")]


def test_iso_date_time_is_a_date(spark):
    found = spark.createDataFrame([("2020-03-01T10:00:00",), ("20200302",), ("99991231",), ("x",)], "t string")
    assert [r.d for r in found.select(parse.nullable_date("t").alias("d")).collect()] == [dt.date(2020, 3, 1), dt.date(2020, 3, 2), None, None]


def test_person_lookup_takes_one_person(spark):
    people = spark.createDataFrame([("a-id", "X", "2001-01-01"), ("z-id", "X", "1990-01-01")], "id string, legacy_ssn string, dob string")
    rows = spark.createDataFrame([("X",), ("Y",)], "ssn string")
    found = person_lookup(rows, people, "ssn", {"id": "person_id", "dob": "birth"}).orderBy("ssn").collect()
    assert [tuple(r) for r in found] == [("X", "a-id", "2001-01-01"), ("Y", None, None)]


def test_a_large_literal_dimension_is_an_ordinary_side(spark):
    assert literal_dimension(spark, [(k,) for k in range(10_001)], "k int").count() == 10_001


def test_publishing_skips_rows_that_the_target_has(spark):
    have = spark.createDataFrame([("a", 1)], "id string, n int")
    new = spark.createDataFrame([("a", 2), ("b", 3)], "id string, n int")
    assert [r.id for r in transfer._not_present(have, new).collect()] == ["b"]
    have = spark.createDataFrame([("a", None)], "child string, n int").withColumn("updated", F.lit("then"))
    new = have.withColumn("updated", F.lit("now"))
    assert transfer._not_present(have, new).count() == 0
