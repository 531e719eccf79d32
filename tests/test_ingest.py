"""Record-file and delimited ingest, with the five coded structural errors.
Fixtures are small dumps written here (own content, same shapes as the
legacy files: no root element, comments, mixed-case tags, sentinels)."""

import datetime as dt
import os

import pytest

from registrar.sources import errors as E
from registrar.sources import records
from registrar.sources.delimited import read_delimited
from registrar.sources.specs import REGISTRY

FAMILIES = """<!--
dump header
-->
<personinfamily>
    <FamilyNbr>7</FamilyNbr>
    <personid>111111-111A</personid>
    <startdate>20200101</startdate>
    <enddate>99999999</enddate>
    <RoleInFamily>R</RoleInFamily>
    <guid>{g1}</guid>
</personinfamily>
<personinfamily>
    <familynbr>7</familynbr>
    <personid>&#x20;</personid>
    <startdate>2020-02-01</startdate>
    <enddate>99991231</enddate>
    <roleinfamily>B</roleinfamily>
</personinfamily>
"""

CASES = {
    "nonflat/codes.xml": ("<item><code>1</code><extrainfo2><x>1</x></extrainfo2></item>\n<item><code>2</code></item>\n",
                          E.NON_FLAT_DATA),
    "ambiguous/income.xml": ("<income><summa>1</summa></income>\n<income2><summa>2</summa></income2>\n",
                             E.AMBIGUOUS_TABLE_DATA),
    "unknowncolumn/persons.xml": ("<person><personid>1</personid><notacolumn>x</notacolumn></person>\n",
                                  E.NON_MAPPED_COLUMN),
    "unknowntable/notatable.xml": ("<person><personid>1</personid></person>\n", E.NON_MAPPED_TABLE),
    "empty/codes.xml": ("<!-- nothing here -->\n", E.NO_DATA_CONTENT),
}


def _write(base, rel, text):
    p = os.path.join(base, rel)
    os.makedirs(os.path.dirname(p), exist_ok=True)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_records_parse_and_sentinels(spark, tmp_path):
    _write(str(tmp_path), "ok/families.xml", FAMILIES)
    _write(str(tmp_path), "ok/families.xml.license", "licence text")
    out = records.ingest_dir(spark, str(tmp_path / "ok"))
    rows = sorted(out["families"].collect(), key=lambda r: r.startdate)
    assert rows[0].familynbr == 7 and rows[0].roleinfamily == "R" and rows[0].enddate is None
    assert rows[0].startdate == dt.date(2020, 1, 1)
    assert rows[1].personid is None and rows[1].enddate is None and rows[1].guid is None
    assert rows[1].startdate == dt.date(2020, 2, 1)


@pytest.mark.parametrize("rel", sorted(CASES))
def test_structural_errors(spark, tmp_path, rel):
    text, code = CASES[rel]
    p = _write(str(tmp_path), rel, text)
    with pytest.raises(E.IngestError) as ei:
        records.ingest_dir(spark, os.path.dirname(p))
    assert ei.value.code == code


def test_import_target_many_files(spark, tmp_path):
    _write(str(tmp_path), "a/part1.txt", "<item><code>1</code><active>A</active></item>\n")
    _write(str(tmp_path), "a/part2.txt", "<item><code>0</code><active>p</active></item>\n")
    out = records.ingest_dir(spark, str(tmp_path / "a"), target="codes")
    rows = sorted(out["codes"].collect(), key=lambda r: (r.code is None, r.code))
    assert [(r.code, r.active) for r in rows] == [(1, True), (None, False)]


def test_delimited_with_bom(spark, tmp_path):
    p = _write(str(tmp_path), "unitmap.csv", "﻿effica_id|evaka_id\r\n123 | 19FEC146-E2F1-11EB-8473-DB55258254C5\r\n |x\r\n")
    rows = read_delimited(spark, [p], REGISTRY["unitmap"]).collect()
    assert rows[0].effica_id == 123 and rows[0].evaka_id == "19fec146-e2f1-11eb-8473-db55258254c5"
    assert rows[1].effica_id is None


def test_large_file_split_keeps_every_record(spark, tmp_path):
    body = "".join(f"<item>\n  <code>{i}</code>\n  <text>t{i}</text>\n</item>\n" for i in range(1, 20001))
    p = _write(str(tmp_path), "big/codes.xml", body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        df = records.read_records(spark, [p], REGISTRY["codes"], element="item")
        assert df.rdd.getNumPartitions() > 4
        assert df.count() == 20000
        assert df.select("code").distinct().count() == 20000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_single_line_dump(spark, tmp_path):
    body = "<!-- x -->" + "".join(f"<item><code>{i}</code><active>A</active></item>" for i in range(1, 501))
    p = _write(str(tmp_path), "one/codes.xml", body)
    out = records.ingest_dir(spark, os.path.dirname(p))
    assert out["codes"].count() == 500 and out["codes"].filter("active").count() == 500
