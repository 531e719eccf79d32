"""Staging: one scan, coded error rows, comments and CDATA, strict mode."""

import pytest

from registrar.sources import errors as E
from registrar.sources import records, staging
from registrar.sources.specs import spec

SPEC = spec("item", "code integer number, text text text", element="item")


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


def staged(spark, path, text):
    return staging.stage_files(spark, [write(path, text)], SPEC, "item")


def test_comments_and_cdata(spark, tmp_path):
    s = staged(spark, tmp_path / "a", "<!-- <item><code>1</code></item> --><item><code>2</code><!-- </item> --><text>x</text></item>"
               "<item><code>3</code><text><![CDATA[<b> </item> & --> ]]></text></item><!-- end -->\n")
    assert sorted((r.code, r.text) for r in s.table.collect()) == [(2, "x"), (3, "<b> </item> & -->")]
    assert (s.rows, s.by_code, s.scans) == (2, {}, 1)


@pytest.mark.parametrize("size", [64, 200, 1_000_000])
def test_comments_across_splits(spark, tmp_path, size):
    records_ = [f"<item><code>{k}</code><text>t{k}</text></item>" for k in range(200)]
    text = "\n".join("<!-- " + " ".join(records_[k:k + 20]) + " -->" if k % 40 == 0 else "\n".join(records_[k:k + 20]) for k in range(0, 200, 20))
    keep = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size))
    try:
        s = staged(spark, tmp_path / "a", text + "\n")
        assert sorted(r.code for r in s.table.collect()) == [k for k in range(200) if k // 20 % 2]
        assert s.rows == 100 and s.scans == (1 if size > 10_000 else 2) and not s.by_code
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", keep)


BROKEN = {
    E.NON_FLAT_DATA: "<item><code>1</code><text><b>2</b></text></item>",
    E.NON_MAPPED_COLUMN: "<item><code>1</code><oops>2</oops></item>",
    E.MALFORMED_RECORD: "<item><code>1</code><text>2</item>",
    E.AMBIGUOUS_TABLE_DATA: "<item><code>1</code></item><thing>5</thing>",
}


@pytest.mark.parametrize("code", sorted(BROKEN))
def test_every_code_is_a_row_or_stops_the_load(spark, tmp_path, code):
    good = "<item><code>7</code><text>fine</text></item>\n"
    path = write(tmp_path / "item.xml", good + BROKEN[code] + "\n" + good)
    found = staging.stage_dir(spark, str(tmp_path), registry={"item": SPEC}, strict=False)
    rows = found.errors.collect()
    assert [(r.table, r.code, r.file.endswith("item.xml")) for r in rows] == [("item", code, True)]
    assert rows[0].fragment.strip()
    assert {(r.code, r.text) for r in found.tables["item"].collect()} <= {(7, "fine"), (1, None)}
    with pytest.raises(E.IngestError) as e:
        records.read_records(spark, [path], SPEC)
    assert e.value.code == code and "item.xml" in str(e.value)


def test_file_that_ends_inside_a_comment(spark, tmp_path):
    s = staged(spark, tmp_path / "a", "<item><code>1</code></item><item><code>2</code><!-- <text>x</text></item>")
    assert [r.code for r in s.table.collect()] == [1] and s.by_code == {E.MALFORMED_RECORD: 1}
    assert [(r.code, r.detail) for r in s.errors.collect()] == [(E.MALFORMED_RECORD, "comment without an end")]
    assert staged(spark, tmp_path / "b", "<item><code>1</code></item><!-- open").by_code == {}


def test_tables_without_data_and_of_no_name(spark, tmp_path):
    write(tmp_path / "item.xml", "<!-- <item><code>1</code></item> -->")
    write(tmp_path / "thing.xml", "<thing/>")
    found = staging.stage_dir(spark, str(tmp_path), registry={"item": SPEC}, strict=False)
    assert sorted((r.table, r.code) for r in found.errors.collect()) == [("item", E.NO_DATA_CONTENT), ("thing", E.NON_MAPPED_TABLE)]
    assert found.tables == {} and found.counts == {}
    with pytest.raises(E.IngestError):
        staging.stage_dir(spark, str(tmp_path), registry={"item": SPEC})


def test_counts_are_observed_and_tables_are_files(spark, tmp_path):
    write(tmp_path / "item.xml", "".join(f"<item><code>{k}</code></item>" for k in range(30)))
    found = staging.stage_dir(spark, str(tmp_path), registry={"item": SPEC}, out_dir=str(tmp_path / "out"))
    assert found.counts == {"item": 30}
    (tmp_path / "item.xml").unlink()  # the staged table needs the dump no more
    assert found.tables["item"].count() == 30 and found.tables["item"].where("code >= 10").count() == 20
    assert "Scan parquet" in found.tables["item"]._jdf.queryExecution().executedPlan().toString() or \
        "FileScan parquet" in found.tables["item"]._jdf.queryExecution().toString()
