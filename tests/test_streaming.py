"""Incremental ingest: each file is loaded exactly once across runs."""

import os

from registrar.sources.specs import REGISTRY
from registrar.streaming.incremental import incremental_ingest


def _dump(path, codes):
    with open(path, "w", encoding="utf-8") as f:
        f.write("<!-- dump -->\n")
        for c in codes:
            f.write(f"<item>\n  <code>{c}</code>\n  <active>A</active>\n</item>\n")


def test_incremental_runs_load_each_file_once(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    target = str(tmp_path / "codes")
    ckpt = str(tmp_path / "ckpt")
    _dump(src / "codes_1.xml", range(1, 101))
    _dump(src / "codes_2.xml", range(101, 201))
    incremental_ingest(spark, str(src), REGISTRY["codes"], "item", target, ckpt)
    assert spark.read.parquet(target).count() == 200
    incremental_ingest(spark, str(src), REGISTRY["codes"], "item", target, ckpt)
    assert spark.read.parquet(target).count() == 200
    _dump(src / "codes_3.xml", range(201, 251))
    incremental_ingest(spark, str(src), REGISTRY["codes"], "item", target, ckpt)
    df = spark.read.parquet(target)
    assert df.count() == 250 and df.select("code").distinct().count() == 250
    assert df.filter("active").count() == 250


def test_incremental_rejects_a_bad_batch(spark, tmp_path):
    import pytest
    from registrar.sources.errors import IngestError
    src = tmp_path / "in"
    src.mkdir()
    with open(src / "codes_1.xml", "w", encoding="utf-8") as f:
        f.write("<item><code>1</code><surprise>x</surprise></item>\n")
    with pytest.raises(Exception) as ei:
        incremental_ingest(spark, str(src), REGISTRY["codes"], "item", str(tmp_path / "t"), str(tmp_path / "ck"))
    assert "E-TREP-10003" in str(ei.value) or isinstance(ei.value, IngestError)
    assert not (tmp_path / "t").exists() or spark.read.parquet(str(tmp_path / "t")).count() == 0
