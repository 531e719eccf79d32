"""Helpers shared by the operators of this package."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import registrar
from registrar.session import scratch_path

#: Bytes of result values after which a worker hands a batch on.
BATCH_BYTES = 8 << 20
#: Rows in a batch handed to a worker; texts are long, so fewer than Spark's 10,000.
BATCH_ROWS = 2000
#: Longer keys are not remembered, so a worker's memory is bounded.
CACHED_LENGTH = 64


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Hand this package's code to the workers, as ``--py-files`` would: a
    worker need not have the driver's import path."""
    context, root = spark.sparkContext, os.path.dirname(registrar.__file__)
    if context.applicationId in _shipped or not os.path.isdir(root):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="registrar-code-"), "registrar-code.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    z.write(path, os.path.join("registrar", os.path.relpath(path, root)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def mapped(df: DataFrame, run: Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    """``df.mapInArrow`` whose workers can import this package."""
    _ship(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table in the shared folder: cuts the lineage and
    survives the loss of executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def batches(rows: Iterable[tuple[tuple, int]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Record batches of about BATCH_BYTES from (row, size in bytes) pairs."""
    held, size = [], 0
    for row, n in rows:
        held.append(row)
        size += n + 64
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, type=f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def texts(stream: Iterable[pa.RecordBatch], key: str = "doc_id", text: str = "text") -> Iterator[tuple]:
    """(key, text) of every row; the text is decoded row by row."""
    for b in stream:
        for k, t in zip(b.column(key), b.column(text)):
            yield k.as_py(), t.as_py()


class Remembered(dict):
    """What ``find`` gave for short keys, in two generations: when the young
    one is full it becomes the old one, and what is used again moves up."""

    def __init__(self, find, most: int):
        super().__init__()
        self.find, self.most, self.old = find, most, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.find(key)
        if len(key) <= CACHED_LENGTH:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value
