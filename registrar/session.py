"""Session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC wall clock (dates never shift), explicit
# JSON nulls, AQE for runtime re-planning (coalescing, skew-join splitting,
# broadcast conversion based on measured shuffle sizes).
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.jsonGenerator.ignoreNullFields": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
}

# Bytes a task reads, at most. A task's sorts and hash tables are many times its
# compressed input, so these bound its memory whatever the size of the tables.
# A session that has a smaller value keeps it.
SESSION_SIZES = {
    "spark.sql.files.maxPartitionBytes": 16 << 20,
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": 8 << 20,
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": 32 << 20,
}
_UNITS = {"": 0, "k": 10, "m": 20, "g": 30, "t": 40, "p": 50}


def build_session(master: str | None = None, app_name: str = "registrar",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the defaults above.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_DEFAULTS)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark)
    return spark


def apply_defaults(spark: SparkSession) -> None:
    """Apply the runtime-settable defaults to an existing session."""
    for k, v in SESSION_DEFAULTS.items():
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep theirs
            pass
    for k, most in SESSION_SIZES.items():
        if _bytes(spark.conf.get(k)) > most:
            spark.conf.set(k, str(most))


def _bytes(size: str) -> int:
    """A size as Spark writes it (``64MB``, ``16m``, ``1024``, ``8b``)."""
    n, unit = re.fullmatch(r"(\d+)([kmgtp]?)(?:i?b)?", size.strip().lower()).groups()
    return int(n) << _UNITS[unit]


_LOCAL_ROOTS: dict[int, str] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read from ``spark.checkpoint.dir`` (the cluster's shared storage) or the
    context's checkpoint directory. Only when neither is set and the master
    is local (tests) a private folder is created and registered; on a
    cluster that is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        key = id(spark.sparkContext)
        root = _LOCAL_ROOTS.get(key)
        if root is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
            root = tempfile.mkdtemp(prefix="registrar-ckpt-")
            _LOCAL_ROOTS[key] = root
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the shared checkpoint root."""
    return f"{checkpoint_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def release_shuffles(spark: SparkSession) -> None:
    """Between the steps of a job: the driver collects its garbage now, upon which
    Spark deletes the shuffle files of the steps that are written. By itself it
    may do so half an hour later, and the disk would hold those of all steps."""
    spark.sparkContext._jvm.System.gc()


_SHIPPED: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Hand this package's code to the Python workers once per application, as
    ``--py-files`` does: they need not have the driver's import path."""
    context, root = spark.sparkContext, os.path.dirname(os.path.abspath(__file__))
    if context.applicationId in _SHIPPED or not os.path.isdir(root):
        return
    archive = os.path.join(tempfile.mkdtemp(prefix="registrar-archive-"), "registrar-package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    at = os.path.join(folder, name)
                    z.write(at, os.path.join("registrar", os.path.relpath(at, root)))
    context.addPyFile(archive)
    _SHIPPED.add(context.applicationId)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared folder (survives executor loss)."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def local_session_for_tests(parallelism: int | str = "*") -> SparkSession:
    spark = build_session(master=f"local[{parallelism}]", shuffle_partitions=8,
                          extra={"spark.driver.memory": os.environ.get("REGISTRAR_DRIVER_MEM", "8g")})
    spark.sparkContext.setLogLevel("ERROR")
    return spark
