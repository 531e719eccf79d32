"""Dependency-ordered runner for the reconciliation jobs.

Outputs of each job are added to the table mapping for the next ones (so
``mig_person`` from persons feeds families, and so on). Every output is
written once to a fresh run folder and read back: later jobs read files
instead of re-planning all upstream jobs (the composed plan would grow with
every reuse of a table), and a job that loses executors recomputes only from
the written tables. Before anything is planned, every job's declared inputs
must be given or come from an earlier job. ``out_dir`` defaults to a fresh folder under the shared
``spark.checkpoint.dir``. The first failing
job stops the chain; outputs already written stay, as in the legacy chain.
``strict`` makes a broken constraint such a failure: the rows of a job's
``*_violations`` are counted while they are written (Q2).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ..operators.constraints import require_none
from ..sources import inputs
from .transform import CHAIN

Job = Callable[[Mapping[str, DataFrame]], dict[str, DataFrame]]


def run_chain(tables: Mapping[str, DataFrame], jobs: Sequence[tuple[str, Job]] | None = None,
              include_off: bool = False, out_dir: str | None = None, strict: bool = False) -> dict[str, DataFrame]:
    if jobs is None:
        jobs = [(n, f) for n, f, on in CHAIN if on or include_off]
    inputs.resolve(tables, [n for n, _ in jobs])
    state: dict[str, DataFrame] = dict(tables)
    run = uuid.uuid4().hex[:12]
    if out_dir is None and state:
        from ..session import scratch_path
        out_dir = scratch_path(next(iter(state.values())).sparkSession, "chain")
    for name, job in jobs:
        try:
            out = job(state)
        except Exception as e:
            raise RuntimeError(f"job '{name}' failed; earlier outputs are kept") from e
        if out_dir:
            written = {}
            for table, df in out.items():
                path = f"{out_dir.rstrip('/')}/run={run}/{name}/{table}"
                checked = strict and table.endswith("_violations")
                seen = Observation(f"{name} {table}") if checked else None
                (df.observe(seen, F.count(F.lit(1)).alias("n")) if checked else df).write.mode("errorifexists").parquet(path)
                written[table] = df.sparkSession.read.schema(df.schema).parquet(path)
                if checked:
                    require_none(table, int(seen.get["n"]), written[table])
            out = written
        state.update(out)
    return state
