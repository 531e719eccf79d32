"""Entry point: ingest a dump folder, reconcile, publish.

    spark-submit --py-files registrar.zip run_migration.py --input /shared/dumps/2021-06 \\
        --dims /shared/target-dims --work /shared/work --target /shared/target
    python -m registrar.cli ...            (local runs)

``--dims`` holds parquet folders of existing target tables (declared in
``sources.inputs``), each named by its table. ``--jobs`` runs only the named
reconciliation and publishing jobs. Intermediate and job outputs go to
``--work`` (default: a fresh folder under ``spark.checkpoint.dir``). Exit code
2, with the coded error, on a structural error of a dump, a dimension that
does not fit its declaration, a missing input or, with ``--strict``, a broken
constraint; nothing is published then. Without ``--strict`` broken constraints
are reported as rows of the ``*_violations`` tables.

    python -m registrar.cli --target TARGET --reset [TABLES]
    python -m registrar.cli --target TARGET --analyze DATABASE [--input ...]

``--reset`` empties published tables and all that refer to them; it runs
alone. ``--analyze`` registers the published tables in a catalog database and
computes their statistics, after the run if there is one.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="registrar")
    ap.add_argument("--input", help="folder with record dumps and pipe files")
    ap.add_argument("--target", required=True, help="folder of the published target tables")
    ap.add_argument("--dims", help="folder with target dimension tables (parquet, one folder per table)")
    ap.add_argument("--work", help="folder for job outputs (default: under spark.checkpoint.dir)")
    ap.add_argument("--import-target", help="load every record file into this one table")
    ap.add_argument("--jobs", help="comma-separated names of the jobs to run (default: the whole chain)")
    ap.add_argument("--include-off", action="store_true", help="also run the jobs switched off in the chain")
    ap.add_argument("--strict", action="store_true", help="stop at the first table that breaks a constraint")
    ap.add_argument("--reset", nargs="?", const="", metavar="TABLES", help="empty tables (comma-separated; default: all migrated ones)")
    ap.add_argument("--analyze", metavar="DATABASE", help="register the published tables there and compute statistics")
    args = ap.parse_args(argv)
    if args.reset is None and args.analyze is None and not args.input:
        ap.error("--input, --reset or --analyze is required")
    if args.reset is not None and (args.input or args.analyze):
        ap.error("--reset runs alone")

    from .operators.constraints import ConstraintError
    from .plans import transfer
    from .plans.runner import run_chain
    from .plans.transform import CHAIN
    from .session import build_session
    from .sinks import catalog
    from .sinks.publish import Manifest
    from .sources import inputs
    from .sources.errors import IngestError
    from .sources.staging import stage_dir

    wanted = set(args.jobs.split(",")) if args.jobs else None

    def chosen(chain):
        return [(n, f) for n, f, on in chain if (n in wanted if wanted is not None else on or args.include_off)]

    jobs, publishing = chosen(CHAIN), chosen(transfer.CHAIN)
    spark = build_session()
    if args.reset is not None:
        try:
            print(json.dumps({"reset": catalog.reset(spark, args.target, args.reset.split(",") if args.reset else catalog.RESET_ROOTS)}))
            return 0
        except KeyError as e:
            print(json.dumps({"error": inputs.UNKNOWN, "message": str(e)}))
            return 2
    if not args.input:
        print(json.dumps({"analyzed": catalog.analyze(spark, args.target, database=args.analyze)}))
        return 0
    try:
        if wanted is not None and (unknown := wanted - {n for n, *_ in (*CHAIN, *transfer.CHAIN)}):
            raise inputs.InputError(inputs.UNKNOWN, f"Unknown job '{min(unknown)}'")
        loaded = stage_dir(spark, args.input, target=args.import_target)
        staged = dict(loaded.tables)
        if args.dims:
            staged.update(inputs.load_dimensions(spark, args.dims))
        if "idmap" not in staged and (before := Manifest(spark, args.target).read("idmap")) is not None:
            staged["idmap"] = before.select("type", "source_id", "target_id", "updated")  # the ids of earlier runs
        names = [n for n, _ in jobs]
        inputs.resolve(staged, names)
        made = {t for n in names for t in inputs.JOB_OUTPUTS[n]}
        inputs.resolve({*staged, *made}, [n for n, _ in publishing], inputs.PUBLISH_INPUTS, {})
    except (IngestError, inputs.InputError) as e:
        print(json.dumps({"error": e.code, "message": str(e)}))
        return 2
    try:
        state = run_chain(staged, jobs, out_dir=args.work, strict=args.strict)
        report = transfer.publish_all(state, args.target, jobs=publishing, strict=args.strict)
    except ConstraintError as e:
        print(json.dumps({"error": e.code, "message": str(e), "violations": e.counts}))
        return 2
    done = {"staged": loaded.counts, "published": report}
    if args.analyze:
        done["analyzed"] = catalog.analyze(spark, args.target, database=args.analyze)
    print(json.dumps(done))
    return 0


if __name__ == "__main__":
    sys.exit(main())
