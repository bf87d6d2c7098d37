"""Command line.

    python -m navforge run --raw <csv_root> --lake <root> [--materialize staged|checkpoint|recompute]
    python -m navforge run --lake <root>                 # rerun over the bronze tables in <root>
    python -m navforge run --raw <csv_root> --incremental <checkpoint_root> --lake <root>
    python -m navforge ingest --raw <dir> --dataset positions --target <path> --checkpoint <path>
    python -m navforge query <name> --sf-dir <dir> [--rows 20]
    python -m navforge list
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="navforge")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="bronze -> silver -> gold -> ops, every layer written")
    r.add_argument("--raw", help="folder with one CSV file or folder per dataset")
    r.add_argument("--incremental", metavar="CHECKPOINT_ROOT",
                   help="append only raw files not loaded before (stream checkpoints here)")
    r.add_argument("--lake", required=True)
    r.add_argument("--format", default="parquet")
    r.add_argument("--materialize", default="staged",
                   choices=["staged", "checkpoint", "recompute"])
    r.add_argument("--workers", type=int, default=4, help="independent steps run at once")
    r.add_argument("--run-id", help="a run repeated under its id adds no second metrics rows")
    r.add_argument("--by-day", action="store_true",
                   help="divide the fact tables of silver and gold into a folder for each day")
    r.add_argument("--register", action="store_true",
                   help="also name the tables <layer>.<table> in the session catalog")
    r.add_argument("--keep-fanout", action="store_true",
                   help="look references up without de-duplicating their ids")
    i = sub.add_parser("ingest", help="load raw files not loaded before")
    i.add_argument("--raw", required=True)
    i.add_argument("--dataset", required=True)
    i.add_argument("--target", required=True)
    i.add_argument("--checkpoint", required=True)
    q = sub.add_parser("query", help="show a registered query")
    q.add_argument("name")
    q.add_argument("--sf-dir", required=True)
    q.add_argument("--rows", type=int, default=20)
    sub.add_parser("list", help="names of the registered queries")
    args = p.parse_args(argv)

    from navforge.plans.registry import queries

    if args.cmd == "list":
        print("\n".join(sorted(queries())))
        return 0

    from navforge.session import build_session

    spark = build_session()
    if args.cmd == "run":
        from navforge.plans import pipeline
        from navforge.sources.bronze import load_bronze_csv
        from navforge.sources.sinks import Lakehouse

        lake = Lakehouse(args.lake, args.format, register=args.register,
                         days=pipeline.DAYS if args.by_day else {})
        bronze = None
        if args.raw and args.incremental:
            pipeline.ingest_bronze_incremental(spark, lake, args.raw, args.incremental)
        elif args.raw:
            bronze = load_bronze_csv(spark, args.raw, keep_malformed=True)
        steps = pipeline.run(spark, lake, bronze=bronze,
                             dedupe_refs=not args.keep_fanout, materialize=args.materialize,
                             workers=args.workers, run_id=args.run_id)
        print(json.dumps(steps))
    elif args.cmd == "ingest":
        from navforge.specs import DATASETS
        from navforge.streaming.ingest import ingest_new_files

        n = ingest_new_files(spark, args.raw, DATASETS[args.dataset], args.target,
                             args.checkpoint)
        print(json.dumps({"rows_added": n}))
    elif args.cmd == "query":
        queries()[args.name](spark, args.sf_dir).show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
