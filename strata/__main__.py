"""Command line: run the pipeline, or ask one named query.

    python -m strata run   --src DIR --out DIR     write every table, print rule counts
    python -m strata query NAME --src DIR [--show N]
"""

from __future__ import annotations

import argparse
import json

from .session import build_session


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="strata")
    sub = ap.add_subparsers(dest="cmd", required=True)
    run = sub.add_parser("run", help="write all bronze, silver and gold tables")
    run.add_argument("--src", required=True)
    run.add_argument("--out", required=True)
    q = sub.add_parser("query", help="run one named query")
    q.add_argument("name")
    q.add_argument("--src", required=True)
    q.add_argument("--show", type=int, default=20)
    ap.add_argument("--master", default="local[*]")
    args = ap.parse_args(argv)

    spark = build_session(master=args.master)
    if args.cmd == "run":
        from .plans.pipeline import Pipeline
        report = Pipeline.from_tables(spark, args.src).materialize(args.out)
        print(json.dumps(report, indent=1, sort_keys=True))
    else:
        from .queries import REGISTRY
        REGISTRY[args.name](spark, args.src).show(args.show, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
