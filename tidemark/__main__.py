"""Command line: one subcommand per step, for schedulers that start processes.

    python -m tidemark ingest --root DIR --payloads DIR [--entity users]
    python -m tidemark replicate --root DIR [--table users]
    python -m tidemark build --root DIR
    python -m tidemark test --root DIR
    python -m tidemark run --root DIR --payloads DIR
    python -m tidemark validate --root DIR

``--payloads`` holds one folder per entity. ``build`` writes the marts, ``test`` tests them and
makes both visible, or leaves the earlier ones in place. Any failure ends with a non-zero exit code;
every step may be repeated.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from tidemark.plans.elt import build_models, publish_models, replicate_all, run_elt
from tidemark.plans.ingest import ingest
from tidemark.plans.transforms import ENTITIES
from tidemark.plans.validate import validation
from tidemark.session import build_session


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark", description=__doc__.split("\n")[0])
    p.add_argument("step", choices=["ingest", "replicate", "build", "test", "run", "validate"])
    p.add_argument("--root", required=True, help="folder shared by all executors")
    p.add_argument("--payloads", help="folder with one payload folder per entity")
    p.add_argument("--lines", action="store_true", help="payloads hold one record per line")
    p.add_argument("--entity", default="all", choices=[*ENTITIES, "all"])
    p.add_argument("--table", default="all", choices=[*ENTITIES, "all"])
    p.add_argument("--buckets", type=int, help="hash buckets of new keyed tables (default 1)")
    p.add_argument("--incremental", action="store_true", help="marts from the change feeds")
    p.add_argument(
        "--on-duplicate", default="latest", choices=["latest", "error"], help="keys repeated in a payload"
    )
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    if args.step in ("ingest", "run") and not args.payloads:
        parser().error(f"{args.step} needs --payloads")
    spark = build_session()
    now = datetime.now(tz=timezone.utc)
    paths = {name: f"{args.payloads}/{name}" for name in ENTITIES}
    if args.step == "ingest":
        done = ingest(
            spark,
            paths,
            args.root,
            now,
            args.entity,
            args.buckets,
            lines=args.lines,
            on_duplicate=args.on_duplicate,
        )
        print(done)
    elif args.step == "replicate":
        moved, _ = replicate_all(spark, args.root, now, args.table, args.buckets)
        print(moved)
    elif args.step == "build":
        build_models(
            spark, args.root, now, incremental=args.incremental, buckets=args.buckets, publish=False
        )
    elif args.step == "test":
        publish_models(spark, args.root, written=not args.incremental)
    elif args.step == "run":
        report = run_elt(
            spark,
            paths,
            args.root,
            now,
            args.lines,
            args.buckets,
            on_duplicate=args.on_duplicate,
            incremental=args.incremental,
        )
        report.suite.show(50, truncate=False)
    else:
        for name, df in validation(spark, args.root, args.buckets).items():
            print(name)
            df.show(50, truncate=False)


if __name__ == "__main__":
    main()
