"""Command line: ``python -m slotplan run|plan ...`` (spark-submit works the same way).

    python -m slotplan run  --recipes r.csv --appliances a.csv --levels l.csv --out /shared/run1
    python -m slotplan run  --sf /data/sf1 --out /shared/run1 [--mode both] [--steps clean,master]
    python -m slotplan plan --sf /data/sf1 --mode bakery --level 40 --tier medium
    python -m slotplan plan --cube /shared/run1/report_cube --mode bakery --level 40
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .constants import DEFAULT_LEVEL, DEFAULT_MODE, DEFAULT_TIER
from .pipeline import STEPS, run_pipeline
from .plans.planner import cube_lookup, planner_filtered
from .session import ensure_checkpoint_dir
from .sources.catalogue import CsvFiles


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="slotplan")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("run", help="run the batch pipeline")
    r.add_argument("--sf", default=None, help="folder with the base tables to derive the catalogue from")
    r.add_argument("--recipes", default=None, help="recipe CSV (with --appliances and --levels)")
    r.add_argument("--appliances", default=None)
    r.add_argument("--levels", default=None)
    r.add_argument("--out", required=True, help="shared output folder for step tables")
    r.add_argument("--mode", default="both")
    r.add_argument("--steps", default=",".join(STEPS))
    r.add_argument("--force", action="store_true", help="run steps that are up to date too")
    p = sub.add_parser("plan", help="print the planner report for one game/level/tier")
    p.add_argument("--sf", default=None)
    p.add_argument("--mode", default=DEFAULT_MODE)
    p.add_argument("--level", type=int, default=DEFAULT_LEVEL)
    p.add_argument("--tier", default=DEFAULT_TIER)
    p.add_argument("--cube", default=None,
                   help="answer from a stored report_cube table (a filter) instead of the raw data")
    args = ap.parse_args(argv)
    if args.cmd == "run" and not (args.sf or (args.recipes and args.appliances and args.levels)):
        ap.error("run needs --recipes, --appliances and --levels, or --sf")
    if args.cmd == "plan" and not (args.sf or args.cube):
        ap.error("plan needs --sf (compute from the data) or --cube (look up a stored cube)")

    spark = SparkSession.builder.appName("slotplan").getOrCreate()
    ensure_checkpoint_dir(spark)
    if args.cmd == "run":
        source = args.sf or CsvFiles(args.recipes, args.appliances, args.levels)
        paths = run_pipeline(spark, source, args.out, args.mode, args.steps.split(","), force=args.force)
        for k, v in paths.items():
            print(f"{k}\t{v}")
    elif args.cube:
        cube_lookup(spark, args.cube, args.mode, args.level, args.tier).orderBy("return_time") \
            .show(50, truncate=False)
    else:
        planner_filtered(spark, args.sf, args.mode, args.level, args.tier).orderBy("return_time") \
            .show(50, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
