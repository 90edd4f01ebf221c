"""Command line: run the layers over a raw folder.

    python -m chanfold run --raw <raw folder> --lake <lake folder> [--master local[8]]

Discovers and ingests every source (the known ones by their declared schemas) under ``--raw`` (bronze), conforms and
converts them (silver, partitioned by channel) and writes the gold tables,
then prints one JSON line with row counts and the missing-rate audit.  On a
cluster, submit it with ``spark-submit`` and leave ``--master`` unset.
"""

from __future__ import annotations

import argparse
import json
import sys


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="chanfold")
    sub = parser.add_subparsers(dest="command", required=True)
    run = sub.add_parser("run", help="bronze -> silver -> gold")
    run.add_argument("--raw", required=True)
    run.add_argument("--lake", required=True)
    run.add_argument("--master", default=None)
    run.add_argument("--infer-schemas", action="store_true",
                     help="infer the schemas of the known sources too (not for spreadsheets)")
    args = parser.parse_args(argv)

    from pyspark.sql import SparkSession

    from chanfold.plans import medallion
    from chanfold.plans.raw_files import declared_schemas
    from chanfold.session import SESSION_DEFAULTS, build_session

    if args.master:
        spark = build_session(args.master)
    else:
        builder = SparkSession.builder.appName("chanfold")
        for k, v in SESSION_DEFAULTS.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    out = medallion.run_all(spark, args.raw, args.lake,
                            None if args.infer_schemas else declared_schemas())
    report = {
        "bronze_rows": {k: v.count() for k, v in sorted(out["bronze"].items())},
        "silver_rows": out["silver"].count(),
        "gold_tables": sorted(out["gold"]),
        "missing_rate_rows": out["missing_rate_rows"],
    }
    print(json.dumps(report))
    return 0


if __name__ == "__main__":
    sys.exit(main())
