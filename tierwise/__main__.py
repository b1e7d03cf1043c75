"""Command line: full refresh from CSV extracts, then the data-quality suite.

    python -m tierwise refresh --landing DIR [--out DIR] [--as-of YYYY-MM-DD]
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .plans.warehouse import refresh_from_csv
from .session import build_session


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tierwise")
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="CSV landing folder -> bronze/silver/gold parquet")
    r.add_argument("--landing", required=True)
    r.add_argument("--out", default=None, help="output root (default: under spark.checkpoint.dir)")
    r.add_argument("--as-of", default=None, help="reporting date replacing NOW() (default: today)")
    r.add_argument("--too-wide", choices=["keep", "fail", "reject"], default="keep",
                   help="text beyond its declared width: kept and reported, fails the load, or goes to rejects/")
    r.add_argument("--master", default="local[*]")
    args = ap.parse_args(argv)
    if args.master.startswith("local"):
        spark = build_session(args.master)          # local defaults (tests, laptops)
    else:                                           # a cluster: its spark-defaults rule
        spark = SparkSession.builder.master(args.master).appName("tierwise").getOrCreate()
    wh = refresh_from_csv(spark, args.landing, args.out, args.as_of, too_wide=args.too_wide)
    print(json.dumps({"root": wh.root, "published": wh.publish(args.as_of)}))
    for row in wh.quality.collect():
        print(json.dumps(row.asDict()))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
