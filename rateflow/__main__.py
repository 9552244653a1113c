"""Command line for the daily job and the dashboard read.

    python -m rateflow refresh --input <folder of SERIES.csv> [--env dev] [--convert A,B] [--weekly]
    python -m rateflow serve [--env dev] [--root <folder>] [--freq daily|weekly|monthly] [--group rates|changes|volatility] [-k 20]

``spark-submit`` supplies the cluster settings (including ``spark.checkpoint.dir``); the
session is taken with ``getOrCreate()``. ``refresh`` prints the job's status line; ``serve``
shows the newest k rows of one metric group, oldest first (only k rows leave the executors).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from rateflow.operators.serve import GROUPS, serve_latest
from rateflow.plans.refresh import refresh_from_files, serve_published, table_names

_DATE_COL = {"DAILY": "DDATE", "WEEKLY": "WDATE", "MONTHLY": "MDATE"}


def _rates(columns: list[str], date_col: str) -> list[str]:
    """Rate columns of a metrics table: everything except the date and the metric columns."""
    return [c for c in columns if c != date_col and not c.startswith(("rate_change_percent_", "volatility_"))]


def main(argv: list[str] | None = None):
    ap = argparse.ArgumentParser(prog="rateflow", description=__doc__,
                                 formatter_class=argparse.RawDescriptionHelpFormatter)
    sub = ap.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh", help="raw -> harmonized -> analytics from landed files")
    r.add_argument("--input", required=True, help="folder with <SERIES>.csv files (date,value)")
    r.add_argument("--env", default="dev", help="prefix of the raw/harmonized/analytics databases")
    r.add_argument("--convert", default="", help="comma-separated series ids quoted the other way round")
    r.add_argument("--root", default=None, help="shared folder for the tables (default: below the checkpoint dir)")
    r.add_argument("--weekly", action="store_true", help="also build the weekly tables from the daily series")
    r.add_argument("--missing", default="zero", choices=["zero", "null"],
                   help="zero: missing values become 0 at load (parity); null: they are gaps, filled forward")
    s = sub.add_parser("serve", help="newest rows of one metric group")
    s.add_argument("--env", default="dev")
    s.add_argument("--freq", default="daily", choices=["daily", "weekly", "monthly"])
    s.add_argument("--group", default="rates", choices=list(GROUPS))
    s.add_argument("--root", default=None, help="the folder that refresh wrote to (default: by table name)")
    s.add_argument("-k", type=int, default=20)
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName(f"rateflow-{args.cmd}").getOrCreate()
    if args.cmd == "refresh":
        convert = [c.strip() for c in args.convert.split(",") if c.strip()]
        status = refresh_from_files(spark, args.input, env=args.env, convert=convert, root=args.root,
                                    weekly=args.weekly, missing=args.missing)
        print(status)
        return status
    freq = args.freq.upper()
    date_col = _DATE_COL[freq]
    if args.root:  # the newest published version: needs no catalog that outlives the session of the refresh
        out = serve_published(spark, args.root, f"{args.freq}_metrics", date_col, k=args.k, group=args.group)
    else:
        table = spark.table(table_names(args.env)[f"{freq}_metrics"])
        out = serve_latest(table, date_col, _rates(table.columns, date_col), k=args.k, group=args.group)
    out.show(args.k, truncate=False)
    return out


if __name__ == "__main__":
    main()
