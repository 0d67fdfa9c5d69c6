"""Command line: build market tables from landed responses.

    python -m overround tab --landing L --out O [--snapshot S] [--format csv|parquet]
    python -m overround sportsbet --pages P --landing L --metadata M --out O [...]

On a cluster run it through ``spark-submit``; the master, executors and
``spark.checkpoint.dir`` come from the submit configuration.
"""

from __future__ import annotations

import argparse
import json
import sys

from .plans import pipelines
from .session import build_session


def main(argv: list[str] | None = None) -> int:
    """Parse arguments, run one feed, print the written table paths; 1 if a market failed."""
    ap = argparse.ArgumentParser(prog="overround")
    sub = ap.add_subparsers(dest="feed", required=True)
    tab = sub.add_parser("tab", help="TAB-style responses -> TAB market tables")
    sb = sub.add_parser("sportsbet", help="listing pages + Sportsbet-style responses -> market tables")
    for p in (tab, sb):
        p.add_argument("--landing", required=True, help="folder of landed JSON-lines {url, body}")
        p.add_argument("--out", required=True, help="output folder")
        p.add_argument("--snapshot", default="latest", help="snapshot id of this run")
        p.add_argument("--format", default="parquet", choices=["parquet", "csv"])
        p.add_argument("--master", default=None, help="only for local runs")
    tab.add_argument("--layout", default="lines", choices=["lines", "files"],
                     help="landing holds JSON lines of (url, body), or one response in each file")
    sb.add_argument("--base", default="https://api.example.com/sportsbook", help="address that the responses were fetched from")
    sb.add_argument("--pages", required=True, help="Parquet table (page_id, url, html)")
    sb.add_argument("--metadata", required=True, help="folder of landed event-metadata responses")
    args = ap.parse_args(argv)

    from pyspark.sql import SparkSession

    owned = SparkSession.getActiveSession() is None
    spark = build_session(args.master)
    if args.feed == "tab":
        out = pipelines.run_tab(spark, args.landing, args.out, args.snapshot, args.format, args.layout)
    else:
        out = pipelines.run_sportsbet(spark, args.pages, args.landing, args.metadata, args.out,
                                      args.snapshot, args.format, base=args.base)
    print(json.dumps(out, indent=2))
    wanted = pipelines.TAB_MARKETS if args.feed == "tab" else {"sportsbet_h2h", *pipelines.SPORTSBET_ROUTES}
    failed = sorted(set(wanted) - set(out))
    if failed:
        print(f"failed (see {args.out}/run_ledger): {', '.join(failed)}", file=sys.stderr)
    if owned:
        spark.stop()
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
