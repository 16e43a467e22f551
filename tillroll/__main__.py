"""Command line: the daily run paths as Spark jobs.

    python -m tillroll extract --sf-dir D --lake L     # incremental extract -> raw
    python -m tillroll process --lake L [--incremental] # raw -> processed -> marts
    python -m tillroll quality --lake L                # audit marts (raises on critical)
    python -m tillroll publish --lake L                # register marts as tables
    python -m tillroll full    --sf-dir D --lake L     # extract -> process -> audit -> publish
    python -m tillroll query KEY --sf-dir D [--show N] # any registered query
    python -m tillroll report NAME [--database DB]      # report on published marts

``--sf-dir`` points at the driver-style base tables (read through the fixture
adapter).  ``--lake`` is any Hadoop URI shared by the cluster; raw data and
watermarks of one run are found by the next one there.  On a cluster, ship the package
(``--py-files tillroll.zip``) and run ``spark-submit submit.py <command>``;
the session then comes from the platform (``--master`` here only matters for
local runs).
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from . import schemas
from .operators import quality as Q
from .operators import reports as R
from .plans import catalog, pipeline
from .session import apply_required_conf, local_session
from .sources.extract import run_extract
from .sources.fixtures import fixture_sources
from .sources.raw import read_folder, read_raw_all


def _session(args) -> SparkSession:
    if args.master:
        return local_session(args.master.removeprefix("local[").removesuffix("]") or "*",
                             args.shuffle_partitions)
    spark = SparkSession.builder.appName("tillroll").getOrCreate()
    apply_required_conf(spark)
    return spark


#: Reports on published marts: name -> (mart, function).
REPORTS = {
    "monthly_trend": ("daily_sales", R.monthly_trend),
    "category_recent": ("daily_sales", R.category_recent),
    "top_products": ("product_performance", R.top_products),
    "ltv_segments": ("customer_ltv", R.ltv_segments),
    "tier_performance": ("customer_ltv", R.tier_performance),
    "dow_pattern": ("daily_sales", R.dow_pattern),
    "vip_customers": ("customer_ltv", R.vip_customers),
    "category_margin": ("daily_sales", R.category_margin),
}


def _print(df, n: int) -> None:
    for row in df.limit(n).collect():  # display only: bounded by n
        print(json.dumps(row.asDict(), default=str))


def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="tillroll")
    ap.add_argument("command", choices=["extract", "process", "quality", "publish", "full", "query",
                                        "report"])
    ap.add_argument("key", nargs="?")
    ap.add_argument("--sf-dir", default="/root/testdata/sf0.01")
    ap.add_argument("--lake")
    ap.add_argument("--database", default="tillroll_marts")
    ap.add_argument("--master", default=None, help="e.g. local[8]; omit on a cluster")
    ap.add_argument("--shuffle-partitions", type=int, default=8)
    ap.add_argument("--show", type=int, default=20)
    ap.add_argument("--floors", default=None, help='JSON, e.g. {"customer_ltv": 100}')
    ap.add_argument("--incremental", action="store_true",
                    help="process from per-key latest tables instead of the whole raw history")
    ap.add_argument("--ts-policy", choices=["parent", "reference"], default="parent",
                    help="what the watermark of order items follows")
    args = ap.parse_args(argv)
    if args.command in ("extract", "process", "quality", "publish", "full") and not args.lake:
        ap.error(f"{args.command} needs --lake")

    spark = _session(args)
    lake = (args.lake or "").rstrip("/")
    floors = json.loads(args.floors) if args.floors else None

    if args.command == "extract":
        _print(run_extract(spark, fixture_sources(spark, args.sf_dir), f"{lake}/raw",
                           f"{lake}/state/watermarks", ts_policy=args.ts_policy), args.show)
    elif args.command == "process":
        if args.incremental:
            raw = pipeline.refresh_latest(spark, lake)
        else:
            raw = {t: read_raw_all(spark, f"{lake}/raw", t, schemas.SOURCES[t]).drop("ingest_date")
                   for t in pipeline.PROCESSED}
        _print(pipeline.process(spark, raw, lake, deduped=args.incremental), args.show)
    elif args.command == "quality":
        marts = pipeline.candidate_marts(spark, lake)
        results = pipeline.audit(spark, marts, lake, floors)
        _print(results.drop("details"), 100)
        warnings = Q.gate(results)
        print(json.dumps({"critical_failures": 0, "warning_failures": warnings}))
    elif args.command == "publish":
        results = read_folder(spark, f"{lake}/quality/results")
        if results is None:
            raise SystemExit("publish: run quality first")
        Q.gate(results)
        written = pipeline.publish_all(spark, lake, pipeline.candidate_marts(spark, lake), args.database)
        print(json.dumps({f"{m['layer']}/{m['dataset']}": m["rows"] for m in written}))
    elif args.command == "full":
        _print(pipeline.run_full(spark, fixture_sources(spark, args.sf_dir), lake, floors,
                                 args.database, incremental=args.incremental,
                                 ts_policy=args.ts_policy), 100)
    elif args.command == "report":
        if args.key not in REPORTS:
            print(f"unknown report {args.key!r}; known: {', '.join(sorted(REPORTS))}")
            return 2
        mart, report = REPORTS[args.key]
        _print(report(spark.table(f"{args.database}.{mart}")), args.show)
    elif args.command == "query":
        if args.key not in catalog.QUERIES:
            print(f"unknown query {args.key!r}; known: {', '.join(sorted(catalog.QUERIES))}")
            return 2
        _print(catalog.QUERIES[args.key](spark, args.sf_dir), args.show)
    if lake:
        print(json.dumps({"lake": lake}), file=sys.stderr)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
