"""Command line: what an operator of the mart runs.

    python -m sparkmart build  --sf-dir DIR --out WH            # D6: rebuild staging, dimensions, fact (new versions)
    python -m sparkmart load   --sf-dir DIR --out WH            # a later load: history, keys and stored lines are kept
    python -m sparkmart sync   --source WH --target TGT         # I2: watermark sync of the four tables
    python -m sparkmart report --warehouse WH [--view monthly|rank] [--out DIR]   # V1 / V2

``--now`` and ``--as-of`` default to the clock.  A printed report has at most
``--limit`` rows; ``--out`` writes all of them as Parquet.

On a cluster run it through ``spark-submit`` with ``spark.checkpoint.dir`` set;
locally a session is created for you.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import SparkSession


def _session(master: str | None) -> SparkSession:
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    from sparkmart.session import build_session

    return build_session(master=master or "local[*]")


def _params(args):
    from sparkmart.plans.build import BuildParams

    now = dt.datetime.fromisoformat(args.now) if args.now else dt.datetime.now(dt.UTC).replace(tzinfo=None, microsecond=0)
    as_of = dt.date.fromisoformat(args.as_of) if args.as_of else now.date()
    return BuildParams(now=now, as_of=as_of, fact_partition=None if args.fact_partition == "none" else args.fact_partition)


def cmd_build(spark: SparkSession, args) -> dict:
    from sparkmart.plans.build import run_build
    from sparkmart.sources.bindings import Sources

    wh = run_build(Sources(spark, args.sf_dir), _params(args), out_dir=args.out)
    return {name: df.count() for name, df in wh.tables().items()}


def cmd_load(spark: SparkSession, args) -> dict:
    from sparkmart.plans.build import run_load
    from sparkmart.sources.bindings import Sources

    wh = run_load(Sources(spark, args.sf_dir), _params(args), args.out)
    return {name: df.count() for name, df in wh.tables().items()}


def cmd_sync(spark: SparkSession, args) -> list[dict]:
    from sparkmart import schemas
    from sparkmart.operators import sync
    from sparkmart.sources.sinks import latest_version, read_snapshot

    sources = {spec.name: read_snapshot(spark, args.source, spec.name) for spec in schemas.WAREHOUSE_SPECS}
    targets = {}
    for spec in schemas.WAREHOUSE_SPECS:
        v = latest_version(spark, args.target, spec.name)
        new = spark.createDataFrame([], sources[spec.name].schema)
        targets[spec.name] = new if v is None else read_snapshot(spark, args.target, spec.name, v)
    layout = {} if args.fact_partition == "none" else {"fact_orders": (args.fact_partition,)}
    results = sync.sync_all(sources, targets, out_dir=args.target, partition_by=layout)
    return [r.asDict() for r in sync.sync_report(spark, results).orderBy("sync_order").collect()]


def cmd_report(spark: SparkSession, args) -> list[dict]:
    from sparkmart.plans.views import monthly_report, rank_report
    from sparkmart.sources.sinks import read_snapshot

    fact = read_snapshot(spark, args.warehouse, "fact_orders")
    if args.view == "monthly":
        out = monthly_report(fact, read_snapshot(spark, args.warehouse, "dim_date"))
    else:
        out = rank_report(fact, read_snapshot(spark, args.warehouse, "dim_product"))
    if args.out:  # large rankings go to files, not through the driver
        out.write.mode("overwrite").parquet(args.out)
        return [{"written": args.out}]
    return [r.asDict() for r in out.limit(args.limit).collect()]


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="sparkmart")
    parser.add_argument("--master", default=None)
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("build", "load"):
        b = sub.add_parser(name)
        b.add_argument("--sf-dir", required=True)
        b.add_argument("--out", required=True)
        b.add_argument("--now", default=None, help="load time (default: the clock, UTC)")
        b.add_argument("--as-of", default=None, help="business date of price changes (default: the day of --now)")
    s = sub.add_parser("sync")
    s.add_argument("--source", required=True)
    s.add_argument("--target", required=True)
    for name in ("build", "load", "sync"):
        sub.choices[name].add_argument("--fact-partition", default="date_key", help="stored layout of the fact; none: sorted by day")
    r = sub.add_parser("report")
    r.add_argument("--warehouse", required=True)
    r.add_argument("--view", choices=("monthly", "rank"), default="monthly")
    r.add_argument("--out", default=None, help="write the view as parquet instead of printing it")
    r.add_argument("--limit", type=int, default=200, help="rows printed without --out")
    args = parser.parse_args(argv)
    spark = _session(args.master)
    commands = {"build": cmd_build, "load": cmd_load, "sync": cmd_sync, "report": cmd_report}
    print(json.dumps(commands[args.command](spark, args), default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
