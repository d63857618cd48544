"""Command-line entry for spark-submit: the reference's jobs, one run each.

    spark-submit --py-files kiln.zip kiln/cli.py daily --raw <day file or folder> --ds 2026-04-08 --root <folder>
    python -m kiln chain --raw <json files> --root <folder> [--ds DATE]
    python -m kiln score --root <folder> [--applicants <parquet>]
    python -m kiln ingest --landing <folder> --sink <folder>

``--root`` holds the warehouse (database ``--database``, default ``kiln``),
the clean files and the staging folders. Scheduling stays with whatever
runs the command. Each run prints its counts as one JSON line.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kiln")
    sub = p.add_subparsers(dest="job", required=True)
    d = sub.add_parser("daily", help="one run date: day file -> clean CSV -> replace the day")
    d.add_argument("--raw", required=True)
    d.add_argument("--ds", required=True)
    c = sub.add_parser("chain", help="extract -> transform -> load as three stages")
    c.add_argument("--raw", required=True)
    c.add_argument("--ds")
    c.add_argument("--mode", choices=["overwrite", "append"], default="overwrite")
    c.add_argument("--handoff", choices=["parquet", "text"], default="parquet", help="files between the stages")
    c.add_argument("--by-file-date", action="store_true", help="run dates from the file names, not the rows")
    s = sub.add_parser("score", help="score pending customers, update by key")
    s.add_argument("--applicants", help="parquet with user_id, income, loan_amt: full refresh first")
    s.add_argument("--salt", default="")
    s.add_argument("--strict", action="store_true")
    s.add_argument("--empty", choices=["skip", "fail"], default="skip")
    i = sub.add_parser("ingest", help="stream new raw files into the sink once")
    i.add_argument("--landing", required=True)
    i.add_argument("--sink", required=True)
    i.add_argument("--archive")
    for q in (d, c, s):
        q.add_argument("--root", required=True)
        q.add_argument("--database", default="kiln")
    for q in (d, c):
        q.add_argument("--keep-quarantine", action="store_true")
    return p


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"kiln-{args.job}").getOrCreate()
    from kiln.plans.credit_run import credit_run
    from kiln.plans.sensor_etl import run_chain, run_daily
    from kiln.sinks.warehouse import Warehouse
    from kiln.sources.files import scan_raw_json
    from kiln.streaming.ingest import stream_ingest

    if args.job == "ingest":
        stream_ingest(spark, args.landing, args.sink, archive_dir=args.archive)
        out = {"job": "ingest", "sink": args.sink}
    else:
        wh = Warehouse(spark, root=f"{args.root.rstrip('/')}/warehouse", database=args.database)
        wh.ensure_tables()
        if args.job == "daily":
            audit = run_daily(spark, args.raw, args.ds, args.root, wh, keep_quarantine=args.keep_quarantine)
            out = {"job": "daily", **audit.__dict__}
        elif args.job == "chain":
            source = scan_raw_json(spark, args.raw, with_file_date=args.by_file_date, keep_corrupt=True)
            audit = run_chain(spark, source, args.root, wh, args.ds, args.mode,
                              keep_quarantine=args.keep_quarantine, handoff=args.handoff)
            out = {"job": "chain", **audit.__dict__}
        else:
            apps = spark.read.parquet(args.applicants) if args.applicants else None
            out = {"job": "score", **credit_run(wh, apps, args.salt, strict=args.strict, empty=args.empty)}
    print(json.dumps(out, default=str))
    return out


if __name__ == "__main__":
    main(sys.argv[1:])
