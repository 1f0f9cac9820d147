"""Command line: the job's four user-facing operations on the active Spark session.

    python -m popspark state-names --county fips_codes.csv --out data/
    python -m popspark audit       --src src/ [--decade 1990 ...]
    python -m popspark decade      --src src/ --out data/ --decade 2010
    python -m popspark combine     --out data/
    python -m popspark run         --src src/ --out data/ --county fips_codes.csv

On a cluster: ``spark-submit --py-files popspark.zip tools/popspark_submit.py run ...``.  ``--county`` is a CSV with a header
holding at least ``state_code`` and ``state_name`` (the county-level code
table); every other path may be any Hadoop-compatible URI.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .functions import codes
from .operators import quality
from .plans import job
from .plans import pipelines as pl
from .sources import readers, sinks


def _county(spark: SparkSession, path: str):
    """The county code table (S8): header CSV, every column text so codes keep their zeros."""
    return spark.read.option("header", "true").csv(path)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="popspark")
    sub = p.add_subparsers(dest="cmd", required=True)
    s = sub.add_parser("state-names", help="PL8: write the state-name dimension")
    s.add_argument("--county", required=True)
    s.add_argument("--out", required=True)
    a = sub.add_parser("audit", help="S13: list missing or empty source files")
    a.add_argument("--src", required=True)
    a.add_argument("--decade", type=int, action="append")
    d = sub.add_parser("decade", help="PL1–PL6: process one decade")
    d.add_argument("--src", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--decade", type=int, required=True, choices=codes.DECADES)
    c = sub.add_parser("combine", help="PL7: combine the written decades into the product")
    c.add_argument("--out", required=True)
    c.add_argument("--decade", type=int, action="append", choices=codes.DECADES)
    r = sub.add_parser("run", help="PL9: dimension, audit, all decades, combined product")
    r.add_argument("--src", required=True)
    r.add_argument("--out", required=True)
    r.add_argument("--county", required=True)
    r.add_argument("--resume", action="store_true", help="reuse the decades that a failed run left complete")
    r.add_argument("--incremental", action="store_true", help="leave published decades whose files and state names didn't change")
    r.add_argument("--domain-report", action="store_true", help="also write per-decade code-domain violations")
    r.add_argument("--parse-report", action="store_true", help="also write per-decade counts of unreadable fields")
    w = sub.add_parser("where", help="print where a published output lies")
    w.add_argument("--out", required=True)
    w.add_argument("name", help="such as states-asrpe, state_names, 1990/states-asrpe1990")
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"popspark-{args.cmd}").getOrCreate()
    if args.cmd == "state-names":
        names = pl.state_names_sorted(_county(spark, args.county))
        stage = job.staging(args.out)
        sinks.write_state_names(names, f"{stage}/state_names", mode="overwrite")
        sinks.publish(spark, stage, args.out.rstrip("/"), ["state_names"])
    elif args.cmd == "audit":
        quality.require_sources(job.audit_sources(spark, args.src, args.decade or codes.DECADES))
        print("all source files present")
    elif args.cmd == "decade":
        names = readers.read_state_names(spark, job.output(spark, args.out, "state_names"))
        quality.require_sources(job.audit_sources(spark, args.src, [args.decade]))
        stage, name = job.staging(args.out), job.decade_name(args.decade)
        job.write_decade(spark, args.src, f"{stage}/{name}", args.decade, names)
        sinks.publish(spark, stage, args.out.rstrip("/"), [name])
    elif args.cmd == "combine":
        job.combine_outputs(spark, args.out, args.decade or codes.DECADES)
    elif args.cmd == "where":
        print(job.output(spark, args.out, args.name))
    else:
        job.run_job(
            spark,
            args.src,
            args.out,
            _county(spark, args.county),
            resume=args.resume,
            domain_report=args.domain_report,
            parse_report=args.parse_report,
            incremental=args.incremental,
        )
    return 0


if __name__ == "__main__":
    sys.exit(main())
