"""python -m arbograph.cli publish|collect|scan|convert ..."""

from __future__ import annotations

import argparse
import signal
import sys

from pyspark.sql import SparkSession

from .plans.collect import collect, scan_to_jsonl
from .plans.convert import convert_file
from .plans.publish import Request, publish


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="arbograph")
    jobs = top.add_subparsers(dest="job", required=True)
    p = jobs.add_parser("publish", help="publish the usage report of an inventory")
    p.add_argument("--input", required=True)
    p.add_argument("--completed", action="store_true")
    p.add_argument("--snapshot-at", required=True)
    c = jobs.add_parser("collect", help="scan a tree and publish its report")
    c.add_argument("--inventory-dir", required=True)
    for x in (p, c):
        x.add_argument("--root", required=True)
        x.add_argument("--output", required=x is c, default="usage.sqlite3")
        x.add_argument("--fss-usage")
        x.add_argument("--fss-carry-forward", action="store_true")
    s = jobs.add_parser("scan", help="write the records of a tree as JSON lines")
    s.add_argument("--prefix", required=True)
    s.add_argument("--outfile", required=True)
    v = jobs.add_parser("convert", help="convert scanner lines to columns and side files")
    v.add_argument("--chunk-mb", type=int, default=8, help="size of a split of the input")
    v.add_argument("--arrow", action="store_true")
    v.add_argument("input")
    v.add_argument("outdir")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.job == "convert" and not 1 <= a.chunk_mb <= 1024:
        print("--chunk-mb: from 1 to 1024", file=sys.stderr)
        return 1
    signal.signal(signal.SIGTERM, lambda *_: sys.exit(143))
    builder = SparkSession.builder.appName("arbograph")
    spark = (builder.config("spark.sql.files.maxPartitionBytes", f"{a.chunk_mb}m") if a.job == "convert" else builder).getOrCreate()
    if a.job == "publish":
        return publish(spark, Request(a.input, a.root, a.output, a.completed, a.snapshot_at, a.fss_usage, a.fss_carry_forward))
    try:
        if a.job == "collect":
            print(collect(spark, a.root, a.inventory_dir, a.output, a.fss_usage, a.fss_carry_forward))
        elif a.job == "scan":
            from pathlib import Path

            scan_to_jsonl(spark, a.prefix, Path(a.outfile).absolute())
        else:
            print(convert_file(spark, a.input, a.outdir, a.arrow))
        return 0
    except Exception as why:
        print(f"{a.job} failed: {why}", file=sys.stderr)
        return 1 if a.job == "convert" else 2


if __name__ == "__main__":
    sys.exit(main())
