"""Command line jobs: ``python -m lakestrata <job> ...`` (or spark-submit on this file)."""

import argparse
import sys

from lakestrata.operators.audit import RunLog, run_status_latest
from lakestrata.operators.quality import live_checks
from lakestrata.plans.batch import Medallion
from lakestrata.plans.cleaning import clean_job
from lakestrata.plans.live import gold_live, medallion_live
from lakestrata.plans.report import layer_report
from lakestrata.session import build_session
from lakestrata.sources.sinks import report_json, write_report
from lakestrata.sources.tabular import scan_parquet
from lakestrata.streaming.ingest import medallion_stream


def _arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="lakestrata")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, text: str, *arguments: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=text)
        for argument in arguments:
            sub.add_argument(argument)
        return sub

    job("medallion", "new files of a folder into quarantine and silver", "input", "root")
    stream = job("stream", "the same, as files arrive", "input", "root", "checkpoint")
    stream.add_argument("--interval", help="poll interval; without it, drain and stop")
    quality = job("quality", "report over the layers below a folder", "root", "report")
    quality.add_argument("--as-of")
    clean = job("clean", "clean one CSV into Parquet", "input", "output")
    clean.add_argument("--fill", default="age")
    job("verify", "schema, sample and row count of a Parquet folder", "path")
    job("runs", "the latest event of each pipeline below a root", "root")
    job("gold", "daily gold straight from raw files", "input")
    job("live", "live checks straight from raw files", "input")
    return parser.parse_args()


def main() -> int:
    args = _arguments()
    spark = build_session(f"lakestrata-{args.job}")
    if args.job == "medallion":
        with RunLog(spark, f"{args.root}/runs").task("medallion", "batch"):
            Medallion(spark, args.root).run(args.input).show(truncate=False)
    elif args.job == "stream":
        with RunLog(spark, f"{args.root}/runs").task("medallion", "stream"):
            medallion_stream(spark, args.input, args.root, args.checkpoint, args.interval).awaitTermination()
    elif args.job == "runs":
        run_status_latest(RunLog(spark, f"{args.root}/runs").events()).show(truncate=False)
    elif args.job == "quality":
        report = layer_report(spark, args.root, args.as_of)
        write_report(report, args.report)
        written = spark.read.schema(report.schema).json(args.report)
        print(report_json(written).first()["report"])
        return 1 if written.first()["overall_status"] == "FAIL" else 0
    elif args.job == "clean":
        clean_job(spark, args.input, args.output, args.fill).show()
    elif args.job == "verify":
        df = scan_parquet(spark, args.path)
        df.printSchema()
        df.show(truncate=False)
        print(f"Total rows: {df.count()}")
    elif args.job == "gold":
        gold = gold_live(spark, args.input)
        print("No data found.") if gold is None else gold.show(truncate=False)
    elif args.job == "live":
        view = medallion_live(spark, args.input)
        if view.bronze is None:
            view.issues.show(truncate=False)
        else:
            live_checks(view.issues, view.bronze, view.silver).show(100, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
