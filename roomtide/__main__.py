"""Jobs for spark-submit: python -m roomtide local|nightly ..."""

from __future__ import annotations

import argparse

from roomtide.plans.local import run_local
from roomtide.plans.nightly import run_nightly
from roomtide.runtime import build_session
from roomtide.sinks.tables import export

REPORTS = ("event_types", "event_overview", "viewer_metrics", "top_likers", "gift_revenue", "top_commenters")


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="roomtide")
    jobs = parser.add_subparsers(dest="job", required=True)
    local = jobs.add_parser("local", help="type JSONL events and print the reports")
    local.add_argument("--input", "-i", required=True)
    local.add_argument("--out", help="folder for the typed tables and the whole reports; nothing is written without it")
    local.add_argument("--show", type=int, default=0, help="print so many rows of each report")
    nightly = jobs.add_parser("nightly", help="type one day of the archive")
    nightly.add_argument("--lake", required=True, help="root of the archive")
    nightly.add_argument("--date", required=True, help="YYYY-MM-DD")
    nightly.add_argument("--dry-run", action="store_true")
    nightly.add_argument("--out", help="root of the typed tables, if not the archive's")
    options = parser.parse_args(arguments)

    spark = build_session(f"roomtide-{options.job}")
    if options.job == "nightly":
        summary = run_nightly(spark, options.lake, options.date, options.dry_run, options.out)
        for row in summary.toLocalIterator():  # a row for each table or event type
            print(row.date, row.item, row.rows, row.path or "")
        return
    results = run_local(spark, options.input, options.out)
    reports = {name: results[name] for name in REPORTS}
    if options.out:
        export(reports, options.out, prefix="report_")
        reports = {name: spark.read.parquet(f"{options.out.rstrip('/')}/report_{name}") for name in REPORTS}
    for name, report in reports.items():
        print(f"{name}: {report.count()} rows")
        if options.show:
            report.show(options.show, truncate=False)


if __name__ == "__main__":
    main()
