"""Jobs from the command line: ``spark-submit … -m gridtally hourly --dt … --hour …``."""

from __future__ import annotations

import argparse

from gridtally.operators.rollups import RETENTION_DAYS
from gridtally.plans import heatmap_jobs, listen_jobs
from gridtally.session import build_session
from gridtally.sources import raw_files


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="gridtally")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def raw(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--bucket", required=True, help="root of the landing area, any Hadoop path")
        sub.add_argument("--topics-dir", default=raw_files.JSON_FOLDER)
        sub.add_argument("--topic", default=raw_files.TOPIC)
        sub.add_argument("--format", default="json", choices=["json", "parquet"])

    raw(job("hourly", "dt", "hour", "hourly-table"))
    job("daily", "dt", "hourly-table", "daily-table")
    job("weekly", "week-start", "daily-table", "weekly-table")
    raw(job("backfill", "first", "last", "hourly-table", "daily-table", "weekly-table"))
    raw(job("late", "run-start", "run-end", "hourly-table", "daily-table", "weekly-table"))
    expire = job("expire", "as-of")
    for name in RETENTION_DAYS:
        expire.add_argument(f"--{name}-table", help=f"rows are kept for {RETENTION_DAYS[name]} days")
    topk = job("topk", "counters", "as-of", "output")
    topk.add_argument("--days")
    topk.add_argument("--k")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = build_session(f"gridtally-{args.job}")
    base = raw_files.raw_base(args.bucket, args.format, args.topics_dir, args.topic) if "bucket" in args else None
    if args.job == "hourly":
        heatmap_jobs.hourly_job(spark, base, args.hourly_table, args.dt, args.hour, args.format)
    elif args.job == "daily":
        heatmap_jobs.daily_job(spark, args.hourly_table, args.daily_table, args.dt)
    elif args.job == "weekly":
        heatmap_jobs.weekly_job(spark, args.daily_table, args.weekly_table, args.week_start)
    elif args.job == "expire":
        given = {name: getattr(args, f"{name}_table") for name in RETENTION_DAYS}
        heatmap_jobs.expire_job(spark, {name: path for name, path in given.items() if path}, args.as_of)
    elif args.job == "topk":
        ranked = listen_jobs.serve_topk(spark, args.counters, args.as_of, args.days, args.k)
        ranked.write.mode("overwrite").parquet(args.output)
    else:
        places = (spark, base, args.hourly_table, args.daily_table, args.weekly_table)
        if args.job == "backfill":
            heatmap_jobs.backfill_job(*places, args.first, args.last, args.format)
        else:
            heatmap_jobs.late_job(*places, args.run_start, args.run_end, args.format)


if __name__ == "__main__":
    main()
