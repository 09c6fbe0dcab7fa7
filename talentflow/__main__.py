"""Command line: ``python -m talentflow <job> [options]`` (e.g. via spark-submit)."""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession

from .plans import jobs


def _date(s: str | None):
    return dt.date.fromisoformat(s) if s else None


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="talentflow")
    sub = p.add_subparsers(dest="job", required=True)
    a = sub.add_parser("bronze", help="landed responses -> Bronze (append)")
    a.add_argument("landing_root"); a.add_argument("bronze_path"); a.add_argument("rejects_path")
    a.add_argument("--ingestion-date")
    a.add_argument("--run-id", help="id of a run to repeat: it replaces its own rows")
    a.add_argument("--targets", help="CSV with header source,company_identifier,risk_tier")
    s = sub.add_parser("silver", help="Bronze -> Silver (upsert)")
    s.add_argument("bronze_path"); s.add_argument("silver_path")
    s.add_argument("--since-date"); s.add_argument("--rejects-path")
    s.add_argument("--full", action="store_true", help="recompute from all of Bronze")
    g = sub.add_parser("gold", help="write every Gold view")
    g.add_argument("silver_path"); g.add_argument("gold_root")
    g.add_argument("--bronze-path"); g.add_argument("--previous-date"); g.add_argument("--current-date")
    m = sub.add_parser("match", help="rank postings for one CV")
    m.add_argument("silver_path"); m.add_argument("cv_file"); m.add_argument("years", type=float)
    m.add_argument("--top-k", type=int, default=20)
    args = p.parse_args(argv)

    spark = SparkSession.builder.appName(f"talentflow-{args.job}").getOrCreate()
    if args.job == "bronze":
        targets = None
        if args.targets:
            from .schemas import TARGETS

            targets = spark.read.schema(TARGETS).option("header", True).csv(args.targets)
        print(json.dumps({"rows": jobs.land_to_bronze(spark, args.landing_root, args.bronze_path, args.rejects_path,
                                                       targets=targets, ingestion_date=_date(args.ingestion_date), run_id=args.run_id)}))
    elif args.job == "silver":
        print(json.dumps({"rows": jobs.bronze_to_silver(spark, args.bronze_path, args.silver_path,
                                                         _date(args.since_date), args.rejects_path, args.full)}))
    elif args.job == "gold":
        print(json.dumps(jobs.write_gold(spark, args.gold_root, args.silver_path, args.bronze_path,
                                         _date(args.previous_date), _date(args.current_date))))
    else:
        with open(args.cv_file, encoding="utf-8") as f:
            cv = f.read()
        jobs.match_cv(spark, args.silver_path, cv, args.years, args.top_k).select(
            "job_id", "company", "title", "match_score", "matched_skills", "missing_skills", "rationale"
        ).show(args.top_k, truncate=False)


if __name__ == "__main__":
    main()
