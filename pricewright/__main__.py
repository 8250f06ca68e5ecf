"""Command line: ``python -m pricewright train|retrain|score|follow --data in.csv --out folder``."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import SparkSession

from pricewright.operators.models import NAMES
from pricewright.plans.full_run import full_run
from pricewright.plans.retrain_plan import retrain
from pricewright.plans.score_plan import score_run
from pricewright.session import tuned
from pricewright.sources.tables import scan_csv, scan_quarantined
from pricewright.spec import AIRFARES
from pricewright.staging import drop_stages
from pricewright.streaming.score_stream import csv_requests, follow_stream


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="pricewright")
    parser.add_argument("job", choices=["train", "retrain", "score", "follow"])
    parser.add_argument("--data", required=True, help="header CSV, a file or a folder of files")
    parser.add_argument("--out", required=True, help="folder on shared storage for reports and models")
    parser.add_argument("--skip-explore", action="store_true")
    parser.add_argument("--learner", choices=sorted(NAMES), help="retrain another learner than the served one")
    parser.add_argument("--version", help="score with this version instead of the served one")
    parser.add_argument("--resume", help="folder for stages that a run started again goes on from")
    parser.add_argument("--refused", help="table for rows that are no rows; without it the first one stops the job")
    parser.add_argument("--multi-line", action="store_true", help="allow line breaks inside quoted cells")
    args = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = tuned(SparkSession.builder.appName("pricewright").getOrCreate())
    try:
        if args.job == "follow":
            follow_stream(csv_requests(spark, args.data), AIRFARES, args.out, f"{args.out}/followed",
                          f"{args.out}/followed_progress").awaitTermination()
            return
        hint = "pass --data with the raw table"
        raw = (scan_quarantined(spark, args.data, args.refused, hint=hint) if args.refused
               else scan_csv(spark, args.data, hint=hint, multi_line=args.multi_line))
        if args.job == "train":
            done = full_run(raw, AIRFARES, args.out, explore=not args.skip_explore, resume=args.resume)
            logging.info("best learner %s, version %s", done.best, done.version)
        elif args.job == "retrain":
            again = retrain(raw, AIRFARES, args.out, learner=args.learner)
            logging.info("version %s: %s", again.version, again.metrics.first().asDict())
        else:
            logging.info("scored requests in %s", score_run(raw, AIRFARES, args.out, args.version))
    finally:
        drop_stages(spark)


if __name__ == "__main__":
    main()
