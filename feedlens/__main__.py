"""Command line for an external scheduler: one subcommand per job.

    python -m feedlens cube --feed PATH --messages PATH --run-date 2024-01-09 --table db.cube
    python -m feedlens feed-report --feed PATH --run-date 2024-01-09 --table db.reports
    python -m feedlens app-report --feed PATH --messages PATH --run-date 2024-01-09 --table db.reports
                                  [--first-seen db.seen] [--since 2024-01-01] [--audience db.weeks]
    python -m feedlens user-counts --feed PATH --messages PATH --run-date 2024-01-09 --table db.users
    python -m feedlens experiment --feed PATH --run-date 2024-01-09 --start 2024-01-02 --groups 1 2 --table db.exp
    python -m feedlens alerts --feed PATH --messages PATH --as-of "2024-01-09 12:07:00" --table db.reports
    python -m feedlens ingest --feed-dir DIR --messages-dir DIR --out DIR --table db.cube --checkpoint DIR
    python -m feedlens stream --feed-dir DIR --messages-dir DIR --out DIR --checkpoint DIR

--feed/--messages take a path (parquet unless --format) or a catalog table name.
Dates are explicit: the scheduler passes the run date or the run time. ``user-counts`` and
``experiment`` keep tables whose names begin with --table.
"""

from __future__ import annotations

import argparse
import sys

from feedlens.plans import jobs
from feedlens.session import build_session
from feedlens.sources.schema import FEED_SCHEMA, MESSAGE_SCHEMA
from feedlens.sources.tables import TableRef, read_feed, read_messages


def _ref(value: str, fmt: str) -> TableRef:
    return TableRef(path=value, format=fmt) if "/" in value else TableRef(name=value)


def main(argv=None) -> int:
    """Parse the arguments and run one job; returns the exit code."""
    p = argparse.ArgumentParser(prog="feedlens")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="cmd", required=True)
    for name in ("cube", "feed-report", "app-report", "alerts", "user-counts", "experiment"):
        s = sub.add_parser(name)
        s.add_argument("--feed", required=True)
        if name not in ("feed-report", "experiment"):
            s.add_argument("--messages", required=True)
        if name == "alerts":
            s.add_argument("--as-of", required=True)
        else:
            s.add_argument("--run-date", required=True)
        s.add_argument("--table", required=True)
        s.add_argument("--location", default=None)
        s.add_argument("--format", default="parquet")
        if name == "app-report":
            s.add_argument("--first-seen", default=None, help="prefix of the maintained first-seen tables")
            s.add_argument("--first-seen-location", default=None)
            s.add_argument("--since", default=None, help="first week of the audience chart")
            s.add_argument("--audience", default=None, help="name of the maintained table of week bits")
            s.add_argument("--audience-location", default=None)
        if name == "experiment":
            s.add_argument("--start", required=True, help="first day of the experiment")
            s.add_argument("--groups", type=int, nargs=2, required=True, help="control and test group")
        if name == "cube":
            s.add_argument("--age-bins", default="fixed", choices=["fixed", "reference"])
    for name in ("ingest", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--feed-dir", required=True)
        s.add_argument("--messages-dir", required=True)
        s.add_argument("--out", required=True)
        s.add_argument("--checkpoint", required=True, help="the stream's progress: the same shared folder at every start")
        if name == "ingest":
            s.add_argument("--table", required=True, help="cube table")
            s.add_argument("--location", default=None)
            s.add_argument("--age-bins", default="fixed", choices=["fixed", "reference"])
    s.add_argument("--delay", default="15 minutes")
    s.add_argument("--once", action="store_true", help="process what is there and stop")
    s.add_argument("--approx", action="store_true", help="HyperLogLog distinct users (small state)")
    a = p.parse_args(argv)

    spark = build_session(a.master)
    if a.cmd in ("ingest", "stream"):
        from feedlens.streaming import start_ingest_job, start_slot_job
        feed = spark.readStream.schema(FEED_SCHEMA).parquet(a.feed_dir)
        msgs = spark.readStream.schema(MESSAGE_SCHEMA).parquet(a.messages_dir)
        if a.cmd == "ingest":
            start_ingest_job(spark, feed, msgs, a.out, a.table, a.checkpoint, a.location, a.age_bins).awaitTermination()
            return 0
        q = start_slot_job(spark, feed, msgs, a.out, a.checkpoint, delay=a.delay, approx=a.approx,
                           trigger={"availableNow": True} if a.once else {"processingTime": "1 minute"})
        q.awaitTermination()
        return 0
    feed = read_feed(spark, _ref(a.feed, a.format))
    if a.cmd == "feed-report":
        rep = jobs.feed_report_job(spark, feed, a.run_date, a.table, a.location)
        print(rep.summary.first().text)
        return 0
    if a.cmd == "experiment":
        rows = jobs.experiment_job(spark, feed, a.run_date, a.start, *a.groups, a.table, a.location)
        for r in rows.orderBy("Date", "metric").collect():     # two rows a day of the experiment
            print(r.Date, r.metric, r.n_a, r.n_b, r.t, r.df)
        return 0
    msgs = read_messages(spark, _ref(a.messages, a.format))
    if a.cmd == "user-counts":
        for r in jobs.user_counts_job(spark, feed, msgs, a.run_date, a.table, a.location).orderBy("days").collect():    # a row a window
            print(r.Date, r.days, r.users)
    elif a.cmd == "cube":
        n = jobs.daily_cube_job(spark, feed, msgs, a.run_date, a.table, a.location, a.age_bins).count()
        print(f"wrote {n} cube rows")
    elif a.cmd == "app-report":
        rep = jobs.app_report_job(spark, feed, msgs, a.run_date, a.table, a.location, a.first_seen, a.first_seen_location, a.since,
                                  a.audience, a.audience_location)
        print(rep.summary.first().text)
    else:
        run = jobs.anomaly_alert_job(spark, feed, msgs, a.as_of, a.table, a.location)
        for r in run.alerts.filter("text IS NOT NULL").collect():  # at most one row per metric
            print(r.text)
    return 0


if __name__ == "__main__":
    sys.exit(main())
