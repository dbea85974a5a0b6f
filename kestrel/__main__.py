"""Command-line entry: ``python -m kestrel <command>``.

  refresh  --store DIR --repos DIR --stories DIR --tracked FILE [--as-of ISO] [--baseline-days 7]
           landed repo responses (JSON lines {org, payload}), story responses ({company, payload, seq}),
           tracked companies (one per line) -> upsert, bronze, data quality, gold
  stream   --root DIR --source-format kafka|parquet [--source-path DIR] [--sink-format delta|parquet]
           [--available-now] [--option k=v ...]   one ingest query per stream spec
  alerts   --store DIR [--limit 20]              newest failing checks as JSON lines
"""

from __future__ import annotations

import argparse
import datetime as dt
import json
import sys

from pyspark.sql import types as T

from kestrel.session import build_session


def _refresh(args) -> None:
    from kestrel.plans import refresh
    from kestrel.sources import landing

    spark = build_session("kestrel-refresh")
    repos = landing.read_payloads(spark, args.repos, T.StructType([T.StructField("org", T.StringType())]))
    stories = landing.read_payloads(spark, args.stories, T.StructType([
        T.StructField("company", T.StringType()), T.StructField("seq", T.LongType())]))
    tracked = spark.read.text(args.tracked).selectExpr("trim(value) AS org").where("org <> ''")
    as_of = dt.datetime.fromisoformat(args.as_of) if args.as_of else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    res = refresh.refresh(spark, refresh.Store(args.store, args.format), tracked, repos,
                          stories.select("company", "payload", "seq"), as_of,
                          warehouse_project=args.warehouse_project, warehouse_dataset=args.warehouse_dataset,
                          baseline_days=args.baseline_days)
    print(json.dumps(res.__dict__, default=str))


def _stream(args) -> None:
    from kestrel.streaming import ingest

    spark = build_session("kestrel-stream")
    options = dict(o.split("=", 1) for o in args.option)
    ingest.run(spark, args.root, available_now=args.available_now, source_format=args.source_format,
               source_path=args.source_path, sink_format=args.sink_format, source_options=options)


def _alerts(args) -> None:
    from kestrel.plans import refresh

    spark = build_session("kestrel-alerts")
    for row in refresh.recent_alerts(spark, refresh.Store(args.store, args.format), args.limit).toJSON().collect():
        print(row)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="kestrel")
    sub = p.add_subparsers(dest="cmd", required=True)
    r = sub.add_parser("refresh")
    r.add_argument("--store", required=True)
    r.add_argument("--repos", required=True)
    r.add_argument("--stories", required=True)
    r.add_argument("--tracked", required=True)
    r.add_argument("--as-of")
    r.add_argument("--format", default="parquet")
    r.add_argument("--warehouse-project")
    r.add_argument("--warehouse-dataset")
    r.add_argument("--baseline-days", type=int, default=None)
    r.set_defaults(fn=_refresh)
    s = sub.add_parser("stream")
    s.add_argument("--root", required=True)
    s.add_argument("--source-format", default="kafka")
    s.add_argument("--source-path")
    s.add_argument("--sink-format", default="delta")
    s.add_argument("--available-now", action="store_true")
    s.add_argument("--option", action="append", default=[])
    s.set_defaults(fn=_stream)
    a = sub.add_parser("alerts")
    a.add_argument("--store", required=True)
    a.add_argument("--limit", type=int, default=20)
    a.add_argument("--format", default="parquet")
    a.set_defaults(fn=_alerts)
    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main(sys.argv[1:])
