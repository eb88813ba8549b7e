"""Command line: ``python -m vigil <command> ...`` (or via ``spark-submit``).

  ingest   CSV logs -> date-partitioned Parquet (+ quarantine of bad rows)
  batch    the history jobs over the log table (+ ``--serving`` tables)
  stream   live detectors over Kafka or a folder of JSON messages
  publish  log table -> keyed JSON messages (Kafka or text files)
  profile  one IP's threat profile from the served tables, as JSON
  alerts   active alerts; stats: global statistics; timeline: hourly counts

The session comes from ``SparkSession.builder.getOrCreate()``, so cluster
settings are whatever ``spark-submit`` / ``spark-defaults.conf`` provide.
"""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="vigil")
    sub = p.add_subparsers(dest="cmd", required=True)

    i = sub.add_parser("ingest", help="CSV -> partitioned Parquet")
    i.add_argument("--csv", required=True)
    i.add_argument("--out", required=True)
    i.add_argument("--quarantine")
    i.add_argument("--files-per-day", type=int, default=0)
    i.add_argument("--replace", choices=["all", "days"], default="all")

    b = sub.add_parser("batch", help="history jobs")
    b.add_argument("--logs", required=True, help="partitioned log table")
    b.add_argument("--out", required=True)
    b.add_argument("--from", dest="date_from")
    b.add_argument("--to", dest="date_to")
    b.add_argument("--serving", action="store_true", help="also alerts and served profiles")
    b.add_argument("--atomic", action="store_true", help="write a run folder and publish it when all jobs succeed")

    s = sub.add_parser("stream", help="live detectors")
    src = s.add_mutually_exclusive_group(required=True)
    src.add_argument("--kafka", help="bootstrap servers")
    src.add_argument("--json-dir")
    s.add_argument("--topic", default="cybersecurity-logs")
    s.add_argument("--sink", required=True)
    s.add_argument("--checkpoint", required=True)
    s.add_argument("--watermark", default="none", help="e.g. '10 minutes'; 'none' keeps windows open")
    s.add_argument("--starting-offsets", default="latest")
    s.add_argument("--max-offsets", type=int, default=10000, help="per trigger; 0 reads all")
    s.add_argument("--allow-data-loss", action="store_true", help="go on where retention deleted unread offsets")
    s.add_argument("--available-now", action="store_true", help="drain available input, then stop")

    pub = sub.add_parser("publish", help="log table -> messages")
    pub.add_argument("--logs", required=True)
    tgt = pub.add_mutually_exclusive_group(required=True)
    tgt.add_argument("--kafka")
    tgt.add_argument("--out")

    pr = sub.add_parser("profile", help="threat profile of one IP")
    pr.add_argument("--tables", required=True, help="output folder of 'batch --serving'")
    pr.add_argument("--ip", required=True)

    al = sub.add_parser("alerts", help="active alerts (TTL, top by score)")
    al.add_argument("--tables", required=True)
    al.add_argument("--limit", type=int, default=200)

    st = sub.add_parser("stats", help="global batch statistics")
    st.add_argument("--tables", required=True)

    tl = sub.add_parser("timeline", help="hourly threat counts of whole days")
    tl.add_argument("--tables", required=True)
    tl.add_argument("--from", dest="date_from", help="first day (yyyyMMdd); open when absent")
    tl.add_argument("--to", dest="date_to", help="last day; open when absent")
    return p


def run(argv: list[str], spark: SparkSession | None = None) -> dict | list:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"vigil-{args.cmd}").getOrCreate()

    if args.cmd == "ingest":
        from vigil.sources.logs import ingest_csv

        return ingest_csv(spark, args.csv, args.out, args.quarantine, args.replace, args.files_per_day)

    if args.cmd == "batch":
        from vigil.plans.jobs import run_all
        from vigil.plans.publish import publish_all
        from vigil.sources.logs import read_logs

        logs = read_logs(spark, args.logs, args.date_from, args.date_to)
        return (publish_all if args.atomic else run_all)(spark, logs, args.out, serving=args.serving)

    if args.cmd == "stream":
        from vigil.streaming import detectors as D

        stream = (D.kafka_source(spark, args.kafka, args.topic, args.starting_offsets, args.max_offsets or None,
                                 not args.allow_data_loss) if args.kafka
                  else D.json_file_source(spark, args.json_dir))
        wm = None if args.watermark.lower() == "none" else args.watermark
        trigger = {"availableNow": True} if args.available_now else None
        queries = D.start_all(stream, args.sink, args.checkpoint, trigger, wm)
        if args.available_now:
            for q in queries.values():
                q.awaitTermination()
        else:
            D.await_any(spark, queries)
        return {name: f"{args.sink}/{name}" for name in queries}

    if args.cmd == "publish":
        from vigil.sources.logs import read_logs
        from vigil.sources.messages import encode_messages, write_messages

        write_messages(encode_messages(read_logs(spark, args.logs)), path=args.out, bootstrap=args.kafka)
        return {"published": args.kafka or args.out}

    if args.cmd == "profile":
        from vigil.plans.serve import profile_document, service_response

        return service_response(profile_document(spark, args.tables, args.ip))

    if args.cmd in ("alerts", "stats", "timeline"):
        from vigil.plans import serve

        if args.cmd == "alerts":
            rows = serve.active_alerts_of(spark, args.tables, args.limit).collect()  # at most --limit rows
            return [serve.alert_response(r.asDict()) for r in rows]
        if args.cmd == "stats":
            return serve.stats_response(serve.global_stats_of(spark, args.tables).first().asDict())
        rows = serve.timeline_of(spark, args.tables, args.date_from, args.date_to).collect()  # hours of the range
        return [serve.timeline_response(r.asDict()) for r in rows]

    raise AssertionError(args.cmd)


def main() -> None:
    print(json.dumps(run(sys.argv[1:]), default=str))


if __name__ == "__main__":
    main()
