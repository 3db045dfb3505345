"""Command line: the scheduled jobs and the stream, over real lake tables.

    python -m stratus ingest    --source DIR --sink DIR --checkpoint DIR [--format parquet|json|kafka]
                                [--kafka-servers HOST:PORT] [--available-now | --trigger-seconds 30]
                                [--mode raw|dedup|enrich] [--sink-format parquet] [--max-files N]
                                [--starting earliest|latest] [--tolerate-loss]
    python -m stratus analytics --table DIR --out DIR
    python -m stratus models    --table DIR --mart DIR
    python -m stratus quality   --table DIR
    python -m stratus maintain  --table DIR [--run-id ID | --compacted DIR] [--retention-hours 168]
    python -m stratus route     --raw DIR --out DIR

Each command prints one JSON line describing what it did; ``quality`` exits with 1 if a rule failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from stratus.session import build_session, configure


def _session(args):
    from pyspark.sql import SparkSession

    active = SparkSession.getActiveSession()
    return configure(active) if active is not None else build_session(master=args.master)


def cmd_ingest(spark, a) -> dict:
    from stratus.streaming import ingest as ST

    opts = {"kafka.bootstrap.servers": a.kafka_servers} if a.format == "kafka" and a.kafka_servers else {}
    if a.format == "kafka" and a.starting:
        opts["startingOffsets"] = a.starting
    parsed = ST.parse_stream(ST.read_messages(spark, a.source, fmt=a.format, options=opts,
                                                max_files_per_trigger=a.max_files, starting=a.starting or ST.EARLIEST,
                                                checkpoint=a.checkpoint, tolerate_loss=a.tolerate_loss))
    trigger = {"availableNow": True} if a.available_now else {"processingTime": f"{a.trigger_seconds} seconds"}
    if a.mode == "enrich":
        q = ST.start_enrich(parsed, a.sink, a.checkpoint, a.sink_format, trigger=trigger)
    else:
        if a.mode == "dedup":
            parsed = ST.dedup_stream(parsed)
        q = ST.start_ingest(parsed, a.sink, a.checkpoint, a.sink_format, trigger=trigger)
    q.awaitTermination()
    return {"command": "ingest", "sink": a.sink, "batches": len(q.recentProgress)}


def cmd_analytics(spark, a) -> dict:
    from stratus.plans.jobs import batch_analysis
    from stratus.sources.lake import read_table

    paths, run = batch_analysis(read_table(spark, a.table, a.table_format), a.out, a.out_format)
    rec = run.first().asDict()
    return {"command": "analytics", "tables": paths, "records_processed": rec["records_processed"],
            "jobs_run": rec["jobs_run"]}


def cmd_models(spark, a) -> dict:
    from stratus.plans import models as M
    from stratus.sources.lake import read_table

    mart = M.materialize_mart(spark, read_table(spark, a.table, a.table_format), a.mart, a.out_format)
    return {"command": "models", "mart": a.mart, "rows": mart.count()}


def cmd_quality(spark, a) -> dict:
    from stratus.operators import quality as Q
    from stratus.plans import models as M
    from stratus.sources.lake import read_table

    table = read_table(spark, a.table, a.table_format)
    stg = M.staging(table)
    mart = M.mart(stg)
    checks = (Q.constraints(table)
              .unionByName(Q.not_null(stg, Q.STAGING_NOT_NULL, "stg_weather_events"))
              .unionByName(Q.accepted_values(stg, Q.ACCEPTED_VALUES, "stg_weather_events"))
              .unionByName(Q.not_null(mart, Q.MART_NOT_NULL, "mart_city_weather_summary")))
    rows = [r.asDict() for r in checks.collect()]  # one row per rule: bounded
    return {"command": "quality", "failed": [r for r in rows if r["violations"] > 0], "rules": len(rows)}


def cmd_maintain(spark, a) -> dict:
    from stratus.operators import upkeep as U

    if a.compacted:
        rep = U.maintenance_report(spark, a.table, a.compacted, a.table_format, a.retention_hours).first()
    else:
        run_id = a.run_id or f"upkeep__{dt.datetime.now(dt.timezone.utc).isoformat()}"
        rep = U.upkeep(spark, a.table, run_id, a.table_format, retention_hours=a.retention_hours).first()
    return {"command": "maintain", "report": rep.asDict(recursive=True)}


def cmd_route(spark, a) -> dict:
    from pyspark.sql import functions as F

    from stratus.operators import validate as V

    raw = spark.read.text(a.raw).select(F.monotonically_increasing_id().alias("message_id"),
                                        F.col("value"))
    V.write_routed(V.route(V.check(raw)), a.out)
    return {"command": "route", "out": a.out}


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="stratus")
    p.add_argument("--master", help="only to override the master of spark-submit or of the configuration")
    sub = p.add_subparsers(dest="command", required=True)
    i = sub.add_parser("ingest")
    i.add_argument("--source")
    i.add_argument("--sink", required=True)
    i.add_argument("--checkpoint", required=True)
    i.add_argument("--format", default="parquet")
    i.add_argument("--kafka-servers")
    i.add_argument("--sink-format", default="parquet")
    i.add_argument("--max-files", type=int, help="files per micro-batch of a file source")
    i.add_argument("--starting", choices=["earliest", "latest"], help="where a query without a checkpoint begins "
                   "(Kafka: latest, files: earliest)")
    i.add_argument("--tolerate-loss", action="store_true", help="files that vanish before they are read are passed over")
    i.add_argument("--available-now", action="store_true")
    i.add_argument("--trigger-seconds", type=int, default=30)
    i.add_argument("--mode", choices=["raw", "dedup", "enrich"], default="raw")
    for name in ("analytics", "models", "quality", "maintain"):
        s = sub.add_parser(name)
        s.add_argument("--table", required=True)
        s.add_argument("--table-format", default="parquet")
        s.add_argument("--out-format", default="parquet")
        if name == "analytics":
            s.add_argument("--out", required=True)
        if name == "models":
            s.add_argument("--mart", required=True)
        if name == "maintain":
            s.add_argument("--compacted", help="rewrite the whole table to this folder instead of packing small files in place")
            s.add_argument("--run-id", help="id of the run in the table's log; a run that is there already is not repeated")
            s.add_argument("--retention-hours", type=int, default=168)
    r = sub.add_parser("route")
    r.add_argument("--raw", required=True)
    r.add_argument("--out", required=True)
    args = p.parse_args(argv)
    spark = _session(args)
    handlers = {"ingest": cmd_ingest, "analytics": cmd_analytics, "models": cmd_models,
                "quality": cmd_quality, "maintain": cmd_maintain, "route": cmd_route}
    result = handlers[args.command](spark, args)
    print(json.dumps(result, default=str))
    if args.command == "quality" and result["failed"]:
        raise SystemExit(1)


if __name__ == "__main__":
    main()
