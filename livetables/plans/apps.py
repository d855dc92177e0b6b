"""Command-line programs: the same jobs as the reference's applications.

    python -m livetables.plans.apps generate SCALE PATH [--format parquet]
    python -m livetables.plans.apps load-ticks {row,column} PATH
    python -m livetables.plans.apps query-ticks [--runs 5]
    python -m livetables.plans.apps flights AIRLINE_PATH AIRLINEREF_PATH
    python -m livetables.plans.apps bulk-copy FORMAT TABLE PARTITION_COL [--option k=v ...]
    python -m livetables.plans.apps cdc-sync LOG_DIR TARGET CHECKPOINT KEYSPACE TABLE
            --log-schema DDL --cells-schema DDL --rejects DIR [--format parquet] [--available-now]
            [--report DIR --known-table KEYSPACE.TABLE ...] [--max-files N]
            [--clean-source archive|delete] [--archive-dir DIR]
    python -m livetables.plans.apps json-feed SOURCE_DIR GOOD REJECTS CHECKPOINT --schema DDL
            [--source-format text] [--option k=v ...] [--timeout 50000] [--max-batches N]

Run them with spark-submit on a cluster (the session comes from the
environment) or locally (`--local N` builds a local session).
"""

from __future__ import annotations

import argparse
import time

from pyspark.sql import SparkSession

from livetables.plans.loads import load_flights, load_ticks, tick_query
from livetables.sinks.tables import bulk_copy
from livetables.sources.generators import generate_to
from livetables.sources.tables import read_format
from livetables.streaming.cdc_sync import cdc_sync
from livetables.streaming.json_feed import MessageCap, json_feed, message_stream, run_for

TICK_QUERIES = ("last_quote_by_symbol", "last_price_by_symbol_exchange", "hourly_avg_size")


def _session(args: argparse.Namespace) -> SparkSession:
    if args.local:
        from livetables.session import local_session
        return local_session(args.local, 2 * int(args.local) if str(args.local).isdigit() else 16)
    return SparkSession.builder.appName("livetables").getOrCreate()


def query_ticks(spark: SparkSession, runs: int = 5, prefix: str = "") -> dict[str, float]:
    """The reference's protocol: one warm-up, then the mean of `runs` runs (ms)."""
    out = {}
    for name in TICK_QUERIES:
        tick_query(spark, name, prefix).write.format("noop").mode("overwrite").save()
        t0 = time.perf_counter()
        for _ in range(runs):
            tick_query(spark, name, prefix).write.format("noop").mode("overwrite").save()
        out[name] = (time.perf_counter() - t0) * 1000.0 / runs
    return out


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(prog="livetables")
    p.add_argument("--local", help="run on local[N] instead of the submitted cluster")
    sub = p.add_subparsers(dest="cmd", required=True)

    g = sub.add_parser("generate", help="write quotes/, trades/, symbols/ under PATH")
    g.add_argument("scale", type=float)
    g.add_argument("path")
    g.add_argument("--format", default="parquet")

    lt = sub.add_parser("load-ticks", help="stage and load generated ticks")
    lt.add_argument("provider", choices=["row", "column"])
    lt.add_argument("path")
    lt.add_argument("--bucket-by-symbol", action="store_true")

    qt = sub.add_parser("query-ticks", help="time the three tick rollups")
    qt.add_argument("--runs", type=int, default=5)

    fl = sub.add_parser("flights", help="load flights and carriers, run the delay query")
    fl.add_argument("airline_path")
    fl.add_argument("airlineref_path")

    bc = sub.add_parser("bulk-copy", help="copy a table of any source into an analytic table")
    bc.add_argument("format")
    bc.add_argument("table")
    bc.add_argument("partition_col")
    bc.add_argument("--option", action="append", default=[], help="source option k=v")

    cs = sub.add_parser("cdc-sync", help="keep a copy current from change files")
    for a in ("log_dir", "target", "checkpoint", "keyspace", "table"):
        cs.add_argument(a)
    cs.add_argument("--log-schema", required=True)
    cs.add_argument("--cells-schema", required=True)
    cs.add_argument("--format", default="parquet")
    cs.add_argument("--available-now", action="store_true")
    cs.add_argument("--rejects", required=True, help="folder for records that don't fit the table")
    cs.add_argument("--report", help="folder for records of unknown tables")
    cs.add_argument("--known-table", action="append", default=[], help="keyspace.table that is known")
    cs.add_argument("--max-files", type=int, help="change files per batch")
    cs.add_argument("--clean-source", choices=["archive", "delete"])
    cs.add_argument("--archive-dir")

    jf = sub.add_parser("json-feed", help="take JSON messages from a folder into a table")
    for a in ("source_dir", "good", "rejects", "checkpoint"):
        jf.add_argument(a)
    jf.add_argument("--schema", required=True)
    jf.add_argument("--source-format", default="text", help="any streaming source; SOURCE_DIR '-' for none")
    jf.add_argument("--option", action="append", default=[], help="source option k=v")
    jf.add_argument("--timeout", type=float, default=50_000.0)
    jf.add_argument("--max-batches", type=int, default=None)
    jf.add_argument("--max-messages", type=int, default=None)

    args = p.parse_args(argv)
    spark = _session(args)
    if args.cmd == "generate":
        print(generate_to(spark, args.path, args.scale, fmt=args.format))
    elif args.cmd == "load-ticks":
        times = load_ticks(spark, args.path, provider=args.provider,
                           bucket_by_symbol=args.bucket_by_symbol)
        print("loaded " + ", ".join(f"{k} in {times[k]:.0f} ms" for k in ("trades", "quotes")))
    elif args.cmd == "query-ticks":
        for i, (name, ms) in enumerate(query_ticks(spark, args.runs).items()):
            print(f"{i} {name}: mean {ms:.0f} ms")
    elif args.cmd == "flights":
        load_flights(spark, args.airline_path, args.airlineref_path).show(20, truncate=False)
    elif args.cmd == "bulk-copy":
        opts = {"table": args.table, **dict(o.split("=", 1) for o in args.option)}
        source = read_format(spark, args.format, **opts)
        source.show()                 # rows and schema of the source, then the copy
        source.printSchema()
        copy = bulk_copy(spark, source, f"copy_{args.table}", partition_by=args.partition_col)
        copy.show()
    elif args.cmd == "cdc-sync":
        q = cdc_sync(spark, args.log_dir, args.target, args.checkpoint, log_schema=args.log_schema,
                     cells_schema=args.cells_schema, keyspace=args.keyspace, table=args.table,
                     fmt=args.format, available_now=args.available_now, reject_path=args.rejects,
                     report_path=args.report, known_tables=[tuple(t.split(".", 1)) for t in args.known_table] or None,
                     max_files_per_trigger=args.max_files, clean_source=args.clean_source,
                     source_archive_dir=args.archive_dir)
        q.awaitTermination()
    elif args.cmd == "json-feed":
        source = message_stream(spark, args.source_format, None if args.source_dir == "-" else args.source_dir,
                                **dict(o.split("=", 1) for o in args.option))
        cap = MessageCap(args.max_messages) if args.max_messages else None
        q = json_feed(spark, source, args.schema, args.good, args.rejects, args.checkpoint, cap=cap)
        run_for(q, args.timeout, args.max_batches, cap=cap)


if __name__ == "__main__":
    main()
