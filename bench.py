"""Bench: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Protocol (the reference's measuring method): per query one warm-up run, then
the mean of 5 timed runs. Each run builds the plan, runs what a query writes on
the way (staged tables, merged changes) and writes every result row to the `noop`
sink, so the whole work is timed without collecting rows to the driver. What the
warm-up leaves for later runs: the file listing of the source tables and, for
`bucketed_last_quote`, the bucketed table, which each run only checks for new rows.

The reference's own workload is timed too: ticks are generated once at
scale = sf (untimed, like its generator step), then `load_ticks` (drop,
stage, create day-partitioned tables, append; column and row layouts) and
its three tick queries on the loaded tables, each 1 warm-up + mean of 5. The change-log stream is timed
as well (`stream_cdc_sync`: availableNow over the sf change log in 4 files,
2 per trigger, fresh copy each run).

Prints one JSON line: {"metric", "value" (sum of per-query means, sec),
"unit", "queries": {name: sec}, "sf"}.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import tempfile  # noqa: E402

from livetables.plans.catalog import EVENT_CELLS, QUERIES, events_change_log, table  # noqa: E402
from livetables.plans.loads import load_ticks, tick_query  # noqa: E402
from livetables.session import local_session, scratch_path  # noqa: E402
from livetables.sources.changelog import change_log_schema  # noqa: E402
from livetables.sources.generators import generate_to  # noqa: E402
from livetables.streaming.cdc_sync import cdc_sync  # noqa: E402

HEADLINE = [
    "last_quote_by_symbol",
    "last_price_by_symbol_exchange",
    "hourly_avg_size",
    "max_bid_by_symbol",
    "delay_by_carrier",
    "top_delays",
    "varchar_violations",
    "json_ingest",
    "cdc_sync",
    "cdc_compact",
    "cdc_compact_cells",
    "gen_quotes",
    "bucketed_last_quote",
    "hour_of_text_time",
    "cdc_flatten",
    "cdc_positions",
    "cdc_unknown_tables",
    "gen_trades",
]
RUNS = 5


def run_once(spark, name: str, sf_dir: str) -> None:
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()


def timed(fn) -> float:
    fn()                                                    # warm-up
    total = 0.0
    for _ in range(RUNS):
        t0 = time.perf_counter()
        fn()
        total += time.perf_counter() - t0
    return round(total / RUNS, 4)


def reference_workload(spark, scale: float) -> dict[str, float]:
    path = scratch_path(spark, "bench_ticks")
    generate_to(spark, path, scale=scale, partitions=max(8, spark.sparkContext.defaultParallelism))
    out = {"load_ticks": timed(lambda: load_ticks(spark, path, prefix="bench_")),
           # the row layout: VARCHAR lengths checked by Spark, NOT NULL by a guard in the write
           "load_ticks_row": timed(lambda: load_ticks(spark, path, provider="row", prefix="bench_row_"))}
    for key, name in (("ticks_q1_last_bid", "last_quote_by_symbol"),
                      ("ticks_q2_last_price", "last_price_by_symbol_exchange"),
                      ("ticks_q3_avg_size", "hourly_avg_size")):
        out[key] = timed(lambda name=name: tick_query(spark, name, prefix="bench_")
                         .write.format("noop").mode("overwrite").save())
    return out


def stream_workload(spark, sf_dir: str) -> dict[str, float]:
    """The change-log stream: the sf change log as 4 files, 2 per trigger, into
    a fresh copy and checkpoint each run (so every run does the same work)."""
    log_dir = scratch_path(spark, "bench_log")
    events_change_log(table(spark, sf_dir, "events")).repartition(4).write.parquet(log_dir)
    ddl = change_log_schema("user_id bigint", "event_id bigint")

    def once() -> None:
        run = scratch_path(spark, "bench_sync")
        q = cdc_sync(spark, log_dir, f"{run}/copy", f"{run}/ckpt", log_schema=ddl,
                     cells_schema=EVENT_CELLS, keyspace="shop", table="click", reject_path=f"{run}/rejects",
                     available_now=True, max_files_per_trigger=2)
        q.awaitTermination()
    return {"stream_cdc_sync": timed(once)}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, 2 * int(cpus) if cpus.isdigit() else 16),
                          extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lt-bench-")})
    results = {name: timed(lambda name=name: run_once(spark, name, sf_dir)) for name in names}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    if not sys.argv[1:]:
        results.update(reference_workload(spark, sf or 0.1))
        results.update(stream_workload(spark, sf_dir))
    print(json.dumps({
        "metric": "sum of mean query time (1 warm-up + mean of 5, noop sink)",
        "value": round(sum(results.values()), 4),
        "unit": "sec",
        "queries": results,
        "sf": sf if sf is not None else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
