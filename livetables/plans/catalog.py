"""Named queries over the driver's test tables (their SQL oracles: `oracles.py`).

Each query takes (spark, sf_dir) and returns a DataFrame computed by the
library's operators from the whole tables. How the test tables stand in for
the reference's data:

* ticks:   sym = events.user_id, ex = event_type, bid/price/size = value,
           order = event_id, day = date of ts; the symbol dimension S holds
           every fourth user (the reference lists 100 of 400 symbols).
* flights: airline = lineitem (carrier = l_partkey, origin = l_returnflag,
           weather delay = l_tax); carrier table = part (code = p_partkey,
           description = p_name).
* changes: a change log written from events (segment = user_id % 4,
           position = event_id, table = event_type).
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livetables.operators import changes, compact_files, contracts, feeds, flights, ticks
from livetables.plans.loads import TICK_COMPRESSION, TICK_TABLES, enforce_not_null, load_ticks, tick_query
from livetables.session import scratch_path, session_key, unique_name
from livetables.sinks import generations
from livetables.sinks import tables as sinks
from livetables.sources import changelog, generators
from livetables.sources import tables as sources
from livetables.streaming import handover
from livetables.streaming.cdc_sync import cdc_sync, fold, read_copy, unknown_tables_report
from livetables.streaming.json_feed import json_feed, message_stream
from livetables.streaming.live_rollups import Greatest, Last, Total, live_rollup, read_rollup

TICK_DAY = "2024-01-02"
# Days that generated ticks are spread over (10,000 ids a day), and the second of them.
TICK_DAYS = 4
TICK_ID_STEP = 7
SECOND_TICK_DAY = "2016-06-07"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A source table, registered once per session as a temporary view.

    Like the reference's staging tables: the folder is listed and its footers
    read once; later queries reuse the resolved relation.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    view = "lt_src_" + hashlib.md5(path.encode()).hexdigest()[:12]
    key = (session_key(spark), view)
    if key not in _REGISTERED or not spark.catalog.tableExists(view):
        spark.read.parquet(path).createOrReplaceTempView(view)
        _REGISTERED.add(key)
    return spark.table(view)


_REGISTERED: set = set()
_BUCKETED: dict = {}


def symbol_dimension(events: DataFrame) -> DataFrame:
    """The listed symbols: every fourth user, one row each, column `value`."""
    return (events.where(F.col("user_id") % 4 == 0)
            .select(F.col("user_id").alias("value")).distinct())


def _tick_args(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, dict]:
    symbols = symbol_dimension(table(spark, sf_dir, "events"))
    return symbols, dict(sym="user_id", order="event_id", symbol_key="value", day_col="ts", day=TICK_DAY)


# ---------------------------------------------------------------------------
# Ticks
# ---------------------------------------------------------------------------

def q_last_quote_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols, args = _tick_args(spark, sf_dir)
    return ticks.last_quote_by_symbol(table(spark, sf_dir, "events"), symbols, bid="value",
                                      out_value="last_bid", **args)


def q_last_price_by_symbol_exchange(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols, args = _tick_args(spark, sf_dir)
    return ticks.last_price_by_symbol_exchange(table(spark, sf_dir, "events"), symbols,
                                               ex="event_type", price="value", **args)


def q_hourly_avg_size(spark: SparkSession, sf_dir: str) -> DataFrame:
    symbols, args = _tick_args(spark, sf_dir)
    args.pop("order")
    return ticks.hourly_avg_size(table(spark, sf_dir, "events"), symbols, time_col="ts",
                                 size="value", exact_scale=2, **args)


def q_hour_of_text_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    text = e.select(F.date_format("ts", "HH:mm:ss.SSS").alias("time"))
    return (text.groupBy(ticks.hour_of(text, "time").alias("hr"))
            .agg(F.count(F.lit(1)).alias("n")))


def q_max_bid_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    trades = e.where(F.col("event_type") == "click")
    quotes = e.where(F.col("event_type") == "view")
    return ticks.max_bid_by_symbol(trades, quotes, trade_sym="user_id", quote_sym="user_id",
                                   bid="value")


# ---------------------------------------------------------------------------
# Flights
# ---------------------------------------------------------------------------

_FLIGHT_ARGS = dict(carrier="l_partkey", origin="l_returnflag", origin_pattern="%A%",
                    delay="l_tax", code="p_partkey", description="p_name", sum_scale=2)


def q_delay_by_carrier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights.delay_by_carrier(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), **_FLIGHT_ARGS)


def q_top_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights.top_delays(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"),
                              k=20, **_FLIGHT_ARGS)


def q_delay_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """LIMIT 20 without an order: which groups come is not fixed, so the answer is how many did."""
    some = flights.delay_by_carrier(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part"), limit=20, **_FLIGHT_ARGS)
    return some.agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# Tables and contracts
# ---------------------------------------------------------------------------

def _path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def q_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.external_table(spark, unique_name("lt_staging_nation"), _path(sf_dir, "nation"))


def q_external_table_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events written as one folder per event_type, registered in both ways; each supplies half of the rows."""
    path = scratch_path(spark, "events_by_type")
    e = table(spark, sf_dir, "events")
    e.hint("rebalance", "event_type").write.partitionBy("event_type").parquet(path)
    first = sources.external_table(spark, unique_name("lt_staging_parts"), path)
    second = sources.sql_external_table(spark, unique_name("lt_sql_parts"), "parquet", path=path)
    even = F.col("event_id") % 2 == 0
    return first.where(even).unionByName(second.where(~even)).select(*e.columns)


def q_varchar_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer in a row-layout table: text columns as VARCHAR(n) NOT NULL, the limits enforced by the write."""
    c = table(spark, sf_dir, "customer")
    name = unique_name("lt_row_customer")
    sinks.create_table(spark, name, contracts.as_varchar(c.schema))
    sinks.append(enforce_not_null(c, list(contracts.varchar_limits(c.schema))), name)
    return _handed_over(spark, name)


def q_allow_existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creating a table that is there: allowed with the flag, and its rows stay."""
    n = table(spark, sf_dir, "nation")
    name = unique_name("lt_nation")
    sinks.create_table(spark, name, n.schema)
    sinks.append(n, name)
    sinks.create_table(spark, name, n.schema, if_not_exists=True)
    return _handed_over(spark, name)


def q_rename_reserved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.rename_reserved(table(spark, sf_dir, "nation"), reserved=("n_nationkey",))


def q_varchar_violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contracts.varchar_violations(table(spark, sf_dir, "customer"),
                                        {"c_name": 17, "c_mktsegment": 30})


def _split_events(e: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two disjoint parts of events that together are the whole table."""
    is_click = F.coalesce(F.col("event_type") == "click", F.lit(False))
    return e.where(is_click), e.where(~is_click)


def _handed_over(spark: SparkSession, name: str) -> DataFrame:
    """The rows of a table made for a query, after dropping what the last call of the query left.

    The result reads the table lazily, so it can only be dropped by a later call.
    """
    label = re.sub(r"_[0-9a-f]{10}$", "", name)
    key = (session_key(spark), label)
    if key in _LEFT:
        sinks.drop_table(spark, _LEFT[key])
    _LEFT[key] = name
    return spark.table(name)


_LEFT: dict = {}


def q_ctas(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging, name = unique_name("lt_staging_events"), unique_name("lt_ctas_events")
    sources.external_table(spark, staging, _path(sf_dir, "events"))
    sinks.ctas(spark, name, f"SELECT * FROM {staging}")
    sinks.drop_table(spark, staging)          # unmanaged: the files stay
    return _handed_over(spark, name)


def q_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    name = unique_name("lt_append_events")
    sinks.create_table(spark, name, e.schema)
    first, rest = _split_events(e)
    sinks.append(first, name, by="name")
    sinks.append(rest.select(*e.columns), name, by="position")
    return _handed_over(spark, name)


def q_create_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    name = unique_name("lt_bucketed_events")
    sinks.create_table(spark, name, e.schema, bucket_by="user_id", buckets=sinks.buckets_for(e.count()))
    first, rest = _split_events(e)
    sinks.append(first, name, by="position")
    sinks.append(rest, name, by="name")
    return _handed_over(spark, name)


def q_csv_import(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    path = scratch_path(spark, "events_csv")
    sinks.csv_export(e, path)
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in e.schema.fields)
    return sources.csv_import(spark, path, ddl)


def q_bulk_copy(spark: SparkSession, sf_dir: str) -> DataFrame:
    remote = sources.read_format(spark, "parquet", path=_path(sf_dir, "events"))
    name = unique_name("lt_copy_events")
    sinks.bulk_copy(spark, remote, name, partition_by="user_id")
    return _handed_over(spark, name)


def q_csv_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Real text through CSV and back: line breaks, quotes, blanks at the ends, commas."""
    c = table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "conversations_csv")
    sinks.csv_export(c, path)
    return sources.csv_import(spark, path, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in c.schema.fields))


def q_csv_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`csv_text` with files that many tasks read: fields with line breaks are put together across byte ranges."""
    c = table(spark, sf_dir, "conversations")
    path = scratch_path(spark, "conversations_csv")
    sinks.csv_export(c, path)
    return sources.csv_import_split(spark, path, c.schema)


def _tick_id():
    """Ids far enough apart that even the small tables reach several days."""
    return F.col("event_id") * TICK_ID_STEP


def q_load_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The staged load of generated ticks (one quote and trade per event, several days, staged in
    folders by day), then the last-quote rollup of the second day on the loaded tables."""
    events = table(spark, sf_dir, "events")
    ids = generators.dealt_by_day(events.select(_tick_id().alias("id")), days=TICK_DAYS)
    path = scratch_path(spark, "staged_ticks")
    for name, make in (("quotes", generators.quotes_from_ids), ("trades", generators.trades_from_ids)):
        make(ids, days=TICK_DAYS).write.partitionBy("date").options(**TICK_COMPRESSION).parquet(f"{path}/{name}")
    symbols = (events.where(F.col("event_id") < generators.LISTED_SYMBOLS)
               .select(generators.symbol_name("event_id").alias("value")))
    symbols.write.parquet(f"{path}/symbols")
    prefix = unique_name("lt_staged") + "_"          # a warehouse may hold what an earlier application left
    load_ticks(spark, path, prefix=prefix)
    key = (session_key(spark), "lt_staged")
    for table_name in TICK_TABLES.values() if key in _LEFT else ():
        sinks.drop_table(spark, _LEFT[key] + table_name)
        sinks.drop_table(spark, f"{_LEFT[key]}STAGING_{table_name}")
    _LEFT[key] = prefix
    return (tick_query(spark, "last_quote_by_symbol", prefix=prefix, day=SECOND_TICK_DAY, order="seq")
            .withColumn("last_bid", F.round("last_bid", 6)))


def q_save_dir(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "events_saved")
    sinks.save_dir(table(spark, sf_dir, "events"), path)
    return sources.read_default(spark, path)


def q_sql_external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.sql_external_table(spark, unique_name("lt_sql_part"), "parquet",
                                      path=_path(sf_dir, "part"))


def _files_mark(spark: SparkSession, path: str) -> tuple:
    """What tells one state of a folder's files from another; their contents are not read."""
    files = spark.read.format("binaryFile").load(path)
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return tuple(files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(mark)).first())


def bucketed_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events in a table bucketed on the symbol (the reference's partitioned fact).

    Loaded once and loaded anew when the source's files (names, lengths, times) have changed.
    """
    key = (session_key(spark), sf_dir)
    files = _files_mark(spark, _path(sf_dir, "events"))
    if key not in _BUCKETED or _BUCKETED[key][0] != files or not spark.catalog.tableExists(_BUCKETED[key][1]):
        if key in _BUCKETED:
            sinks.drop_table(spark, _BUCKETED[key][1])
        e = spark.read.parquet(_path(sf_dir, "events"))
        name = unique_name("lt_quotes_bucketed")
        sinks.create_table(spark, name, e.schema, bucket_by="user_id", buckets=sinks.buckets_for(e.count()))
        sinks.append(e, name)
        _BUCKETED[key] = files, name
    return spark.table(_BUCKETED[key][1])


def q_bucketed_last_quote(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last-quote rollup over the fact bucketed on the symbol: the
    group-by needs no exchange (the bucketing already co-locates symbols)."""
    symbols, args = _tick_args(spark, sf_dir)
    return ticks.last_quote_by_symbol(bucketed_events(spark, sf_dir), symbols, bid="value",
                                      out_value="last_bid", **args)


# ---------------------------------------------------------------------------
# Generators, driven by the ids of an existing table
# ---------------------------------------------------------------------------

def q_gen_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    users = table(spark, sf_dir, "events").select("user_id").distinct()
    return users.select("user_id", generators.symbol_name("user_id").alias("value"))


def q_gen_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return generators.quotes_from_ids(ids)


def q_gen_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "events").select(F.col("event_id").alias("id"))
    return generators.trades_from_ids(ids)


def q_gen_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates of ticks generated over several days, with their counts."""
    ids = table(spark, sf_dir, "events").select(_tick_id().alias("id"))
    return generators.trades_from_ids(ids, days=TICK_DAYS).groupBy("date").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------------------
# JSON feed and change feed
# ---------------------------------------------------------------------------

def q_json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _rejects = feeds.json_ingest(table(spark, sf_dir, "events"), "k int", value_col="props",
                                       keep=("event_id",))
    return good


FEED_SCHEMA = "event_id bigint, k int, ok boolean, at struct<x:int>"


def feed_messages(events: DataFrame) -> DataFrame:
    """A JSON message per event; by the last digit of the id it is good or broken in some way."""
    i = F.col("event_id").cast("string")
    shapes = ['"k":12', '"k":"foo"', '"k":7} trailing', '"k":1,"z":1', '"k":', '"k":12.0', '"ok":true', '"k":1,"k":2', '"ok":"yes"',
              '"at":{"x":"foo"}']
    body = F.element_at(F.array(*[F.lit(s) for s in shapes]), (F.col("event_id") % 10 + 1).cast("int"))
    return events.select("event_id", F.concat(F.lit('{"event_id":'), i, F.lit(","), body, F.lit("}")).alias("value"))


def q_json_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    _good, rejects = feeds.json_ingest(feed_messages(table(spark, sf_dir, "events")), FEED_SCHEMA, keep=("event_id",))
    return rejects


def q_json_checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, _rejects = feeds.json_ingest(feed_messages(table(spark, sf_dir, "events")), FEED_SCHEMA)
    return good.select("event_id", "k", "ok")


def q_stream_json_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The messages as text files taken by the live feed: good rows and counted rejects, read back."""
    run = scratch_path(spark, "json_feed")
    feed_messages(table(spark, sf_dir, "events")).select("value").write.option("maxRecordsPerFile", ROWS_PER_FILE).text(f"{run}/in")
    q = json_feed(spark, message_stream(spark, "text", f"{run}/in", max_files_per_trigger=FILES_PER_BATCH), FEED_SCHEMA,
                  f"{run}/good", f"{run}/rejects", f"{run}/ckpt", available_now=True)
    q.awaitTermination()
    good = spark.read.parquet(f"{run}/good").select(F.lit("good").alias("reason"), "event_id")
    bad = spark.read.parquet(f"{run}/rejects").select(
        F.col("reject_reason").alias("reason"), F.regexp_extract("value", "[0-9]+", 0).cast("bigint").alias("event_id"))
    return good.unionByName(bad).groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


KEYSPACE = "shop"


def events_change_log(events: DataFrame) -> DataFrame:
    """events written as change records: one table per event_type, key user_id,
    clustering event_id, segment user_id % 4, position event_id."""
    return changelog.change_log_from_rows(
        events.select("user_id", "event_id", "ts", "value", "event_type"),
        keyspace=KEYSPACE, table=F.col("event_type"), pk=["user_id"], ck=["event_id"],
        segment=F.col("user_id") % 4, position=F.col("event_id"))


EVENT_CELLS = "ts timestamp_ntz, value double, event_type string"


def q_cdc_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = events_change_log(table(spark, sf_dir, "events"))
    replayed = log.unionByName(log)            # the same change files delivered twice
    target = changes.cdc_target(replayed, KEYSPACE, "CLICK")
    rows = changes.cdc_flatten(changes.cdc_replay_guard(target), EVENT_CELLS)
    return rows.select("event_id", "user_id", "ts", "value")


def q_cdc_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.cdc_flatten(events_change_log(table(spark, sf_dir, "events")),
                               "ts timestamp_ntz, value double, event_type string")


def q_cdc_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.cdc_positions(events_change_log(table(spark, sf_dir, "events")))


def q_cdc_unknown_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes.cdc_unknown_tables(events_change_log(table(spark, sf_dir, "events")),
                                      [("click",), ("VIEW",)], by=("table_name",))


def q_cdc_compact(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    base = e.select("user_id", "event_type", "event_id", "value")      # the bulk copy
    # newest record per (user, table) first, so only winners' cells are parsed
    latest = changes.cdc_latest(events_change_log(e), keys=["pk.user_id", "table_name"])
    rows = changes.cdc_flatten(latest, EVENT_CELLS, keep=changelog.IDENTITY).drop("ts")
    return changes.cdc_compact(base, rows, keys=["user_id", "event_type"]).select(
        "user_id", "event_type", "event_id", "value")


ORDER_CELLS = "o_totalprice double, o_orderstatus string, o_orderpriority string"


def order_changes(orders: DataFrame) -> DataFrame:
    """A change log of every third order over four segments, positions counted anew in each.

    Segment 1 sets the price, segment 2 (at lower positions) the status alone and
    for some a null priority, segment 3 deletes some, segment 4 brings some of
    those back with a price only and adds orders that the base doesn't have.
    """
    k = F.col("o_orderkey")
    o = orders.where(k % 3 == 0).select("o_orderkey")

    def records(rows: DataFrame, segment: int, position, cells: str, op: str = "upsert") -> DataFrame:
        return rows.select(F.lit(segment).cast("bigint").alias("segment"), position.cast("bigint").alias("position"),
                           F.lit(0).alias("row_no"), F.struct("o_orderkey").alias("pk"), F.struct().alias("ck"),
                           F.lit(cells).alias("cells"), F.lit(op).alias("op"))
    parts = [records(o, 1, 1_000_000 + k % 1000, '{"o_totalprice":1.5}'),
             records(o, 1, 2_000_000 + k % 1000, '{"o_totalprice":2.5,"o_orderstatus":"old"}'),
             records(o, 2, k % 1000, '{"o_orderstatus":"new"}'),
             records(o.where(k % 15 == 0), 2, 2000 + k % 1000, '{"o_orderpriority":null}'),
             records(o.where(k % 9 == 0), 3, k % 1000, "{}", "delete"),
             records(o.where(k % 27 == 0), 4, k % 1000, '{"o_totalprice":5.5}'),
             records(o.where((k % 6 == 0) & (k > 0)).select((-k).alias("o_orderkey")), 4, 5000 - k % 1000, '{"o_orderpriority":"added"}')]
    log = parts[0]
    for part in parts[1:]:
        log = log.unionByName(part)
    return log


def q_cdc_compact_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders brought up to date cell by cell; two of three orders have no change and stay as they are."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_custkey")
    log = order_changes(o)
    replayed = changes.cdc_replay_guard(log.unionByName(log))
    rows = changes.cdc_flatten(replayed, ORDER_CELLS, keep=(*changelog.IDENTITY, "op"), present="held")
    return changes.cdc_compact(o, rows, keys=["o_orderkey"], op_col="op", present_col="held")


#: Files of a stream's input hold so many records at most; a batch takes so many files.
ROWS_PER_FILE = 1_000_000
FILES_PER_BATCH = 1000


def _log_files(log: DataFrame, path: str) -> None:
    log.write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)


def q_stream_cdc_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change-log stream over the events' log: several files, delivered twice, stopped in the middle
    and started again from its checkpoint; the copy, read back."""
    run = scratch_path(spark, "cdc_sync")
    log = events_change_log(table(spark, sf_dir, "events"))
    schema = changelog.change_log_schema("user_id bigint", "event_id bigint")

    def sync() -> None:
        q = cdc_sync(spark, f"{run}/log", f"{run}/copy", f"{run}/ckpt", log_schema=schema, cells_schema=EVENT_CELLS,
                     keyspace=KEYSPACE, table="CLICK", reject_path=f"{run}/rejects", report_path=f"{run}/report",
                     known_tables=[(KEYSPACE, "click"), (KEYSPACE, "view")], available_now=True, max_files_per_trigger=FILES_PER_BATCH)
        q.awaitTermination()
    half = F.col("position") % 2 == 0
    _log_files(log.where(half), f"{run}/log")
    sync()
    _log_files(log, f"{run}/log")       # the rest, and the first half again
    sync()
    copy = read_copy(spark, f"{run}/copy").select(F.lit("copy").alias("kind"), "event_id", "user_id", "ts", "value")
    told = unknown_tables_report(spark, f"{run}/report").select(
        F.concat(F.lit("unknown "), "table_name").alias("kind"), F.col("n").alias("event_id"),
        F.lit(None).cast("bigint").alias("user_id"), F.lit(None).cast("timestamp_ntz").alias("ts"), F.lit(None).cast("double").alias("value"))
    return copy.unionByName(told)


def q_stream_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change-log stream with its copy folded while it runs: a third of the log, then two thirds and a fold,
    then all of it once more from a new checkpoint (every record known, from folded files or from folders), and a last fold."""
    run = scratch_path(spark, "cdc_fold")
    log = events_change_log(table(spark, sf_dir, "events"))
    schema = changelog.change_log_schema("user_id bigint", "event_id bigint")

    def sync(checkpoint: str) -> None:
        cdc_sync(spark, f"{run}/log", f"{run}/copy", f"{run}/{checkpoint}", log_schema=schema, cells_schema=EVENT_CELLS, keyspace=KEYSPACE,
                 table="CLICK", reject_path=f"{run}/rejects", available_now=True, max_files_per_trigger=FILES_PER_BATCH).awaitTermination()
    for third in range(3):
        _log_files(log.where(F.col("position") % 3 == third), f"{run}/log")
        sync("first")
        fold(spark, f"{run}/copy")
    sync("second")
    fold(spark, f"{run}/copy")
    return read_copy(spark, f"{run}/copy").select("event_id", "user_id", "ts", "value")


def q_live_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last quote and price and the hourly totals of every day, kept current by three streams over five
    arrivals of events (each spread over all days and out of order)."""
    run = scratch_path(spark, "live_rollups")
    e = table(spark, sf_dir, "events")
    kinds = {
        "quote": (["user_id"], {"x": Last("value", "event_id"), "top": Greatest("value")}),
        "price": (["user_id", "event_type"], {"x": Last("value", "event_id"), "top": Greatest("value")}),
        "size": (["user_id", "hr"], {"x": Total("value", 2)}),
    }
    for fifth in range(5):
        e.where(F.col("event_id") % 5 == fifth).write.mode("append").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(f"{run}/in")
        running = []
        for kind, (keys, measures) in kinds.items():
            rows = spark.readStream.schema(e.schema).option("maxFilesPerTrigger", FILES_PER_BATCH).parquet(f"{run}/in").withColumn("hr", F.hour("ts"))
            running.append(live_rollup(spark, rows, f"{run}/{kind}", f"{run}/{kind}-checkpoint", day=F.col("ts"), keys=keys, measures=measures,
                                       available_now=True))
        for q in running:
            q.awaitTermination()
    out = [read_rollup(spark, f"{run}/{kind}").select(
        F.lit(kind).alias("kind"), "day", "user_id", (F.col(keys[1]).cast("string") if keys[1:] else F.lit(None).cast("string")).alias("part"),
        F.col("x").cast("double").alias("x"), (F.col("x__n") if kind == "size" else F.lit(None).cast("long")).alias("n"),
        (F.lit(None).cast("double") if kind == "size" else F.col("top")).alias("top")) for kind, (keys, _) in kinds.items()]
    return out[0].unionByName(out[1]).unionByName(out[2])


def q_cdc_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per segment of the events' log: how far it has no gap, and the gaps."""
    return changes.cdc_gaps(events_change_log(table(spark, sf_dir, "events")), start=0)


ORDER_COLUMNS = ("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority", "o_custkey")


def _flat_order_changes(log: DataFrame) -> DataFrame:
    return changes.cdc_flatten(log, ORDER_CELLS, keep=(*changelog.IDENTITY, "op"), present="held")


class _Killed(Exception):
    """Stands for a process that dies."""


def q_bulk_then_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders copied in chunks while its changes land, killed inside a chunk and resumed, then handed over to the feed.

    The live table is orders with the changes of the log so far. Two segments of the log
    land while the first chunk is read, the others while the second is.
    """
    o = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    run = scratch_path(spark, "bulk_then_feed")
    log = _flat_order_changes(order_changes(o))
    log.write.parquet(f"{run}/log")
    log = spark.read.schema(log.schema).parquet(f"{run}/log")
    changes.cdc_compact(o, log, ["o_orderkey"], op_col="op", present_col="held").write.parquet(f"{run}/now")
    moment = {"reads": 0}

    def seen() -> DataFrame:
        """The log so far; chunks ask before and after they read the table."""
        return log.where(F.col("segment") <= (0 if moment["reads"] < 2 else 2 if moment["reads"] < 4 else 4))

    def live() -> DataFrame:
        moment["reads"] += 1                         # for the chunks' bounds, the first chunk, the second (killed), the second again, ...
        if moment["reads"] == 3:
            raise _Killed
        return o if moment["reads"] <= 2 else spark.read.schema(o.schema).parquet(f"{run}/now")

    def copy() -> None:
        handover.copy_in_chunks(spark, live, seen, f"{run}/copy", key="o_orderkey", rows_per_chunk=max(1, o.count() // 4))
    try:
        copy()
    except _Killed:
        copy()
    return handover.handed_over(spark, f"{run}/copy", log, keys=["o_orderkey"], op_col="op", present_col="held").select(*ORDER_COLUMNS)


def q_cdc_compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as generations of files: the changes of the smaller half of the keys, then all others, each
    rewriting only the files that hold a changed key."""
    o = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    base = scratch_path(spark, "orders_base")
    compact_files.write_base(o, base, ["o_orderkey"])
    log = order_changes(o)
    middle = o.agg(F.percentile_approx("o_orderkey", 0.5)).first()[0]
    first = F.abs(F.col("o_orderkey")) <= F.lit(middle)
    flat = _flat_order_changes(log)
    for part in (flat.where(first), flat.where(~first)):
        compact_files.cdc_compact_files(spark, base, part, ["o_orderkey"], op_col="op", present_col="held")
    return generations.read_generation(spark, base)


def q_changelog_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log written as JSON files and scanned: one row per record, cells read back."""
    path = scratch_path(spark, "change_log")
    events_change_log(table(spark, sf_dir, "events")).write.json(path)
    log = changelog.cdc_read(spark, path, changelog.change_log_schema("user_id bigint", "event_id bigint"), "json")
    return changes.cdc_flatten(log, EVENT_CELLS, keep=("segment", "position", "table_name"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "last_quote_by_symbol": q_last_quote_by_symbol,
    "last_price_by_symbol_exchange": q_last_price_by_symbol_exchange,
    "hourly_avg_size": q_hourly_avg_size,
    "hour_of_text_time": q_hour_of_text_time,
    "max_bid_by_symbol": q_max_bid_by_symbol,
    "delay_by_carrier": q_delay_by_carrier,
    "top_delays": q_top_delays,
    "delay_limit": q_delay_limit,
    "external_table": q_external_table,
    "external_table_partitioned": q_external_table_partitioned,
    "varchar_schema": q_varchar_schema,
    "allow_existing": q_allow_existing,
    "csv_text": q_csv_text,
    "csv_split": q_csv_split,
    "load_ticks": q_load_ticks,
    "gen_days": q_gen_days,
    "json_checked": q_json_checked,
    "stream_json_feed": q_stream_json_feed,
    "changelog_scan": q_changelog_scan,
    "cdc_compact_cells": q_cdc_compact_cells,
    "stream_cdc_sync": q_stream_cdc_sync,
    "rename_reserved": q_rename_reserved,
    "varchar_violations": q_varchar_violations,
    "ctas": q_ctas,
    "append": q_append,
    "create_table": q_create_table,
    "csv_import": q_csv_import,
    "bulk_copy": q_bulk_copy,
    "save_dir": q_save_dir,
    "sql_external_table": q_sql_external_table,
    "bucketed_last_quote": q_bucketed_last_quote,
    "gen_symbols": q_gen_symbols,
    "gen_quotes": q_gen_quotes,
    "gen_trades": q_gen_trades,
    "json_ingest": q_json_ingest,
    "json_rejects": q_json_rejects,
    "cdc_sync": q_cdc_sync,
    "cdc_flatten": q_cdc_flatten,
    "cdc_positions": q_cdc_positions,
    "cdc_unknown_tables": q_cdc_unknown_tables,
    "cdc_compact": q_cdc_compact,
    "bulk_then_feed": q_bulk_then_feed,
    "cdc_compact_files": q_cdc_compact_files,
    "cdc_gaps": q_cdc_gaps,
    "stream_fold": q_stream_fold,
    "live_rollups": q_live_rollups,
}
