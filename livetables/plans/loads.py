"""Staged loads: files -> staging tables -> typed targets.

load_ticks:   quotes/, trades/, symbols/ folders -> QUOTES and TRADES (bucketed
              on sym) and S (the symbol dimension, broadcast at query time).
load_flights: airline folder -> airline table (reserved names renamed, rows
              appended by position), carrier folder -> airlineref table.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from livetables.operators import flights, ticks
from livetables.operators.contracts import as_varchar, rename_reserved_schema
from livetables.sinks.tables import analyze_rows, append, buckets_for, create_table, drop_table
from livetables.sources import generators
from livetables.sources.tables import external_table, read_default

TICK_TABLES = {"trades": "TRADES", "quotes": "QUOTES", "symbols": "S"}
# Ticks are wide texts that differ in a few characters: files by zstd take well under half of Spark's default.
TICK_COMPRESSION = {"compression": "zstd"}


def enforce_not_null(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fail the write on the first NULL in `cols` (Parquet tables accept NULL
    into NOT NULL columns). The check runs inside the write, no extra scan."""
    def guard(c: str):
        return F.when(F.col(c).isNull(), F.raise_error(F.lit(f"NULL in NOT NULL column {c}"))) \
            .otherwise(F.col(c)).alias(c)
    return df.select(*[guard(c) if c in cols else F.col(c) for c in df.columns])


def load_ticks(spark: SparkSession, path: str, provider: str = "column", prefix: str = "",
               day_partitions: bool = True, bucket_by_symbol: bool = False,
               buckets: int | None = None) -> dict[str, float]:
    """Load generated ticks under `path`; return load times in ms per table.

    provider="row" gives the row-table contract: text as VARCHAR(30), or
    VARCHAR(400) for comment columns, all NOT NULL. Length is enforced by
    Spark on write; NOT NULL by a guard inside the write.

    Layout. day_partitions=True partitions the facts by `date` (one folder
    per day), so the rollups' day filter prunes folders. bucket_by_symbol=True
    also buckets them on `sym` (the reference's partitioning by symbol):
    joins and group-bys on the symbol then need no exchange, but a bucketed
    scan reads each bucket in one task, so at 100 TB every task would read
    total/buckets bytes and a symbol holding a third of the rows would be a
    third of the table in one task. The rollups only shuffle partial
    aggregates, so by default the facts are not bucketed.
    """
    names = {k: prefix + v for k, v in TICK_TABLES.items()}
    staging = {k: prefix + "STAGING_" + v for k, v in TICK_TABLES.items()}
    for n in list(names.values()) + list(staging.values()):
        drop_table(spark, n)
    dfs = {k: external_table(spark, staging[k], f"{path.rstrip('/')}/{k}") for k in names}
    times = {}
    for k in ("trades", "quotes"):
        schema = as_varchar(dfs[k].schema) if provider == "row" else dfs[k].schema
        if day_partitions:
            # partition columns go last in a Spark table
            schema = type(schema)([f for f in schema.fields if f.name != "date"]
                                  + [f for f in schema.fields if f.name == "date"])
        create_table(spark, names[k], schema,
                     bucket_by="sym" if bucket_by_symbol else None,
                     buckets=(buckets or buckets_for(dfs[k].count())) if bucket_by_symbol else None,
                     partition_by="date" if day_partitions else None, options=TICK_COMPRESSION)
    create_table(spark, names["symbols"], as_varchar(dfs["symbols"].schema))
    for k in ("trades", "quotes", "symbols"):
        df = dfs[k]
        target_schema = spark.table(names[k]).schema
        required = [f.name for f in target_schema.fields if not f.nullable]
        if required:
            df = enforce_not_null(df, required)
        t0 = time.perf_counter()
        append(df, names[k], by="name")
        times[k] = (time.perf_counter() - t0) * 1000.0
    analyze_rows(spark, names["symbols"])       # Spark's broadcast check reads its size
    return times


def tick_query(spark: SparkSession, name: str, prefix: str = "", day: str = "2016-06-06",
               order: str | tuple[str, str] = ("date", "time")) -> DataFrame:
    """One of the three rollups over loaded tick tables."""
    s = spark.table(prefix + TICK_TABLES["symbols"])
    if name == "last_quote_by_symbol":
        return ticks.last_quote_by_symbol(spark.table(prefix + TICK_TABLES["quotes"]), s, day=day, order=order)
    trades = spark.table(prefix + TICK_TABLES["trades"])
    if name == "last_price_by_symbol_exchange":
        return ticks.last_price_by_symbol_exchange(trades, s, day=day, order=order)
    if name == "hourly_avg_size":
        # generated sizes sit on a 10^-4 grid: an exact decimal sum is partition-proof
        return ticks.hourly_avg_size(trades, s, day=day,
                                     exact_scale=generators.SIZE_SCALE)
    raise KeyError(name)


def tick_queries(spark: SparkSession, prefix: str = "", day: str = "2016-06-06") -> dict[str, DataFrame]:
    """The three rollups over loaded tick tables."""
    return {q: tick_query(spark, q, prefix, day)
            for q in ("last_quote_by_symbol", "last_price_by_symbol_exchange", "hourly_avg_size")}


def load_flights(spark: SparkSession, airline_path: str, airlineref_path: str,
                 col_table: str = "airline", row_table: str = "airlineref",
                 staging: str = "staging_airline", buckets: int = 11) -> DataFrame:
    """Load flights and carriers, then run the delay-by-carrier query.

    The airline table is created with the reserved names renamed (Year_,
    Month_) and the staged rows, which still carry the old names, are
    appended by position.
    """
    for n in (col_table, row_table, staging):
        drop_table(spark, n)
    airline = external_table(spark, staging, airline_path)
    create_table(spark, col_table, rename_reserved_schema(airline.schema), buckets=buckets)
    append(airline, col_table, by="position")
    ref = read_default(spark, airlineref_path)
    create_table(spark, row_table, ref.schema)
    append(ref, row_table, by="name")
    analyze_rows(spark, row_table)                # Spark's broadcast check reads its size
    return flights.delay_by_carrier(spark.table(col_table), spark.table(row_table), limit=20)
