"""Repeatable tick data at any scale.

Quotes and trades are built from an id column with built-in expressions only
(no Python per row). Every draw is a seeded hash of (tag, id), so the rows do
not depend on the number of partitions, the task order or task retries: 1, 7
or 200 partitions give the same table, and DuckDB can compute the same rows.

`gen_quotes(spark, n)` reads `spark.range`; `quotes_from_ids(df)` turns any id
column into quotes, so generation can also be driven by an existing table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from livetables.functions.expressions import (
    decimal_text,
    digest,
    hash_window,
    pick,
    symbol_name,
    time_text,
    uniform,
)

# Fixed values of the tick data set.
QUOTES_PER_SCALE = 791_465
TRADES_PER_SCALE = 116_391
EXCHANGES = ["NYSE", "NASDAQ", "AMEX", "TSE", "LON", "BSE", "BER", "EPA", "TYO"]
ALL_SYMBOLS = 400          # SY00..SY99, S100..S399
LISTED_SYMBOLS = 100       # the symbol table keeps the first 100
BASE_DAY = "2016-06-06"
TRADING_HOURS = 8          # times fall in hours 0..7
QUOTE_COMMENTS = 15
TRADE_COMMENTS = 9
MAX_BID = 100_000
MAX_SIZE = 1_000
SIZE_SCALE = 4                       # size = unscaled / 10^4, in [0, 1000)
PRICE_UNSCALED_LIMIT = 100_000_000   # price = unscaled / 10^4, decimal(10,4)
ROWS_PER_DAY_STEP = 10_000
DEFAULT_PARTITIONS = 200
QUOTE_COMMENT_PREFIX = "Comment{k} : Quote Table : "
TRADE_COMMENT_PREFIX = "Comment{k} : Trade Table : "
COMMENT_FIELD_SEPARATOR = " + "

# Hash tags: one md5 per tag gives four 32-bit draws.
_TAGS = {"quote": ("qa:", "qb:"), "trade": ("ta:", "tb:")}


def gen_symbols(spark: SparkSession, n: int = LISTED_SYMBOLS) -> DataFrame:
    """The symbol dimension: one column `value`, the first n symbol names."""
    return spark.range(0, n, 1, 1).select(symbol_name("id").alias("value"))


def _draws(kind: str, id_col: Column) -> dict[str, Column]:
    a, b = (digest(t, id_col) for t in _TAGS[kind])
    return {
        "sym_idx": hash_window(a, 0) % ALL_SYMBOLS,
        "ex_idx": hash_window(a, 1) % len(EXCHANGES),
        "value_a": a,
        "hour": hash_window(a, 3) % TRADING_HOURS,
        "minute": hash_window(b, 0) % 60,
        "second": hash_window(b, 1) % 60,
        "millis": hash_window(b, 2) % 1000,
        "value_b": b,
    }


def _size_unscaled(hex_digest: Column) -> Column:
    return hash_window(hex_digest, 3) % (MAX_SIZE * 10 ** SIZE_SCALE)


def _day(id_col: Column, days: int) -> Column:
    if days <= 1:
        return F.lit(BASE_DAY)
    step = F.floor(id_col / ROWS_PER_DAY_STEP) % days
    return F.date_add(F.lit(BASE_DAY).cast("date"), step.cast("int")).cast("string")


def dealt_by_day(ids: DataFrame, id_col: str = "id", days: int = 1, per_task: int = 250_000) -> DataFrame:
    """The same ids, dealt to tasks by day and id, about `per_task` to each.

    A write by day sorts each task's wide rows, which is done in memory for so
    many; the ids that are dealt out are narrow. A task holds one day, or few.
    """
    tasks = max(1, -(-ids.count() // per_task))
    return ids.repartitionByRange(tasks, _day(F.col(id_col), days), F.col(id_col))


def quotes_from_ids(ids: DataFrame, id_col: str = "id", days: int = 1,
                    keep_id: bool = True) -> DataFrame:
    """One quote per id: sym, ex, bid, time, date, comment1..comment15.

    bid is uniform in [0, 100000); time is HH:mm:ss.SSS in hours 0-7.
    Parallelism is the id source's: repartition a narrow one first.
    """
    i = F.col(id_col)
    d = _draws("quote", i)
    base = ids.select(
        i.alias("seq"),
        symbol_name(d["sym_idx"]).alias("sym"),
        pick(EXCHANGES, d["ex_idx"]).alias("ex"),
        uniform(d["value_a"], 2, MAX_BID).alias("bid"),
        time_text(d["hour"], d["minute"], d["second"], d["millis"]).alias("time"),
        _day(i, days).alias("date"),
    )
    stamp = F.concat_ws(COMMENT_FIELD_SEPARATOR, "sym", "ex", F.concat_ws(" ", "date", "time"), "date")
    comments = [F.concat(F.lit(QUOTE_COMMENT_PREFIX.format(k=k)), stamp).alias(f"comment{k}")
                for k in range(1, QUOTE_COMMENTS + 1)]
    out = base.select("seq", "sym", "ex", "bid", "time", "date", *comments)
    return out if keep_id else out.drop("seq")


def trades_from_ids(ids: DataFrame, id_col: str = "id", days: int = 1,
                    keep_id: bool = True) -> DataFrame:
    """One trade per id: sym, ex, price (decimal(10,4) text), time, date, size,
    comment1..comment9. size is uniform in [0, 1000) on a 10^-4 grid, so its
    text form in the comments is exact."""
    i = F.col(id_col)
    d = _draws("trade", i)
    base = ids.select(
        i.alias("seq"),
        symbol_name(d["sym_idx"]).alias("sym"),
        pick(EXCHANGES, d["ex_idx"]).alias("ex"),
        decimal_text(hash_window(d["value_a"], 2) % PRICE_UNSCALED_LIMIT).alias("price"),
        time_text(d["hour"], d["minute"], d["second"], d["millis"]).alias("time"),
        _day(i, days).alias("date"),
        (_size_unscaled(d["value_b"]) / F.lit(10.0 ** SIZE_SCALE)).alias("size"),
        decimal_text(_size_unscaled(d["value_b"]), 10, SIZE_SCALE).alias("__size_text"),
    )
    stamp = F.concat_ws(COMMENT_FIELD_SEPARATOR, "sym", "ex", "price",
                        F.concat_ws(" ", "date", "time"), "date", "__size_text")
    comments = [F.concat(F.lit(TRADE_COMMENT_PREFIX.format(k=k)), stamp).alias(f"comment{k}")
                for k in range(1, TRADE_COMMENTS + 1)]
    out = base.select("seq", "sym", "ex", "price", "time", "date", "size", *comments)
    return out if keep_id else out.drop("seq")


def gen_quotes(spark: SparkSession, scale: float = 1.0, rows: int | None = None,
               partitions: int = DEFAULT_PARTITIONS, days: int = 1) -> DataFrame:
    """scale x 791,465 quotes (or exactly `rows`) over `partitions` range splits."""
    n = rows if rows is not None else int(scale * QUOTES_PER_SCALE)
    return quotes_from_ids(spark.range(0, n, 1, partitions), days=days)


def gen_trades(spark: SparkSession, scale: float = 1.0, rows: int | None = None,
               partitions: int = DEFAULT_PARTITIONS, days: int = 1) -> DataFrame:
    """scale x 116,391 trades (or exactly `rows`) over `partitions` range splits."""
    n = rows if rows is not None else int(scale * TRADES_PER_SCALE)
    return trades_from_ids(spark.range(0, n, 1, partitions), days=days)


def generate_to(spark: SparkSession, path: str, scale: float = 1.0, fmt: str = "parquet",
                partitions: int = DEFAULT_PARTITIONS) -> dict[str, str]:
    """Write quotes/, trades/ and symbols/ under `path` (fails if present)."""
    out = {k: f"{path.rstrip('/')}/{k}" for k in ("quotes", "trades", "symbols")}
    gen_quotes(spark, scale, partitions=partitions).write.format(fmt).save(out["quotes"])
    gen_trades(spark, scale, partitions=partitions).write.format(fmt).save(out["trades"])
    gen_symbols(spark).write.format(fmt).save(out["symbols"])
    return out
