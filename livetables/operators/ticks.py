"""Tick rollups over quotes and trades.

The three reference rollups filter one trading day, keep symbols listed in a
small symbol dimension, and aggregate per symbol:

* last quote per symbol          (`last(bid)`)
* last trade price per symbol and exchange (`last(price)`)
* average trade size per symbol and hour of the trade time (`avg(size)`)

`last()` in SQL returns whichever row the scan met last, which is not defined
on a distributed scan. Here "last" is `max_by(value, order)`: by date and time of
the row unless other order columns are named (a sequence number, or a timestamp),
which plans as a partial + final hash aggregate: each task collapses its rows to one
per group before the shuffle, so a hot symbol costs no more than a cold one.

Column names are parameters: the same code runs on the tick schema
(sym, ex, bid/price/size, time, date) and on any other fact table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetables.functions.expressions import exact_avg, hour_of_text
from livetables.operators.joins import membership_join


def day_predicate(df: DataFrame, day_col: str, day: str) -> Column:
    """`day_col` falls on `day` (yyyy-MM-dd), for text, date or timestamp columns.

    On a timestamp column the cast-to-date equality is rewritten by Catalyst
    into a range on the raw column and pushed to the Parquet scan.
    """
    dtype = df.schema[day_col].dataType
    c = F.col(day_col)
    if isinstance(dtype, T.StringType):
        return c == F.lit(day)
    return c.cast("date") == F.lit(day).cast("date")


def hour_of(df: DataFrame, time_col: str) -> Column:
    """Hour of a time column as bigint; text times are parsed leniently."""
    dtype = df.schema[time_col].dataType
    if isinstance(dtype, T.StringType):
        return hour_of_text(time_col).cast("bigint")
    return F.hour(F.col(time_col)).cast("bigint")


def _day_symbols(fact: DataFrame, symbols: DataFrame, *, sym: str, symbol_key: str,
                 day_col: str | None, day: str | None, join_type: str) -> DataFrame:
    if day_col is not None and day is not None:
        fact = fact.where(day_predicate(fact, day_col, day))
    return membership_join(fact, symbols, sym, symbol_key, how=join_type)


def _moment(df: DataFrame, day_col: str, time_col: str, tie: Column) -> Column:
    """Day and time of day of a row as one number, so that `max_by` stays a hash aggregate.

    Texts that are no date or time come first. The last 18 digits are a hash of
    `tie`: rows at the same moment have a fixed order.
    """
    if isinstance(df.schema[time_col].dataType, T.StringType):
        stamp = F.concat(F.lit("1970-01-01 "), F.trim(F.col(time_col))).try_cast("timestamp_ntz")
        micros = F.unix_micros(stamp.cast("timestamp")) + 86_400_000_000      # the session's zone may lie ahead
    else:
        micros = F.unix_micros(F.col(time_col).cast("timestamp")) % 86_400_000_000
    day = F.unix_date(F.col(day_col).try_cast("date")) + 1_000_000
    number = [F.coalesce(c, F.lit(0)).cast("decimal(18,0)") for c in (day, micros, F.pmod(F.xxhash64(tie), F.lit(10 ** 18)))]
    scaled = number[0] * F.lit(10 ** 12).cast("decimal(13,0)") + number[1]
    return (scaled.cast("decimal(19,0)") * F.lit(10 ** 18).cast("decimal(19,0)") + number[2]).cast("decimal(38,0)")


def _last(df: DataFrame, value: Column, order: str | tuple[str, str]) -> Column:
    """The value of the last row: by one column, or by (day, time) with a fixed order of ties."""
    by = F.col(order) if isinstance(order, str) else _moment(df, *order, tie=value)
    return F.max_by(value, by)


def last_quote_by_symbol(quotes: DataFrame, symbols: DataFrame, *, sym: str = "sym",
                         bid: str = "bid", order: str | tuple[str, str] = ("date", "time"), symbol_key: str = "value",
                         day_col: str | None = "date", day: str | None = "2016-06-06",
                         out_sym: str = "sym", out_value: str = "last_bid",
                         join_type: str = "inner") -> DataFrame:
    """Last bid per listed symbol on one day.

    `order` says which row is last: the day and time columns, or one column
    such as a sequence number. Rows at the same moment go by a hash of their
    bid, so that reruns agree.
    """
    f = _day_symbols(quotes, symbols, sym=sym, symbol_key=symbol_key, day_col=day_col, day=day,
                     join_type=join_type)
    return (f.groupBy(F.col(sym).alias(out_sym))
            .agg(_last(f, F.col(bid), order).alias(out_value)))


def last_price_by_symbol_exchange(trades: DataFrame, symbols: DataFrame, *, sym: str = "sym",
                                  ex: str = "ex", price: str = "price",
                                  order: str | tuple[str, str] = ("date", "time"),
                                  symbol_key: str = "value", day_col: str | None = "date",
                                  day: str | None = "2016-06-06", out_sym: str = "sym",
                                  out_ex: str = "ex", out_value: str = "last_price",
                                  join_type: str = "inner",
                                  text_price: str = "decimal(10,4)") -> DataFrame:
    """Last trade price per listed symbol and exchange on one day.

    The price keeps its stored type. Text prices are aggregated as
    `text_price`, a fixed width, and returned as text of that type.
    """
    f = _day_symbols(trades, symbols, sym=sym, symbol_key=symbol_key, day_col=day_col, day=day,
                     join_type=join_type)
    text = isinstance(f.schema[price].dataType, T.StringType)
    last = _last(f, F.col(price).try_cast(text_price) if text else F.col(price), order)
    return (f.groupBy(F.col(sym).alias(out_sym), F.col(ex).alias(out_ex))
            .agg((last.cast("string") if text else last).alias(out_value)))


def hourly_avg_size(trades: DataFrame, symbols: DataFrame, *, sym: str = "sym",
                    time_col: str = "time", size: str = "size", symbol_key: str = "value",
                    day_col: str | None = "date", day: str | None = "2016-06-06",
                    out_sym: str = "sym", out_hour: str = "hr", out_value: str = "avg_size",
                    join_type: str = "inner", exact_scale: int | None = None) -> DataFrame:
    """Average trade size per listed symbol and hour of day on one day.

    A time text that does not parse gives hour NULL (its own group) instead
    of failing the query. With `exact_scale=s` (sizes carry at most s
    decimals) the sum runs as decimal(18+s, s), so the result does not depend
    on the order rows are added in; None is a plain double `avg`.
    """
    f = _day_symbols(trades, symbols, sym=sym, symbol_key=symbol_key, day_col=day_col, day=day,
                     join_type=join_type)
    avg = (exact_avg(size, 18 + exact_scale, exact_scale) if exact_scale is not None
           else F.avg(F.col(size)))
    return (f.groupBy(F.col(sym).alias(out_sym), hour_of(f, time_col).alias(out_hour))
            .agg(avg.alias(out_value)))


def max_bid_by_symbol(trades: DataFrame, quotes: DataFrame, *, trade_sym: str = "sym",
                      quote_sym: str = "sym", bid: str = "bid", out_sym: str = "sym",
                      out_value: str = "max_bid") -> DataFrame:
    """Highest quote bid per symbol that also has trades.

    Written as trades JOIN quotes ON sym GROUP BY sym, max(bid). Joining first
    multiplies every trade by every quote of its symbol; reducing both sides
    to one row per symbol first gives the same answer from two small inputs.
    Both aggregates are hash-partitioned on the symbol, so the join adds no
    further exchange.
    """
    t = trades.select(F.col(trade_sym).alias(out_sym)).distinct()
    q = quotes.groupBy(F.col(quote_sym).alias(out_sym)).agg(F.max(F.col(bid)).alias(out_value))
    return t.join(q, out_sym, "inner").select(out_sym, out_value)
