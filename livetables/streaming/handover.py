"""From a bulk copy to the feed without a gap: a chunked copy bracketed by log positions.

    copy_in_chunks:  for each range of the key, one after the other
                        low  = the log's newest position
                        the chunk's rows, read from the live table and written
                        high = the log's newest position
                        mark (chunk, low, high)
    handed_over:     copied rows  +  changes after their chunk's `low`

The table keeps changing while it is copied. A row read after `low` holds every
change up to `low` and perhaps some up to `high`. So a change at or before the
`low` of its key's chunk is in the copy and is left out; each later one is applied,
in log order: whether the read saw it or not, the newest change wins and counts
once. No lock on the source, and no moment at which the whole table stands still, is needed.

Resuming. The ranges are fixed by the first run and kept with the copy; a chunk
counts when its mark is there. A run that was killed, whether between or inside
chunks, is started again with the same call: marked chunks are kept, a chunk without
a mark is overwritten with a new `low`. The marks tell how far the log has to
reach before the copy is whole (`high`); `handed_over` refuses a shorter log.

Scale. A chunk is a range predicate on the key, which connectors and Parquet push
down; its rows are written by as many tasks as its scan has. The bounds are one
aggregate over the key column. The driver holds two numbers and a bound per chunk (`rows_per_chunk`
keeps chunks in the thousands); changes find their chunk in array literals, in
two steps of about the square root of the number of chunks, without a join.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetables.operators.changes import cdc_compact, order_key
from livetables.sources.changelog import IDENTITY
from livetables.streaming.cdc_sync import path_exists

#: A table or change log as it is at the moment of the call.
Live = Callable[[], DataFrame]


@dataclass(frozen=True)
class Marks:
    """Lower bounds of chunks 1.. (chunk 0 takes smaller keys and nulls), and per chunk the log's position before and after."""

    bounds: list
    low: list[Decimal]
    high: list[Decimal]


def _folder(target: str, *parts: str) -> str:
    return "/".join([target.rstrip("/"), *parts])


def _complete(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path}/_SUCCESS")


def newest_position(log: DataFrame, order: tuple[str, ...] = IDENTITY) -> Decimal:
    """The log's newest order key; -1 for an empty log."""
    return log.agg(F.max(order_key(order))).first()[0] or Decimal(-1)


def chunk_bounds(source: DataFrame, key: str, rows_per_chunk: int, accuracy: int = 10_000) -> list:
    """Lower bounds of all chunks but the first: approximate quantiles of a numeric, date or timestamp key."""
    chunks = max(1, -(-source.count() // rows_per_chunk))
    if chunks == 1:
        return []
    shares = [i / chunks for i in range(1, chunks)]
    found = source.agg(F.percentile_approx(key, shares, max(accuracy, 10 * chunks))).first()[0]
    return sorted({b for b in found or [] if b is not None})


def _bounds(spark: SparkSession, source: Live, target: str, key: str, rows_per_chunk: int, bounds: list | None) -> list:
    path = _folder(target, "bounds")
    if not _complete(spark, path):
        table = source()
        found = sorted(set(bounds)) if bounds is not None else chunk_bounds(table, key, rows_per_chunk)
        schema = T.StructType([T.StructField("bound", table.schema[key].dataType)])
        spark.createDataFrame([(b,) for b in found], schema).coalesce(1).write.mode("overwrite").parquet(path)
    return sorted(r["bound"] for r in spark.read.parquet(path).collect())


def _in_chunk(key: str, bounds: list, chunk: int) -> Column:
    inside = F.lit(True)
    if chunk > 0:
        inside = inside & (F.col(key) >= F.lit(bounds[chunk - 1]))
    if chunk < len(bounds):
        inside = inside & (F.col(key) < F.lit(bounds[chunk]))
    return inside | F.col(key).isNull() if chunk == 0 and bounds else inside


def copy_in_chunks(spark: SparkSession, source: Live, log: Live, target: str, *, key: str, rows_per_chunk: int = 50_000_000,
                   bounds: list | None = None, order: tuple[str, ...] = IDENTITY) -> int:
    """Copy the live table to `target`, or go on with a copy that was interrupted; the number of chunks copied by this call.

    `key` is the first column of the table's key. `bounds` are chunk bounds for keys
    that have no quantiles (texts). Both count on the first call only.
    """
    bounds = _bounds(spark, source, target, key, rows_per_chunk, bounds)
    copied = 0
    for chunk in range(len(bounds) + 1):
        mark = _folder(target, "marks", f"chunk={chunk}")
        if _complete(spark, mark):
            continue
        low = newest_position(log(), order)
        source().where(_in_chunk(key, bounds, chunk)).write.mode("overwrite").parquet(_folder(target, "rows", f"chunk={chunk}"))
        high = newest_position(log(), order)
        row = spark.createDataFrame([(low, high)], "low decimal(38,0), high decimal(38,0)")
        row.coalesce(1).write.mode("overwrite").parquet(mark)
        copied += 1
    return copied


def read_marks(spark: SparkSession, target: str) -> Marks:
    """The marks of a finished copy; an unfinished one is an error that names a missing chunk."""
    bounds = sorted(r["bound"] for r in spark.read.parquet(_folder(target, "bounds")).collect())
    for chunk in range(len(bounds) + 1):
        if not _complete(spark, _folder(target, "marks", f"chunk={chunk}")):
            raise ValueError(f"{target}: chunk {chunk} of {len(bounds) + 1} is not copied yet")
    rows = {r["chunk"]: r for r in spark.read.parquet(_folder(target, "marks")).collect()}
    return Marks(bounds, [rows[i]["low"] for i in range(len(rows))], [rows[i]["high"] for i in range(len(rows))])


def copied_rows(spark: SparkSession, target: str) -> DataFrame:
    """The rows of a finished copy, as they were read (folders of chunks from other runs are not there)."""
    marks = read_marks(spark, target)
    return spark.read.parquet(*[_folder(target, "rows", f"chunk={i}") for i in range(len(marks.low))])


def chunk_of(key: Column, bounds: list, kind: T.DataType) -> Column:
    """Number of the chunk that holds a key."""
    if not bounds:
        return F.lit(0)
    step = max(1, int(len(bounds) ** 0.5))

    def literal(values: list) -> Column:
        return F.array(*[F.lit(v) for v in values]).cast(T.ArrayType(kind))

    def below(values: Column) -> Column:
        return F.size(F.filter(values, lambda b: b <= key))
    block = F.greatest(below(literal(bounds[::step])) - 1, F.lit(0))
    return F.when(key.isNull(), F.lit(0)).otherwise(block * step + below(F.slice(literal(bounds), block * step + 1, step)))


def changes_after(changes: DataFrame, marks: Marks, key: str, order: tuple[str, ...] = IDENTITY) -> DataFrame:
    """The changes that the copy can't hold: those after the `low` of their key's chunk."""
    lows = F.array(*[F.lit(v).cast("decimal(38,0)") for v in marks.low])
    chunk = chunk_of(F.col(key), marks.bounds, changes.schema[key].dataType)
    return changes.where(order_key(order) > F.element_at(lows, chunk + 1))


def handed_over(spark: SparkSession, target: str, changes: DataFrame, *, keys: list[str], order: tuple[str, ...] = IDENTITY,
                op_col: str | None = None, present_col: str | None = None) -> DataFrame:
    """The copied table brought up to the end of `changes` (flattened, see `cdc_flatten`): one row per key.

    `keys[0]` is the key of the chunks. The changes have to reach at least
    the newest `high` of the copy: a shorter log would leave rows of different
    moments side by side.
    """
    marks = read_marks(spark, target)
    reached = newest_position(changes, order)
    if reached < max(marks.high):
        raise ValueError(f"the log ends at {reached}, before the copy's end at {max(marks.high)}")
    return cdc_compact(copied_rows(spark, target), changes_after(changes, marks, keys[0], order), keys, order, op_col, present_col=present_col)
