"""Rollups kept current under a feed: mergeable partial results per day and group, merged batch by batch.

A rollup's state is a table with one row per (day, group): the last value with
its order, exact sums and counts, greatest values. All of them can be merged, so a
batch is reduced to its own partial results first (one shuffle of partials) and then
merged with the state of the days that it touches, whose files alone are read and written
again; the other days' files are listed as they are (`sinks.generations`). A batch's
work is bounded by its rows and by the groups of its days, however long the feed has run.

Exactly once: the number of the last batch is kept with the generation that holds it, and both
appear in one step. A batch that is tried again is merged again, from the same
state, if its generation didn't appear, and left out if it did. Readers see whole batches.

Rows are expected once each (sums would count a repeated row twice): behind a replay
guard, or from the copy of a change feed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from livetables.sinks import generations
from livetables.streaming.cdc_sync import run_id_for

#: Name of the state's day column.
DAY = "day"


@dataclass(frozen=True)
class Last:
    """The value of the row with the greatest order, which one row of a group has (an event's id, say)."""

    value: str
    order: str

    def partial(self, name: str) -> dict[str, Column]:
        return {name: F.max_by(self.value, self.order), f"{name}__at": F.max(self.order)}

    def merge(self, name: str) -> dict[str, Column]:
        return {name: F.max_by(name, f"{name}__at"), f"{name}__at": F.max(f"{name}__at")}


@dataclass(frozen=True)
class Total:
    """An exact sum (decimal with `scale` digits after the point) and the number of values; their quotient is the average."""

    value: str
    scale: int = 2

    def partial(self, name: str) -> dict[str, Column]:
        return {name: F.sum(F.col(self.value).cast(f"decimal({18 + self.scale},{self.scale})")).cast(f"decimal(38,{self.scale})"),
                f"{name}__n": F.count(self.value)}

    def merge(self, name: str) -> dict[str, Column]:
        return {name: F.sum(name).cast(f"decimal(38,{self.scale})"), f"{name}__n": F.sum(f"{name}__n")}


@dataclass(frozen=True)
class Greatest:
    value: str

    def partial(self, name: str) -> dict[str, Column]:
        return {name: F.max(self.value)}

    def merge(self, name: str) -> dict[str, Column]:
        return {name: F.max(name)}


Measures = dict[str, Last | Total | Greatest]


def partials(rows: DataFrame, day: Column, keys: list[str], measures: Measures) -> DataFrame:
    """day, keys and the measures' partial results."""
    made = [c.alias(n) for name, m in measures.items() for n, c in m.partial(name).items()]
    return rows.withColumn(DAY, day.cast("date")).groupBy(DAY, *keys).agg(*made)


def merged(parts: DataFrame, keys: list[str], measures: Measures) -> DataFrame:
    """Partial results of the same groups made one."""
    made = [c.alias(n) for name, m in measures.items() for n, c in m.merge(name).items()]
    return parts.groupBy(DAY, *keys).agg(*made)


def merge_batch(batch: DataFrame, batch_id: int, *, path: str, run_id: str, day: Column, keys: list[str], measures: Measures,
                keep: int = 2) -> int | None:
    """Merge one batch into the state at `path`; the files of earlier state read, or None for a batch that is there already."""
    spark = batch.sparkSession
    number = generations.current(spark, path)
    done = generations.note(spark, path, number)["batches"] if number is not None else {}
    if batch_id <= done.get(run_id, -1):
        return None
    new = partials(batch, day, keys, measures).persist()
    try:
        days = new.select(DAY).distinct()
        kept, old_files, state = None, [], new
        if number is not None:
            listed = generations.manifest(spark, path, number)
            old_files = [r["file"] for r in listed.join(days, listed[DAY].eqNullSafe(days[DAY]), "left_semi").select("file").collect()]   # of the batch's days
            kept = listed.join(spark.createDataFrame([(f,) for f in old_files], "file string"), "file", "left_anti")
            state = new.unionByName(generations.read_files(spark, path, old_files, new.schema))
        rows = merged(state, keys, measures)
        rows = rows.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in new.schema.fields])
        folder = generations.new_folder(path)
        # files hold one day each
        rows.withColumn("of", F.coalesce(F.col(DAY).cast("string"), F.lit("none"))).hint("rebalance", "of").write.partitionBy("of").parquet(folder)
        added = (spark.read.schema(new.schema).parquet(folder).groupBy(generations.file_name().alias("file"))
                 .agg(F.first(DAY).alias(DAY), F.count(F.lit(1)).alias("rows")))
        added = added.select("file", DAY, "rows")
        generations.publish(spark, path, added if kept is None else kept.select("file", DAY, "rows").unionByName(added), new.schema, number,
                            writer=run_id, notes={"batches": {**done, run_id: batch_id}})
        generations.remove_old(spark, path, keep)
        return len(old_files)
    finally:
        new.unpersist()


def live_rollup(spark: SparkSession, rows: DataFrame, path: str, checkpoint: str, *, day: Column, keys: list[str], measures: Measures,
                trigger_seconds: float = 5.0, available_now: bool = False) -> StreamingQuery:
    """Keep a rollup of a stream's rows at `path` (see `read_rollup`)."""
    run_id = run_id_for(spark, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if not batch.isEmpty():
            merge_batch(batch, batch_id, path=path, run_id=run_id, day=day, keys=keys, measures=measures)
    writer = rows.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=f"{trigger_seconds} seconds"))
    return writer.start()


def read_rollup(spark: SparkSession, path: str, day: str | None = None) -> DataFrame:
    """The state: day, keys, and per measure its value (`x`, and `x__at` or `x__n`); of one day only that day's files are read."""
    number = generations.current(spark, path)
    if number is None or day is None:
        return generations.read_generation(spark, path, number)
    files = [r["file"] for r in generations.manifest(spark, path, number).where(F.col(DAY) == F.lit(day).cast("date")).select("file").collect()]
    return generations.read_files(spark, path, files, T.StructType.fromJson(generations.note(spark, path, number)["schema"]))
