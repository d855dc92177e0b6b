"""Keep an analytic copy current from a change log (Structured Streaming).

    change files --file source--> foreachBatch:
        records of the table  -> drop repeats, judge the cells
                                   good   -> flatten -> copy
                                   others -> rejects, with the reason
        records of tables that aren't known -> report, whole records

Each of the three outputs is a folder tree
<path>/seg_group=<g>/run_id=<r>/batch_id=<n>, keyed by the records' identity.

Exactly-once without a transactional sink, for every output:

* The file source records taken files in the checkpoint; a restart resumes.
* A record delivered again (same file twice, a replayed segment, files in any
  order) has an identity already seen: it is dropped inside the batch and
  against what the output holds, so nothing is lost, repeated or counted twice.
* A retried batch (failure after the write, before the commit) runs with the
  same batch id and overwrites its own folders; those are left out of the
  "already present" check, so the retry rewrites the same rows.
* `run_id` is stored in the checkpoint folder: a new checkpoint restarts batch
  ids at 0 and gets a new run id, so it never overwrites an older run's rows.

Scale: `seg_group = segment div segments_per_folder` (segment ids grow with
time, so one group holds consecutive segments). The number is kept with the copy;
another one is refused, as it would look for old records in the wrong folders.
The "already present" check opens only the folders of the groups that the batch
touches: neither listing nor reading grows with the stream's other batches.
`fold` puts finished batch folders into larger files behind a pointer that is replaced in one step
(`sinks.generations`), so a group's listing doesn't grow with its age either.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from livetables.operators.changes import cdc_flatten, cdc_replay_guard, cdc_split, cdc_target, cdc_unknown
from livetables.sinks import generations
from livetables.sources.changelog import IDENTITY, cdc_stream

# Consecutive segments sharing one folder of the copy.
SEGMENTS_PER_FOLDER = 1024

#: Known tables: a frame or list of (keyspace_name, table_name), or a function that
#: returns one and is asked again for every batch.
KnownTables = DataFrame | list[tuple] | Callable[[], DataFrame | list[tuple]]


def _path(spark: SparkSession, path: str):
    """A path and its file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop, fs = _path(spark, path)
    return fs.exists(hadoop)


def _marker(spark: SparkSession, path: str, value: str) -> str:
    """The text kept at `path`, written there on the first call."""
    if not path_exists(spark, path):
        spark.createDataFrame([(value,)], "value string").coalesce(1).write.text(path)
    return spark.read.text(path).first()[0]


def run_id_for(spark: SparkSession, checkpoint: str) -> str:
    """The run id kept next to the stream's checkpoint (created once)."""
    # a letter first: partition discovery must read it as text, never as a number
    return _marker(spark, f"{checkpoint.rstrip('/')}/_run_id", "r" + uuid.uuid4().hex[:16])


def keep_layout(spark: SparkSession, target_path: str, segments_per_folder: int) -> None:
    """Keep the folder layout with the copy; refuse another one."""
    kept = int(_marker(spark, f"{target_path.rstrip('/')}/_segments_per_folder", str(segments_per_folder)))
    if kept != segments_per_folder:
        raise ValueError(f"{target_path} has {kept} segments per folder, not {segments_per_folder}")


def batch_folder(target_path: str, run_id: str, batch_id: int) -> str:
    """Folder of one batch's output (used by the JSON feed)."""
    return f"{target_path.rstrip('/')}/run_id={run_id}/batch_id={batch_id}"


BOOKKEEPING = ("seg_group", "run_id", "batch_id")


def folded_path(target_path: str) -> str:
    """Where the folded batches of an output are kept (see `fold`); hidden from a reader of the output's folders."""
    return f"{target_path.rstrip('/')}/_folded"


def _batches(spark: SparkSession, path: str) -> list[tuple[str, str, int]]:
    """(seg_group folder, run id, batch id) of the batch folders at `path`."""
    hadoop, fs = _path(spark, path)
    found = fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(hadoop, "seg_group=*/run_id=*/batch_id=*"))
    out = []
    for status in found or []:
        group, run, batch = str(status.getPath().toString()).split("/")[-3:]
        out.append((group, run.removeprefix("run_id="), int(batch.removeprefix("batch_id="))))
    return out


def _folded(spark: SparkSession, target_path: str) -> tuple[int | None, dict[str, int]]:
    """(current generation, last folded batch per run)."""
    number = generations.current(spark, folded_path(target_path))
    return number, generations.note(spark, folded_path(target_path), number)["folded"] if number is not None else {}


def read_copy(spark: SparkSession, target_path: str, bookkeeping: bool = False) -> DataFrame:
    """The synced rows (bookkeeping partition columns dropped): the folded ones and the batches since.

    The generation of folded rows is taken once; batches that it holds are not
    read again, whether or not their folders are still there.
    """
    number, folded = _folded(spark, target_path)
    if number is None:
        rows = spark.read.parquet(target_path)
        return rows if bookkeeping else rows.drop(*BOOKKEEPING)
    rows = generations.read_generation(spark, folded_path(target_path), number)
    later = sorted({f"{target_path.rstrip('/')}/{g}/run_id={run}/batch_id={batch}" for g, run, batch in _batches(spark, target_path)
                    if batch > folded.get(run, -1)})
    if later:
        new = spark.read.schema(rows.schema).option("basePath", target_path).parquet(*later)
        rows = rows.unionByName(new)
    return rows if bookkeeping else rows.drop(*BOOKKEEPING)


def fold(spark: SparkSession, target_path: str, *, upto: dict[str, int] | None = None, keep: int = 2) -> int | None:
    """Fold the batch folders of an output into its next generation; its number, or None if there is nothing to fold.

    Takes, per run, the batches up to `upto` (by default all but the run's
    newest, which a retry might still write). Only they are read and written: earlier folded files are
    listed again as they are. Readers see the change in one step. Folders whose rows every kept
    generation (`keep`) holds are removed, so neither listing nor lookup grows with the number of batches;
    a read has to end before `keep` more folds are made.
    """
    root, store = target_path.rstrip("/"), folded_path(target_path)
    there = _batches(spark, target_path)
    number, folded = _folded(spark, target_path)
    if upto is None:
        newest: dict[str, int] = {}
        for _, run, batch in there:
            newest[run] = max(newest.get(run, -1), batch)
        upto = {run: batch - 1 for run, batch in newest.items()}
    upto = {run: max(batch, folded.get(run, -1)) for run, batch in upto.items()}
    todo = [(g, run, batch) for g, run, batch in there if folded.get(run, -1) < batch <= upto.get(run, -1)]
    published = None
    if todo:
        rows = spark.read.option("basePath", root).parquet(*[f"{root}/{g}/run_id={run}/batch_id={batch}" for g, run, batch in todo])
        rows = rows.select(*[c for c in rows.columns if c not in BOOKKEEPING], F.col("seg_group").cast("bigint"),
                           F.col("run_id").cast("string"), F.col("batch_id").cast("bigint"))
        folder = generations.new_folder(store)
        # one folder per group, as the lookup of known records opens folders by group
        out = rows.withColumn("group", F.col("seg_group")).hint("rebalance", "group")
        out.write.partitionBy("group").parquet(folder)
        names = T.StructType(rows.schema.fields)
        listed = (spark.read.schema(names).parquet(folder).groupBy(generations.file_name().alias("file"))
                  .agg(F.count(F.lit(1)).alias("rows"), F.first("seg_group").alias("seg_group")))
        if number is not None:
            listed = listed.unionByName(generations.manifest(spark, store, number))
        published = generations.publish(spark, store, listed, names, number, writer="fold", notes={"folded": {**folded, **upto}})
    now = generations.current(spark, store)
    if now is not None and now - keep + 1 >= 0:
        held = generations.note(spark, store, now - keep + 1)["folded"]
        hadoop, fs = _path(spark, root)
        for g, run, batch in there:
            if batch <= held.get(run, -1):
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{g}/run_id={run}/batch_id={batch}"), True)
        generations.remove_old(spark, store, keep)
    return published


def unknown_tables_report(spark: SparkSession, report_path: str,
                          by: tuple[str, ...] = ("keyspace_name", "table_name")) -> DataFrame:
    """Each unknown table once, with its record count over all batches."""
    return (spark.read.parquet(report_path).where("unknown").groupBy(*by)
            .agg(F.count(F.lit(1)).alias("n")))


def _seg_group(segment: str, segments_per_folder: int):
    return F.floor(F.col(segment) / F.lit(segments_per_folder)).cast("bigint")


def unseen(batch: DataFrame, path: str, run_id: str, batch_id: int, identity: tuple[str, ...],
           segments_per_folder: int) -> DataFrame:
    """The batch's records whose identity isn't in the output at `path` (this batch's own folders aside)."""
    spark = batch.sparkSession
    hadoop, fs = _path(spark, path)
    if not fs.exists(hadoop):
        return batch
    there = {s.getPath().getName() for s in fs.listStatus(hadoop)}
    # few numbers: a batch holds consecutive segments
    groups = [r.g for r in batch.select(_seg_group(identity[0], segments_per_folder).alias("g")).distinct().collect()]
    folders = [f"{path.rstrip('/')}/seg_group={g}" for g in groups if f"seg_group={g}" in there]
    own = (F.col("run_id") == run_id) & (F.col("batch_id") == batch_id)
    keys = T.StructType([batch.schema[c] for c in identity])
    schema = T.StructType(keys.fields).add("run_id", T.StringType()).add("batch_id", T.LongType())
    number, _ = _folded(spark, path)
    if number is not None and groups:
        # a group's folded files; rows folded from folders that are still there are merely found twice
        store = folded_path(path)
        files = [r["file"] for r in generations.manifest(spark, store, number).where(F.col("seg_group").isin(groups)).select("file").collect()]
        if files:
            batch = batch.join(generations.read_files(spark, store, files, keys), list(identity), "left_anti")
    if not folders:
        return batch
    old = spark.read.schema(schema).option("basePath", path).parquet(*folders).where(~own).select(*identity)
    return batch.join(old, list(identity), "left_anti")


def cdc_append(rows: DataFrame, target_path: str, run_id: str, batch_id: int,
               segment: str = "segment", segments_per_folder: int = SEGMENTS_PER_FOLDER) -> None:
    """Append one batch of rows to an output in one bulk write.

    Dynamic partition overwrite replaces only this batch's folders
    (seg_group=*/run_id=<r>/batch_id=<n>), so a retried batch rewrites
    exactly what it wrote before and never adds rows twice.
    """
    out = rows.select("*", _seg_group(segment, segments_per_folder).alias("seg_group"),
                      F.lit(run_id).alias("run_id"), F.lit(batch_id).cast("bigint").alias("batch_id"))
    # one task per folder (AQE splits a large one), not one file per task per folder
    out = out.hint("rebalance", "seg_group")
    (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*BOOKKEEPING).parquet(target_path))


def sync_batch(batch: DataFrame, batch_id: int, *, target_path: str, run_id: str,
               cells_schema: str, reject_path: str, identity: tuple[str, ...] = IDENTITY,
               report_path: str | None = None, known_tables: KnownTables | None = None,
               keyspace: str | None = None, table: str | None = None, keep_others: bool = False,
               segments_per_folder: int = SEGMENTS_PER_FOLDER) -> None:
    """Apply one micro-batch of change records to the outputs (idempotent).

    With `keep_others` every record of another table goes to the report, marked
    `unknown` or not, so that no record of the batch is only in the log.
    """
    place = dict(run_id=run_id, batch_id=batch_id, segments_per_folder=segments_per_folder)
    batch = cdc_replay_guard(batch).persist()
    fresh = None
    try:
        if report_path is not None and known_tables is not None:
            known = known_tables() if callable(known_tables) else known_tables
            others = cdc_unknown(batch, known).withColumn("unknown", F.lit(True))
            if keep_others:
                told = batch.join(others.select(*identity, "unknown"), list(identity), "left").where(
                    F.col("unknown").isNotNull() | ~_is_table(keyspace, table))
                others = told.select(*batch.columns, F.coalesce("unknown", F.lit(False)).alias("unknown"))
            cdc_append(unseen(others, report_path, identity=identity, **place), report_path, segment=identity[0], **place)
        rows = batch if keyspace is None else cdc_target(batch, keyspace, table)
        good, rejects = cdc_split(rows, cells_schema, keep_parsed=True)
        cdc_append(unseen(rejects, reject_path, identity=identity, **place), reject_path, segment=identity[0], **place)
        fresh = unseen(good, target_path, identity=identity, **place).persist()
        if not fresh.isEmpty():
            # already judged: no second check of the cells
            flat = cdc_flatten(fresh, cells_schema, keep=identity, strict=False)
            cdc_append(flat, target_path, segment=identity[0], **place)
    finally:
        if fresh is not None:
            fresh.unpersist()
        batch.unpersist()


def _is_table(keyspace: str, table: str):
    return F.coalesce((F.lower("keyspace_name") == keyspace.lower()) & (F.lower("table_name") == table.lower()), F.lit(False))


def cdc_sync(spark: SparkSession, log_dir: str, target_path: str, checkpoint: str, *,
             log_schema: str, cells_schema: str, keyspace: str, table: str, reject_path: str,
             fmt: str = "parquet", trigger_seconds: float = 5.0, available_now: bool = False,
             max_files_per_trigger: int | None = None, report_path: str | None = None,
             known_tables: KnownTables | None = None,
             segments_per_folder: int = SEGMENTS_PER_FOLDER,
             clean_source: str | None = None,
             source_archive_dir: str | None = None) -> StreamingQuery:
    """Start the sync stream. `available_now=True` takes what is there and stops.

    Records that don't fit the table go to `reject_path` with a reason. With
    `report_path` and `known_tables` records of tables not in the list go to
    `report_path` (see `unknown_tables_report`); a function as `known_tables`
    is asked again for every batch, so tables that were made meanwhile count.
    `clean_source="delete"` (or "archive" with `source_archive_dir`) removes
    change files once the batch that read them is committed. "delete" needs a
    report: then records of all other tables are kept there, and what a file
    held is in the copy, the rejects or the report before the file goes.
    """
    if clean_source == "delete" and (report_path is None or known_tables is None):
        raise ValueError("clean_source='delete' loses the records of other tables without report_path and known_tables")
    keep_layout(spark, target_path, segments_per_folder)
    run_id = run_id_for(spark, checkpoint)
    src = cdc_stream(spark, log_dir, log_schema, fmt, max_files_per_trigger,
                     clean_source=clean_source, source_archive_dir=source_archive_dir)
    if report_path is None:
        # Without a report only the target table matters: filter before the batch.
        src = cdc_target(src, keyspace, table)

    def handle(batch: DataFrame, batch_id: int) -> None:
        sync_batch(batch, batch_id, target_path=target_path, run_id=run_id,
                   cells_schema=cells_schema, reject_path=reject_path, report_path=report_path,
                   known_tables=known_tables, keyspace=keyspace, table=table,
                   keep_others=clean_source == "delete", segments_per_folder=segments_per_folder)

    writer = src.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=f"{trigger_seconds} seconds"))
    return writer.start()
