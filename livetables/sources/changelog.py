"""Change-log records: layout, reader (batch and stream) and writer.

A change record is one changed row of one table, as captured from a store's
commit log:

  segment   bigint   log segment id (a commit-log file)
  position  bigint   entry position inside the segment
  row_no    int      row number inside the entry (one entry can change many rows)
  keyspace_name, table_name  string
  pk        struct   partition-key columns
  ck        struct   clustering-key columns
  cells     string   the changed simple cells as a JSON object
  op        string   optional: 'upsert' / 'delete' (used by compaction only)

(segment, position, row_no) identifies a record; a replayed or re-delivered
file repeats identities, never invents new ones. The binary commit-log
decoder itself is not rebuilt: change files are read as Parquet or JSON.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from livetables.sources.tables import TS_FORMAT, TS_NTZ_FORMAT

IDENTITY = ("segment", "position", "row_no")

# JSON options so timestamps keep all six fraction digits on a round trip.
JSON_OPTIONS = {"timestampNTZFormat": TS_NTZ_FORMAT, "timestampFormat": TS_FORMAT}


def change_log_schema(pk_ddl: str, ck_ddl: str, with_op: bool = False) -> str:
    """DDL of the change-log layout for the given key structs."""
    ddl = (f"segment bigint, position bigint, row_no int, keyspace_name string, "
           f"table_name string, pk struct<{pk_ddl}>, ck struct<{ck_ddl}>, cells string")
    return ddl + (", op string" if with_op else "")


def change_log_from_rows(rows: DataFrame, *, keyspace: str | Column, table: str | Column,
                         pk: list[str], ck: list[str], segment: Column, position: Column,
                         row_no: Column | None = None, op: Column | None = None) -> DataFrame:
    """Write rows of a keyed table as change records (what a capture would emit).

    Every non-key column becomes a cell of the `cells` JSON object.
    """
    keyset = set(pk) | set(ck)
    cells = [c for c in rows.columns if c not in keyset]
    as_col = (lambda v: F.lit(v) if isinstance(v, str) else v)
    cols = [
        segment.cast("bigint").alias("segment"),
        position.cast("bigint").alias("position"),
        (row_no if row_no is not None else F.lit(0)).cast("int").alias("row_no"),
        as_col(keyspace).alias("keyspace_name"),
        as_col(table).alias("table_name"),
        F.struct(*pk).alias("pk"),
        F.struct(*ck).alias("ck"),
        F.to_json(F.struct(*cells), JSON_OPTIONS).alias("cells"),
    ]
    if op is not None:
        cols.append(op.alias("op"))
    return rows.select(*cols)


def cdc_read(spark: SparkSession, path: str, schema: str, fmt: str = "parquet") -> DataFrame:
    """Batch read of every change file under `path`."""
    return spark.read.schema(schema).options(**JSON_OPTIONS).format(fmt).load(path)


def cdc_stream(spark: SparkSession, path: str, schema: str, fmt: str = "parquet",
               max_files_per_trigger: int | None = None,
               clean_source: str | None = None, source_archive_dir: str | None = None) -> DataFrame:
    """Streaming read of change files arriving under `path`.

    The file source records which files it has taken in the checkpoint, so a
    restart resumes instead of reading everything again. `clean_source=
    'delete'` removes files once a batch using them is committed (the
    overflow folder's delete-after-read).
    """
    reader = spark.readStream.schema(schema).options(**JSON_OPTIONS).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    if clean_source:
        reader = reader.option("cleanSource", clean_source)
        if source_archive_dir:
            reader = reader.option("sourceArchiveDir", source_archive_dir)
    return reader.load(path)
