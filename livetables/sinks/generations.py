"""A base table as numbered generations of immutable files, behind one pointer.

    <path>/data/<id>/...          files, written once and never changed
    <path>/generations/<n>/       the files of generation n, one or more rows per file (Parquet)
    <path>/generations/<n>.note   what its writer keeps with it (JSON)
    <path>/CURRENT                the number of the current generation

A writer adds files, lists the next generation and then replaces the pointer by a
rename, which file systems do in one step. A reader takes the number once and reads that
generation's files, so it sees the old table or the new one, never both; files of the
newest `keep` generations are not removed, so it can go on reading meanwhile.

One writer at a time: the next number is claimed by creating a file that must not be
there. A second writer is refused; a writer that died is started again under its name.
"""

from __future__ import annotations

import json
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@contextmanager
def _files(spark: SparkSession, path: str):
    """(a file system of its own for `path`, a maker of its paths)."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    fs = spark._jvm.org.apache.hadoop.fs.FileSystem.newInstance(make(path).toUri(), conf)
    fs.setWriteChecksum(False)            # a checksum beside the pointer could not be replaced in the same step
    try:
        yield fs, make
    finally:
        fs.close()


def _read(fs, file) -> str:
    stream = fs.open(file)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def _write(fs, file, text: str, overwrite: bool = False) -> None:
    stream = fs.create(file, overwrite)
    stream.write(bytearray(text.encode()))
    stream.close()


def current(spark: SparkSession, path: str) -> int | None:
    """The number of the current generation; None before the first."""
    with _files(spark, path) as (fs, make):
        pointer = make(f"{path}/CURRENT")
        return int(_read(fs, pointer)) if fs.exists(pointer) else None


def note(spark: SparkSession, path: str, number: int) -> dict:
    with _files(spark, path) as (fs, make):
        return json.loads(_read(fs, make(f"{path}/generations/{number}.note")))


def manifest(spark: SparkSession, path: str, number: int) -> DataFrame:
    """The rows that list a generation's files; column `file` is the place below `path`."""
    return spark.read.parquet(f"{path}/generations/{number}")


def new_folder(path: str) -> str:
    """A folder for new files."""
    return f"{path}/data/{uuid.uuid4().hex}"


def file_name() -> Column:
    """Of a row read from the table's files: the file's place below the table's path."""
    return F.regexp_extract(F.col("_metadata.file_path"), r"(data/[0-9a-f]{32}/.*)$", 1)


def read_files(spark: SparkSession, path: str, files: list[str], schema: T.StructType) -> DataFrame:
    """The rows of some files; folder names in their paths are columns if the schema has them."""
    if not files:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{f}" for f in files])


def read_generation(spark: SparkSession, path: str, number: int | None = None) -> DataFrame:
    """The table as of a generation (the current one, taken once)."""
    number = current(spark, path) if number is None else number
    if number is None:
        raise ValueError(f"{path} has no generation yet")
    # as many names as files: what Spark's own listing of a folder holds too
    files = [r["file"] for r in manifest(spark, path, number).select("file").distinct().collect()]
    return read_files(spark, path, files, T.StructType.fromJson(note(spark, path, number)["schema"]))


def publish(spark: SparkSession, path: str, listed: DataFrame, schema: T.StructType, expected: int | None, *,
            writer: str = "writer", notes: dict | None = None) -> int:
    """Make `listed` (see `manifest`) the generation after `expected`; its number."""
    number = 0 if expected is None else expected + 1
    with _files(spark, path) as (fs, make):
        claim = make(f"{path}/generations/{number}.claim")
        if fs.exists(claim):
            owner = _read(fs, claim)
            if owner != writer:
                raise ValueError(f"generation {number} of {path} is being written by {owner}")
        else:
            _write(fs, claim, writer)                     # fails if another writer was faster
        now = current(spark, path)
        if now != expected:
            raise ValueError(f"{path} is at generation {now}, not {expected}")
        listed.write.mode("overwrite").parquet(f"{path}/generations/{number}")
        _write(fs, make(f"{path}/generations/{number}.note"), json.dumps({"schema": schema.jsonValue(), **(notes or {})}), overwrite=True)
        fresh = make(f"{path}/CURRENT.{uuid.uuid4().hex}")
        _write(fs, fresh, str(number))
        jvm = spark._jvm
        options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(make(path).toUri(), spark._jsc.hadoopConfiguration())
        context.rename(fresh, make(f"{path}/CURRENT"), options)
    return number


def remove_old(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Remove the files that only generations before the newest `keep` list, and those lists; the files removed."""
    now = current(spark, path)
    if now is None:
        return []
    with _files(spark, path) as (fs, make):
        old = [n for n in range(now - keep + 1) if fs.exists(make(f"{path}/generations/{n}"))]
        if not old:
            return []
        live = None
        for n in range(max(0, now - keep + 1), now + 1):
            own = manifest(spark, path, n).select("file")
            live = own if live is None else live.union(own)
        listed = manifest(spark, path, old[0]).select("file")
        for n in old[1:]:
            listed = listed.union(manifest(spark, path, n).select("file"))
        gone = [r["file"] for r in listed.distinct().join(live.distinct(), "file", "left_anti").collect()]
        for f in gone:
            fs.delete(make(f"{path}/{f}"), False)
        for n in old:
            fs.delete(make(f"{path}/generations/{n}"), True)
            for end in ("note", "claim"):
                fs.delete(make(f"{path}/generations/{n}.{end}"), False)
    return gone
