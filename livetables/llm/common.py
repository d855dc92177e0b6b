"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import livetables
from livetables.session import scratch_path, session_key

_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


#: Rows of an Arrow batch. Spark's default suits narrow rows; 10,000 whole texts, or blocks
#: of vectors, take hundreds of MB in the executor and again in its Python worker.
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "128"


def ship_package(spark: SparkSession) -> None:
    """Make a session ready for Python workers that handle whole texts.

    They get this package, once per application (as --py-files would), and small
    Arrow batches, unless the session has its own setting for those.
    """
    if spark.conf.get(_BATCH[0]) == _BATCH[1]:
        spark.conf.set(_BATCH[0], _BATCH[2])
    key = session_key(spark)
    if key not in _SHIPPED:
        folder = tempfile.TemporaryDirectory()
        top = os.path.dirname(os.path.dirname(os.path.abspath(livetables.__file__)))
        spark.sparkContext.addPyFile(shutil.make_archive(f"{folder.name}/livetables", "zip", top, "livetables"))
        _SHIPPED[key] = folder           # Spark serves the file as long as the application runs


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A whole input table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """`df` as a table written to the shared scratch folder and read again.

    Cuts the lineage: a lost executor costs no recomputation of what is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bits of the table that `likely` broadcasts: 512 rows of 4 KB, whatever the input.
_LIKELY_BITS = 1 << 24


def likely(df: DataFrame, id_col: str, ids: DataFrame) -> DataFrame:
    """`df` without most rows whose id isn't in `ids` (one column): a cheap step before a join on the id.

    The ids' hashes are marked in a bit table of fixed size (2 MB), which is
    broadcast. Rows that are in `ids` always pass; with very many ids most others
    pass too, and the join that follows does all the work.
    """
    place = F.pmod(F.xxhash64(F.col(ids.columns[0])), F.lit(_LIKELY_BITS)).cast("long")
    # dealt out by bucket first: what is shuffled is a narrow row for each id, not a 4 KB row for each bucket and task
    marks = (ids.select(F.bitmap_bucket_number(place).alias("__bucket"), F.bitmap_bit_position(place).alias("p"))
             .repartition("__bucket").groupBy("__bucket").agg(F.bitmap_construct_agg("p").alias("__bits")))
    own = F.pmod(F.xxhash64(F.col(id_col)), F.lit(_LIKELY_BITS)).cast("long")
    bit = F.bitmap_bit_position(own)
    byte = F.conv(F.hex(F.substring("__bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.element_at(F.array(*[F.lit(1 << i) for i in range(8)]), (bit % 8 + 1).cast("int"))) != 0
    return (df.withColumn("__own", F.bitmap_bucket_number(own))
            .join(F.broadcast(marks), F.col("__own") == F.col("__bucket")).where(hit).select(*df.columns))


def give_back() -> None:
    """Hand memory that Python has freed back to the system, where the C library can do so.

    Small freed objects otherwise stay with the process, beside what the JVM takes in later steps; so does what Arrow holds ready.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def giving_back(batches: Iterator) -> Iterator:
    """A task's batches; behind the last one `give_back` leaves the worker, which is used again, no larger than it need be."""
    yield from batches
    give_back()


def col(name: str) -> Column:
    """A column by its exact name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_or_empty(name: str) -> Column:
    """A text column; null counts as the empty text."""
    return F.coalesce(col(name).cast("string"), F.lit(""))


def hex_sha256(c: Column) -> Column:
    return F.sha2(c.cast("binary"), 256)
