"""Compaction that rewrites only the files that hold a changed key.

A base (see `sinks.generations`) keeps an index of its files: per file the number of rows, the
least and greatest first key, and a bit for the hash of every key, 8 bits per
row in rows of 4 KB. Changed keys are looked up in it:

1. Files and keys are dealt into bins of the first key (at most `bins`, from the files' own least keys), so a key
   meets only the files whose range reaches its bin, and of each of these one row of bits.
   A file is a candidate if a key lies in its range and has its bit set.
2. The candidates' key columns, and nothing else of them, are read and joined with the
   changed keys: what is left holds a changed key for certain.
3. These files and the changes are merged by `cdc_compact` into new files; all other files stay as
   they are and are listed again. Keys that no file holds are in the new files too.

So the work follows the changes and the files that they touch, not the base; only
the index, about a byte per row, is read as a whole. The driver holds names of touched files and of
the bins' bounds. The new generation appears in one step.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetables.operators.changes import cdc_compact
from livetables.session import scratch_path
from livetables.sinks import generations
from livetables.sources.changelog import IDENTITY
from livetables.streaming.handover import chunk_of

_BLOCK = 1 << 15                 # bits of a row of the index
_BITS_PER_ROW = 8


@dataclass(frozen=True)
class Compacted:
    """What a compaction did: the new generation, files before it, candidates by the index, files rewritten."""

    generation: int
    files: int
    candidates: int
    rewritten: int


def _place(keys: list[str], blocks):
    return F.xxhash64(*keys).bitwiseAND(blocks * F.lit(_BLOCK) - 1)


def file_index(rows: DataFrame, keys: list[str]) -> DataFrame:
    """file, rows, nulls (in the first key), lo, hi, blocks, block, bits of the files that `rows` is read from."""
    read = rows.select(*keys, generations.file_name().alias("file"))
    sizes = read.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.count_if(F.col(keys[0]).isNull()).alias("nulls"),
                                     F.min(keys[0]).alias("lo"), F.max(keys[0]).alias("hi"))
    least = F.greatest(F.lit(1.0), F.col("rows") * _BITS_PER_ROW / _BLOCK)
    sizes = sizes.withColumn("blocks", F.pow(F.lit(2.0), F.ceil(F.log2(least))).cast("bigint"))
    place = _place(keys, F.col("blocks"))
    return (read.join(sizes, "file").select("file", "rows", "nulls", "lo", "hi", "blocks", F.shiftright(place, 15).alias("block"),
                                            place.bitwiseAND(F.lit(_BLOCK - 1)).alias("bit"))
            .groupBy("file", "rows", "nulls", "lo", "hi", "blocks", "block").agg(F.bitmap_construct_agg("bit").alias("bits")))


def write_base(df: DataFrame, path: str, keys: list[str], files: int | None = None) -> int:
    """Write `df` as the first generation, its files in ranges of the key; its number."""
    spark = df.sparkSession
    folder = generations.new_folder(path)
    ordered = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    ordered.write.parquet(folder)
    listed = file_index(spark.read.schema(df.schema).parquet(folder), keys)
    return generations.publish(spark, path, listed, df.schema, None)


def touched_files(spark: SparkSession, path: str, number: int, changed: DataFrame, keys: list[str], schema: T.StructType,
                  bins: int = 1024) -> tuple[list[str], list[str]]:
    """(candidates by the index, files that hold a changed key); `changed` holds the keys, once each."""
    index = generations.manifest(spark, path, number)
    kind = schema[keys[0]].dataType
    numeric = isinstance(kind, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType))
    files = index.select("file", "lo").distinct()
    bounds = (files.agg(F.percentile_approx("lo", [i / bins for i in range(1, bins)], 10 * bins)).first()[0] or []) if numeric else []
    bounds = sorted({b for b in bounds if b is not None})
    # a file is in the bins of its range, and in bin -1 if it holds null keys
    nothing = F.array().cast("array<int>")
    reach = F.when(F.col("lo").isNotNull(), F.sequence(chunk_of(F.col("lo"), bounds, kind), chunk_of(F.col("hi"), bounds, kind))).otherwise(nothing)
    listed = index.withColumn("bin", F.explode(F.concat(reach, F.when(F.col("nulls") > 0, F.array(F.lit(-1))).otherwise(nothing))))
    sizes = [r["blocks"] for r in index.select("blocks").distinct().collect()]         # powers of two
    if not sizes:
        return [], []
    wanted = changed.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    names = [f"__k{i}" for i in range(len(keys))]
    wanted = wanted.withColumn("blocks", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])))
    place = _place(names, F.col("blocks"))
    wanted = (wanted.withColumn("block", F.shiftright(place, 15)).withColumn("bit", place.bitwiseAND(F.lit(_BLOCK - 1)))
              .withColumn("bin", F.when(F.col("__k0").isNull(), F.lit(-1)).otherwise(chunk_of(F.col("__k0"), bounds, kind))))
    byte = F.conv(F.hex(F.substring("bits", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    met = wanted.join(listed, ["blocks", "block", "bin"]).where((F.col("bin") < 0) | F.col("__k0").between(F.col("lo"), F.col("hi")))
    hit = F.getbit(byte, (F.col("bit") % 8).cast("int")) == 1
    candidates = sorted(r["file"] for r in met.where(hit).select("file").distinct().collect())
    if not candidates:
        return [], []
    rows = generations.read_files(spark, path, candidates, schema).select(*keys, generations.file_name().alias("__file"))
    same = F.lit(True)
    renamed = changed.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    found = rows.join(renamed, same, "left_semi").select("__file").distinct().collect()
    return candidates, sorted(r["__file"] for r in found)


def cdc_compact_files(spark: SparkSession, path: str, changes: DataFrame, keys: list[str], order: tuple[str, ...] = IDENTITY,
                      op_col: str | None = None, present_col: str | None = None, *, writer: str = "compaction", bins: int = 1024) -> Compacted:
    """Merge flattened changes (see `cdc_compact`) into the base at `path` as its next generation."""
    number = generations.current(spark, path)
    if number is None:
        raise ValueError(f"{path} has no generation yet")
    schema = T.StructType.fromJson(generations.note(spark, path, number)["schema"])
    # the changes are read for their keys and then merged: written once
    staged = scratch_path(spark, "changes")
    changes.write.parquet(staged)
    changes = spark.read.schema(changes.schema).parquet(staged)
    index = generations.manifest(spark, path, number)
    before = index.select("file").distinct().count()
    candidates, touched = touched_files(spark, path, number, changes.select(*keys).distinct(), keys, schema, bins)
    merged = cdc_compact(generations.read_files(spark, path, touched, schema), changes, keys, order, op_col, present_col=present_col)
    folder = generations.new_folder(path)
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields]
    merged.select(*columns).repartitionByRange(*keys).write.parquet(folder)
    added = file_index(spark.read.schema(schema).parquet(folder), keys)
    kept = index.join(spark.createDataFrame([(f,) for f in touched], "file string"), "file", "left_anti").select(*added.columns)
    now = generations.publish(spark, path, kept.unionByName(added), schema, number, writer=writer)
    return Compacted(now, before, len(candidates), len(touched))
