"""Readers: named external tables, default-format loads, CSV, any connector."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# CSV and JSON cut timestamps to milliseconds by default; six fraction digits
# make a write/read round trip exact.
TS_NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def sql_string(value: str) -> str:
    """A Spark SQL string literal."""
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def quote_name(name: str) -> str:
    return ".".join(f"`{p.replace('`', '``')}`" for p in name.split("."))


# Text that stands for NULL in CSV files; an empty text is a quoted empty field.
CSV_NULL = "\\N"
# Options that writer and reader share, so that any text comes back as it was:
# every field quoted, quotes doubled, blanks kept, one line separator. A quoted
# field may hold line breaks, so a file can't be split: one task reads a file.
CSV_OPTIONS = {"nullValue": CSV_NULL, "emptyValue": "", "quote": '"', "escape": '"', "lineSep": "\n",
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
               "timestampNTZFormat": TS_NTZ_FORMAT, "timestampFormat": TS_FORMAT}


def _with_partitions(spark: SparkSession, name: str) -> DataFrame:
    """The table, its partition folders registered (a new table over such folders has none yet)."""
    if any(c.isPartition for c in spark.catalog.listColumns(name)):
        spark.catalog.recoverPartitions(name)
    return spark.table(name)


def external_table(spark: SparkSession, name: str, path: str, fmt: str = "parquet",
                   replace: bool = False, **options: str) -> DataFrame:
    """Register files at `path` as table `name` (unmanaged) and return it.

    Dropping the table later leaves the files in place.
    """
    if replace:
        spark.sql(f"DROP TABLE IF EXISTS {quote_name(name)}")
    spark.catalog.createTable(name, path=path, source=fmt, **options)
    return _with_partitions(spark, name)


def read_default(spark: SparkSession, path: str) -> DataFrame:
    """Load with the session's default format (`spark.sql.sources.default`)."""
    return spark.read.load(path)


def read_parquet(spark: SparkSession, *paths: str) -> DataFrame:
    return spark.read.parquet(*paths)


def read_format(spark: SparkSession, fmt: str, schema: str | None = None, **options: str) -> DataFrame:
    """Scan any Spark data source, e.g. a keyed remote store whose connector
    jar the user supplies: read_format(spark, "<format>", table=t, keyspace=k).
    """
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load()


def sql_external_table(spark: SparkSession, name: str, fmt: str, if_not_exists: bool = False,
                       **options: str) -> DataFrame:
    """`CREATE TABLE name USING fmt OPTIONS (...)`: a source registered in SQL."""
    opts = ", ".join(f"{quote_name(k)} {sql_string(v)}" for k, v in options.items())
    ine = "IF NOT EXISTS " if if_not_exists else ""
    spark.sql(f"CREATE TABLE {ine}{quote_name(name)} USING {fmt}"
              + (f" OPTIONS ({opts})" if opts else ""))
    return _with_partitions(spark, name)


def csv_import(spark: SparkSession, path: str, schema: str, header: bool = True,
               **options: str) -> DataFrame:
    """Read CSV with an explicit column list (no inference pass over the data).

    Reads what `csv_export` writes. For splittable reading of files without
    line breaks inside fields pass multiLine="false".
    """
    opts = {**CSV_OPTIONS, "header": str(header).lower(), "multiLine": "true", "mode": "FAILFAST"}
    opts.update(options)
    return spark.read.schema(schema).options(**opts).csv(path)


def csv_records(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """The records of CSV files as text (column `value`), line breaks in quoted fields included; files are split.
    With `header` the first record of each file is left out.

    A byte range of a file can't tell by itself whether it begins inside a quoted
    field. But quotes come in pairs, so it does if the number of quotes before it is odd:

    1. Lines are read by Spark's text source, which splits files; each line knows its file and range.
    2. The quotes of each range are counted (one narrow pass, one row per range), and a running
       sum over a file's ranges gives the parity at each range's start.
    3. Inside a range a running sum over its lines tells which lines begin a record; lines of a record are joined.
    4. What a range holds of a record that began before it is one fragment per range. Fragments are
       joined with the record's beginning in an exchange of their own.

    Windows and groups are a range's lines, so the size of a file doesn't matter; a
    record as large as several ranges is put together in one task, as it has to become one value.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"),
        F.monotonically_increasing_id().alias("line"))                     # ascends inside a range
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    ranges = lines.groupBy("file", "at").agg((F.sum(quotes) % 2).alias("odd"))
    before = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select(F.col("file").alias("__file"), F.col("at").alias("__at"),
                           (F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2).alias("inside"))
    own = Window.partitionBy("file", "at").orderBy("line").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "at").orderBy("line").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = lines.join(ranges, (F.col("file") == F.col("__file")) & (F.col("at") == F.col("__at"))).drop("__file", "__at")
    placed = placed.withColumn("begins", ((F.coalesce(F.sum(quotes).over(own), F.lit(0)) + F.col("inside")) % 2 == 0).cast("int"))
    numbered = placed.withColumn("record", F.sum("begins").over(upto))        # 0: of a record that began before the range

    def joined(column: str):
        parts = F.array_sort(F.collect_list(F.struct("line", column)))
        return F.array_join(F.transform(parts, lambda p: p[column]), "\n")
    records = numbered.groupBy("file", "at", "record").agg(joined("value").alias("value"), F.min("line").alias("line"))
    last = F.max("record").over(Window.partitionBy("file", "at"))
    records = (records.withColumn("open", (F.col("record") == last) & (F.col("record") > 0))
               .withColumn("first", (F.col("at") == 0) & (F.col("record") == 1) & F.lit(header)))
    # fragments go to the last record that began before them: the open one of the nearest earlier range that has any
    borders = records.where((F.col("record") == 0) | F.col("open"))
    back = Window.partitionBy("file").orderBy("at", "record")
    group = F.sum((F.col("record") > 0).cast("int")).over(back)
    ends = borders.select("file", "at", "record").withColumn("group", group)
    ends = ends.select(F.col("file").alias("__file"), F.col("at").alias("__at"), F.col("record").alias("__record"), "group")
    crossing = (borders.join(ends, (F.col("file") == F.col("__file")) & (F.col("at") == F.col("__at")) & (F.col("record") == F.col("__record")))
                .groupBy("file", "group").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "record", "value"))),
                                                                       lambda p: p["value"]), "\n").alias("value"), F.max("first").alias("first")))
    whole = records.where((F.col("record") > 0) & ~F.col("open")).select("value", "first")
    return whole.unionByName(crossing.select("value", "first")).where(~F.col("first")).select("value")


def csv_import_split(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Like `csv_import` of files with a header, but one file is read by many tasks (see `csv_records`)."""
    st = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    rows = csv_records(spark, path).where(F.col("value") != "")
    columns = ", ".join(f"{quote_name(f.name)} {f.dataType.simpleString()}" for f in st.fields)
    return rows.select(F.from_csv("value", columns, {**CSV_OPTIONS, "mode": "FAILFAST"}).alias("row")).select("row.*")
