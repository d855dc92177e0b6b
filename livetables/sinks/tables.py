"""DDL and writes: create, append (by name or position), CTAS, drop, save,
CSV export and the full bulk copy.

All tables are Parquet. A "partitioned" fact in the reference's sense (rows
spread by a key so joins and group-bys on it co-locate) is a Spark bucketed
table (`CLUSTERED BY (key) INTO n BUCKETS`), not Hive `PARTITIONED BY`, which
would make one folder per key value. A "replicated" dimension is an ordinary
table that the queries broadcast after a size check.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetables.operators.contracts import schema_ddl
from livetables.session import scratch_path
from livetables.sources.tables import CSV_NULL, CSV_OPTIONS, quote_name, sql_string

# Table property that records a bucket count given without a key.
BUCKETS_PROPERTY = "livetables.buckets"


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {quote_name(name)}")


def create_table(spark: SparkSession, name: str, schema: T.StructType | str, *,
                 fmt: str = "parquet", bucket_by: str | list[str] | None = None,
                 buckets: int | None = None, sort_by: str | list[str] | None = None,
                 partition_by: str | list[str] | None = None,
                 if_not_exists: bool = False, properties: dict[str, str] | None = None,
                 options: dict[str, str] | None = None) -> DataFrame:
    """Create an empty table from a schema and return it.

    * bucket_by + buckets: bucketed (co-located) fact.
    * buckets without a key: recorded as a table property only. Spark
      bucketing needs a key, and a fixed number of write tasks would cap the
      load's parallelism, so the number does not shape the write.
    * if_not_exists: the allow-existing flag; otherwise an existing table
      is an error.
    * options: of the format, for every write to the table (`compression`).
    """
    cols = schema if isinstance(schema, str) else schema_ddl(schema)
    clauses = [f"USING {fmt}"]
    if options:
        clauses.append("OPTIONS (" + ", ".join(f"{sql_string(k)} = {sql_string(v)}" for k, v in options.items()) + ")")
    if partition_by:
        pcols = [partition_by] if isinstance(partition_by, str) else list(partition_by)
        clauses.append("PARTITIONED BY (" + ", ".join(quote_name(c) for c in pcols) + ")")
    props = dict(properties or {})
    if bucket_by:
        bcols = [bucket_by] if isinstance(bucket_by, str) else list(bucket_by)
        if not buckets:
            raise ValueError("bucket_by needs a bucket count (see buckets_for)")
        n = buckets
        clause = "CLUSTERED BY (" + ", ".join(quote_name(c) for c in bcols) + ")"
        if sort_by:
            scols = [sort_by] if isinstance(sort_by, str) else list(sort_by)
            clause += " SORTED BY (" + ", ".join(quote_name(c) for c in scols) + ")"
        clauses.append(f"{clause} INTO {n} BUCKETS")
    elif buckets:
        props[BUCKETS_PROPERTY] = str(buckets)
    if props:
        clauses.append("TBLPROPERTIES (" + ", ".join(
            f"{sql_string(k)} = {sql_string(v)}" for k, v in props.items()) + ")")
    ine = "IF NOT EXISTS " if if_not_exists else ""
    spark.sql(f"CREATE TABLE {ine}{quote_name(name)} ({cols}) " + " ".join(clauses))
    return spark.table(name)


def bucket_spec(spark: SparkSession, name: str) -> tuple[list[str], int] | None:
    """(bucket columns, bucket count) of a table, or None if not bucketed."""
    info = {r["col_name"]: r["data_type"]
            for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(name)}").collect()}
    if "Num Buckets" not in info or not info.get("Bucket Columns"):
        return None
    cols = [c.strip().strip("`") for c in info["Bucket Columns"].strip("[]").split(",")]
    return cols, int(info["Num Buckets"])


def distribute_for_buckets(df: DataFrame, bucket_cols: list[str], buckets: int) -> DataFrame:
    """Shuffle rows so each write task holds one bucket (or a slice of one).

    Without this every input task writes up to one file per bucket. The
    REBALANCE hint with the bucket count hash-partitions on the bucket columns,
    so partition id and bucket id are the same Murmur3 hash modulo the count;
    AQE then splits partitions above the advisory size (a bucket holding a
    third of all rows is written by many tasks, one file each) and merges
    small neighbours. The hash is deterministic, so a retried task sends rows
    to the same place.
    """
    return df.hint("rebalance", buckets, *bucket_cols)


def append(df: DataFrame, name: str, by: str = "name") -> None:
    """Append rows to an existing table.

    by="name": columns are matched to the target by name (and reordered);
    by="position": the i-th column goes to the i-th target column whatever
    its name, as INSERT INTO does. Both go through insertInto, which also
    appends to bucketed tables (saveAsTable in append mode refuses a bucketed
    target without the same bucket spec).
    """
    spark = df.sparkSession
    target_cols = spark.table(name).columns
    if by == "name":
        lower = {c.lower(): c for c in df.columns}
        missing = [c for c in target_cols if c.lower() not in lower]
        if missing:
            raise ValueError(f"columns {missing} of {name} are not in the data")
        df = df.select(*[F.col(lower[c.lower()]).alias(c) for c in target_cols])
    elif by != "position":
        raise ValueError("by must be 'name' or 'position'")
    elif len(df.columns) != len(target_cols):
        raise ValueError(f"{len(df.columns)} columns for {len(target_cols)} in {name}")
    spec = bucket_spec(spark, name)
    if spec is not None:
        cols, n = spec
        if by == "position":
            df = df.toDF(*target_cols)
        df = distribute_for_buckets(df, cols, n)
    else:
        folders = [c.name for c in spark.catalog.listColumns(name) if c.isPartition]
        if folders:                  # one task per folder (AQE splits a large one), not a file per task and folder
            df = df.toDF(*target_cols).hint("rebalance", *folders)
    df.write.insertInto(name)


def analyze_rows(spark: SparkSession, name: str) -> int:
    """Compute table statistics (`ANALYZE TABLE`) and return the row count.

    The statistics stay in the catalog, where Catalyst's broadcast threshold
    reads the size.
    """
    spark.sql(f"ANALYZE TABLE {quote_name(name)} COMPUTE STATISTICS")
    rows = recorded_rows(spark, name)
    assert rows is not None
    return rows


def recorded_rows(spark: SparkSession, name: str) -> int | None:
    """Row count stored by ANALYZE TABLE, or None if never analyzed."""
    for r in spark.sql(f"DESCRIBE TABLE EXTENDED {quote_name(name)}").collect():
        if r["col_name"] == "Statistics":
            m = re.search(r"(\d+) rows", r["data_type"])
            return int(m.group(1)) if m else None
    return None


def replicated_table(spark: SparkSession, df: DataFrame, label: str = "dimension") -> DataFrame:
    """Write a (small) dimension once to the shared checkpoint folder and read it back.

    Spark then knows its bytes, so joins with it are broadcast if it is small.
    Writing it also cuts its lineage: an expensive derivation is not re-run.
    """
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.parquet(path)


def ctas(spark: SparkSession, name: str, select_sql: str, fmt: str = "parquet") -> DataFrame:
    """`CREATE TABLE name USING fmt AS <select>`."""
    spark.sql(f"CREATE TABLE {quote_name(name)} USING {fmt} AS {select_sql}")
    return spark.table(name)


def save_dir(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> None:
    """Write to a folder; by default fail if it exists."""
    df.write.format(fmt).mode(mode).save(path)


def csv_export(df: DataFrame, path: str, header: bool = True, single_file: bool = False,
               mode: str = "errorifexists") -> None:
    """CSV with header and microsecond timestamps that `csv_import` reads back exactly.

    A text equal to the NULL marker fails the write rather than come back as
    NULL. `single_file=True` funnels all rows through one task (as the one-file
    export in the reference); keep it for small outputs only.
    """
    texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    df = df.select(*[F.when(F.col(f"`{c}`") == CSV_NULL, F.raise_error(F.lit(f"the NULL marker as text in {c}")))
                     .otherwise(F.col(f"`{c}`")).alias(c) if c in texts else F.col(f"`{c}`") for c in df.columns])
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).options(**CSV_OPTIONS, header=str(header).lower(), quoteAll="true").csv(path)


def buckets_for(rows: int, per_bucket: int = 5_000_000) -> int:
    """A bucket count that keeps buckets near `per_bucket` rows (one task scans a bucket)."""
    return max(8, -(-rows // per_bucket))


def bulk_copy(spark: SparkSession, source: DataFrame, target: str,
              partition_by: str | list[str] | None = None, buckets: int | None = None,
              if_not_exists: bool = True) -> DataFrame:
    """Copy a (remote) table into an analytic table and return the copy.

    Drop the target, create it with the source schema (bucketed on the
    partition column when one is given), insert by position, read back.
    Without `buckets` the source is counted first and the count sizes them.
    """
    drop_table(spark, target)
    if partition_by and buckets is None:
        buckets = buckets_for(source.count())
    create_table(spark, target, source.schema, bucket_by=partition_by,
                 buckets=buckets if partition_by else None, if_not_exists=if_not_exists)
    append(source, target, by="position")
    return spark.table(target)
