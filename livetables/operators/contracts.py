"""Schema transforms and contracts for target tables.

* rename_reserved: reserved column names get a suffix (exact case, position,
  type, nullability and metadata kept).
* as_varchar: text columns become VARCHAR(n) NOT NULL for row-layout tables;
  a name containing the marker gets the long limit, other text the short one.
* varchar_violations: the same contract checked over data in one aggregate
  pass (Spark enforces the length on write but not NOT NULL on Parquet, so
  the check runs before the write).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the reference's contract.
RESERVED_NAMES = ("Year", "Month")
RESERVED_SUFFIX = "_"
LONG_TEXT_MARKER = "comment"
LONG_TEXT_LIMIT = 400
SHORT_TEXT_LIMIT = 30


def rename_reserved_schema(schema: T.StructType, reserved=RESERVED_NAMES,
                           suffix: str = RESERVED_SUFFIX) -> T.StructType:
    return T.StructType([
        T.StructField(f.name + suffix if f.name in reserved else f.name, f.dataType, f.nullable,
                      f.metadata)
        for f in schema.fields])


def rename_reserved(df: DataFrame, reserved=RESERVED_NAMES, suffix: str = RESERVED_SUFFIX) -> DataFrame:
    """Rename reserved columns (exact-case match) in place.

    Positional (toDF): a name-based rename would also hit `year` when the
    session is case-insensitive.
    """
    names = [c + suffix if c in reserved else c for c in df.columns]
    return df.toDF(*names) if names != df.columns else df


def varchar_limits(schema: T.StructType, marker: str = LONG_TEXT_MARKER,
                   long_limit: int = LONG_TEXT_LIMIT,
                   short_limit: int = SHORT_TEXT_LIMIT) -> dict[str, int]:
    """Column -> length limit for every text column under the contract rule."""
    return {f.name: (long_limit if marker in f.name else short_limit)
            for f in schema.fields
            if isinstance(f.dataType, (T.StringType, T.VarcharType, T.CharType))}


def as_varchar(schema: T.StructType, marker: str = LONG_TEXT_MARKER,
               long_limit: int = LONG_TEXT_LIMIT,
               short_limit: int = SHORT_TEXT_LIMIT) -> T.StructType:
    """Text columns as VARCHAR(n) NOT NULL; other columns unchanged."""
    limits = varchar_limits(schema, marker, long_limit, short_limit)
    return T.StructType([
        T.StructField(f.name, T.VarcharType(limits[f.name]), False, f.metadata)
        if f.name in limits else f
        for f in schema.fields])


def schema_ddl(schema: T.StructType) -> str:
    """Column list for CREATE TABLE, keeping VARCHAR(n) and NOT NULL."""
    parts = []
    for f in schema.fields:
        dtype = f.dataType
        type_sql = f"VARCHAR({dtype.length})" if isinstance(dtype, T.VarcharType) else dtype.simpleString()
        parts.append(f"`{f.name}` {type_sql}{'' if f.nullable else ' NOT NULL'}")
    return ", ".join(parts)


def varchar_violations(df: DataFrame, limits: dict[str, int] | None = None) -> DataFrame:
    """One row: per text column, `<c>_too_long` and `<c>_null` counts.

    One scan, one partial + final aggregate; nothing but counters is shuffled.
    """
    if limits is None:
        limits = varchar_limits(df.schema)
    aggs = []
    for c, n in limits.items():
        aggs.append(F.count_if(F.length(F.col(c)) > n).alias(f"{c}_too_long"))
        aggs.append(F.count_if(F.col(c).isNull()).alias(f"{c}_null"))
    return df.agg(*aggs)
