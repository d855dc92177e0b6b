"""JSON messages -> typed rows, with rejected messages kept aside.

Each message is one JSON document. A message is rejected, with a reason, when
it is empty, is not one JSON object (text after the object included), names a
field twice, holds a value that does not convert to the column's type (nested
values too), or names a column the table does not have. A missing field or a
JSON null gives NULL. As in a store's JSON insert, a number may also come as a
string ("12") and an integer with a zero fraction (12.0); a boolean is `true` or
`false`. Text with quotes or apostrophes is data, never pasted into SQL.

Plan: the document is parsed once, into map<string,string> (non-string values
keep their raw JSON text), wrapped in an object whose last field is a salted hash of
the message: only a message that is one whole JSON value leaves that field in
place. The map is the output of a generator (`pinned_object`), an operator of its own, so
keys, conversions, the reason and later filters read it and never parse again.
Parallelism is the input's.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _schema(schema: T.StructType | str) -> T.StructType:
    return T.DataType.fromDDL(schema) if isinstance(schema, str) else schema


def pinned_object(text: Column) -> Column:
    """A generator: struct `m`, the JSON object as map<string,string>; NULL if the text is not exactly one object.

    Select it under an alias and read `alias.m`: the text is parsed once per row, whatever uses the map.
    """
    salt = F.lit(uuid.uuid4().hex)                   # a text can't foresee it
    mark = F.xxhash64(salt, text).cast("string")
    wrapped = F.concat(F.lit('{"m":'), text, F.lit(',"e":"'), mark, F.lit('"}'))
    parsed = F.from_json(wrapped, "m map<string,string>, e string")
    return F.explode_outer(F.filter(F.array(parsed), lambda p: p["e"] == mark))


def fits(raw: Column, dtype: T.DataType) -> Column:
    """Whether raw JSON text converts to the type, at every level; NULL (absent or JSON null) fits."""
    if isinstance(dtype, T.StructType):
        m = F.from_json(raw, "map<string,string>")
        ok = m.isNotNull()
        for f in dtype.fields:
            ok = ok & fits(m[f.name], f.dataType)
    elif isinstance(dtype, T.ArrayType):
        a = F.from_json(raw, "array<string>")
        ok = a.isNotNull() & F.forall(a, lambda x: fits(x, dtype.elementType))
    elif isinstance(dtype, T.MapType):
        m = F.from_json(raw, "map<string,string>")
        ok = m.isNotNull() & F.forall(F.map_values(m), lambda x: fits(x, dtype.valueType))
    else:
        ok = convert(raw, dtype).isNotNull()
    return raw.isNull() | F.coalesce(ok, F.lit(False))


def convert(raw: Column, dtype: T.DataType) -> Column:
    """Raw JSON text of one field -> the column type (NULL if it does not fit)."""
    if isinstance(dtype, (T.StructType, T.ArrayType, T.MapType)):
        return F.when(fits(raw, dtype), F.try_variant_get(F.try_parse_json(raw), "$", dtype.simpleString()))
    if isinstance(dtype, T.StringType):
        return raw
    if isinstance(dtype, T.BooleanType):
        return F.when(raw.isin("true", "false"), raw.cast("boolean"))
    if isinstance(dtype, T.IntegralType):
        number = raw.try_cast("decimal(38,10)")
        return F.when(number == F.floor(number), number.try_cast("decimal(38,0)").try_cast(dtype))
    return raw.try_cast(dtype)


def object_faults(fields: Column, schema: T.StructType, reject_unknown_keys: bool = True,
                  converted: dict[str, Column] | None = None) -> Column:
    """Why a parsed object does not fit the columns; NULL if it does. `converted`: values that are at hand already."""
    keys, known = F.map_keys(fields), converted or {}
    wrong = [F.when(fields[f.name].isNotNull() & known.get(f.name, convert(fields[f.name], f.dataType)).isNull(), F.lit(f.name))
             for f in schema.fields]
    wrong = F.array_join(F.array(*wrong).cast("array<string>"), ",") if wrong else F.lit("")
    unknown = F.array_except(keys, F.array(*[F.lit(f.name) for f in schema.fields]).cast("array<string>"))
    reason = (F.when(fields.isNull(), F.lit("not a JSON object"))
              .when(F.size(F.array_distinct(keys)) < F.size(keys), F.lit("repeated field"))
              .when(wrong != "", F.concat(F.lit("field of the wrong type: "), wrong)))
    if reject_unknown_keys:
        reason = reason.when(F.size(unknown) > 0,
                             F.concat(F.lit("unknown field: "), F.array_join(F.sort_array(unknown), ",")))
    return reason


def parse_messages(df: DataFrame, schema: T.StructType | str, value_col: str = "value",
                   keep: tuple[str, ...] = (), reject_unknown_keys: bool = True) -> DataFrame:
    """All messages with parsed fields plus a `reject_reason` (NULL = good)."""
    st = _schema(schema)
    v = F.col(value_col)
    rows = df.select(*keep, v.alias("__message"), pinned_object(v).alias("__object"))
    m = F.col("__object.m")
    values = [convert(m[f.name], f.dataType).alias(f.name) for f in st.fields]
    reason = F.when(F.col("__message").isNull(), F.lit("empty message")).otherwise(object_faults(m, st, reject_unknown_keys))
    return rows.select(*keep, "__message", F.struct(*values).alias("__parsed"), reason.alias("reject_reason"))


def split_messages(parsed: DataFrame, schema: T.StructType | str,
                   keep: tuple[str, ...] = (), value_col: str = "value") -> tuple[DataFrame, DataFrame]:
    """(good rows: keep + fields, rejects: keep + message + reason)."""
    st = _schema(schema)
    good = (parsed.where(F.col("reject_reason").isNull())
            .select(*keep, *[F.col(f"__parsed.{f.name}").alias(f.name) for f in st.fields]))
    rejects = (parsed.where(F.col("reject_reason").isNotNull())
               .select(*keep, F.col("__message").alias(value_col), "reject_reason"))
    return good, rejects


def json_ingest(df: DataFrame, schema: T.StructType | str, value_col: str = "value",
                keep: tuple[str, ...] = (), reject_unknown_keys: bool = True) -> tuple[DataFrame, DataFrame]:
    """Parse a column of JSON messages into (good rows, rejects)."""
    parsed = parse_messages(df, schema, value_col, keep, reject_unknown_keys)
    return split_messages(parsed, schema, keep, value_col)
