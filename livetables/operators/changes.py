"""Change-feed operators (batch form; the stream applies them per micro-batch).

* cdc_target:         keep changes of one keyspace.table (case-insensitive)
* cdc_replay_guard:   drop repeated records
* cdc_split:          (records that fit the table, the others with a reason)
* cdc_flatten:        one row per change: simple cells, then partition key,
                      then clustering columns
* cdc_positions:      furthest position per segment
* cdc_gaps:           positions that a segment lacks, and how far it has none
* cdc_unknown_tables: records whose table is not known, counted per table
* cdc_latest:         newest raw record per key (before parsing cells)
* cdc_compact:        bulk copy + change rows -> one row per key, newest wins,
                      cell by cell

Order. A position is a place inside its segment, so records are ordered by
(segment, position, row_no). `order_key` makes one decimal of them: maxima of it
are hash aggregates of a fixed width.

Cells. A record's cells are parsed once, by `cdc_parse`; judging, flattening and the
names of the cells that it holds all read the parsed map.

Replay guard. A per-segment high-water mark is only right when one reader
walks each segment in order; Spark reads files in no set order, so repeated
records are dropped instead. A replay repeats a record as it was, so `distinct`
over whole records does it: a hash aggregate that folds a record repeated a
million times inside each task, before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetables.operators.feeds import convert, object_faults, pinned_object
from livetables.session import scratch_path
from livetables.sources.changelog import IDENTITY

#: Decimal digits of an order of one, two or three columns; they add up to at most 38.
ORDER_DIGITS = {1: (38,), 2: (19, 19), 3: (13, 15, 10)}


def order_key(order: tuple[str, ...] = IDENTITY, digits: tuple[int, ...] | None = None, wide: bool = False) -> Column:
    """Up to three non-negative integer columns as one value that sorts like them.

    A decimal with a fixed number of digits for each column (by default 13 for the
    segment, as for a time in milliseconds, 15 for the position, 10 for the row
    number), whose maxima are hash aggregates; a larger value fails the query, it
    never misorders. `wide=True` holds any bigint in 8 bytes per column (sort aggregates).
    """
    if not 1 <= len(order) <= 3:
        raise ValueError("order by one to three columns")
    digits = digits or ORDER_DIGITS[len(order)]
    if len(digits) != len(order) or sum(digits) > 38:
        raise ValueError("one number of digits per column, 38 in all")

    def checked(c: str, fine: Column) -> Column:
        return F.when(fine | F.col(c).isNull(), F.col(c)).otherwise(
            F.raise_error(F.concat(F.lit(f"order column {c} out of range: "), F.col(c).cast("string"))))
    if wide:
        return F.to_binary(F.concat(*[F.lpad(F.hex(checked(c, F.col(c) >= 0).cast("bigint")), 16, "0") for c in order]), F.lit("hex"))
    out = None
    for c, d in zip(order, digits):
        part = checked(c, (F.col(c) >= 0) & (F.col(c).cast("decimal(38,0)") < F.lit("1" + "0" * d).cast("decimal(38,0)")) if d < 38
                       else F.col(c) >= 0).cast("decimal(38,0)")
        out = part if out is None else (out * F.lit("1" + "0" * d).cast("decimal(38,0)") + part).cast("decimal(38,0)")
    return out


def cdc_target(log: DataFrame, keyspace: str, table: str, keyspace_col: str = "keyspace_name",
               table_col: str = "table_name") -> DataFrame:
    return log.where((F.lower(F.col(keyspace_col)) == keyspace.lower())
                     & (F.lower(F.col(table_col)) == table.lower()))


def cdc_replay_guard(log: DataFrame) -> DataFrame:
    return log.distinct()


def _struct_fields(df: DataFrame, name: str) -> list[str]:
    dtype = df.schema[name].dataType
    return [f.name for f in dtype.fields] if isinstance(dtype, T.StructType) else []


def simple_cells_schema(schema: T.StructType | str) -> T.StructType:
    """Drop collection / nested cells, which the flattened row leaves out."""
    st = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    return T.StructType([f for f in st.fields
                         if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))])


def _cells_and_keys(log: DataFrame, cells_schema: T.StructType | str, pk: str, ck: str) -> tuple[T.StructType, set[str]]:
    st = T.DataType.fromDDL(cells_schema) if isinstance(cells_schema, str) else cells_schema
    keys = set(_struct_fields(log, pk)) | set(_struct_fields(log, ck))
    return T.StructType([f for f in st.fields if f.name not in keys]), keys


#: The column of a parsed record: struct `m`, its cells as raw JSON texts (`cdc_parse`).
PARSED = "__cells"


def cdc_parse(log: DataFrame, cells_schema: T.StructType | str, pk: str = "pk", ck: str = "ck", cells: str = "cells") -> DataFrame:
    """The records with their parsed cells and `reject_reason`: why they don't fit the table, NULL if they do.

    Reasons: cells that aren't one JSON object, a value of the wrong type, a
    repeated cell, or a cell that is neither a column (collections included) nor a key.
    """
    parsed = log.select("*", pinned_object(F.col(cells)).alias(PARSED))
    return parsed.select("*", F.explode(F.array(_cell_faults(log, cells_schema, pk, ck, cells))).alias("reject_reason"))


def _cell_faults(log: DataFrame, cells_schema: T.StructType | str, pk: str, ck: str, cells: str, converted: dict[str, Column] | None = None) -> Column:
    st, keys = _cells_and_keys(log, cells_schema, pk, ck)
    known = T.StructType([*st.fields, *(T.StructField(k, T.StringType()) for k in sorted(keys))])
    return F.when(F.col(cells).isNotNull(), object_faults(F.col(f"{PARSED}.m"), known, converted=converted))


def cdc_split(log: DataFrame, cells_schema: T.StructType | str, pk: str = "pk", ck: str = "ck",
              cells: str = "cells", keep_parsed: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records that fit the table, the other records with `reject_reason`).

    With `keep_parsed` the first keep their parsed cells, which `cdc_flatten` then reads.
    """
    judged = cdc_parse(log, cells_schema, pk, ck, cells)
    good = judged.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return (good if keep_parsed else good.drop(PARSED)), judged.where(F.col("reject_reason").isNotNull()).drop(PARSED)


def cdc_flatten(log: DataFrame, cells_schema: T.StructType | str, pk: str = "pk", ck: str = "ck",
                cells: str = "cells", keep: tuple[str, ...] = (), drop_complex: bool = True,
                strict: bool = True, present: str | None = None) -> DataFrame:
    """One row per change record: cells, then pk columns, then ck columns.

    A record without cells gives a key-only row. A cell named like a key
    column is left to the key. A record that doesn't fit the table fails the
    query (take `cdc_split` first); with strict=False what doesn't fit is NULL.
    `present` names a column to add: the names of the cells that the record holds.
    """
    st, _ = _cells_and_keys(log, cells_schema, pk, ck)
    if drop_complex:
        st = simple_cells_schema(st)
    if strict or PARSED not in log.columns:
        log = log.drop(PARSED).select("*", pinned_object(F.col(cells)).alias(PARSED))
    held = F.col(f"{PARSED}.m")
    # converted once, too: what judges them and what selects them read the same values
    values = F.struct(F.lit(None).alias("none"), *[convert(held[f.name], f.dataType).alias(f.name) for f in st.fields])
    log = log.select("*", F.explode(F.array(values)).alias("__values"))
    if strict:
        fault = _cell_faults(log, cells_schema, pk, ck, cells, {f.name: F.col("__values")[f.name] for f in st.fields})
        log = log.select("*", F.explode(F.array(fault)).alias("__fault"))
        log = log.where(F.when(F.col("__fault").isNull(), F.lit(True)).otherwise(F.raise_error(F.col("__fault"))))
    names = F.coalesce(F.map_keys(held), F.array().cast("array<string>"))
    return log.select(*keep, *[F.col("__values")[f.name].alias(f.name) for f in st.fields],
                      *[F.col(f"{pk}.{n}").alias(n) for n in _struct_fields(log, pk)],
                      *[F.col(f"{ck}.{n}").alias(n) for n in _struct_fields(log, ck)],
                      *([names.alias(present)] if present else []))


def cdc_positions(log: DataFrame, segment: str = "segment", position: str = "position") -> DataFrame:
    return log.groupBy(segment).agg(F.max(position).alias("position"))


def cdc_gaps(log: DataFrame, segment: str = "segment", position: str = "position", start: int | None = None,
             block_bits: int = 16) -> DataFrame:
    """segment, gap_free_to, gap_from, gap_to: a row per gap of consecutive missing positions; one with nulls if there is none.

    `gap_free_to` is the last position before the segment's first gap. With `start`, positions
    begin there (a later first one leaves a gap; earlier ones are left out), else at the segment's first.

    Plan: a segment isn't sorted as a whole. Distinct positions are compared with the next one inside blocks of
    2^block_bits positions; a block's first and last are one row of the next level, where blocks are compared
    inside blocks of blocks. So every window has at most 2^block_bits rows, a segment with most of
    the log is spread over its blocks, and the levels' number is that of a bigint's bits.
    """
    rows = log.where(F.col(position).isNotNull()).select(F.col(segment).alias("segment"), F.col(position).cast("bigint").alias("first")).distinct()
    if start is not None:
        before = log.select(F.col(segment).alias("segment")).distinct().select("segment", F.lit(start - 1).cast("bigint").alias("first"))
        rows = rows.where(F.col("first") >= start).union(before)
    level = rows.withColumn("last", F.col("first"))
    # the last step joins the blocks of negative numbers (a start of 0 has -1 before it) and of all others
    gaps, shifts = [], [*range(block_bits, 63, block_bits), 63, None]
    for shift in shifts:
        level = level.withColumn("block", F.lit(0).cast("bigint") if shift is None else F.shiftright("first", shift))
        after = F.lead("first").over(Window.partitionBy("segment", "block").orderBy("first"))
        gaps.append(level.withColumn("after", after).where(F.col("after") - F.col("last") > 1)
                    .select("segment", (F.col("last") + 1).alias("gap_from"), (F.col("after") - 1).alias("gap_to")))
        level = level.groupBy("segment", "block").agg(F.min("first").alias("first"), F.max("last").alias("last")).drop("block")
    found = gaps[0]
    for more in gaps[1:]:
        found = found.union(more)
    ends = level.groupBy("segment").agg(F.max("last").alias("end"))
    first_gap = found.groupBy("segment").agg((F.min("gap_from") - 1).alias("sound"))
    first_gap = first_gap.withColumnRenamed("segment", "of")
    told = (ends.join(first_gap, F.col("segment").eqNullSafe(F.col("of")), "left")
            .select(F.col("segment").alias("s"), F.coalesce("sound", "end").alias("gap_free_to")))
    return (told.join(found, F.col("s").eqNullSafe(F.col("segment")), "left")
            .select(F.col("s").alias("segment"), "gap_free_to", "gap_from", "gap_to"))


def cdc_unknown_tables(log: DataFrame, known: DataFrame | list[tuple],
                       by: tuple[str, ...] = ("keyspace_name", "table_name")) -> DataFrame:
    """Count records per table for tables not in `known` (same columns as `by`).

    `known` is a DataFrame or a list of name tuples. Names compare
    case-insensitively. The records are counted with a partial aggregate.
    """
    return cdc_unknown(log, known, by).groupBy(*by).agg(F.count(F.lit(1)).alias("n"))


def cdc_unknown(log: DataFrame, known: DataFrame | list[tuple],
                by: tuple[str, ...] = ("keyspace_name", "table_name")) -> DataFrame:
    """The records of tables not in `known`; a list is compared as literals, without a join."""
    if not isinstance(known, DataFrame):
        named = F.lit(False)
        for names in known:
            same = F.lit(True)
            for c, name in zip(by, names):
                same = same & F.coalesce(F.lower(F.col(c)) == name.lower(), F.lit(False))
            named = named | same
        return log.where(~named)
    lk = known.select(*[F.lower(F.col(c)).alias(f"__k{i}") for i, c in enumerate(by)])
    cond = None
    for i, c in enumerate(by):
        e = F.lower(F.col(c)) == lk[f"__k{i}"]
        cond = e if cond is None else cond & e
    return log.join(lk, cond, "left_anti")


def cdc_latest(log: DataFrame, keys: list, order: tuple[str, ...] = IDENTITY) -> DataFrame:
    """The newest raw record per key (keys may be columns of pk/ck, e.g. "pk.id").

    Run before `cdc_flatten`, so only the winning records' cells are parsed.
    The newest order per key comes from a hash aggregate over two narrow columns
    (a hot key is one row per task); the records are then fetched by a join.
    """
    names = [f"__key{i}" for i in range(len(keys))]
    ranked = log.select("*", *[(F.col(k) if isinstance(k, str) else k).alias(n) for k, n in zip(keys, names)],
                        order_key(order).alias("__order"))
    newest = ranked.groupBy(*names).agg(F.max("__order").alias("__newest"))
    newest = newest.select(*[F.col(n).alias(f"{n}n") for n in names], "__newest")
    same = F.col("__order") == F.col("__newest")
    for n in names:
        same = same & F.col(n).eqNullSafe(F.col(f"{n}n"))
    return ranked.join(newest, same).select(*log.columns).distinct()


def cdc_compact(base: DataFrame | None, changes: DataFrame, keys: list[str],
                order: tuple[str, ...] = IDENTITY, op_col: str | None = None,
                delete_ops: tuple[str, ...] = ("delete",), present_col: str | None = None) -> DataFrame:
    """Merge flattened change rows into a bulk copy: one row per key.

    `changes` holds flattened change rows plus the `order` columns. With
    `present_col` (the cells each change holds, see `cdc_flatten`) each column
    takes the newest change that holds it, an explicit null included, and keeps
    the base value where none does; without it a change is a whole row. A key
    whose newest change is a delete (`op_col`) is removed; changes and base
    values from before a delete don't show through later changes. Unchanged base
    rows are kept as they are. Column order: keys, then the change columns, then
    further base columns.

    Plan: (1) one hash aggregate over the changes finds per key the order of the
    newest change of each column and of the newest delete: numbers only, a hot
    key is one row per task; (2) the winning changes are fetched by a join and
    their values put into one row per key, written to the shared folder; (3) the
    base is joined to that table, which Spark broadcasts if it is small, so a
    large base is streamed past few changed keys without a shuffle; (4) new rows
    are added. Whole-row changes replace every base row of their key; with
    `present_col` the base is expected to hold a key once.
    """
    spark = changes.sparkSession
    value_cols = [c for c in changes.columns if c not in (*keys, *order, op_col, present_col)]
    by_cell = present_col is not None
    deleted = F.coalesce(F.lower(F.col(op_col)).isin(*delete_ops), F.lit(False)) if op_col else F.lit(False)
    ranked = changes.withColumn("__order", order_key(order)).withColumn("__deleted", deleted)

    def held(c: str) -> Column:
        return ~F.col("__deleted") & (F.array_contains(present_col, c) if by_cell else F.lit(True))
    newest = [F.max(F.when(held(c), F.col("__order"))).alias(f"__at{i}") for i, c in enumerate(value_cols)] if by_cell else []
    marks = ranked.groupBy(*keys).agg(
        F.max(F.when(~F.col("__deleted"), F.col("__order"))).alias("__kept"),
        F.max(F.when(F.col("__deleted"), F.col("__order"))).alias("__gone"), *newest)
    at = [F.col(f"__at{i}") if by_cell else F.col("__kept") for i in range(len(value_cols))]
    wins = F.col("__order") == F.col("__kept")
    for a in at if by_cell else ():
        wins = wins | (F.col("__order") == a)
    key_marks = marks.select(*[F.col(k).alias(f"__m{i}") for i, k in enumerate(keys)], *[c for c in marks.columns if c not in keys])
    winners = ranked.where(~F.col("__deleted")).join(key_marks, _all_same(keys, "__m") & F.coalesce(wins, F.lit(False)))
    values = [F.max_by(F.col(c), F.when(F.col("__order") == a, F.col("__order"))).alias(f"__v{i}")
              for i, (c, a) in enumerate(zip(value_cols, at))]
    rows = marks if not value_cols else marks.join(
        winners.groupBy(*keys).agg(*values).select(*[F.col(k).alias(f"__w{i}") for i, k in enumerate(keys)],
                                                   *[f"__v{i}" for i in range(len(value_cols))]),
        _all_same(keys, "__w"), "left").drop(*[f"__w{i}" for i in range(len(keys))])
    path = scratch_path(spark, "compact")
    alive = F.col("__kept").isNotNull() & (F.col("__gone").isNull() | (F.col("__kept") > F.col("__gone")))
    rows = rows.withColumn("__alive", F.coalesce(alive, F.lit(False)))
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    nothing = F.lit(None)

    def merged(i: int, c: str, old: Column) -> Column:
        if not by_cell:
            return F.col(f"__v{i}").alias(c)
        told = F.col(f"__at{i}").isNotNull() & (F.col("__gone").isNull() | (F.col(f"__at{i}") > F.col("__gone")))
        return F.when(told, F.col(f"__v{i}")).when(F.col("__gone").isNull(), old).alias(c)
    upserts = rows.where("__alive")
    if base is None:
        return upserts.select(*keys, *[merged(i, c, nothing) for i, c in enumerate(value_cols)])
    extra = [c for c in base.columns if c not in keys and c not in value_cols]
    blank = [nothing.cast(base.schema[c].dataType).alias(c) for c in extra]
    old = base.select(*[F.col(k).alias(f"__b{i}") for i, k in enumerate(keys)],
                      *[F.col(c).alias(f"__o{c}") for c in base.columns if c not in keys])
    of_base = _all_same(keys, "__b")
    old_keys = [F.col(f"__b{i}").alias(k) for i, k in enumerate(keys)]
    old_value = {c: F.col(f"__o{c}") if c in base.columns else nothing for c in [*value_cols, *extra]}
    if by_cell:
        kept = (old.join(rows, of_base, "left").where(F.col("__alive").isNull() | F.col("__alive"))
                .select(*old_keys, *[merged(i, c, old_value[c]) for i, c in enumerate(value_cols)],
                        *[F.when(F.col("__gone").isNull(), old_value[c]).alias(c) for c in extra]))
        touched = old.select(*[f"__b{i}" for i in range(len(keys))]).join(rows.select(*keys), of_base, "left_semi")
        upserts = upserts.join(touched, of_base, "left_anti")
    else:
        kept = (old.join(rows.select(*keys), of_base, "left_anti")
                .select(*old_keys, *[old_value[c].alias(c) for c in [*value_cols, *extra]]))
    added = upserts.select(*keys, *[merged(i, c, nothing) for i, c in enumerate(value_cols)], *blank)
    return kept.unionByName(added)


def _all_same(keys: list[str], prefix: str) -> Column:
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
    return same
