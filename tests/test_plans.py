"""Plan tests: the physical plans the operators are meant to produce."""

from pyspark.sql import functions as F

import __spark_entry__ as E
from livetables.operators import flights, ticks
from livetables.plans import inspect
from livetables.plans.catalog import QUERIES
from livetables.session import unique_name
from livetables.sinks import tables as sinks
from livetables.sources import generators
from tests.conftest import SF01


def test_tick_rollup_broadcasts_symbols_and_pushes_day_filter(spark):
    df = E.queries()["last_quote_by_symbol"](spark, SF01)
    assert inspect.count_nodes(df, "BroadcastHashJoin") == 1
    filters = " ".join(inspect.pushed_filters(df))
    assert "GreaterThanOrEqual(ts" in filters and "LessThan(ts" in filters
    # the fact scan reads only the columns the rollup needs
    assert "struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in inspect.read_schemas(df)
    text = inspect.plan_text(df)
    assert "partial_max_by" in text and "SortAggregate" not in text


def test_flight_query_pushes_like_and_sums_before_the_join(spark):
    df = E.queries()["delay_by_carrier"](spark, SF01)
    filters = " ".join(inspect.pushed_filters(df))
    assert "StringContains(l_returnflag,A)" in filters and "GreaterThan(l_tax,0.0)" in filters
    # summed per carrier before the join: the fact is never shuffled row by row
    assert inspect.count_nodes(df, "BroadcastHashJoin") == 1
    assert inspect.shuffle_exchanges(df) == 2


def test_flight_query_over_bound_aggregates_before_the_join(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    part = spark.read.parquet(f"{SF01}/part.parquet")
    args = dict(carrier="l_partkey", origin="l_returnflag", origin_pattern="%A%", delay="l_tax",
                code="p_partkey", description="p_name")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = flights.delay_by_carrier(li, part, sum_scale=2, **args)
        tree = inspect.tree(df)
        assert "SortMergeJoin" in tree
        # the partial sum per code sits below the join
        assert tree.index("SortMergeJoin") < tree.rindex("HashAggregate")
        assert sorted(df.collect()) == sorted(E.queries()["delay_by_carrier"](spark, SF01).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_top_delays_is_take_ordered(spark):
    df = E.queries()["top_delays"](spark, SF01)
    assert inspect.count_nodes(df, "TakeOrderedAndProject") == 1


def test_generated_comment_columns_not_read(spark, scratch):
    generators.gen_quotes(spark, rows=2000, partitions=2).write.parquet(f"{scratch}/q")
    q = spark.read.parquet(f"{scratch}/q")
    s = generators.gen_symbols(spark)
    df = ticks.last_quote_by_symbol(q, s)
    schemas = " ".join(inspect.read_schemas(df))
    assert "comment" not in schemas
    assert "EqualTo(date,2016-06-06)" in " ".join(inspect.pushed_filters(df))


def test_bucketed_join_and_group_by_need_no_exchange(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    a, b = unique_name("lt_bka"), unique_name("lt_bkb")
    for n in (a, b):
        sinks.create_table(spark, n, e.schema, bucket_by="user_id", buckets=8)
        sinks.append(e, n)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = (spark.table(a).join(spark.table(b), "user_id")
                  .groupBy("user_id").agg(F.count(F.lit(1)).alias("n")))
        assert inspect.shuffle_exchanges(joined) == 0
        assert joined.count() > 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_max_bid_join_reuses_aggregate_partitioning(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = E.queries()["max_bid_by_symbol"](spark, SF01)
        # one exchange per aggregate; none added for the join
        assert inspect.shuffle_exchanges(df) == 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_python_udfs_in_registered_queries(spark):
    for name, fn in QUERIES.items():
        text = inspect.plan_text(fn(spark, SF01))
        assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text, name


def test_over_bound_dimension_is_not_broadcast(spark):
    li = spark.read.parquet(f"{SF01}/lineitem.parquet")
    part = spark.read.parquet(f"{SF01}/part.parquet")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = flights.delay_by_carrier(li, part, carrier="l_partkey", origin="l_returnflag",
                                      origin_pattern="%A%", delay="l_tax", code="p_partkey",
                                      description="p_name")
        assert inspect.count_nodes(df, "BroadcastHashJoin") == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_membership_join_over_bound_is_not_broadcast_and_agrees(spark):
    e = spark.read.parquet(f"{SF01}/events.parquet")
    syms = e.where("user_id % 4 = 0").select(F.col("user_id").alias("value")).distinct()
    args = dict(sym="user_id", bid="value", order="event_id", day_col="ts", day="2024-01-02")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        big = ticks.last_quote_by_symbol(e, syms, **args)
        assert inspect.count_nodes(big, "BroadcastHashJoin") == 0
        want = sorted(big.collect())
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        small = ticks.last_quote_by_symbol(e, syms, **args)
        assert inspect.count_nodes(small, "BroadcastHashJoin") == 1
        assert want == sorted(small.collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_unknown_tables_over_bound_agrees(spark):
    from livetables.operators import changes
    log = spark.read.parquet(f"{SF01}/events.parquet").select(
        F.lit("ks").alias("keyspace_name"), F.col("event_type").alias("table_name"))
    known = [("ks", "click"), ("KS", "View")]
    a = changes.cdc_unknown_tables(log, known)
    b = changes.cdc_unknown_tables(log, spark.createDataFrame(known, "keyspace_name string, table_name string"))
    assert sorted(a.collect()) == sorted(b.collect())
