"""Hot keys: one key holds a third (or more) of all rows. Results stay exact,
and every aggregate is partial before its shuffle."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from livetables.plans.catalog import QUERIES
from livetables.operators import changes, flights, ticks
from livetables.plans import inspect
from tests.conftest import SF01

N = 60_000


def _hot(spark, n=N):
    """Rows where key 1 holds every third row plus key 2 every seventh."""
    return spark.range(0, n, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).when(F.col("id") % 7 == 0, F.lit(2))
        .otherwise(F.col("id") % 50 + 10).cast("long").alias("k"),
        (F.col("id") % 1000 / 100).alias("v"), F.col("id").alias("seq"))


def test_last_value_with_hot_symbol(spark):
    df = _hot(spark).select(F.col("k").alias("sym"), F.col("v").alias("bid"), "seq",
                            F.lit("2016-06-06").alias("date"))
    syms = spark.createDataFrame([(1,), (2,), (11,)], "value long")
    got = {r.sym: r.last_bid for r in ticks.last_quote_by_symbol(df, syms, order="seq").collect()}
    pdf = df.toPandas()
    pdf = pdf[pdf["sym"].isin([1, 2, 11])].sort_values("seq").groupby("sym").tail(1)
    assert got == dict(zip(pdf["sym"], pdf["bid"]))


def test_delay_with_hot_carrier(spark):
    fl = _hot(spark).select(F.col("k").alias("UniqueCarrier"), F.lit("XSFOX").alias("Origin"),
                            F.col("v").alias("WeatherDelay"))
    ref = spark.range(0, 70).select(F.col("id").alias("CODE"),
                                    F.concat(F.lit("c"), (F.col("id") % 5).cast("string")).alias("DESCRIPTION"))
    got = {r.description: r.total_delay for r in flights.delay_by_carrier(fl, ref).collect()}
    p = fl.toPandas().merge(ref.toPandas(), left_on="UniqueCarrier", right_on="CODE")
    p = p[p["WeatherDelay"] > 0]
    want = p.groupby("DESCRIPTION")["WeatherDelay"].sum().round(2).to_dict()
    assert {k: round(v, 2) for k, v in got.items()} == want


def test_replay_guard_with_one_record_copied_a_third_of_the_time(spark):
    rows = _hot(spark).select(F.lit(1).cast("long").alias("segment"),
                              F.when(F.col("k") == 1, F.lit(5)).otherwise(F.col("seq")).alias("position"),
                              F.lit(0).alias("row_no"))
    got = changes.cdc_replay_guard(rows).count()
    assert got == rows.distinct().count()


def test_unknown_tables_with_hot_table(spark):
    log = _hot(spark).select(F.lit("ks").alias("keyspace_name"),
                             F.concat(F.lit("t"), F.col("k").cast("string")).alias("table_name"))
    got = {r.table_name: r.n for r in changes.cdc_unknown_tables(log, [("ks", "t2")]).collect()}
    want = log.toPandas().query("table_name != 't2'").groupby("table_name").size().to_dict()
    assert got == want


@pytest.mark.parametrize("name", [n for n in sorted(QUERIES)
                                  if n not in ("cdc_compact", "cdc_compact_cells")])
def test_aggregates_are_partial_before_the_shuffle(spark, name):
    df = E.queries()[name](spark, SF01)
    text = inspect.plan_text(df)
    finals = inspect.count_nodes(df, "HashAggregate") + inspect.count_nodes(df, "SortAggregate")
    if finals:
        assert "partial_" in text or "Keys" in text, name
        # every aggregate that feeds a shuffle is paired with a partial one
        assert finals % 2 == 0, name
