"""Contracts, DDL and writes: hand-made cases."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from livetables.operators import contracts, flights
from livetables.plans.loads import enforce_not_null, load_flights
from livetables.session import unique_name
from livetables.sinks import tables as sinks
from livetables.sources import tables as sources
from tests.conftest import SF001


# --- contracts -------------------------------------------------------------

def test_rename_reserved_keeps_position_type_and_metadata(spark):
    schema = T.StructType([
        T.StructField("Year", T.IntegerType(), False, {"note": "key"}),
        T.StructField("year", T.StringType(), True),          # other case: untouched
        T.StructField("Month", T.IntegerType(), True),
        T.StructField("Origin", T.StringType(), True)])
    df = spark.createDataFrame([(2001, "x", 5, "SFO")], schema)
    out = contracts.rename_reserved(df)
    assert out.columns == ["Year_", "year", "Month_", "Origin"]
    assert out.schema["Year_"].metadata == {"note": "key"}
    s = contracts.rename_reserved_schema(schema)
    assert [f.name for f in s.fields] == ["Year_", "year", "Month_", "Origin"]
    assert s["Year_"].nullable is False and s["Year_"].dataType == T.IntegerType()


def test_as_varchar_rule():
    schema = T.StructType([
        T.StructField("sym", T.StringType(), True),
        T.StructField("comment1", T.StringType(), True),
        T.StructField("my_comment_x", T.StringType(), True),
        T.StructField("bid", T.DoubleType(), True)])
    out = contracts.as_varchar(schema)
    assert out["sym"].dataType == T.VarcharType(30) and not out["sym"].nullable
    assert out["comment1"].dataType == T.VarcharType(400)
    assert out["my_comment_x"].dataType == T.VarcharType(400)
    assert out["bid"].dataType == T.DoubleType() and out["bid"].nullable


def test_varchar_violations_edges(spark):
    df = spark.createDataFrame(
        [("a" * 30, "c" * 400, 1.0), ("a" * 31, "c" * 401, 2.0), (None, None, None)],
        "sym string, comment1 string, bid double")
    r = contracts.varchar_violations(df).first().asDict()
    assert r == {"sym_too_long": 1, "sym_null": 1, "comment1_too_long": 1, "comment1_null": 1}


def test_varchar_length_enforced_on_write_and_not_null_guard(spark):
    name = unique_name("lt_vc")
    schema = contracts.as_varchar(T.StructType([T.StructField("sym", T.StringType())]))
    sinks.create_table(spark, name, schema)
    sinks.append(spark.createDataFrame([("a" * 30,)], "sym string"), name)
    with pytest.raises(Exception, match="(?i)exceed|length"):
        sinks.append(spark.createDataFrame([("a" * 31,)], "sym string"), name)
    with pytest.raises(Exception, match="NULL in NOT NULL column sym"):
        sinks.append(enforce_not_null(spark.createDataFrame([(None,)], "sym string"), ["sym"]), name)
    assert spark.table(name).count() == 1


# --- tables ----------------------------------------------------------------

def test_append_by_name_reorders_and_by_position_ignores_names(spark):
    name = unique_name("lt_app")
    sinks.create_table(spark, name, "a int, b string")
    sinks.append(spark.createDataFrame([("x", 1)], "b string, a int"), name, by="name")
    sinks.append(spark.createDataFrame([(2, "y")], "other int, names string"), name, by="position")
    assert sorted(spark.table(name).collect()) == [(1, "x"), (2, "y")]
    with pytest.raises(ValueError):
        sinks.append(spark.createDataFrame([(3,)], "z int"), name, by="name")


def test_renamed_target_takes_old_names_by_position(spark):
    name = unique_name("lt_ren")
    src = spark.createDataFrame([(2001, 5, "SFO")], "Year int, Month int, Origin string")
    sinks.create_table(spark, name, contracts.rename_reserved_schema(src.schema))
    with pytest.raises(ValueError):
        sinks.append(src, name, by="name")
    sinks.append(src, name, by="position")
    assert spark.table(name).columns == ["Year_", "Month_", "Origin"]
    assert spark.table(name).collect() == [(2001, 5, "SFO")]


def test_bucketed_table_keeps_buckets_after_appends(spark):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    name = unique_name("lt_bkt")
    sinks.create_table(spark, name, e.schema, bucket_by="user_id", buckets=5)
    sinks.append(e.where("event_type = 'click'"), name, by="name")
    sinks.append(e.where("event_type <> 'click'").select(*e.columns), name, by="position")
    assert sinks.bucket_spec(spark, name) == (["user_id"], 5)
    assert spark.table(name).count() == e.where("event_type is not null").count()
    # every file holds one bucket; the bucket id is the file name suffix
    files = spark.table(name).select(F.input_file_name().alias("f"), "user_id").distinct()
    per_file = files.groupBy("f").agg(F.countDistinct(F.pmod(F.hash("user_id"), F.lit(5))).alias("b"))
    assert per_file.where("b > 1").count() == 0


def test_bucket_count_without_key_is_recorded(spark):
    name = unique_name("lt_b11")
    sinks.create_table(spark, name, "a int", buckets=11)
    props = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    assert props[sinks.BUCKETS_PROPERTY] == "11"


def test_create_if_not_exists_and_plain_create(spark):
    name = unique_name("lt_ine")
    sinks.create_table(spark, name, "a int")
    sinks.create_table(spark, name, "a int", if_not_exists=True)
    with pytest.raises(Exception):
        sinks.create_table(spark, name, "a int")
    sinks.drop_table(spark, name)
    sinks.drop_table(spark, name)
    assert not spark.catalog.tableExists(name)


def test_save_dir_fails_if_present_and_default_format_load(spark, scratch):
    df = spark.createDataFrame([(1, "a")], "a int, b string")
    sinks.save_dir(df, f"{scratch}/out")
    with pytest.raises(Exception):
        sinks.save_dir(df, f"{scratch}/out")
    assert sources.read_default(spark, f"{scratch}/out").collect() == [(1, "a")]


def test_external_table_drop_keeps_files(spark, scratch):
    df = spark.createDataFrame([(1,)], "a int")
    sinks.save_dir(df, f"{scratch}/ext")
    name = unique_name("lt_ext")
    assert sources.external_table(spark, name, f"{scratch}/ext").collect() == [(1,)]
    sinks.drop_table(spark, name)
    assert spark.read.parquet(f"{scratch}/ext").count() == 1


def test_sql_external_table_and_ctas(spark, scratch):
    spark.createDataFrame([(1, "a'b")], "a int, b string").write.json(f"{scratch}/j")
    name = unique_name("lt_sqlext")
    df = sources.sql_external_table(spark, name, "json", path=f"{scratch}/j")
    assert df.collect()[0].b == "a'b"
    copy = sinks.ctas(spark, unique_name("lt_ctas"), f"SELECT * FROM {name}")
    assert copy.collect() == df.collect()


def test_csv_round_trip_keeps_microseconds(spark, scratch):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    sinks.csv_export(e, f"{scratch}/csv")
    ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in e.schema.fields)
    back = sources.csv_import(spark, f"{scratch}/csv", ddl)
    assert back.exceptAll(e).count() == 0 and e.exceptAll(back).count() == 0


def test_single_file_csv(spark, scratch):
    e = spark.read.parquet(f"{SF001}/nation.parquet")
    sinks.csv_export(e, f"{scratch}/one", single_file=True)
    import glob
    assert len(glob.glob(f"{scratch}/one/part-*.csv")) == 1


def test_bulk_copy_partition_column(spark):
    src = spark.read.parquet(f"{SF001}/events.parquet")
    out = sinks.bulk_copy(spark, src, unique_name("lt_bulk"), partition_by="user_id", buckets=7)
    assert out.count() == src.count()
    assert out.exceptAll(src).count() == 0


# --- flights ---------------------------------------------------------------

def _airline_fixture(spark, scratch):
    """A small airline folder and carrier folder from lineitem/part."""
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    airline = li.select(
        F.year("l_shipdate").alias("Year"), F.month("l_shipdate").alias("Month"),
        F.dayofmonth("l_shipdate").alias("DayOfMonth"),
        F.col("l_partkey").cast("string").alias("UniqueCarrier"),
        F.concat(F.lit("X"), F.col("l_returnflag"), F.lit("SFO")).alias("Origin"),
        (F.col("l_tax") * 100).cast("int").alias("WeatherDelay"))
    ref = spark.read.parquet(f"{SF001}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("CODE"), F.col("p_name").alias("DESCRIPTION"))
    airline.write.parquet(f"{scratch}/airline")
    ref.write.parquet(f"{scratch}/airlineref")
    return airline, ref


def test_load_flights_and_query(spark, scratch):
    airline, ref = _airline_fixture(spark, scratch)
    res = load_flights(spark, f"{scratch}/airline", f"{scratch}/airlineref",
                       col_table="lt_airline", row_table="lt_airlineref", staging="lt_staging_airline")
    assert spark.table("lt_airline").columns[:2] == ["Year_", "Month_"]
    rows = res.collect()
    full = {r.description: r.total_delay for r in flights.delay_by_carrier(airline, ref).collect()}
    assert len(rows) == min(20, len(full))
    assert all(full[r.description] == r.total_delay for r in rows)
    pdf = airline.toPandas().merge(ref.toPandas(), left_on="UniqueCarrier", right_on="CODE")
    pdf = pdf[pdf["Origin"].str.contains("SFO") & (pdf["WeatherDelay"] > 0)]
    want = pdf.groupby("DESCRIPTION")["WeatherDelay"].sum().astype(float).to_dict()
    assert full == want
    top = flights.top_delays(airline, ref, k=5).collect()
    assert [r.total_delay for r in top] == sorted(want.values(), reverse=True)[:5]


def test_delay_by_carrier_large_dimension_falls_back_to_shuffle_join(spark, scratch):
    airline, ref = _airline_fixture(spark, scratch)
    small = sorted(flights.delay_by_carrier(airline, ref).collect())
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert sorted(flights.delay_by_carrier(airline, ref).collect()) == small
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_small_delays_are_not_rounded_away(spark):
    fl = spark.createDataFrame([("c", "SFO", 0.004)] * 2, "UniqueCarrier string, Origin string, WeatherDelay double")
    ref = spark.createDataFrame([("c", "carrier")], "CODE string, DESCRIPTION string")
    assert flights.delay_by_carrier(fl, ref).collect()[0].total_delay == 0.008


def test_external_tables_over_partitioned_folders(spark, scratch):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    e.write.partitionBy("event_type").parquet(f"{scratch}/parts")
    for df in (sources.external_table(spark, unique_name("lt_p"), f"{scratch}/parts"),
               sources.sql_external_table(spark, unique_name("lt_q"), "parquet", path=f"{scratch}/parts")):
        assert df.count() == e.count()


def test_csv_keeps_any_text(spark, scratch):
    import pytest
    texts = ["", None, " lead ", "a\nb", 'a"b', '"', "back\\", 'x\\"y', "c,d", "\r\n", "\r", "\ttab", "é🎉", '""']
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, s string")
    sinks.csv_export(df, f"{scratch}/texts")
    got = {r.i: r.s for r in sources.csv_import(spark, f"{scratch}/texts", "i int, s string").collect()}
    assert got == dict(enumerate(texts))
    with pytest.raises(Exception, match="NULL marker"):
        sinks.csv_export(spark.createDataFrame([("\\N",)], "s string"), f"{scratch}/marker")


def test_partitioned_appends_write_few_files(spark, scratch):
    df = spark.range(0, 4000, 1, 16).selectExpr("id", "cast(id % 5 as int) as day")
    name = unique_name("lt_days")
    sinks.create_table(spark, name, df.schema, partition_by="day")
    sinks.append(df, name)
    assert spark.table(name).count() == 4000
    assert len(spark.table(name).inputFiles()) <= 10          # not one per task and day (80)
