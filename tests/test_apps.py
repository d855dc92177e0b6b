"""The command-line programs run end to end on the test session."""

from livetables.plans import apps


def test_generate_load_query_programs(spark, scratch, capsys):
    apps.main(["generate", "0.01", f"{scratch}/ticks"])
    apps.main(["load-ticks", "row", f"{scratch}/ticks"])
    apps.main(["query-ticks", "--runs", "1"])
    out = capsys.readouterr().out
    assert "loaded trades in" in out
    assert out.count(": mean ") == 3
    assert spark.table("QUOTES").count() == 7914


def test_flights_bulk_copy_and_feed_programs(spark, scratch, capsys):
    import os

    from pyspark.sql import functions as F

    from tests.conftest import SF001
    li = spark.read.parquet(f"{SF001}/lineitem.parquet")
    li.select(F.year("l_shipdate").alias("Year"), F.month("l_shipdate").alias("Month"),
              F.col("l_partkey").cast("string").alias("UniqueCarrier"),
              F.lit("SFO").alias("Origin"), (F.col("l_tax") * 100).cast("int").alias("WeatherDelay")
              ).write.parquet(f"{scratch}/airline")
    spark.read.parquet(f"{SF001}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("CODE"), F.col("p_name").alias("DESCRIPTION")
    ).write.parquet(f"{scratch}/ref")
    apps.main(["flights", f"{scratch}/airline", f"{scratch}/ref"])
    assert "total_delay" in capsys.readouterr().out
    assert spark.table("airline").columns[:2] == ["Year_", "Month_"]

    apps.main(["bulk-copy", "parquet", "nation_src", "n_regionkey", "--option",
               f"path={SF001}/nation.parquet"])
    assert spark.table("copy_nation_src").count() == 25

    os.makedirs(f"{scratch}/msgs")
    with open(f"{scratch}/msgs/a.json", "w") as f:
        f.write('{"k": 1}\n{"k": "x"}\n')
    apps.main(["json-feed", f"{scratch}/msgs", f"{scratch}/good", f"{scratch}/rej", f"{scratch}/ck",
               "--schema", "k int", "--timeout", "60", "--max-batches", "1"])
    assert spark.read.parquet(f"{scratch}/good").count() == 1
    assert spark.read.parquet(f"{scratch}/rej").count() == 1


def test_cdc_sync_program(spark, scratch):
    from pyspark.sql import functions as F

    from livetables.sources import changelog
    from livetables.streaming.cdc_sync import read_copy, unknown_tables_report
    from tests.conftest import SF001
    e = spark.read.parquet(f"{SF001}/events.parquet")
    log = changelog.change_log_from_rows(
        e.select("user_id", "event_id", "ts", "value", "event_type"), keyspace="shop",
        table=F.col("event_type"), pk=["user_id"], ck=["event_id"],
        segment=F.col("user_id") % 4, position=F.col("event_id"))
    log.unionByName(log).write.parquet(f"{scratch}/log")          # delivered twice
    apps.main(["cdc-sync", f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ck", "shop", "VIEW",
               "--log-schema", changelog.change_log_schema("user_id bigint", "event_id bigint"),
               "--cells-schema", "ts timestamp_ntz, value double, event_type string", "--available-now",
               "--rejects", f"{scratch}/rej", "--report", f"{scratch}/report", "--known-table", "shop.view",
               "--known-table", "shop.click", "--max-files", "2"])
    got = read_copy(spark, f"{scratch}/copy").select("event_id", "user_id", "ts", "value")
    want = e.where("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    told = {r.table_name: r.n for r in unknown_tables_report(spark, f"{scratch}/report").collect()}
    assert told == {r.event_type: r["count"] for r in e.groupBy("event_type").count().collect()
                    if r.event_type not in ("view", "click")}        # delivered twice, counted once
