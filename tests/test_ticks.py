"""Tick rollups and the tick generator: hand-made cases and properties."""

from pyspark.sql import functions as F
from pyspark.sql import Row

from livetables.operators import ticks
from livetables.plans.loads import load_ticks, tick_queries, tick_query
from livetables.sources import generators

QUOTE_DDL = "sym string, ex string, bid double, time string, date string, seq bigint"
TRADE_DDL = "sym string, ex string, price string, time string, date string, size double, seq bigint"
DAY = "2016-06-06"


def _symbols(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "value string")


def test_last_quote_uses_order_not_scan_order(spark):
    # Rows arrive out of order across partitions; the highest seq wins.
    rows = [("SY01", "NYSE", 5.0, "01:00:00.000", DAY, 3),
            ("SY01", "NYSE", 9.0, "01:00:00.000", DAY, 7),   # same time (tie): seq decides
            ("SY01", "NYSE", 1.0, "02:00:00.000", DAY, 1)]
    q = spark.createDataFrame(rows, QUOTE_DDL).repartition(3)
    out = ticks.last_quote_by_symbol(q, _symbols(spark, "SY01"), order="seq").collect()
    assert out == [Row(sym="SY01", last_bid=9.0)]


def test_symbol_not_listed_and_other_day_are_left_out(spark):
    rows = [("SY01", "NYSE", 5.0, "01:00:00.000", DAY, 1),
            ("S399", "NYSE", 6.0, "01:00:00.000", DAY, 2),          # not in S
            ("SY01", "NYSE", 7.0, "01:00:00.000", "2016-06-07", 3)]  # other day
    q = spark.createDataFrame(rows, QUOTE_DDL)
    out = ticks.last_quote_by_symbol(q, _symbols(spark, "SY01"), order="seq").collect()
    assert out == [Row(sym="SY01", last_bid=5.0)]


def test_null_bid_can_be_last(spark):
    rows = [("SY01", "NYSE", 5.0, "01:00:00.000", DAY, 1),
            ("SY01", "NYSE", None, "01:00:01.000", DAY, 2)]
    q = spark.createDataFrame(rows, QUOTE_DDL)
    out = ticks.last_quote_by_symbol(q, _symbols(spark, "SY01"), order="seq").collect()
    assert out == [Row(sym="SY01", last_bid=None)]


def test_empty_day_gives_no_rows(spark):
    q = spark.createDataFrame([("SY01", "NYSE", 5.0, "01:00:00.000", DAY, 1)], QUOTE_DDL)
    assert ticks.last_quote_by_symbol(q, _symbols(spark, "SY01"), day="2016-06-08").count() == 0


def test_last_price_keeps_text_type(spark):
    rows = [("SY01", "NYSE", "12.5000", "01:00:00.000", DAY, 1.0, 1),
            ("SY01", "NYSE", "9.1000", "01:00:00.000", DAY, 1.0, 2),
            ("SY01", "LON", "3.0000", "01:00:00.000", DAY, 1.0, 3)]
    t = spark.createDataFrame(rows, TRADE_DDL)
    out = ticks.last_price_by_symbol_exchange(t, _symbols(spark, "SY01"), order="seq")
    assert dict(out.dtypes)["last_price"] == "string"
    assert sorted(out.collect()) == [Row(sym="SY01", ex="LON", last_price="3.0000"),
                                     Row(sym="SY01", ex="NYSE", last_price="9.1000")]


def test_last_by_date_and_time_without_a_sequence(spark):
    rows = [("SY01", "NYSE", 5.0, "09:15:00", DAY, 3), ("SY01", "NYSE", 9.0, "10:15:00.500", DAY, 1),
            ("SY01", "NYSE", 1.0, "bad", DAY, 9), ("SY01", "NYSE", 2.0, "10:15:00.499", DAY, 2)]
    q = spark.createDataFrame(rows, QUOTE_DDL).drop("seq")
    assert ticks.last_quote_by_symbol(q, _symbols(spark, "SY01")).collect() == [Row(sym="SY01", last_bid=9.0)]
    ties = spark.createDataFrame([("SY01", "NYSE", float(i), "10:00:00", DAY, i) for i in range(20)], QUOTE_DDL).drop("seq")
    got = {ticks.last_quote_by_symbol(ties.repartition(n), _symbols(spark, "SY01")).collect()[0].last_bid for n in (1, 3, 7)}
    assert len(got) == 1                       # ties have a fixed order


def test_hash_aggregates_for_text_prices(spark):
    from livetables.plans import inspect
    t = spark.createDataFrame([("SY01", "NYSE", "1.0", "01:00:00.000", DAY, 2.0, 1)], TRADE_DDL)
    df = ticks.last_price_by_symbol_exchange(t, _symbols(spark, "SY01"))
    assert "SortAggregate" not in inspect.plan_text(df)


def test_hour_of_usual_texts(spark):
    from livetables.functions.expressions import hour_of_text
    texts = {"09:15:00": 9, "9:15": 9, "23:59:59.123": 23, "24:00:00": None, "": None, "x": None, "2024-01-02 07:00:00": 7}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", hour_of_text("t").alias("h"))
    assert {r.t: r.h for r in df.collect()} == texts


def test_bad_time_text_gives_null_hour_not_failure(spark):
    rows = [("SY01", "NYSE", "1.0", "03:10:00.000", DAY, 2.0, 1),
            ("SY01", "NYSE", "1.0", "03:59:59.999", DAY, 4.0, 2),
            ("SY01", "NYSE", "1.0", "not a time", DAY, 8.0, 3)]
    t = spark.createDataFrame(rows, TRADE_DDL)
    out = {(r.sym, r.hr): r.avg_size for r in ticks.hourly_avg_size(t, _symbols(spark, "SY01")).collect()}
    assert out == {("SY01", 3): 3.0, ("SY01", None): 8.0}


def test_inner_join_as_written_duplicates_on_duplicate_symbol(spark):
    # S is unique in the reference; with a repeated symbol the inner join (as
    # written) counts rows twice while left_semi does not.
    rows = [("SY01", "NYSE", "1.0", "01:00:00.000", DAY, 2.0, 1),
            ("SY01", "NYSE", "1.0", "01:00:00.000", DAY, 4.0, 2)]
    t = spark.createDataFrame(rows, TRADE_DDL)
    s = _symbols(spark, "SY01", "SY01")
    assert ticks.hourly_avg_size(t, s).collect()[0].avg_size == 3.0
    assert ticks.hourly_avg_size(t, s, join_type="left_semi").collect()[0].avg_size == 3.0


def test_max_bid_reduces_before_join(spark):
    trades = spark.createDataFrame([("A",), ("A",), ("B",), ("C",)], "sym string")
    quotes = spark.createDataFrame([("A", 1.0), ("A", 7.0), ("B", 3.0), ("D", 9.0)],
                                   "sym string, bid double")
    out = sorted(ticks.max_bid_by_symbol(trades, quotes).collect())
    assert out == [Row(sym="A", max_bid=7.0), Row(sym="B", max_bid=3.0)]


# --- generator -------------------------------------------------------------

def test_generator_same_rows_for_any_partition_count(spark):
    a = generators.gen_quotes(spark, rows=3000, partitions=1).collect()
    b = generators.gen_quotes(spark, rows=3000, partitions=7).collect()
    c = generators.gen_quotes(spark, rows=3000, partitions=200).collect()
    assert sorted(a) == sorted(b) == sorted(c)
    t1 = generators.gen_trades(spark, rows=2000, partitions=1).collect()
    t2 = generators.gen_trades(spark, rows=2000, partitions=13).collect()
    assert sorted(t1) == sorted(t2)


def test_generator_value_ranges(spark):
    q = generators.gen_quotes(spark, rows=20000, partitions=8)
    s = q.agg(F.countDistinct("sym").alias("syms"), F.countDistinct("ex").alias("exs"),
              F.min("bid").alias("lo"), F.max("bid").alias("hi"),
              F.countDistinct("date").alias("days"),
              F.min(F.substring("time", 1, 2)).alias("h0"),
              F.max(F.substring("time", 1, 2)).alias("h1")).first()
    assert s.syms == 400 and s.exs == 9 and s.days == 1
    assert 0 <= s.lo and s.hi < 100000
    assert (s.h0, s.h1) == ("00", "07")
    assert len(q.columns) == 6 + 15
    assert q.where(~F.col("time").rlike(r"^\d\d:\d\d:\d\d\.\d\d\d$")).count() == 0
    t = generators.gen_trades(spark, rows=20000, partitions=8)
    r = t.agg(F.min(F.col("price").cast("decimal(10,4)")).alias("plo"),
              F.max(F.col("price").cast("decimal(10,4)")).alias("phi"),
              F.min("size").alias("slo"), F.max("size").alias("shi")).first()
    assert r.plo >= 0 and r.phi < 10000 and 0 <= r.slo and r.shi < 1000
    assert t.where(~F.col("price").rlike(r"^\d+\.\d{4}$")).count() == 0
    assert len(t.columns) == 7 + 9


def test_symbols_first_100_names(spark):
    names = [r.value for r in generators.gen_symbols(spark).collect()]
    assert names[:3] == ["SY00", "SY01", "SY02"] and names[-1] == "SY99" and len(names) == 100
    all_names = [r.value for r in generators.gen_symbols(spark, 400).collect()]
    assert all_names[100] == "S100" and all_names[-1] == "S399" and len(set(all_names)) == 400


def test_scale_row_counts(spark):
    assert generators.gen_quotes(spark, scale=0.01).count() == 7914
    assert generators.gen_trades(spark, scale=0.01).count() == 1163


def test_generate_load_and_query(spark, scratch):
    paths = generators.generate_to(spark, f"{scratch}/ticks", scale=0.02, partitions=4)
    times = load_ticks(spark, scratch + "/ticks", provider="row", bucket_by_symbol=True, buckets=4,
                       day_partitions=False, prefix="t1_")
    assert set(times) == {"trades", "quotes", "symbols"}
    assert spark.table("t1_QUOTES").count() == 15829
    assert spark.table("t1_S").count() == 100
    res = tick_queries(spark, prefix="t1_")
    # brute force on the generated rows
    q = spark.read.parquet(paths["quotes"]).toPandas()
    s = set(spark.read.parquet(paths["symbols"]).toPandas()["value"])
    q = q[q["sym"].isin(s)]
    last = q.sort_values("seq").groupby("sym").tail(1)
    got = {r.sym: r.last_bid for r in tick_query(spark, "last_quote_by_symbol", prefix="t1_", order="seq").collect()}
    assert got == dict(zip(last["sym"], last["bid"]))
    latest = q.merge(q.groupby("sym")["time"].max().reset_index(), on=["sym", "time"])        # by date and time
    at_last = latest.groupby("sym")["bid"].apply(set).to_dict()
    got = {r.sym: r.last_bid for r in res["last_quote_by_symbol"].collect()}
    assert got.keys() == at_last.keys() and all(v in at_last[k] for k, v in got.items())
    t = spark.read.parquet(paths["trades"]).toPandas()
    t = t[t["sym"].isin(s)]
    t["hr"] = t["time"].str[:2].astype(int)
    want_avg = t.groupby(["sym", "hr"])["size"].mean().to_dict()
    got_avg = {(r.sym, r.hr): r.avg_size for r in res["hourly_avg_size"].collect()}
    assert got_avg.keys() == want_avg.keys()
    assert all(abs(got_avg[k] - want_avg[k]) < 1e-6 for k in want_avg)
    last_price = t.sort_values("seq").groupby(["sym", "ex"]).tail(1)
    want_lp = {(a, b): c for a, b, c in zip(last_price["sym"], last_price["ex"], last_price["price"])}
    got_lp = {(r.sym, r.ex): r.last_price for r in 
              tick_query(spark, "last_price_by_symbol_exchange", prefix="t1_", order="seq").collect()}
    assert got_lp == want_lp


def test_day_advances_every_10000_rows(spark):
    q = generators.gen_quotes(spark, rows=35000, partitions=3, days=3)
    days = {r.seq // 10000: r.date for r in q.select("seq", "date").collect()}
    assert days == {0: "2016-06-06", 1: "2016-06-07", 2: "2016-06-08", 3: "2016-06-06"}


def test_day_partitioned_load_prunes_folders(spark, scratch):
    from livetables.plans import inspect
    generators.generate_to(spark, f"{scratch}/ticks", scale=0.01, partitions=2)
    load_ticks(spark, f"{scratch}/ticks", prefix="t2_")
    res = tick_queries(spark, prefix="t2_")
    df = res["last_quote_by_symbol"]
    assert "PartitionFilters: [isnotnull(date" in inspect.plan_text(df)
    assert df.count() > 0


def test_loaded_ticks_and_their_staging_are_compact_files(spark, scratch):
    import glob
    import pyarrow.parquet as pq
    from livetables.plans import catalog
    spark.range(0, 6000, 1, 3).select(F.col("id").alias("event_id")).write.parquet(f"{scratch}/sf/events.parquet")
    before = set(glob.glob(f"{catalog.scratch_path(spark, 'x').rsplit('/', 1)[0].removeprefix('file:')}/staged_ticks-*"))
    assert catalog.q_load_ticks(spark, f"{scratch}/sf").count() > 0
    prefix = catalog._LEFT[catalog.session_key(spark), "lt_staged"]
    files = [f.removeprefix("file:") for t in ("QUOTES", "TRADES") for f in spark.table(prefix + t).inputFiles()]
    staged = set(glob.glob(f"{catalog.scratch_path(spark, 'x').rsplit('/', 1)[0].removeprefix('file:')}/staged_ticks-*")) - before
    files += [f for d in staged for k in ("quotes", "trades") for f in glob.glob(f"{d}/{k}/*/*.parquet")]
    assert staged and {pq.ParquetFile(f).metadata.row_group(0).column(5).compression for f in files} == {"ZSTD"}
    assert spark.table(prefix + "QUOTES").count() == spark.table(prefix + "TRADES").count() == 6000


def test_ids_are_dealt_by_day_to_tasks_of_bounded_size(spark):
    ids = spark.range(0, 100_000, 1, 2)
    dealt = generators.dealt_by_day(ids, days=4, per_task=5000)
    rows = dealt.select("id", F.spark_partition_id().alias("p")).collect()
    assert sorted(r.id for r in rows) == list(range(100_000))
    size, days = {}, {}
    for r in rows:
        size[r.p] = size.get(r.p, 0) + 1
        days.setdefault(r.p, set()).add(r.id // 10_000 % 4)
    assert len(size) == 20 and max(size.values()) < 10_000 and max(map(len, days.values())) <= 2
