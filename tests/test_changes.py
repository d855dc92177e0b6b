"""Change feed: batch operators, then the stream (replays, restarts, retries)."""

import random

from pyspark.sql import functions as F

from livetables.operators import changes
from livetables.sources import changelog
from livetables.streaming import cdc_sync as sync
from tests.conftest import SF001

PK2 = "year int, region string"
CK = "flight int"
LOG_DDL = changelog.change_log_schema(PK2, CK, with_op=True)


def _log(spark, rows):
    return spark.createDataFrame(rows, LOG_DDL)


def _rec(seg, pos, row, table, pk, ck, cells, op=None, ks="air"):
    return (seg, pos, row, ks, table, pk, ck, cells, op)


def test_flatten_order_key_only_and_collection_cells(spark):
    log = _log(spark, [
        _rec(1, 10, 0, "airline", (2001, "west"), (7,), '{"delay": 5, "tags": ["a"], "origin": "SFO"}'),
        _rec(1, 11, 0, "airline", (2001, "west"), (8,), None),                  # key-only row
    ])
    flat = changes.cdc_flatten(log, "delay int, tags array<string>, origin string")
    # simple cells first, then the (two-column) partition key, then clustering
    assert flat.columns == ["delay", "origin", "year", "region", "flight"]
    rows = sorted(flat.collect(), key=lambda r: r.flight)
    assert rows[0].asDict() == {"delay": 5, "origin": "SFO", "year": 2001, "region": "west", "flight": 7}
    assert rows[1].asDict() == {"delay": None, "origin": None, "year": 2001, "region": "west", "flight": 8}


def test_target_is_case_insensitive(spark):
    log = _log(spark, [_rec(1, 1, 0, "AirLine", (1, "a"), (1,), "{}"),
                       _rec(1, 2, 0, "other", (1, "a"), (1,), "{}"),
                       _rec(1, 3, 0, "airline", (1, "a"), (1,), "{}", ks="AIR")])
    assert changes.cdc_target(log, "air", "AIRLINE").count() == 2


def test_replay_guard_keeps_rows_under_one_position(spark):
    one_entry = [_rec(1, 5, i, "airline", (1, "a"), (i,), "{}") for i in range(3)]
    log = _log(spark, one_entry + one_entry)          # same file twice
    out = changes.cdc_replay_guard(log)
    assert out.count() == 3


def test_positions_and_unknown_tables(spark):
    log = _log(spark, [_rec(1, 5, 0, "airline", (1, "a"), (1,), "{}"),
                       _rec(1, 9, 0, "airline", (1, "a"), (2,), "{}"),
                       _rec(2, 3, 0, "Mystery", (1, "a"), (3,), "{}"),
                       _rec(2, 4, 0, "mystery", (1, "a"), (4,), "{}")])
    assert sorted(changes.cdc_positions(log).collect()) == [(1, 9), (2, 4)]
    known = spark.createDataFrame([("AIR", "airline")], "keyspace_name string, table_name string")
    rep = changes.cdc_unknown_tables(log, known)
    assert sorted((r.table_name, r.n) for r in rep.collect()) == [("Mystery", 1), ("mystery", 1)]


IN_SEGMENT = ("position", "row_no")


def test_compact_bulk_copy_then_changes_one_row_per_key(spark):
    base = spark.createDataFrame([(1, "a", 10, 1.0), (2, "b", 20, 2.0), (3, "c", 30, 3.0)],
                                 "k int, name string, pos_in_copy int, v double").drop("pos_in_copy")
    ch = spark.createDataFrame(
        [(1, "a2", 100.0, 5, 0, "upsert"), (1, "a3", 101.0, 7, 0, "upsert"),
         (2, None, None, 8, 0, "delete"), (4, "d", 4.0, 9, 0, "upsert"),
         (4, "d", 4.0, 9, 0, "upsert")],        # replayed
        "k int, name string, v double, position bigint, row_no int, op string")
    out = changes.cdc_compact(base, ch, keys=["k"], op_col="op", order=IN_SEGMENT)
    assert sorted(out.collect()) == [(1, "a3", 101.0), (3, "c", 3.0), (4, "d", 4.0)]
    no_ops = changes.cdc_compact(base, ch.drop("op"), keys=["k"], order=IN_SEGMENT)
    assert sorted(no_ops.collect())[1] == (2, None, None)     # key-only insert, as the feed wrote it


def test_compact_hot_key(spark):
    # one key holds most rows; the newest still wins
    ch = spark.range(0, 50000).select(
        F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id")).cast("int").alias("k"),
        F.col("id").cast("double").alias("v"), F.col("id").alias("position"),
        F.lit(0).alias("row_no"))
    out = changes.cdc_compact(None, ch, keys=["k"], order=IN_SEGMENT).where("k = 1").collect()
    assert out == [(1, 49998.0)]


# --- stream ----------------------------------------------------------------

EVENT_LOG_DDL = changelog.change_log_schema("user_id bigint", "event_id bigint")
CELLS = "ts timestamp_ntz, value double, event_type string"


def _event_log(spark):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    log = changelog.change_log_from_rows(
        e.select("user_id", "event_id", "ts", "value", "event_type"), keyspace="shop",
        table=F.col("event_type"), pk=["user_id"], ck=["event_id"],
        segment=F.col("user_id") % 4, position=F.col("event_id"))
    return e, log


def _expected(e):
    return e.where("event_type = 'click'").select("event_id", "user_id", "ts", "value")


def _synced(spark, target):
    return sync.read_copy(spark, target).select("event_id", "user_id", "ts", "value")


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _run(spark, log_dir, target, ckpt, **kw):
    kw.setdefault("reject_path", f"{target}-rejects")
    q = sync.cdc_sync(spark, log_dir, target, ckpt, log_schema=EVENT_LOG_DDL, cells_schema=CELLS,
                      keyspace="SHOP", table="Click", available_now=True, max_files_per_trigger=2,
                      **kw)
    q.awaitTermination(300)
    assert q.exception() is None


def test_stream_replays_shuffled_files_restart_and_retry(spark, scratch):
    e, log = _event_log(spark)
    chunks = [log.where(F.col("event_id") % 6 == i) for i in range(6)]
    order = list(range(6)) + [2, 4]                   # two chunks delivered again
    random.Random(7).shuffle(order)
    log_dir, target, ckpt = f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt"
    for i in order[:4]:
        chunks[i].write.mode("append").parquet(log_dir)
    _run(spark, log_dir, target, ckpt)
    for i in order[4:]:
        chunks[i].write.mode("append").parquet(log_dir)
    _run(spark, log_dir, target, ckpt)                # restart from the checkpoint
    got = _synced(spark, target)
    assert got.count() == _expected(e).count()
    assert _same(got, _expected(e))
    _run(spark, log_dir, target, ckpt)                # nothing new: unchanged
    assert _same(_synced(spark, target), _expected(e))
    # a retried batch: same batch id, same input -> its folder is rewritten
    run_id = sync.run_id_for(spark, ckpt)
    batch = spark.read.schema(EVENT_LOG_DDL).parquet(log_dir)
    batch = batch.where(F.lower("table_name") == "click")
    for _ in range(2):
        sync.sync_batch(batch, 999, target_path=target, run_id=run_id, cells_schema=CELLS,
                        reject_path=f"{target}-rejects")
    assert _same(_synced(spark, target), _expected(e))
    # a new checkpoint (batch ids restart at 0) never overwrites the old run
    _run(spark, log_dir, target, f"{scratch}/ckpt2")
    assert _same(_synced(spark, target), _expected(e))


def test_stream_unknown_table_report(spark, scratch):
    e, log = _event_log(spark)
    log.write.parquet(f"{scratch}/log")
    known = spark.createDataFrame([("shop", "click"), ("shop", "view")],
                                  "keyspace_name string, table_name string")
    _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt",
         report_path=f"{scratch}/report", known_tables=known)
    rep = sync.unknown_tables_report(spark, f"{scratch}/report").drop("keyspace_name")
    want = (e.where("event_type not in ('click', 'view')").groupBy(F.col("event_type").alias("table_name"))
            .agg(F.count(F.lit(1)).alias("n")))
    assert _same(rep, want)
    assert _same(_synced(spark, f"{scratch}/copy"), _expected(e))


def test_stream_rejects_cells_that_are_not_json(spark, scratch):
    e, log = _event_log(spark)
    bad = log.where("event_type = 'click'").limit(3).select(
        *[F.lit("{broken").alias("cells") if c == "cells" else F.col(c) for c in log.columns]
    ).withColumn("position", F.col("position") + 10_000_000)
    log.unionByName(bad).write.parquet(f"{scratch}/log")
    _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", reject_path=f"{scratch}/rej")
    assert spark.read.parquet(f"{scratch}/rej").count() == 3
    assert _same(_synced(spark, f"{scratch}/copy"), _expected(e))


def test_copy_folders_group_segments(spark, scratch):
    e, log = _event_log(spark)
    log.write.parquet(f"{scratch}/log")
    _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", segments_per_folder=2)
    groups = {r.seg_group for r in spark.read.parquet(f"{scratch}/copy").select("seg_group").distinct().collect()}
    assert groups == {0, 1}


def test_latest_raw_record_then_flatten(spark):
    log = _log(spark, [
        _rec(1, 10, 0, "airline", (2001, "west"), (7,), '{"delay": 5}'),
        _rec(1, 12, 0, "airline", (2001, "west"), (7,), '{"delay": 9}'),
        _rec(2, 3, 0, "airline", (2001, "east"), (7,), '{"delay": 1}'),
    ])
    latest = changes.cdc_latest(log, keys=["pk.year", "pk.region", "ck.flight"])
    assert latest.columns == log.columns
    flat = changes.cdc_flatten(latest, "delay int")
    assert sorted(flat.collect()) == [(1, 2001, "east", 7), (9, 2001, "west", 7)]


def test_compact_keeps_unchanged_base_rows_and_join_plans_agree(spark):
    from livetables.plans import inspect
    base = spark.createDataFrame([(1, 1.0), (2, 2.0), (3, 3.0), (3, 3.5)], "k int, v double")
    ch = spark.createDataFrame([(1, 10.0, 5, 0), (1, 11.0, 6, 0), (4, 4.0, 1, 0)],
                               "k int, v double, position bigint, row_no int")
    small = changes.cdc_compact(base, ch, keys=["k"], order=IN_SEGMENT)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = changes.cdc_compact(base, ch, keys=["k"], order=IN_SEGMENT)
        big_rows, big_tree = sorted(big.collect()), inspect.tree(big)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    want = [(1, 11.0), (2, 2.0), (3, 3.0), (3, 3.5), (4, 4.0)]
    assert sorted(small.collect()) == want and big_rows == want
    assert "SortMergeJoin" in big_tree or "ShuffledHashJoin" in big_tree or "BroadcastHashJoin" in big_tree
    assert "BroadcastHashJoin" in inspect.tree(small) and "LeftAnti" in inspect.plan_text(small)


def test_json_change_files_read_like_parquet(spark, scratch):
    e, log = _event_log(spark)
    log.write.json(f"{scratch}/jlog")
    back = changelog.cdc_read(spark, f"{scratch}/jlog", EVENT_LOG_DDL, fmt="json")
    flat = changes.cdc_flatten(changes.cdc_target(back, "shop", "click"), CELLS)
    assert _same(flat.select("event_id", "user_id", "ts", "value"), _expected(e))


def test_stream_can_delete_files_after_a_clean_read(spark, scratch):
    import glob
    import time
    e, log = _event_log(spark)
    log.repartition(3).write.parquet(f"{scratch}/log")
    import pytest
    with pytest.raises(ValueError):          # records of other tables would be lost
        _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", clean_source="delete")
    _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", clean_source="delete",
         report_path=f"{scratch}/report", known_tables=[("shop", "click"), ("shop", "view")])
    kept = spark.read.parquet(f"{scratch}/report")
    assert kept.count() == log.where("table_name <> 'click'").count()
    assert kept.where("unknown").count() == log.where("table_name not in ('click', 'view')").count()
    assert _same(_synced(spark, f"{scratch}/copy"), _expected(e))
    deadline = time.time() + 30
    while glob.glob(f"{scratch}/log/*.parquet") and time.time() < deadline:
        time.sleep(0.5)
    # the source removes files of committed batches (the last batch's files are
    # removed when the next batch commits, so at most one trigger's files stay)
    assert len(glob.glob(f"{scratch}/log/*.parquet")) <= 2


def test_run_ids_are_read_back_as_text(spark, scratch):
    for i in range(5):
        rid = sync.run_id_for(spark, f"{scratch}/ck{i}")
        assert rid.startswith("r") and not rid[1:].isdigit()


def test_latest_then_compact(spark):
    log = _log(spark, [
        _rec(1, 10, 0, "airline", (2001, "west"), (7,), '{"delay": 5}'),
        _rec(1, 5000, 0, "airline", (2001, "west"), (7,), '{"delay": 7}'),
        _rec(2, 12, 0, "airline", (2001, "west"), (7,), '{"delay": 9}'),     # a later segment, at a lower position
        _rec(2, 3, 0, "airline", (2002, "east"), (8,), '{"delay": 1}'),
    ])
    base = spark.createDataFrame([(2001, "west", 7, 0), (2003, "north", 9, 4)],
                                 "year int, region string, flight int, delay int")
    keys = ["year", "region", "flight"]
    want = [(2001, "west", 7, 9), (2002, "east", 8, 1), (2003, "north", 9, 4)]
    latest = changes.cdc_latest(log, keys=["pk.year", "pk.region", "ck.flight"])
    for rows in (log, latest):
        flat = changes.cdc_flatten(rows, "delay int", keep=changelog.IDENTITY)
        assert sorted(changes.cdc_compact(base, flat, keys=keys).collect()) == want


def test_compact_merges_cells(spark):
    base = spark.createDataFrame([(1, 10, "a"), (2, 20, "b"), (3, 30, "c"), (4, 40, "d")], "k int, x int, y string")
    cells = [(1, 1, 1, '{"x": 11}'), (2, 0, 1, '{"y": "late"}'),                       # 1: one cell in each change
             (1, 2, 2, '{"y": null}'), (1, 5, 2, '{}'),                           # 2: an explicit null, then a key-only change
             (3, 1, 3, '{"x": 99}'), (4, 0, 9, '{"y": "new"}')]
    log = spark.createDataFrame([(s, p, 0, "ks", "t", (k,), c, "upsert") for s, p, k, c in cells]
                                + [(3, 0, 0, "ks", "t", (3,), "{}", "delete"), (9, 0, 0, "ks", "t", (4,), None, "delete")],
                                "segment bigint, position bigint, row_no int, keyspace_name string, table_name string, "
                                "pk struct<k:int>, cells string, op string").withColumn("ck", F.struct())
    flat = changes.cdc_flatten(log, "x int, y string", keep=(*changelog.IDENTITY, "op"), present="held")
    out = changes.cdc_compact(base, flat, keys=["k"], op_col="op", present_col="held")
    assert sorted(out.collect(), key=lambda r: r.k) == [
        (1, 11, "late"), (2, 20, None), (3, 99, None), (9, None, "new")]


def test_order_columns_out_of_range_fail(spark):
    import pytest
    rows = spark.createDataFrame([(1, 10 ** 15, 0, 5)], "segment bigint, position bigint, row_no int, k int")
    with pytest.raises(Exception, match="order column position out of range: 1000000000000000"):
        rows.select(changes.order_key()).collect()
    with pytest.raises(Exception, match="out of range"):
        rows.select(changes.order_key(("k",), wide=True), changes.order_key((("segment"),), digits=(0,))).collect()
    top = spark.createDataFrame([(10 ** 13 - 1, 10 ** 15 - 1, 2 ** 31 - 1)], "segment bigint, position bigint, row_no int")
    assert top.select(changes.order_key().alias("o")).first().o == 10 ** 38 - 10 ** 10 + 2 ** 31 - 1


def test_orders_past_32_bits_sort_like_their_columns(spark):
    big = 2 ** 63 - 1
    cells = [(s, p, r) for s in (0, 1, big) for p in (0, 2 ** 31, 2 ** 32, 5_000_000_000, big) for r in (0, 1, 2 ** 31 - 1)]
    rows = spark.createDataFrame(cells, "segment bigint, position bigint, row_no int")
    assert [tuple(r) for r in rows.orderBy(changes.order_key(wide=True)).collect()] == sorted(cells)
    some = [c for c in cells if big not in c]
    rows = spark.createDataFrame(some, "segment bigint, position bigint, row_no int")
    assert [tuple(r) for r in rows.orderBy(changes.order_key()).collect()] == sorted(some)


def test_compaction_with_positions_past_32_bits(spark):
    log = spark.createDataFrame([(1, 4_000_000_000, 0, 1, 10), (1, 5_000_000_000, 0, 1, 20), (1, 4_999_999_999, 7, 1, 30)],
                                "segment bigint, position bigint, row_no int, k int, v int")
    assert [tuple(r) for r in changes.cdc_compact(None, log, ["k"]).collect()] == [(1, 20)]


def test_gaps(spark):
    rows = ([(1, p) for p in (5, 6, 7, 7, 10, 11, 2 ** 20, 2 ** 62)] + [(2, p) for p in range(100)] + [(3, 9)] + [(None, 1), (None, 4)]
            + [(4, None), (5, 65_535), (5, 65_536), (5, 65_538)])
    df = spark.createDataFrame(rows, "segment bigint, position bigint")
    got = sorted((tuple(r) for r in changes.cdc_gaps(df).collect()), key=repr)
    assert got == sorted([(1, 7, 8, 9), (1, 7, 12, 2 ** 20 - 1), (1, 7, 2 ** 20 + 1, 2 ** 62 - 1), (2, 99, None, None), (3, 9, None, None),
                          (None, 1, 2, 3), (5, 65_536, 65_537, 65_537)], key=repr)
    got = sorted((tuple(r) for r in changes.cdc_gaps(df.where("segment in (2, 3, 4)"), start=9, block_bits=20).collect()))
    assert got == [(2, 99, None, None), (3, 9, None, None), (4, 8, None, None)]
    assert changes.cdc_gaps(df.limit(0)).collect() == []


def test_gaps_of_random_positions(spark):
    for seed in range(3):
        rng = random.Random(seed)
        rows = [(s, p) for s in range(3) for p in rng.sample(range(2000), rng.choice([1, 50, 1500]))]
        got = sorted(tuple(r) for r in changes.cdc_gaps(spark.createDataFrame(rows, "segment bigint, position bigint"), block_bits=7).collect()
                     if r.gap_from is not None)
        want = []
        for s in range(3):
            own = sorted(p for t, p in rows if t == s)
            holes = [(a + 1, b - 1) for a, b in zip(own, own[1:]) if b - a > 1]
            want += [(s, holes[0][0] - 1, a, b) for a, b in holes]
        assert got == sorted(want)


BAD = ['{broken', '{"ts": "no time"}', '{"speed": 1}', '{"value": 1} x', '{"value": 1, "value": 2}']


def test_rejects_and_reports_do_not_grow_on_replay(spark, scratch):
    e, log = _event_log(spark)
    click = log.where("table_name = 'click'").limit(1)
    bad = [click.withColumn("cells", F.lit(c)).withColumn("position", F.lit(10_000_000 + i)) for i, c in enumerate(BAD)]
    everything = log
    for b in bad:
        everything = everything.unionByName(b)
    for _ in range(2):                                       # the same records in new files, once per run
        everything.write.mode("append").parquet(f"{scratch}/log")
        _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", reject_path=f"{scratch}/rej",
             report_path=f"{scratch}/report", known_tables=lambda: [("shop", "click")])
        rejects = spark.read.parquet(f"{scratch}/rej")
        assert sorted(r.reject_reason for r in rejects.collect()) == [
            "field of the wrong type: ts", "not a JSON object", "not a JSON object", "repeated field", "unknown field: speed"]
        told = sync.unknown_tables_report(spark, f"{scratch}/report").drop("keyspace_name")
        assert _same(told, e.where("event_type <> 'click'").groupBy(F.col("event_type").alias("table_name"))
                     .agg(F.count(F.lit(1)).alias("n")))
    assert _same(_synced(spark, f"{scratch}/copy"), _expected(e))


def test_flatten_fails_on_what_does_not_fit(spark):
    import pytest
    log = _log(spark, [_rec(1, 10, 0, "airline", (2001, "west"), (7,), '{"delay": "late"}')])
    with pytest.raises(Exception, match="wrong type: delay"):
        changes.cdc_flatten(log, "delay int").collect()
    good, rejects = changes.cdc_split(log, "delay int")
    assert good.count() == 0 and rejects.collect()[0].reject_reason == "field of the wrong type: delay"


def test_another_folder_layout_is_refused(spark, scratch):
    import pytest
    _, log = _event_log(spark)
    log.write.parquet(f"{scratch}/log")
    _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", segments_per_folder=2)
    with pytest.raises(ValueError, match="segments per folder"):
        _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", segments_per_folder=3)


def test_only_touched_groups_are_opened(spark, scratch):
    _, log = _event_log(spark)
    log.write.parquet(f"{scratch}/log")
    _run(spark, f"{scratch}/log", f"{scratch}/copy", f"{scratch}/ckpt", segments_per_folder=1)
    batch = changes.cdc_target(log, "shop", "click").where("segment = 2")
    left = sync.unseen(batch, f"{scratch}/copy", "r", 0, changelog.IDENTITY, 1)
    assert left.count() == 0
    assert all("seg_group=2/" in f for f in left.inputFiles() if "/copy/" in f)
