"""Handover from a bulk copy to the feed, file-level compaction, generations and folding."""

import random
import threading

import pytest
from pyspark.sql import functions as F

from livetables.operators import changes, compact_files
from livetables.sinks import generations
from livetables.sources import changelog
from livetables.streaming import cdc_sync as sync
from livetables.streaming import handover
from tests.conftest import SF001

LOG = "segment bigint, position bigint, row_no int, k bigint, a string, b string, op string, held array<string>"


def _change(segment, position, k, op="upsert", **cells):
    return (segment, position, 0, k, cells.get("a"), cells.get("b"), op, list(cells))


class _Source:
    """A keyed table that changes while it is read: every call of `table` or `log` lets a few changes land."""

    def __init__(self, spark, rows, pending, kill_at=()):
        self.spark, self.rows, self.pending, self.done, self.calls, self.kill_at = spark, dict(rows), list(pending), [], 0, set(kill_at)

    def _step(self):
        self.calls += 1
        if self.calls in self.kill_at:
            raise KeyboardInterrupt
        for _ in range(random.Random(self.calls).randint(0, 4)):
            if self.pending:
                c = self.pending.pop(0)
                self.done.append(c)
                if c[6] == "delete":
                    self.rows.pop(c[3], None)
                else:
                    self.rows[c[3]] = {**self.rows.get(c[3], {"a": None, "b": None}), **{n: c[4 if n == "a" else 5] for n in c[7]}}

    def table(self):
        self._step()
        return self.spark.createDataFrame([(k, v["a"], v["b"]) for k, v in self.rows.items()], "k bigint, a string, b string")

    def log(self):
        self._step()
        return self.spark.createDataFrame(self.done, LOG)

    def finish(self):
        while self.pending:
            self._step()


def _pending(rng, n):
    out = []
    for i in range(n):
        k = rng.randint(-5, 45)
        cells = {c: rng.choice(["x", "y", None]) for c in rng.sample("ab", rng.randint(1, 2))}
        out.append(_change(i // 20, 10 ** 9 * (i % 20), k, "delete") if rng.random() < 0.25 else _change(i // 20, 10 ** 9 * (i % 20), k, **cells))
    return out


@pytest.mark.parametrize("seed,kills", [(1, ()), (3, (5, 6, 14))])
def test_copy_of_a_changing_table_equals_its_end(spark, scratch, seed, kills):
    rng = random.Random(seed)
    start = {k: {"a": f"a{k}", "b": "b"} for k in range(40)}
    source = _Source(spark, start, _pending(rng, 70), kills)
    for _ in range(len(kills) + 1):
        try:
            handover.copy_in_chunks(spark, source.table, source.log, f"{scratch}/copy", key="k", rows_per_chunk=9)
            break
        except KeyboardInterrupt:
            pass
    marks = handover.read_marks(spark, f"{scratch}/copy")
    assert len(marks.low) > 2 and all(a <= b for a, b in zip(marks.low, marks.high))
    assert handover.copy_in_chunks(spark, source.table, source.log, f"{scratch}/copy", key="k") == 0       # all there
    source.finish()
    log = spark.createDataFrame(source.done, LOG)
    out = handover.handed_over(spark, f"{scratch}/copy", log, keys=["k"], op_col="op", present_col="held")
    assert sorted(map(tuple, out.collect())) == sorted((k, v["a"], v["b"]) for k, v in source.rows.items())
    # a change from before its chunk's low is in the copy and isn't applied again
    late = handover.changes_after(log, marks, "k")
    assert late.count() < log.count()


def test_unfinished_copies_and_short_logs_are_refused(spark, scratch):
    source = _Source(spark, {k: {"a": "a", "b": "b"} for k in range(30)}, _pending(random.Random(4), 60), kill_at={7})
    with pytest.raises(KeyboardInterrupt):
        handover.copy_in_chunks(spark, source.table, source.log, f"{scratch}/copy", key="k", rows_per_chunk=9)
    with pytest.raises(ValueError, match="not copied yet"):
        handover.read_marks(spark, f"{scratch}/copy")
    handover.copy_in_chunks(spark, source.table, source.log, f"{scratch}/copy", key="k")
    with pytest.raises(ValueError, match="before the copy's end"):
        handover.handed_over(spark, f"{scratch}/copy", spark.createDataFrame(source.done[:1], LOG), keys=["k"], op_col="op", present_col="held")


def test_chunks_of_texts_and_nulls(spark, scratch):
    rows = spark.createDataFrame([("a", 1), ("m", 2), ("z", 3), (None, 4), ("mm", 5)], "k string, v int")
    log = spark.createDataFrame([], "segment bigint, position bigint, row_no int, k string, v int")
    handover.copy_in_chunks(spark, lambda: rows, lambda: log, f"{scratch}/copy", key="k", bounds=["m", "y"])
    parts = [sorted(r.v for r in spark.read.parquet(f"{scratch}/copy/rows/chunk={i}").collect()) for i in range(3)]
    assert parts == [[1, 4], [2, 5], [3]]
    assert sorted(r.v for r in handover.handed_over(spark, f"{scratch}/copy", log, keys=["k"]).collect()) == [1, 2, 3, 4, 5]
    empty = rows.limit(0)
    handover.copy_in_chunks(spark, lambda: empty, lambda: log, f"{scratch}/empty", key="k", bounds=[])
    assert handover.copied_rows(spark, f"{scratch}/empty").collect() == []


def test_chunk_of_equals_a_plain_search(spark):
    bounds = sorted(random.Random(1).sample(range(-500, 500), 73))
    df = spark.range(-600, 600).select("id", handover.chunk_of(F.col("id"), bounds, spark.range(1).schema["id"].dataType).alias("c"))
    assert all(r.c == sum(b <= r.id for b in bounds) for r in df.collect())


# ---------------------------------------------------------------------------
# Compaction by file
# ---------------------------------------------------------------------------

def _base(spark, scratch, n=4000, files=16):
    rows = spark.range(n).select(F.col("id").alias("k"), (F.col("id") % 7).cast("string").alias("a"), F.lit("b").alias("b"))
    compact_files.write_base(rows, f"{scratch}/base", ["k"], files=files)
    return rows


def test_only_files_with_changed_keys_are_rewritten(spark, scratch):
    _base(spark, scratch)
    path = f"{scratch}/base"
    before = {r.file for r in generations.manifest(spark, path, 0).collect()}
    log = spark.createDataFrame([_change(1, 1, 5, a="new"), _change(1, 2, 6, "delete"), _change(1, 3, 3999, b=None), _change(1, 4, 9000, a="added")], LOG)
    old = generations.read_generation(spark, path)
    done = compact_files.cdc_compact_files(spark, path, log, ["k"], op_col="op", present_col="held")
    assert done.generation == 1 and done.files == len(before) and done.rewritten == 2 and done.candidates < done.files
    after = {r.file for r in generations.manifest(spark, path, 1).collect()}
    assert len(before & after) == len(before) - 2
    got = {r.k: (r.a, r.b) for r in generations.read_generation(spark, path).collect()}
    want = {k: (str(k % 7), "b") for k in range(4000) if k != 6} | {5: ("new", "b"), 3999: (str(3999 % 7), None), 9000: ("added", None)}
    assert got == want
    assert old.count() == 4000                                          # a reader of the old generation still can
    # keys in no file touch none
    done = compact_files.cdc_compact_files(spark, path, spark.createDataFrame([_change(2, 1, 20_000, "delete"), _change(2, 2, -3, a="x")], LOG),
                                           ["k"], op_col="op", present_col="held")
    assert done.rewritten == 0 and generations.read_generation(spark, path).count() == 4001


def test_random_changes_with_null_keys_and_ranges_that_overlap(spark, scratch):
    rng = random.Random(7)
    rows = {(rng.choice([None, *range(50)]), rng.randint(0, 3)): f"v{i}" for i in range(150)}
    path = f"{scratch}/base"
    df = spark.createDataFrame([(k, j, v) for (k, j), v in rows.items()], "k bigint, j int, v string")
    folder = generations.new_folder(path)
    df.repartition(6).write.parquet(folder)                             # ranges overlap
    listed = compact_files.file_index(spark.read.schema(df.schema).parquet(folder), ["k", "j"])
    generations.publish(spark, path, listed, df.schema, None)
    for step in range(3):
        part = {(rng.choice([None, *range(70)]), rng.randint(0, 3)): rng.choice(["upsert", "delete"]) for _ in range(12)}
        log = spark.createDataFrame([(step, i, 0, k, j, f"s{step}", op) for i, ((k, j), op) in enumerate(part.items())],
                                    "segment bigint, position bigint, row_no int, k bigint, j int, v string, op string")
        compact_files.cdc_compact_files(spark, path, log, ["k", "j"], op_col="op", bins=4)
        for key, op in part.items():
            rows.pop(key, None) if op == "delete" else rows.update({key: f"s{step}"})
        assert {(r.k, r.j): r.v for r in generations.read_generation(spark, path).collect()} == rows


def test_writers_are_one_at_a_time_and_old_files_go(spark, scratch):
    _base(spark, scratch, n=100, files=4)
    path = f"{scratch}/base"
    listed, schema = generations.manifest(spark, path, 0), generations.read_generation(spark, path).schema
    with pytest.raises(ValueError, match="is at generation 0"):
        generations.publish(spark, path, listed, schema, 5)
    with pytest.raises(ValueError, match="written by writer"):
        generations.publish(spark, path, listed, schema, 5, writer="other")
    for position in range(1, 4):
        log = spark.createDataFrame([_change(1, position, 1, a=f"v{position}")], LOG)
        compact_files.cdc_compact_files(spark, path, log, ["k"], op_col="op", present_col="held")
    gone = generations.remove_old(spark, path, keep=2)
    assert len(gone) == 2 and generations.current(spark, path) == 3      # what generations 0 and 1 alone listed
    assert {r.k: r.a for r in generations.read_generation(spark, path).collect()}[1] == "v3"
    assert generations.read_generation(spark, path, 2).count() == 100
    assert generations.remove_old(spark, path, keep=2) == []


# ---------------------------------------------------------------------------
# Folding of the streamed copy
# ---------------------------------------------------------------------------

SCHEMA = changelog.change_log_schema("user_id bigint", "event_id bigint")
CELLS = "ts timestamp_ntz, value double, event_type string"


def _log(spark):
    from livetables.plans.catalog import events_change_log
    return events_change_log(spark.read.parquet(f"{SF001}/events.parquet"))


def _sync(spark, root, checkpoint):
    sync.cdc_sync(spark, f"{root}/log", f"{root}/copy", f"{root}/{checkpoint}", log_schema=SCHEMA, cells_schema=CELLS, keyspace="shop",
                  table="click", reject_path=f"{root}/rejects", available_now=True, max_files_per_trigger=1, segments_per_folder=2).awaitTermination()


def test_fold_keeps_rows_and_replays_out(spark, scratch):
    log = _log(spark).where("table_name = 'click'").persist()
    want = sorted((r.event_id, r.user_id) for r in log.select("pk.user_id", "ck.event_id").collect())
    for part in range(4):
        log.where(F.col("position") % 4 == part).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
        _sync(spark, scratch, "one")
        rows = sync.read_copy(spark, f"{scratch}/copy").count()
        batches = len(sync._batches(spark, f"{scratch}/copy"))
        number = sync.fold(spark, f"{scratch}/copy")
        assert sync.read_copy(spark, f"{scratch}/copy").count() == rows
        assert (number is None) == (part == 0)                           # the newest batch is left alone
        assert batches <= 6                                               # two groups of folders: does not grow with the batches
    log.coalesce(1).write.mode("append").parquet(f"{scratch}/log")      # all of it again
    _sync(spark, scratch, "one")
    _sync(spark, scratch, "two")                                         # and by a stream that starts anew
    assert sorted((r.event_id, r.user_id) for r in sync.read_copy(spark, f"{scratch}/copy").collect()) == want
    assert sync.fold(spark, f"{scratch}/copy", upto={r: 10 ** 6 for _, r, _ in sync._batches(spark, f"{scratch}/copy")}) is not None
    assert sorted((r.event_id, r.user_id) for r in sync.read_copy(spark, f"{scratch}/copy").collect()) == want
    assert sync.fold(spark, f"{scratch}/copy") is None


def test_readers_during_folds_see_every_row_once(spark, scratch):
    log = _log(spark).where("table_name = 'click'").persist()
    for part in range(5):
        log.where(F.col("position") % 5 == part).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
    _sync(spark, scratch, "one")
    n = log.count()
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(sync.read_copy(spark, f"{scratch}/copy").count())
    reader = threading.Thread(target=read)
    reader.start()
    run = sync._batches(spark, f"{scratch}/copy")[0][1]
    for batch in range(4):
        sync.fold(spark, f"{scratch}/copy", upto={run: batch}, keep=5)       # a read ends within four folds
    stop.set()
    reader.join()
    assert len(seen) > 2 and set(seen) == {n}


def test_a_failed_fold_is_started_again(spark, scratch, monkeypatch):
    log = _log(spark).where("table_name = 'click'").persist()
    for part in range(3):
        log.where(F.col("position") % 3 == part).coalesce(1).write.mode("append").parquet(f"{scratch}/log")
    _sync(spark, scratch, "one")
    real = generations._write

    def dies(fs, file, text, overwrite=False):
        if "CURRENT" in file.toString():
            raise RuntimeError("died before the pointer")
        real(fs, file, text, overwrite)
    monkeypatch.setattr(generations, "_write", dies)
    with pytest.raises(RuntimeError):
        sync.fold(spark, f"{scratch}/copy")
    monkeypatch.undo()
    assert sync.read_copy(spark, f"{scratch}/copy").count() == log.count()
    assert sync.fold(spark, f"{scratch}/copy") == 0
    assert sync.read_copy(spark, f"{scratch}/copy").count() == log.count()
