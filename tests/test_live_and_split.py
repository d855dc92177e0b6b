"""Rollups kept current under a feed, and CSV files that many tasks read."""

import random

import pytest
from pyspark.sql import functions as F

from livetables.sinks import generations
from livetables.sinks import tables as sinks
from livetables.sources import tables as sources
from livetables.streaming import live_rollups as live

MEASURES = {"last": live.Last("v", "i"), "sum": live.Total("v", 2), "top": live.Greatest("v")}


def _rows(spark, rows):
    return spark.createDataFrame(rows, "i long, d date, sym string, v double")


def _merge(batch, number, path, run="r1"):
    return live.merge_batch(batch, number, path=path, run_id=run, day=F.col("d"), keys=["sym"], measures=MEASURES)


def _state(spark, path):
    return {(r.day, r.sym): (r.last, float(r["sum"]), r["sum__n"], r.top) for r in live.read_rollup(spark, path).collect()}


def _brute(rows):
    out = {}
    for i, d, s, v in sorted(rows):
        last, total, n, top = out.get((d, s), (None, 0.0, 0, None))
        out[d, s] = (v, total + v, n + 1, v if top is None else max(top, v))
    return {k: (a, round(b, 2), n, t) for k, (a, b, n, t) in out.items()}


def test_batches_out_of_order_equal_one_rollup(spark, scratch):
    import datetime
    rng = random.Random(1)
    days = [datetime.date(2024, 1, d) for d in (1, 2, 3)] + [None]
    rows = [(i, rng.choice(days), rng.choice(["A", "B", None]), rng.randint(0, 500) / 100) for i in range(300)]
    rng.shuffle(rows)
    path = f"{scratch}/state"
    for number in range(3):
        assert _merge(_rows(spark, rows[number * 100:(number + 1) * 100]), number, path) is not None
        assert _merge(_rows(spark, rows[number * 100:(number + 1) * 100]), number, path) is None        # tried again after it was there
    assert _state(spark, path) == _brute(rows)
    one = live.read_rollup(spark, path, day="2024-01-02").collect()
    assert {r.sym for r in one} == {"A", "B", None} and {str(r.day) for r in one} == {"2024-01-02"}


def test_only_the_days_of_a_batch_are_read_and_written(spark, scratch):
    import datetime
    path = f"{scratch}/state"
    days = [datetime.date(2024, 1, d) for d in range(1, 21)]
    _merge(_rows(spark, [(i, d, "A", 1.0) for i, d in enumerate(days)]), 0, path)
    before = {r.file for r in generations.manifest(spark, path, 0).collect()}
    assert _merge(_rows(spark, [(99, days[4], "A", 2.0), (100, datetime.date(2024, 3, 1), "B", 1.0)]), 1, path) == 1
    after = {r.file for r in generations.manifest(spark, path, 1).collect()}
    assert len(before & after) == len(before) - 1
    assert _state(spark, path)[days[4], "A"] == (2.0, 3.0, 2, 2.0)


def test_a_batch_that_died_before_the_pointer_counts_once(spark, scratch, monkeypatch):
    import datetime
    path, day = f"{scratch}/state", datetime.date(2024, 1, 1)
    _merge(_rows(spark, [(1, day, "A", 1.0)]), 0, path)
    real = generations._write

    def dies(fs, file, text, overwrite=False):
        if "CURRENT" in file.toString():
            raise RuntimeError("died")
        real(fs, file, text, overwrite)
    monkeypatch.setattr(generations, "_write", dies)
    with pytest.raises(RuntimeError):
        _merge(_rows(spark, [(2, day, "A", 5.0)]), 1, path)
    monkeypatch.undo()
    assert _state(spark, path)[day, "A"] == (1.0, 1.0, 1, 1.0)
    assert _merge(_rows(spark, [(2, day, "A", 5.0)]), 1, path) == 1
    assert _state(spark, path)[day, "A"] == (5.0, 6.0, 2, 5.0)


TEXTS = ["plain", 'quo"te', "two\nlines", '"\n"', "\n\n", "", " blanks ", "comma, and\r\nreturn", '""', "last\n", "ä漢" * 40, "x\n" * 200, '"' * 7 + "\n", None]


@pytest.mark.parametrize("size", [64, 1000])
def test_one_csv_file_read_in_many_ranges(spark, scratch, size):
    rng = random.Random(size)
    rows = [(i, rng.choice(TEXTS), rng.choice(TEXTS)) for i in range(400)]
    df = spark.createDataFrame(rows, "i int, a string, b string")
    sinks.csv_export(df, f"{scratch}/csv", single_file=True)
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    kept = [spark.conf.get(n) for n in names]
    try:
        for n, v in zip(names, (size, 1)):
            spark.conf.set(n, v)
        back = sources.csv_import_split(spark, f"{scratch}/csv", df.schema)
        ranges = spark.read.option("lineSep", "\n").text(f"{scratch}/csv").select("_metadata.file_block_start").distinct().count()
        assert ranges > 20
        assert sorted(map(tuple, back.collect())) == sorted(rows)
    finally:
        for n, v in zip(names, kept):
            spark.conf.set(n, v)


def test_csv_records_of_several_files_and_of_none(spark, scratch):
    df = spark.createDataFrame([(i, f"text\n{i}") for i in range(50)], "i int, a string")
    sinks.csv_export(df.repartition(5), f"{scratch}/csv")
    assert sorted(map(tuple, sources.csv_import_split(spark, f"{scratch}/csv", "i int, a string").collect())) == [(i, f"text\n{i}") for i in range(50)]
    assert sources.csv_records(spark, f"{scratch}/csv", header=False).count() == 55
    sinks.csv_export(df.limit(0), f"{scratch}/empty")
    assert sources.csv_import_split(spark, f"{scratch}/empty", "i int, a string").collect() == []
