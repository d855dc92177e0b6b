"""JSON messages: good rows and rejects, batch and stream."""

import os

from livetables.operators import feeds
from livetables.streaming import json_feed

SCHEMA = "flight string, alt int, note string"


def _messages(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


CASES = [
    ('{"flight": "UA1", "alt": 3000, "note": "pilot\'s note"}', None),      # apostrophe is data
    ('{"flight": "UA2", "alt": 1200}', None),                                 # missing key -> NULL
    ('{"flight": "UA3", "alt": ', "not a JSON object"),                       # broken document
    ('{"flight": "UA4", "alt": "high"}', "field of the wrong type: alt"),
    ('{"flight": "UA5", "alt": 10, "speed": 400}', "unknown field: speed"),
    ('[1, 2]', "not a JSON object"),
    (None, "empty message"),
    ('{"flight": "UA6"} trailing', "not a JSON object"),
    ('{"flight": "UA7", "alt": 1, "alt": 2}', "repeated field"),
    ('{"flight": "UA8", "alt": 1.5}', "field of the wrong type: alt"),
]


def test_split_good_and_rejects(spark):
    df = _messages(spark, [c[0] for c in CASES])
    parsed = feeds.parse_messages(df, SCHEMA).collect()
    reasons = {r["__message"]: r.reject_reason for r in parsed}
    for text, reason in CASES:
        assert reasons[text] == reason, text
    good, rejects = feeds.json_ingest(df, SCHEMA)
    assert sorted(good.collect()) == [("UA1", 3000, "pilot's note"), ("UA2", 1200, None)]
    assert rejects.count() == 8
    assert rejects.columns == ["value", "reject_reason"]


def test_unknown_keys_allowed_when_asked(spark):
    df = _messages(spark, ['{"flight": "UA5", "alt": 10, "speed": 400}'])
    good, rejects = feeds.json_ingest(df, SCHEMA, reject_unknown_keys=False)
    assert good.collect() == [("UA5", 10, None)] and rejects.count() == 0


def test_stream_from_folder_is_idempotent(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write("\n".join(c[0] for c in CASES if c[0] is not None) + "\n")
    good, rej, ckpt = f"{scratch}/good", f"{scratch}/rej", f"{scratch}/ckpt"
    msgs = json_feed.message_stream(spark, "text", src)
    q = json_feed.json_feed(spark, msgs, SCHEMA, good, rej, ckpt, available_now=True)
    json_feed.run_for(q, 300)
    assert spark.read.parquet(good).count() == 2
    assert spark.read.parquet(rej).count() == 7
    with open(f"{src}/b.json", "w") as f:
        f.write('{"flight": "UA9", "alt": 1}\n')
    q = json_feed.json_feed(spark, json_feed.message_stream(spark, "text", src), SCHEMA, good, rej,
                            ckpt, available_now=True)
    json_feed.run_for(q, 300)
    assert spark.read.parquet(good).drop("run_id", "batch_id").count() == 3


def test_run_for_stops_after_max_batches(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    with open(f"{src}/a.json", "w") as f:
        f.write('{"flight": "UA1", "alt": 1}\n')
    q = json_feed.json_feed(spark, json_feed.message_stream(spark, "text", src), SCHEMA,
                            f"{scratch}/good", f"{scratch}/rej", f"{scratch}/ckpt", trigger_seconds=0.5)
    json_feed.run_for(q, timeout_s=120, max_batches=1)
    assert not q.isActive
    assert spark.read.parquet(f"{scratch}/good").count() == 1


def test_message_cap_ends_a_session_and_the_next_goes_on(spark, scratch):
    src = f"{scratch}/in"
    os.makedirs(src)
    for i in range(10):
        with open(f"{src}/{i}.json", "w") as f:
            f.write("".join(f'{{"flight": "UA{i}{j}", "alt": {j}}}\n' for j in range(4)) + "broken\n")

    def session(limit):
        cap = json_feed.MessageCap(limit)
        msgs = json_feed.message_stream(spark, "text", src, max_files_per_trigger=1)
        q = json_feed.json_feed(spark, msgs, SCHEMA, f"{scratch}/good", f"{scratch}/rej", f"{scratch}/ckpt", trigger_seconds=0.1, cap=cap)
        json_feed.run_for(q, timeout_s=120, cap=cap, poll_s=0.2)
        assert not q.isActive
        return cap.taken, spark.read.parquet(f"{scratch}/good").count(), spark.read.parquet(f"{scratch}/rej").count()
    assert session(12) == (15, 12, 3)                  # five messages a file, good and bad ones count
    assert session(5) == (5, 16, 4)
    assert session(26) == (30, 40, 10)
    flights = [r.flight for r in spark.read.parquet(f"{scratch}/good").collect()]
    assert len(set(flights)) == 40


def test_nested_values_and_booleans(spark):
    cases = [('{"a": {"x": 1}}', None), ('{"a": {"x": "foo"}}', "a"), ('{"l": [1, 2]}', None), ('{"l": [1, "q"]}', "l"),
             ('{"b": true}', None), ('{"b": "yes"}', "b"), ('{"n": 12.0}', None), ('{"n": "12"}', None), ('{"a": null}', None),
             ('{"m": {"k": {"x": 1}}}', None), ('{"m": {"k": {"x": []}}}', "m")]
    schema = "a struct<x:int>, l array<int>, b boolean, n int, m map<string,struct<x:int>>"
    got = {r["__message"]: r.reject_reason for r in feeds.parse_messages(_messages(spark, [c for c, _ in cases]), schema).collect()}
    assert got == {c: f and f"field of the wrong type: {f}" for c, f in cases}
    good, _ = feeds.json_ingest(_messages(spark, ['{"a": {"x": 7}, "l": [1, null], "n": 12.0}']), schema)
    row = good.collect()[0]
    assert (row.a.x, row.l, row.n) == (7, [1, None], 12)


def test_building_a_plan_runs_no_job(spark):
    spark.sparkContext.setJobGroup("plan-only", "plan-only")
    shuffled = spark.range(100).repartition(3).selectExpr("concat('{\"alt\": ', id, '}') as value")
    feeds.parse_messages(shuffled, SCHEMA)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("plan-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
