"""Take a live channel of JSON messages into a table, rejects kept aside.

The source is any Spark streaming source that yields one message per row:
a folder of text files (one JSON document per line) or a message bus such as
Kafka (`source_format="kafka"` plus its options; the connector jar is the
user's). Each micro-batch is parsed once; good rows and rejects are written
to their own folders per (run_id, batch_id), so a retried batch overwrites
itself instead of adding rows twice.
"""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from livetables.operators.feeds import parse_messages, split_messages
from livetables.streaming.cdc_sync import batch_folder, run_id_for


def message_stream(spark: SparkSession, source_format: str = "text", path: str | None = None,
                   max_files_per_trigger: int | None = None, **options: str) -> DataFrame:
    """A stream with one string column `value` per message."""
    reader = spark.readStream.format(source_format).options(**options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = reader.load(path) if path else reader.load()
    return df.select(F.col("value").cast("string").alias("value"))


class CapReached(Exception):
    """Ends the query of a capped session; `run_for` takes it as the normal end."""


class MessageCap:
    """Ends a feed session once it has taken `limit` messages: pass it to `json_feed` and to `run_for`.

    Messages are counted by the job that writes them. The batch that reaches the limit is
    the last one: the next doesn't begin, and what it would hold stays for the
    next session. So a session takes at least `limit` messages (if there are as many) and
    less than a batch more; bound batches at the source (`maxFilesPerTrigger`, `maxOffsetsPerTrigger`).
    """

    def __init__(self, limit: int):
        if limit < 1:
            raise ValueError("a limit of at least one message")
        self.limit, self.taken, self.last_batch = limit, 0, -1
        self.reached, self.stopping = threading.Event(), threading.Event()

    def add(self, messages: int, batch_id: int) -> None:
        self.taken, self.last_batch = self.taken + messages, batch_id
        if self.taken >= self.limit:
            self.reached.set()

    def hold(self) -> None:
        """Once the limit is reached, wait until the feed is being stopped and refuse the batch, which is not committed then."""
        if self.reached.is_set():
            self.stopping.wait()
            raise CapReached(f"{self.taken} messages taken, the limit is {self.limit}")


def ingest_batch(batch: DataFrame, batch_id: int, *, schema: str, good_path: str,
                 reject_path: str, run_id: str, reject_unknown_keys: bool = True, cap: MessageCap | None = None) -> None:
    if cap is not None:
        cap.hold()
    parsed = parse_messages(batch, schema, "value", reject_unknown_keys=reject_unknown_keys).persist()
    counted = Observation()
    try:
        good, _ = split_messages(parsed.observe(counted, F.count(F.lit(1)).alias("n")), schema)
        _, rejects = split_messages(parsed, schema)
        # merge small partitions: a batch leaves few files however many tasks parsed it
        good.hint("rebalance").write.mode("overwrite").parquet(batch_folder(good_path, run_id, batch_id))
        rejects.hint("rebalance").write.mode("overwrite").parquet(batch_folder(reject_path, run_id, batch_id))
        if cap is not None:
            cap.add(counted.get["n"], batch_id)
    finally:
        parsed.unpersist()


def json_feed(spark: SparkSession, messages: DataFrame, schema: str, good_path: str,
              reject_path: str, checkpoint: str, *, trigger_seconds: float = 1.0,
              available_now: bool = False, reject_unknown_keys: bool = True, cap: MessageCap | None = None) -> StreamingQuery:
    """Start the feed; stop it with `run_for`."""
    run_id = run_id_for(spark, checkpoint)

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, batch_id, schema=schema, good_path=good_path, reject_path=reject_path,
                     run_id=run_id, reject_unknown_keys=reject_unknown_keys, cap=cap)

    writer = messages.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    writer = (writer.trigger(availableNow=True) if available_now
              else writer.trigger(processingTime=f"{trigger_seconds} seconds"))
    return writer.start()


def run_for(query: StreamingQuery, timeout_s: float, max_batches: int | None = None,
            poll_s: float = 1.0, cap: MessageCap | None = None) -> None:
    """Let a stream run up to `timeout_s` seconds, `max_batches` completed micro-batches
    or the messages of `cap` (the reference's caps on a feed session), then stop it."""
    deadline = time.monotonic() + timeout_s
    try:
        while time.monotonic() < deadline:
            if query.awaitTermination(min(poll_s, max(0.0, deadline - time.monotonic()))):
                return
            progress = query.lastProgress
            if max_batches is not None and progress and progress.get("batchId", -1) + 1 >= max_batches:
                break
            # the batch that reached the cap has to be committed: progress is told after that
            if cap is not None and cap.reached.is_set() and progress and progress["batchId"] >= cap.last_batch:
                break
    finally:
        if cap is not None:
            cap.stopping.set()
    query.stop()
