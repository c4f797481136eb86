"""Starting, draining and watching streams; sinks that survive a replay."""

from __future__ import annotations

import datetime as dt
import json
import threading
from collections import defaultdict
from collections.abc import Callable
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.streaming.query import StreamingQuery

from millrace.streaming import messages as M

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROGRESS_SCHEMA = ("batch_id long, input_rows long, watermark timestamp, max_event_time timestamp, "
                   "behind_seconds double, dropped_rows long, state_rows long, usable_rows long, files_read long")
LAG_SCHEMA = ("batch_id long, input_rows long, watermark timestamp, max_event_time timestamp, behind_seconds double, "
              "dropped_rows long, state_rows long, backlog_rows long, backlog_files long")


def save_batch(out: str) -> Callable[[DataFrame, int], None]:
    """A batch writes the folder named by its id; when it is replayed it writes it again."""

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")

    return save


def save_with_dead_letters(out: str, parsed_to: Callable[[DataFrame], tuple[DataFrame, DataFrame]]):
    """Two sinks in one batch: usable rows and dead letters, each replayable.

    The batch is kept while both are written, so the source is read once.
    """

    def save(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            good, dead = parsed_to(batch)
            good.write.mode("overwrite").parquet(f"{out}/sales/_batch={batch_id}")
            dead.write.mode("overwrite").parquet(f"{out}/dead/_batch={batch_id}")
        finally:
            batch.unpersist()

    return save


def read_batches(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.option("basePath", out).parquet(f"{out}/_batch=*").drop("_batch")


@contextmanager
def _stream_conf(spark: SparkSession, state_partitions: int | None):
    """Settings a query takes over when it starts, put back afterwards.

    A stream keeps the number of state partitions it first started with, and adaptive
    execution does not resize them: by default there is one for each core of the cluster.
    """
    wanted = {STATE_STORE: ROCKSDB,
              "spark.sql.shuffle.partitions": str(state_partitions or spark.sparkContext.defaultParallelism)}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def start(stream: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str,
          state_partitions: int | None = None) -> StreamingQuery:
    """Run over everything that has arrived and stop; the next start goes on from there."""
    with _stream_conf(stream.sparkSession, state_partitions):
        return (stream.writeStream.foreachBatch(save).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def start_continuous(stream: DataFrame, save: Callable[[DataFrame, int], None], checkpoint: str,
                     every: str = "1 minute", state_partitions: int | None = None) -> StreamingQuery:
    """Run until it is stopped. ``stop`` cancels: open windows stay in the state, unemitted."""
    with _stream_conf(stream.sparkSession, state_partitions):
        return (stream.writeStream.foreachBatch(save).outputMode("append")
                .option("checkpointLocation", checkpoint).trigger(processingTime=every).start())


def progress_row(p: dict) -> tuple:
    """Lag of a batch: how far the watermark trails the newest event, and what it dropped as late.

    Dropped are counted here as Spark does, after rows have been added up by task; ``lag_report`` counts the rows.
    """
    def moment(text):
        return dt.datetime.fromisoformat(text.replace("Z", "+00:00")) if text else None

    times = p.get("eventTime") or {}
    watermark, newest = moment(times.get("watermark")), moment(times.get("max"))
    behind = (newest - watermark).total_seconds() if watermark and newest else None
    state = p.get("stateOperators") or []
    return (p["batchId"], p["numInputRows"], watermark, newest, behind,
            sum(s["numRowsDroppedByWatermark"] for s in state), sum(s["numRowsTotal"] for s in state),
            (p.get("observedMetrics", {}).get("usable") or {}).get("rows"), (p.get("observedMetrics", {}).get("feed") or {}).get("files"))


class Progress(StreamingQueryListener):
    """One small row for every batch of the streams started while it listens, however many there are.

    A query object itself remembers its last hundred batches only. The rows of a query that has ended
    are handed over once and then forgotten.
    """

    def __init__(self):
        self._rows, self._ended = defaultdict(list), defaultdict(threading.Event)

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        self._rows[str(event.progress.runId)].append(progress_row(json.loads(event.progress.json)))

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def rows(self, query: StreamingQuery, timeout: float = 60) -> list[tuple]:
        """All batches of a query that has ended; events come in order and the end comes last."""
        if not self._ended[str(query.runId)].wait(timeout):
            raise TimeoutError("the end of the stream was not reported")
        self._ended.pop(str(query.runId))
        return self._rows.pop(str(query.runId), [])


@contextmanager
def progress(spark: SparkSession):
    listener = Progress()
    spark.streams.addListener(listener)
    try:
        yield listener
    finally:
        spark.streams.removeListener(listener)


def progress_report(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, PROGRESS_SCHEMA)


def watched_feed(spark: SparkSession, inbox: str, files_per_batch: int = 10_000) -> DataFrame:
    """The feed, with the number of files of each batch among its progress."""
    feed = M.read_feed(spark, inbox, files_per_batch).select("*", F.col("_metadata.file_path").alias("_file"))
    return feed.observe("feed", F.size(F.collect_set("_file")).alias("files")).drop("_file")


def watched_rows(rows: DataFrame) -> DataFrame:
    """The same rows, with their number among the progress of each batch."""
    return rows.observe("usable", F.count(F.lit(1)).alias("rows"))


def lag_report(spark: SparkSession, rows: list[tuple], inbox: str, out: str, checkpoint: str, counted: str) -> DataFrame:
    """Lag, dropped rows and backlog of each batch of a watched stream that counts rows by window.

    What a batch dropped are the usable rows that went neither into the windows it emitted (``counted`` holds
    their rows) nor into those that stay open, which the state itself tells. The backlog is what has arrived by
    now and was not read by the end of the batch.
    """
    def held(batch: int) -> DataFrame:
        state = spark.read.format("statestore").option("batchId", batch).load(checkpoint)
        return state.agg(F.lit(batch).cast("long").alias("batch"), F.sum(F.col("value")["count"]).alias("n"))

    rows = sorted(rows)
    emitted, open_rows = {}, {}
    if rows:
        stored = spark.read.option("basePath", out).parquet(f"{out}/_batch=*")
        emitted = {r["_batch"]: r["n"] for r in stored.groupBy("_batch").agg(F.sum(counted).alias("n")).collect()}
        open_rows = {r["batch"]: r["n"] for r in reduce(DataFrame.unionByName, [held(r[0]) for r in rows]).collect()}
    arrived = spark.read.text(inbox).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("_metadata.file_path").alias("files")).first()
    report, before, left_rows, left_files = [], 0, arrived["rows"], arrived["files"]
    for batch, read, watermark, newest, behind, _, state_rows, usable, files in rows:
        now = open_rows.get(batch) or 0
        dropped = (usable or 0) - (emitted.get(batch) or 0) - now + before
        before, left_rows, left_files = now, left_rows - read, left_files - (files or 0)
        report.append((batch, read, watermark, newest, behind, dropped, state_rows, left_rows, left_files))
    return spark.createDataFrame(report, LAG_SCHEMA)


def deliver(messages: DataFrame, inbox: str) -> None:
    """Let messages arrive in the folder a feed reads."""
    messages.write.mode("append").json(inbox)


def flush_record(spark: SparkSession, event_ts: str) -> DataFrame:
    """A message far past the last window. Spark closes open windows only when time moves on,
    so a drain ends with one; its own window never closes."""
    return spark.range(1).select(
        F.lit('{"store_id": "flush", "total": 0}').alias("body"),
        F.create_map(F.lit("event_ts"), F.lit(event_ts), F.lit("sale_id"), F.lit("flush")).alias("attributes"),
        F.lit("flush").alias("message_id"))
