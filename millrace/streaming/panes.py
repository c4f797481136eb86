"""Windows that stay open for late records and fire again for each of them.

Spark's watermark decides both when a window is complete and when a late record is dropped; here the two
are apart. A batch is added up by store and window before anything is shuffled, so a store with most of the
sales costs one row for each task and window, and is merged with the windows that are still open. Only records that
come after their window has closed are handled one by one. All of it is Spark's own aggregation and windowing.

The open windows and the newest event time are stored under the number of the batch that left them. A batch
that is replayed starts from what the batch before it left, and writes the same panes and the same state again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from millrace.functions.scalars import exact

# The codes of a pane that fired on time and of one that fired late.
ON_TIME, LATE = "1", "2"
OPEN_SCHEMA = "store_id string, start_ms long, sales long, millionths long, panes long"
KEY = ["store_id", "start_ms"]


def timed(sales: DataFrame, length_ms: int) -> DataFrame:
    """What panes need of a sale: its window, its order in it, its amount in whole millionths."""
    at = F.unix_millis("ts")
    return sales.select("store_id", (F.floor(at / length_ms) * length_ms).cast("long").alias("start_ms"), "ts", "message_id",
                        at.alias("at_ms"), (exact("total") * 1000000).cast("long").alias("millionths"))


def advance(batch: DataFrame, known: DataFrame, seen_ms: int | None, newest_ms: int | None, length_ms: int,
            lateness_ms: int) -> tuple[DataFrame, DataFrame]:
    """The panes that a batch of ``timed`` sales fires, and the windows that stay open after it.

    ``known`` are the windows that were open before it, ``seen_ms`` is the newest event time before it and
    ``newest_ms`` after it. A record is late if its window had closed by ``seen_ms``; one whose window had closed
    longer ago than the allowed lateness is dropped. Late records of one window fire in the order of time and message.
    """
    closed = F.col("start_ms") + length_ms
    long_ago = F.lit(False) if seen_ms is None else closed + lateness_ms <= seen_ms
    is_late = F.lit(False) if seen_ms is None else closed <= seen_ms
    alive = batch.where(~long_ago)
    late = alive.where(is_late)
    sums = [F.count(F.lit(1)).alias("sales"), F.sum("millionths").alias("millionths")]
    on_time = alive.where(~is_late).groupBy(*KEY).agg(*sums, F.lit(0).cast("long").alias("panes"))
    again = late.groupBy(*KEY).agg(*sums, F.count(F.lit(1)).alias("panes"))

    so_far = Window.partitionBy(*KEY).orderBy("ts", "message_id").rowsBetween(Window.unboundedPreceding, 0)
    before = known.select(*KEY, *[F.col(c).alias(f"_{c}") for c in ("sales", "millionths", "panes")])
    singly = (late.select(*KEY, F.count(F.lit(1)).over(so_far).alias("nth"), F.sum("millionths").over(so_far).alias("more"))
              .join(before, KEY, "left")
              .select(*KEY, (F.coalesce("_sales", F.lit(0)) + F.col("nth")).alias("sales"),
                      (F.coalesce("_millionths", F.lit(0)) + F.col("more")).alias("millionths"), F.lit(LATE).alias("pane"),
                      (F.coalesce("_panes", F.lit(0)) + F.col("nth") - 1).alias("pane_index")))

    now = known.unionByName(on_time).unionByName(again).groupBy(*KEY).agg(
        *[F.sum(c).alias(c) for c in ("sales", "millionths", "panes")])
    end = -1 if newest_ms is None else newest_ms
    fires = (F.col("panes") == 0) & (closed <= end)
    first = now.where(fires).select(*KEY, "sales", "millionths", F.lit(ON_TIME).alias("pane"), F.col("panes").alias("pane_index"))
    still_open = (now.withColumn("panes", F.col("panes") + fires.cast("long")).where(closed + lateness_ms > end)
                  .select(*KEY, "sales", "millionths", "panes"))
    panes = first.unionByName(singly).select(
        F.timestamp_millis("start_ms").alias("window_start"), "store_id", "sales",
        F.round(F.col("millionths") / 1000000, 2).alias("revenue"), "pane", "pane_index")
    return panes, still_open


def _left_by(spark: SparkSession, state: str, batch_id: int) -> tuple[DataFrame, int | None]:
    """Open windows and newest event time after a batch; there is none before the first."""
    if batch_id < 0:
        return spark.createDataFrame([], OPEN_SCHEMA), None
    seen = spark.read.schema("seen_ms long").parquet(f"{state}/seen/_batch={batch_id}").first()
    return spark.read.schema(OPEN_SCHEMA).parquet(f"{state}/windows/_batch={batch_id}"), seen["seen_ms"]


def save_late_panes(out: str, state: str, length_seconds: int = 60, lateness_seconds: int = 3600) -> Callable[[DataFrame, int], None]:
    """For a stream of usable sales: one pane when a window closes and one more, with running totals, for each late record.

    A window closes in the batch that brings a sale beyond its end. State is one row for each store and window that
    may still get late records. Panes are written by batch, as ``runs.save_batch`` does.
    """
    length_ms, lateness_ms = length_seconds * 1000, lateness_seconds * 1000

    def save(sales: DataFrame, batch_id: int) -> None:
        spark = sales.sparkSession
        known, seen = _left_by(spark, state, batch_id - 1)
        batch = timed(sales, length_ms).persist()
        try:
            newest = batch.agg(F.max("at_ms")).first()[0]
            newest = max((m for m in (seen, newest) if m is not None), default=None)
            panes, still_open = advance(batch, known, seen, newest, length_ms, lateness_ms)
            still_open.write.mode("overwrite").parquet(f"{state}/windows/_batch={batch_id}")
            spark.createDataFrame([(newest,)], "seen_ms long").coalesce(1).write.mode("overwrite").parquet(f"{state}/seen/_batch={batch_id}")
            panes.write.mode("overwrite").parquet(f"{out}/_batch={batch_id}")
        finally:
            batch.unpersist()

    return save


def last_pane(panes: DataFrame) -> DataFrame:
    """What a reader should show: the newest pane of each window and store."""
    return (panes.groupBy("window_start", "store_id")
            .agg(F.max_by(F.struct("sales", "revenue", "pane"), "pane_index").alias("_last"))
            .select("window_start", "store_id", "_last.sales", "_last.revenue", "_last.pane"))
