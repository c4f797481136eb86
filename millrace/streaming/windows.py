"""Event-time windows of sales by store, with and without duplicates."""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from millrace.functions.scalars import money_sum

# What runs in workers travels with the query: executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _first_of_each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of the rows in a batch of rows that share a ``_sale``, the first."""
    for batch in batches:
        codes = batch.column(batch.schema.get_field_index("_sale")).dictionary_encode().indices
        yield batch.take(pa.array(np.sort(np.unique(np.asarray(codes), return_index=True)[1])))


def once_per_sale(sales: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Drop repeats of a producer's id. There is one state, an id for as long as the watermark delay.

    One id may be repeated very often. Its copies are first reduced where they are read, to one for each
    batch of rows that Spark hands over, without state and before the shuffle. Which copy stays
    does not matter to the result. A sale without an id repeats none: its message stands for it.
    """
    own = F.coalesce(F.concat(F.lit("s"), "sale_id"), F.concat(F.lit("m"), "message_id"))
    named = sales.withColumn("_sale", own)
    return (named.mapInArrow(_first_of_each, named.schema).withWatermark("ts", delay)
            .dropDuplicatesWithinWatermark(["_sale"]).drop("_sale"))


def window_totals(sales: DataFrame, length: str = "1 minute", delay: str | None = "0 seconds") -> DataFrame:
    """Sales and revenue by store and window; each window is emitted once, when it has closed.

    A record for a closed window is dropped. ``delay`` None keeps a watermark set before.
    """
    timed = sales.withWatermark("ts", delay) if delay is not None else sales
    return (timed.groupBy(F.window("ts", length).alias("w"), "store_id")
            .agg(F.count(F.lit(1)).alias("sales"), money_sum("total").alias("revenue"))
            .select(F.col("w.start").alias("window_start"), "store_id", "sales", "revenue",
                    F.lit("1").alias("pane")))


def totals_since(windows: DataFrame, since: str) -> DataFrame:
    """Sales, revenue and number of windows from a moment on."""
    return windows.where(F.col("window_start") >= F.lit(since).cast("timestamp")).agg(
        F.sum("sales").alias("sales"), money_sum("revenue").alias("revenue"),
        F.count_distinct("window_start").alias("windows"))


def around(windows: DataFrame, store: str, moment: str, minutes: int = 1) -> DataFrame:
    """The windows of one store that start within some minutes of a moment."""
    middle, band = F.lit(moment).cast("timestamp"), F.make_dt_interval(mins=F.lit(minutes))
    return windows.where((F.col("store_id") == store) & F.col("window_start").between(middle - band, middle + band))
