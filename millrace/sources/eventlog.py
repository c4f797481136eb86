"""Spark event logs: one JSON object a line, one folder or file an application."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

EVENT_SCHEMA = """
  `Event` string, `Timestamp` long, `Stage ID` long, `executionId` long, `physicalPlanDescription` string,
  `Stage Info` struct<`Stage ID`: long, `Stage Name`: string>,
  `Task Info` struct<`Task ID`: long, `Launch Time`: long, `Finish Time`: long>,
  `Task Metrics` struct<`Shuffle Read Metrics`: struct<
    `Remote Bytes Read`: long, `Local Bytes Read`: long, `Total Records Read`: long>>"""


def read_event_logs(spark: SparkSession, path: str) -> DataFrame:
    """All events below a folder of logs; ``app`` is the log's own name.

    A log is a file, or a rolling folder (``eventlog_v2_<app>``), or an ``app=<name>`` folder.
    """
    place = F.col("_metadata.file_path")
    folder = F.regexp_extract(place, r"/(?:eventlog_v2_|app=)([^/]+)/", 1)
    return (spark.read.schema(EVENT_SCHEMA).option("recursiveFileLookup", "true").json(path)
            .withColumn("app", F.when(folder != "", folder)
                        .otherwise(F.regexp_extract(place, r"/([^/]+?)(?:\.[a-z0-9]+)?$", 1))))
