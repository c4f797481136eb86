"""Summary of a request log: ``HH:MM:SS  200  <version> <pod> <n>ms`` or ``HH:MM:SS  ERR  <code>``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

ANSWERED = r"^\d\d:\d\d:\d\d\s+200\s+\S+\s+\S+\s+\d+ms\s*$"
FAILED = r"^\d\d:\d\d:\d\d\s+ERR\s+\S+\s*$"


def parse_requests(lines: DataFrame) -> DataFrame:
    """(clock, answered, version, pod, ms, code, rejected): a line of another shape is kept whole in ``rejected``,
    with nothing else, so that input = answered + failed + rejected."""
    field, answered, failed = F.split("value", r"\s+"), F.col("value").rlike(ANSWERED), F.col("value").rlike(FAILED)
    known = answered | failed
    return lines.select(
        F.when(known, F.get(field, 0)).alias("clock"), F.when(known, answered).alias("answered"),
        F.when(answered, F.get(field, 2)).alias("version"), F.when(answered, F.get(field, 3)).alias("pod"),
        F.when(answered, F.regexp_extract(F.get(field, 4), r"^(\d+)ms", 1).cast("long")).alias("ms"),
        F.when(failed, F.get(field, 2)).alias("code"), F.when(~known, F.col("value")).alias("rejected"))


def dead_letters(requests: DataFrame) -> DataFrame:
    """The lines that are no requests, each with the number of times it came."""
    return requests.where("rejected IS NOT NULL").groupBy("rejected").agg(F.count(F.lit(1)).alias("times"))


def _counts() -> list[Column]:
    return [F.count_if("answered").alias("answered"), F.count_if(~F.col("answered")).alias("failed"),
            F.count("rejected").alias("rejected")]


def totals(requests: DataFrame) -> DataFrame:
    return requests.agg(F.count(F.lit(1)).alias("lines"), *_counts())


def by_pod(requests: DataFrame) -> DataFrame:
    """Answers and latency by version and pod; failures and rejected lines in a row of their own, without a pod."""
    return requests.groupBy("version", "pod").agg(*_counts(), F.avg("ms").alias("mean_ms"), F.max("ms").alias("max_ms"))
