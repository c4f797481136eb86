"""Reports over a job history with nested labels and row counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import clock


def has_label(key: str, value: str) -> Column:
    """Any element of ``labels`` is the given pair."""
    return F.exists("labels", lambda r: (r["key"] == key) & (r["value"] == value))


def label_value(key: str) -> Column:
    """The value of a label, NULL when the job does not carry it."""
    return F.get(F.filter("labels", lambda r: r["key"] == key), 0)["value"]


def spend_by_label(jobs: DataFrame, key: str, run: str | None = None) -> DataFrame:
    """Jobs, processed and billed MB for each value of a label; children are part of their parent."""
    own = jobs.where(F.col("parent_job_id").isNull())
    if run is not None:
        own = own.where(has_label("run", run))
    pairs = own.withColumn("label", F.explode("labels")).where(F.col("label.key") == key)
    mib = F.lit(2.0) ** 20
    return pairs.groupBy(F.col("label.value").alias(key)).agg(
        F.count(F.lit(1)).alias("jobs"),
        F.round(F.sum("total_bytes_processed") / mib, 1).alias("processed_mb"),
        F.round(F.coalesce(F.sum("total_bytes_billed"), F.lit(0)) / mib, 1).alias("billed_mb"))


def recovery_report(jobs: DataFrame, run: str) -> DataFrame:
    """For each step of a run: rows deleted and inserted by it and its children, and
    seconds after the first step.

    Row counts are first summed by the job they belong to, so a parent with very many
    children sends one row through the join.
    """
    steps = jobs.where(F.col("parent_job_id").isNull() & has_label("run", run)).select(
        F.col("job_id").alias("step_job"), label_value("pipeline").alias("step"),
        F.col("end_time").alias("step_end"))
    kind, stats = F.col("statement_type"), F.col("dml_statistics")
    changes = (jobs.withColumn("step_job", F.explode(F.array_distinct(F.array_compact(
                   F.array("job_id", "parent_job_id")))))
               .groupBy("step_job").agg(
                   F.sum(F.when(kind == "DELETE", stats["deleted_row_count"]).otherwise(0)).alias("deleted"),
                   F.sum(F.when(kind == "INSERT", stats["inserted_row_count"]).otherwise(0)).alias("inserted")))
    first = steps.agg(F.min("step_end").alias("first_end"))
    return steps.join(changes, "step_job").select(
        "step_job", "step", clock("step_end").alias("finished_utc"), "deleted", "inserted",
        F.timestamp_diff("SECOND", first.scalar(), F.col("step_end")).alias("s_after_first"))
