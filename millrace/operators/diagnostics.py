"""Reports over Spark's own event logs: slow tasks, skew, run time, final plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from millrace.operators.aggregates import exclusive_quartiles, row_of_largest

# The least read size worth reporting, and the ratio that counts as skew.
MIN_LARGE_READ = 1_000_000
SKEW_RATIO = 5.0
SKEW_MIN_TASKS = 8


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0).cast("long"))


def tasks(log: DataFrame) -> DataFrame:
    """(app, stage, task, launch, seconds, read_bytes, read_records): one row a finished task."""
    read = "`Task Metrics`.`Shuffle Read Metrics`"
    return log.where(F.col("Event") == "SparkListenerTaskEnd").select(
        "app", F.col("`Stage ID`").alias("stage"), F.col("`Task Info`.`Task ID`").alias("task"),
        F.col("`Task Info`.`Launch Time`").alias("launch"),
        ((F.col("`Task Info`.`Finish Time`") - F.col("`Task Info`.`Launch Time`")) / 1000).alias("seconds"),
        (_zero(f"{read}.`Remote Bytes Read`") + _zero(f"{read}.`Local Bytes Read`")).alias("read_bytes"),
        _zero(f"{read}.`Total Records Read`").alias("read_records"))


def stage_names(log: DataFrame) -> DataFrame:
    """(app, stage, stage_name): what was submitted, without the place in the code."""
    submitted = log.where(F.col("Event") == "SparkListenerStageSubmitted")
    return submitted.groupBy("app", F.col("`Stage Info`.`Stage ID`").alias("stage")).agg(
        F.max(F.substring_index("`Stage Info`.`Stage Name`", " at ", 1)).alias("stage_name"))


def stage_summary(log: DataFrame) -> DataFrame:
    """Task times by stage with the ratio of the slowest to the median, and shuffle read."""
    done = tasks(log)
    times = exclusive_quartiles(done, ["app", "stage"], "seconds").withColumnRenamed("n", "tasks")
    reads = done.groupBy("app", "stage").agg((F.sum("read_bytes") / 1e6).alias("shuffle_mb"))
    return (times.join(reads, ["app", "stage"])
            .withColumn("max_to_median", F.coalesce(F.try_divide("max", "median"), F.lit(0.0))))


def largest_reads(log: DataFrame) -> DataFrame:
    """For each stage the task that read most from the shuffle, if that is more than a megabyte.

    Of equal reads the earliest task is shown.
    """
    wanted = tasks(log).select("app", "stage", "read_bytes", "read_records", "seconds", "launch", "task")
    top = row_of_largest(wanted, ["app", "stage"], "read_bytes", ["launch", "task"])
    return top.where(F.col("read_bytes") > MIN_LARGE_READ).drop("launch", "task")


def run_times(log: DataFrame) -> DataFrame:
    """Seconds from the start event to the end event of each application."""
    def at(event):
        return F.max(F.when(F.col("Event") == event, F.col("Timestamp")))

    return log.groupBy("app").agg(((at("SparkListenerApplicationEnd") - at("SparkListenerApplicationStart")) / 1000)
                                  .alias("seconds")).where("seconds IS NOT NULL")


def final_plans(log: DataFrame) -> DataFrame:
    """The plan that adaptive execution ran for the first execution of each application."""
    plan = F.col("physicalPlanDescription")
    final = log.where(F.col("Event").endswith("AdaptiveExecutionUpdate") & plan.contains("isFinalPlan=true"))
    first = final.groupBy("app").agg(F.min_by(plan, "executionId").alias("plan"))
    tree = F.split(F.split("plan", "== Physical Plan ==")[1], "\n\n")[0]
    kept = F.split(tree, r"[^\n]*== Initial Plan ==")[0]
    # Where a line is cut, and its greatest width.
    lines = F.transform(F.split(F.regexp_replace(kept, r"^\n+|\n+$", ""), "\n"), lambda line: F.substring(
        F.split(F.split(line, r", \[plan_id")[0], " Batched:")[0], 1, 110))
    return first.select("app", F.array_join(lines, "\n").alias("plan"))


def skewed_stages(summary: DataFrame, ratio: float = SKEW_RATIO, min_tasks: int = SKEW_MIN_TASKS) -> DataFrame:
    """Stages of many tasks whose slowest is far above the median."""
    return summary.where((F.col("tasks") >= min_tasks) & (F.col("max_to_median") > ratio))
