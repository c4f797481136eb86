"""Data checks on last night's partition, the alert rule, and the error budget."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from millrace.functions.scalars import (boundary_minutes, clock, greatest_strict, local_date, money_mean,
                                        on_day_at, text_or_null)
from millrace.operators.aggregates import trailing_mean
from millrace.sources.metadata import columns_of

# Thresholds of the four checks.
MAX_HOURS_OLD = 26
VOLUME_LOW, VOLUME_HIGH = 0.8, 1.2
NULL_RATE_MARGIN = 0.01
MEAN_MARGIN = 0.10
TRAILING_DAYS = 7

SIGNAL_COLUMNS = ["ord", "signal", "observed", "expected", "status"]


def moment(as_of: dt.datetime) -> Column:
    """A UTC moment as a column, independent of the driver's own time zone."""
    return F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")


def last_night(as_of: dt.datetime, zone: str) -> Column:
    return F.date_sub(local_date(moment(as_of), zone), 1)


def _status(ok: Column) -> Column:
    """GREEN only if the condition holds; NULL counts as RED."""
    return F.when(ok, "GREEN").otherwise("RED")


def freshness_check(partitions: DataFrame, as_of: dt.datetime, zone: str) -> DataFrame:
    """``partitions`` as from ``partitions_of``: newest day is yesterday and under 26 hours old."""
    filled = partitions.where((F.col("total_rows") > 0) & F.col("partition_id").startswith("2"))
    newest = filled.agg(F.max(F.to_date("partition_id", "yyyyMMdd")).alias("newest"),
                        F.timestamp_diff("HOUR", F.max("last_modified_time"), moment(as_of)).alias("hours"))
    return newest.select(
        F.lit(1).alias("ord"), F.lit("freshness").alias("signal"),
        text_or_null("newest %s, %d h old", F.col("newest").cast("string"), F.col("hours")).alias("observed"),
        F.lit(f"yesterday, < {MAX_HOURS_OLD} h").alias("expected"),
        _status((F.col("newest") >= last_night(as_of, zone)) & (F.col("hours") < MAX_HOURS_OLD)).alias("status"))


def contract_diff(df: DataFrame, contract: list[tuple[str, str]]) -> DataFrame:
    """One row: what is missing, extra or of another type, by column name; NULL when nothing is."""
    spark = df.sparkSession
    wanted = spark.createDataFrame(contract, "column_name string, wanted_type string")
    both = wanted.join(columns_of(df), "column_name", "full")
    remark = (F.when(F.col("data_type").isNull(), F.concat(F.lit("missing "), "column_name"))
              .when(F.col("wanted_type").isNull(), F.concat(F.lit("extra "), "column_name"))
              .when(F.col("data_type") != F.col("wanted_type"), F.concat(F.lit("type "), "column_name")))
    found = F.sort_array(F.collect_list(F.when(remark.isNotNull(), F.struct(
        F.col("column_name").alias("name"), remark.alias("remark")))))
    return both.agg(F.nullif(F.array_join(F.transform(found, lambda r: r["remark"]), ", "), F.lit(""))
                    .alias("diff"))


def schema_check(df: DataFrame, contract: list[tuple[str, str]]) -> DataFrame:
    return contract_diff(df, contract).select(
        F.lit(3).alias("ord"), F.lit("schema").alias("signal"),
        F.coalesce("diff", F.lit("matches contract")).alias("observed"),
        F.lit(f"{len(contract)} columns, typed").alias("expected"),
        _status(F.col("diff").isNull()).alias("status"))


def volume_and_distribution_checks(rows: DataFrame, day: str, value: str,
                                   as_of: dt.datetime, zone: str) -> DataFrame:
    """Both checks from one scan of eight days, reduced to one row before they are compared."""
    last = last_night(as_of, zone)
    daily = (rows.where(F.col(day).between(F.date_sub(last, TRAILING_DAYS), last)).groupBy(day).agg(
        F.count(F.lit(1)).alias("n"),
        (F.count_if(F.col(value).isNull()) / F.count(F.lit(1))).alias("null_rate"),
        money_mean(value).alias("mean")))
    is_last = F.col(day) == last
    both = daily.agg(
        F.coalesce(F.max(F.when(is_last, F.col("n"))), F.lit(0)).alias("l_n"),
        *[F.max(F.when(is_last, F.col(c))).alias(f"l_{c}") for c in ("null_rate", "mean")],
        *[F.avg(F.when(~is_last, F.col(c))).alias(f"t_{c}") for c in ("n", "null_rate", "mean")])
    share = F.try_divide(F.col("l_n"), F.col("t_n"))
    volume = (F.lit(2), F.lit("volume"),
              text_or_null("%d rows, %.0f%% of 7-day mean", F.col("l_n"), share * 100),
              F.lit("80 to 120%"), _status(share.between(VOLUME_LOW, VOLUME_HIGH)))
    drift = F.abs(F.try_divide(F.col("l_mean"), F.col("t_mean")) - 1)
    distribution = (
        F.lit(4), F.lit("distribution"),
        F.format_string("null %.1f%%, mean $%.2f", F.coalesce("l_null_rate", F.lit(0.0)) * 100,
                        F.coalesce("l_mean", F.lit(0.0))),
        text_or_null("null < %.1f%%, $%.2f ± 10%%", F.col("t_null_rate") * 100 + 1, F.col("t_mean")),
        _status((F.coalesce("l_null_rate", F.lit(1.0)) < F.col("t_null_rate") + NULL_RATE_MARGIN)
                & (drift <= MEAN_MARGIN)))
    return both.select(F.inline(F.array(*[
        F.struct(*[c.alias(n) for n, c in zip(SIGNAL_COLUMNS, check)]) for check in (volume, distribution)])))


def nightly_checks(rows: DataFrame, partitions: DataFrame, contract: list[tuple[str, str]],
                   day: str, value: str, as_of: dt.datetime, zone: str = "America/New_York") -> DataFrame:
    """The four checks as (signal, observed, expected, status), in fixed order."""
    report = (freshness_check(partitions, as_of, zone)
              .unionByName(volume_and_distribution_checks(rows, day, value, as_of, zone))
              .unionByName(schema_check(rows, contract)))
    return report.orderBy("ord").drop("ord")


def volume_by_series(rows: DataFrame, series: str, day: str) -> DataFrame:
    """The volume check for every series and day: rows against the mean of the seven days before."""
    daily = rows.groupBy(series, day).agg(F.count(F.lit(1)).alias("n"))
    share = F.try_divide(F.col("n"), F.col("trailing_mean"))
    return trailing_mean(daily, [series], day, "n").withColumn(
        "status", _status(share.between(VOLUME_LOW, VOLUME_HIGH)))


def check_log(report: DataFrame, at: Column) -> DataFrame:
    """Check results as log entries with a severity."""
    return report.withColumn("ts", at).withColumn(
        "severity", F.when(F.col("status") == "RED", "ERROR").otherwise("INFO"))


def red_alerts(log: DataFrame, window: str = "5 minutes", delay: str = "5 minutes") -> DataFrame:
    """Signals that were RED in a window, batch or stream; a stream waits ``delay`` for late entries.

    Every entry moves the watermark. The condition names the time, since Spark would move one that doesn't
    below the watermark, and then windows would close only when the next RED entry comes.
    """
    return ((log.withWatermark("ts", delay) if log.isStreaming else log)
            .where(F.when(F.col("ts").isNotNull(), F.col("status") == "RED"))
            .groupBy(F.window("ts", window).alias("w"), "signal").agg(F.count(F.lit(1)).alias("reds"))
            .where("reds > 0").select(F.col("w.start").alias("window_start"), "signal", "reds"))


def _due(sale_date: str, hour: int) -> Column:
    return on_day_at(F.date_add(sale_date, 1), hour)


def error_budget(runs: DataFrame, days: int | None = 30, due_hour: int = 6,
                 allowed: float = 0.01) -> DataFrame:
    """Bad minutes of two service levels against the budget, from one pass over the runs.

    The period is the last ``days`` sale dates up to the newest run; without ``days`` it is as
    long as there are runs.
    """
    if days:
        newest = runs.agg(F.max("sale_date"))
        runs = runs.where(F.col("sale_date") > F.date_sub(newest.scalar(), days))
    due = _due("sale_date", due_hour)
    late = greatest_strict(F.lit(0).cast("long"), boundary_minutes(F.col("finished_at"), due))
    wrong = F.coalesce(boundary_minutes(F.col("corrected_at"), greatest_strict(F.col("finished_at"), due)), F.lit(0))
    totals = runs.agg(F.count_if(F.col("state") == "DONE").alias("done"), F.sum(late).alias("late"),
                      F.sum(late + wrong).alias("bad"), F.count(F.lit(1)).alias("runs"))
    minutes = (F.lit(days) if days else F.col("runs")).cast("double") * 1440

    def level(name, bad):
        return F.struct(
            F.lit(name).alias("sli"), F.col("done").alias("nights_done"), F.col(bad).alias("bad_min"),
            (minutes * allowed).alias("budget_min"),
            F.round((1 - F.col(bad) / minutes) * 100, 2).alias("sli_pct"),
            F.round(F.col(bad) * 100 / (minutes * allowed), 1).alias("budget_used_pct"))

    return (totals.select(F.inline(F.array(level("job DONE by 06:00", "late"),
                                           level("data fresh and complete", "bad"))))
            .orderBy("bad_min"))


def bad_nights(runs: DataFrame, due: str = "06:00:00") -> DataFrame:
    """Nights that finished late on their own clock or had to be corrected."""
    return runs.where((clock("finished_at") > due) | F.col("corrected_at").isNotNull())
