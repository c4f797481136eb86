"""Aggregations and windows. Every one shuffles partial results, never a raw group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from millrace.functions.scalars import money_sum


def count_and_sum(df: DataFrame, by: str | Column, amount: str) -> DataFrame:
    return df.groupBy(by).agg(F.count(F.lit(1)).alias("n"), money_sum(amount).alias("total"))


def key_shares(df: DataFrame, key: str, top: int | None = None) -> DataFrame:
    """Rows and share of all rows by key. The total is a scalar, not an unpartitioned window."""
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").cast("double").alias("total"))
    shares = counts.withColumn("share", F.col("n") / total.scalar())
    if top is None:
        return shares
    return shares.orderBy(F.desc("n"), key).limit(top)


def duplicate_keys(df: DataFrame, key: str, top: int = 5) -> DataFrame:
    return (df.groupBy(key).agg(F.count(F.lit(1)).alias("times")).where("times > 1")
            .orderBy(F.desc("times"), key).limit(top))


TEXT_VALUES = 100_000  # most distinct values that are joined to one text


def ordered_distinct_text(value: str | Column, separator: str = ",", most: int = TEXT_VALUES) -> Column:
    """Distinct values in order as one text; NULL when there are none.

    The values of a group are one cell of the result; a group with more than ``most`` fails the job.
    """
    held = F.collect_set(value)
    refused = F.raise_error(F.lit(f"more than {most} distinct values for one text")).cast("string")
    return (F.when(F.size(held) > most, refused)
            .when(F.size(held) > 0, F.array_join(F.array_sort(held), separator)))


def row_of_largest(df: DataFrame, by: list[str], largest: str, first_by: list[str]) -> DataFrame:
    """The row with the largest value in each group; ties go to the smallest ``first_by``."""
    rest = [c for c in df.columns if c not in by]
    # First one row for each value, then the value: any type that has an order will do.
    firsts = df.where(F.col(largest).isNotNull()).groupBy(*by, F.col(largest).alias("_largest")).agg(
        F.min_by(F.struct(*rest), F.struct(*first_by)).alias("_row"))
    picked = firsts.groupBy(*by).agg(F.max_by("_row", "_largest").alias("_row"))
    return picked.select(*by, *[F.col(f"_row.{c}").alias(c) for c in rest])


def trailing_mean(daily: DataFrame, series: list[str], day: str, value: str,
                  days: int = 7, alias: str = "trailing_mean") -> DataFrame:
    """Mean of the earlier ``days`` calendar days, the day itself left out.

    ``daily`` holds one row a day and series, so a window holds days, not raw rows.
    """
    position = F.datediff(F.col(day), F.lit("1970-01-01").cast("date"))
    frame = Window.partitionBy(*series).orderBy(position).rangeBetween(-days, -1)
    return daily.withColumn(alias, F.avg(value).over(frame))


def range_number(value: str, bounds: list) -> Column:
    """How many of the sorted ``bounds`` are at most the value, by a binary search."""
    if not bounds:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << k) for k in range(len(bounds).bit_length() - 1, -1, -1)])
    array = F.array(*[F.lit(b) for b in bounds])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(
        (at + step <= len(bounds)) & (F.element_at(array, F.least(at + step, F.lit(len(bounds)))) <= F.col(value)), at + step).otherwise(at))
    return F.coalesce(found, F.lit(0))  # never null, so a join adds no condition and both its sides stay the same


def ranked_values(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """One row for each distinct value of a group: ``copies``, ``before`` (rows with a
    smaller value) and ``group_rows``.

    The distinct values, numbers or times, are cut into ranges, so that a hot group is spread over
    many tasks, and the number of rows in earlier ranges is added to the position inside the
    range. Where ranges begin is fixed beforehand, by quantiles of all distinct values: every
    read and every task that is redone sees the same ranges, and nothing has to be stored.
    """
    return ranked_counts(df.where(F.col(value).isNotNull()).groupBy(*by, value).agg(F.count(F.lit(1)).alias("copies")), by, value)


def ranked_counts(counts: DataFrame, by: list[str], value: str) -> DataFrame:
    """``ranked_values`` of distinct values whose ``copies`` are already counted."""
    # the keys as one struct: equal also where a key is NULL, and one partitioning serves
    # the window and the join
    group = F.struct(*by).alias("_group")
    n = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = counts.agg(F.percentile_approx(value, [k / n for k in range(1, n)] or [0.5], 10 * n)).first()[0]
    ranges = counts.select(group, value, "copies", range_number(value, sorted({c for c in cuts or [] if c == c})).alias("_range"))
    earlier_ranges = Window.partitionBy("_group").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranges.groupBy("_group", "_range").agg(F.sum("copies").alias("_rows"))
               .withColumn("_offset", F.coalesce(F.sum("_rows").over(earlier_ranges), F.lit(0)))
               .withColumn("group_rows", F.sum("_rows").over(Window.partitionBy("_group"))).drop("_rows"))
    inside = (Window.partitionBy("_group", "_range").orderBy(value)
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = ranges.withColumn("_inside", F.coalesce(F.sum("copies").over(inside), F.lit(0)))
    return placed.join(offsets, ["_group", "_range"]).select(
        "_group.*", value, "copies", (F.col("_inside") + F.col("_offset")).alias("before"), "group_rows")


def exclusive_quartiles(df: DataFrame, by: list[str], value: str) -> DataFrame:
    """n, min, p25, median, p75 and max by group, quartiles at position i(n+1)/4.

    A group of one repeats its value; a group of two extrapolates, as the rule says.
    """
    ranked = ranked_values(df, by, value)
    n = F.col("group_rows")
    aggs = [F.first("group_rows").alias("n"), F.min(value).alias("min"), F.max(value).alias("max")]
    for i in (1, 2, 3):
        low = F.greatest(F.lit(1), F.least(F.floor(F.lit(i) * (n + 1) / 4).cast("long"), n - 1))
        for name, rank in ((f"_low{i}", low - 1), (f"_high{i}", low)):
            rank = F.least(rank, n - 1)
            here = (F.col("before") <= rank) & (rank < F.col("before") + F.col("copies"))
            aggs.append(F.max(F.when(here, F.col(value))).alias(name))
    picked = ranked.groupBy(*by).agg(*aggs)
    m = F.col("n")

    def quartile(i):
        low = F.greatest(F.lit(1), F.least(F.floor(F.lit(i) * (m + 1) / 4).cast("long"), m - 1))
        delta = F.lit(i) * (m + 1) - low * 4
        between = (F.col(f"_low{i}") * (4 - delta) + F.col(f"_high{i}") * delta) / 4
        return F.when(m == 1, F.col("min")).otherwise(between)

    return picked.select(*by, "n", "min", quartile(1).alias("p25"), quartile(2).alias("median"),
                         quartile(3).alias("p75"), "max")
