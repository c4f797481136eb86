"""Unions and the agreement of two results."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F


def labelled_union(branches: dict[str, DataFrame], label: str) -> DataFrame:
    """UNION ALL of branches, each carrying its own label."""
    return reduce(DataFrame.unionByName,
                  [df.withColumn(label, F.lit(name)) for name, df in branches.items()])


def disagreement(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs between two results: none when they agree.

    Both sides are counted before anything is shuffled, so equal rows travel once.
    """
    columns = left.columns
    sided = (left.withColumn("_copies", F.lit(1).cast("long"))
             .unionByName(right.withColumn("_copies", F.lit(-1).cast("long"))))
    return (sided.groupBy(*columns).agg(F.sum("_copies").alias("surplus"))
            .where("surplus <> 0"))
