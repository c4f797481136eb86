"""Table metadata as rows: columns, partitions, and inline constants."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def columns_of(df: DataFrame) -> DataFrame:
    """(ordinal, column_name, data_type) from the schema alone; no data is read."""
    rows = [(i + 1, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "ordinal long, column_name string, data_type string")


def partitions_of(df: DataFrame, partition: str, pattern: str = "yyyyMMdd") -> DataFrame:
    """(partition_id, total_rows, last_modified_time) of a partitioned folder.

    Takes the frame as read: the file's own time is a hidden column of the scan.
    """
    return (df.groupBy(F.date_format(partition, pattern).alias("partition_id"))
            .agg(F.count(F.lit(1)).alias("total_rows"),
                 F.max("_metadata.file_modification_time").alias("last_modified_time")))


def inline_table(spark: SparkSession, fields: list[str], rows: list[tuple]) -> DataFrame:
    """A constant table from an array of structs."""
    structs = [F.struct(*[F.lit(v).alias(n) for n, v in zip(fields, row)]) for row in rows]
    return spark.range(1).select(F.inline(F.array(*structs)))
