"""Sinks and table changes on plain files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


# Characters that Spark replaces by their code in the name of a partition folder. Fixed values.
ESCAPED = set(map(chr, range(1, 32))) | set("\x7f\"#%'*/:=?\\{[]^")
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
ROLLUP_ROWS = 1_000_000  # most rows of a rollup that is written as one file


def escaped(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in ESCAPED else c for c in text)


def partition_folder(spark: SparkSession, column: str, kind: T.DataType, value) -> str:
    """The folder in which Spark keeps the rows with this value of the partition column.

    Spark itself turns the value into the column's type and that into text, as its writer does: half a second past
    midnight ends in ``.5`` and ten to the sixteenth is ``1.0E16``. A value that the type cannot hold is refused.
    """
    if value is None:
        return f"{escaped(column)}={NULL_FOLDER}"
    text = spark.range(1).select(F.lit(value).try_cast(kind).cast("string")).first()[0]
    if text is None:
        raise ValueError(f"no partition of {column} ({kind.simpleString()}) can be {value!r}")
    return f"{escaped(column)}={escaped(text) or NULL_FOLDER}"


def only_partition(df: DataFrame, column: str, value) -> DataFrame:
    """The same rows; one that belongs to another partition fails the job."""
    belongs = F.col(column).eqNullSafe(F.lit(value).cast(df.schema[column].dataType))
    return df.where(F.when(belongs, True).otherwise(F.raise_error(F.lit(f"a row does not belong to {column}={value}")).cast("boolean")))


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def overwrite(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def replace_partition(df: DataFrame, path: str, column: str, value) -> None:
    """Replace one partition of a partitioned folder.

    The partition's own folder is overwritten, so a frame without rows clears it;
    dynamic partition overwrite would leave the old rows. Rows of other partitions are refused.
    Readers may see the gap between delete and write; ``VersionedTable`` has none.
    """
    folder = partition_folder(df.sparkSession, column, df.schema[column].dataType, value)
    only_partition(df, column, value).drop(column).write.mode("overwrite").parquet(f"{path}/{folder}")


def write_run_errors(df: DataFrame, root: str, run: str) -> None:
    """Errors of one run in a folder of their own; a second write of the run is refused."""
    df.write.mode("errorifexists").json(f"{root}/dt={run}")


def write_partitioned(df: DataFrame, path: str, partition: str, cluster: list[str]) -> None:
    """Partition folders, rows inside clustered for row-group skipping.

    The range shuffle splits a partition with many rows over several tasks.
    """
    (df.repartitionByRange(partition, *cluster).sortWithinPartitions(partition, *cluster)
     .write.mode("overwrite").partitionBy(partition).parquet(path))


def export_ordered(df: DataFrame, path: str, order: list[str]) -> None:
    """Files that are ordered inside and against each other.

    No number of files is given: adaptive execution joins small ranges, so that little
    data makes few files, none of them empty, and much data makes many.
    """
    (df.repartitionByRange(*order).sortWithinPartitions(*order)
     .write.mode("overwrite").parquet(path))


def export_rollup_csv(rollup: DataFrame, path: str, most: int = ROLLUP_ROWS) -> None:
    """A finished rollup (a few rows) as one CSV file with a header.

    The aggregation itself stays parallel; only its result is brought together. One of more than
    ``most`` rows is no rollup and fails the job; ``export_ordered`` writes many files.
    """
    one = rollup.repartition(1)  # in one partition the id is the row's number
    refused = F.raise_error(F.lit(f"more than {most} rows for one file")).cast("boolean")
    (one.where(F.when(F.monotonically_increasing_id() < most, True).otherwise(refused))
     .write.mode("overwrite").option("header", True).csv(path))


def read_day_range(spark: SparkSession, path: str, column: str, low, high) -> DataFrame:
    """The only way to read this folder: a partition range is required."""
    if low is None or high is None:
        raise ValueError(f"cannot read {path} without a range of {column}")
    return spark.read.parquet(path).where(F.col(column).between(F.lit(low), F.lit(high)))
