"""How many logical bytes a scan would read.

Widths follow the published pricing rule of hosted warehouses: numbers and times
8 bytes, decimals 16, booleans 1, text 2 plus its UTF-8 length, NULL nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T


def value_width(name: str, data_type: T.DataType) -> Column:
    """Bytes of one value as a column expression; a nested value counts what it holds."""
    return _width(F.col(name), data_type, name)


def _width(c: Column, data_type: T.DataType, name: str) -> Column:
    none = F.lit(0).cast("long")

    def all_of(values, element):
        return F.aggregate(values, none, lambda so_far, v: so_far + _width(v, element, name))

    if isinstance(data_type, T.ArrayType):
        width = all_of(c, data_type.elementType)
    elif isinstance(data_type, T.MapType):
        width = all_of(F.map_keys(c), data_type.keyType) + all_of(F.map_values(c), data_type.valueType)
    elif isinstance(data_type, T.StructType):
        width = sum((_width(c[f.name], f.dataType, name) for f in data_type.fields), none)
    elif isinstance(data_type, T.StringType):
        width = F.octet_length(c) + 2
    elif isinstance(data_type, T.BinaryType):
        width = F.octet_length(c) + 2
    elif isinstance(data_type, T.DecimalType):
        width = F.lit(16)
    elif isinstance(data_type, T.BooleanType):
        width = F.lit(1)
    elif isinstance(data_type, (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        width = F.lit(8)
    else:
        raise TypeError(f"no scan width is defined for {name} of type {data_type.simpleString()}")
    return F.when(c.isNotNull(), width.cast("long")).otherwise(none)


def _total(df: DataFrame, columns: list[str]) -> Column:
    """Sum over the rows of the widths of some columns; no columns cost nothing."""
    if not columns:
        return F.lit(0).cast("long")
    widths = [value_width(c, df.schema[c].dataType) for c in columns]
    row = widths[0]
    for w in widths[1:]:
        row = row + w
    return F.coalesce(F.sum(row), F.lit(0).cast("long"))


def scanned_bytes(df: DataFrame, columns: list[str], by: list[Column | str] | None = None) -> DataFrame:
    """One row (or one per group) with ``row_count`` and ``scan_bytes``, from one aggregation."""
    grouped = df.groupBy(*by) if by else df.groupBy()
    return grouped.agg(F.count(F.lit(1)).alias("row_count"), _total(df, columns).alias("scan_bytes"))


def bytes_by_column(df: DataFrame) -> DataFrame:
    """(column_name, scan_bytes) for every column, from one pass."""
    one = df.agg(*[_total(df, [f.name]).alias(f.name) for f in df.schema.fields])
    pairs = F.array(*[F.struct(F.lit(f.name).alias("column_name"), F.col(f.name).alias("scan_bytes"))
                      for f in df.schema.fields])
    return one.select(F.inline(pairs))


def stored_file_bytes(spark, *paths: str) -> DataFrame:
    """(file_path, file_bytes) of stored files; only metadata is read."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
            .select(F.col("path").alias("file_path"), F.col("length").alias("file_bytes")))
